"""SimHash, embedding near-duplicates and components against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ratesmith.llm import embedding_dedup, simhash
from ratesmith.llm.components import connected_components
from ratesmith.llm.queries import QUERIES

from .conftest import LONG, SF001, rows


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_union_find(spark, seed):
    rnd = random.Random(seed)
    links = [(rnd.randrange(120), rnd.randrange(120)) for _ in range(90)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(40)]
    want = components({n for link in links for n in link}, links)
    got = {r.node: r.root for r in connected_components(
        spark.createDataFrame(links, "a long, b long")).collect()}
    alone = {n for n in want if n not in got}
    assert all(want[n] == n and sum(v == n for v in want.values()) == 1 for n in alone)
    groups = {}
    for n, root in got.items():
        groups.setdefault(root, set()).add(want[n])
    assert all(len(v) == 1 for v in groups.values())
    assert len(groups) == len({want[n] for n in got})


def test_components_of_nothing(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def plain_fingerprint(text, width=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in words.replace("\t", " ").replace("\n", " ").replace("\x0b", " ")
             .replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    parts = [" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").collect()
    want = {r.doc_id: plain_fingerprint(r.text) for r in docs}
    got = {r.doc_id: r for r in QUERIES["op6_simhash_near_dedup"](spark, SF001).collect()}
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == want
    ids = sorted(want)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
             if bin(want[a] ^ want[b]).count("1") <= 4]
    assert {i: r.component_id for i, r in got.items()} == components(ids, links)


@pytest.mark.parametrize("block", [4096, 3])
def test_every_close_pair_is_connected(spark, block):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2 ** 63, 40, dtype=np.uint64)
    fps = set(base.tolist())
    for f in base.tolist():  # neighbours at 1 to 6 bits, and a chain
        for bits in range(1, 7):
            fps.add(f ^ sum(1 << int(b) for b in rng.choice(63, bits, replace=False)))
    fps = sorted(fps)
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    found = [(r.a, r.b) for r in simhash.fingerprint_links(table, 4, block).collect()]
    assert all(bin(a ^ b).count("1") for a, b in found)
    links = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if bin(a ^ b).count("1") <= 4]
    assert components(fps, found) == components(fps, links)


@pytest.mark.parametrize("block", [4096, 16])
def test_tasks_larger_than_held_rows(spark, block):
    """Fingerprints alike in two bands: one task is many times what is held."""
    rng = np.random.default_rng(7)
    fps = sorted(set((rng.integers(0, 2 ** 19, 1500, dtype=np.int64) << 44).tolist()) | {1, 1 << 43})
    table = spark.createDataFrame([(f,) for f in fps], "fp long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        found = [(r.a, r.b) for r in simhash.fingerprint_links(table, 4, block, rows_at_once=50).collect()]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    bits = np.array(fps)
    near = np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4
    links = [(fps[i], fps[j]) for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True)]
    assert components(fps, found) == components(fps, links)


def test_lower_bound_never_exceeds_hamming():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 2 ** 63, (2, 5000), dtype=np.uint64)
    lower = np.bitwise_count(simhash.embed(a) ^ simhash.embed(b))
    assert (lower <= np.bitwise_count(a ^ b)).all()


def test_simhash_odd_rows(spark, odd, clashing, empty):
    got = rows(simhash.near_duplicates(odd))
    assert got == rows(simhash.near_duplicates(clashing))
    by_id = {}
    for i, fp, comp in got:
        by_id.setdefault(i, []).append((fp, comp))
    assert [c for _, c in by_id[2]] == [1, 1] and len(by_id[None]) == 2
    assert {by_id[i][0] for i in (3, 4, 5)} == {(0, 3)}  # no words: fingerprint 0, linked
    assert by_id[6][0][0] == np.uint64(plain_fingerprint(LONG)).astype(np.int64)
    assert simhash.near_duplicates(empty).count() == 0


def test_vectors_match_brute_force(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(6, 16))
    x = np.concatenate([c + rng.normal(size=(12, 16)) * s for c, s in zip(centre, (.05, .1, .15, .2, .3, .4))])
    x = np.concatenate([x, x[:5], x[:3] * 2.5]).astype(np.float32)
    table = [(i, [float(v) for v in row]) for i, row in enumerate(x)]
    odd = [(900, None), (901, []), (902, [0.0] * 16), (903, [float("nan")] * 16), (904, [1.0] * 8),
           (905, [float("inf")] + [1.0] * 15), (906, [None] + [1.0] * 15)]
    df = spark.createDataFrame(table + odd, "vec_id long, embedding array<float>").withColumn(
        "rep", F.lit("x")).withColumn("tile", F.lit("x"))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    close = unit @ unit.T >= 0.95
    links = [(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if close[i, j]]
    comp = components(range(len(x)), links)
    for tile in (8192, 7):
        got = {r.vec_id: r for r in embedding_dedup.near_duplicate_vectors(df, tile_rows=tile).collect()}
        assert len(got) == len(table) + len(odd)
        for i in range(len(x)):
            assert got[i].n_links == close[i].sum() - 1, i
            assert got[i].component_id == comp[i] and got[i].kept == (comp[i] == i)
        assert all((got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True) for i, _ in odd)


def test_quantisation_bound_is_never_exceeded():
    rng = np.random.default_rng(0)
    x, y = (v / np.linalg.norm(v, axis=1)[:, None] for v in rng.normal(size=(2, 200, 48)))
    qx, sx, ex, _ = embedding_dedup.quantise(x)
    qy, sy, ey, ly = embedding_dedup.quantise(y)
    product = (qx.astype(float) @ qy.astype(float).T) * sx * sy
    assert (x @ y.T <= product + ly.max() * ex[:, None] + ey[None, :] + 1e-12).all()


def test_vectors_repeated_rows_and_empty(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0]), (None, [0.0, 2.0])],
                               "vec_id long, embedding array<double>")
    got = rows(embedding_dedup.near_duplicate_vectors(df))
    assert got == sorted([(1, 1, 1, True), (1, 1, 1, True), (2, 1, 2, True), (None, 1, 2, False)], key=repr)
    assert embedding_dedup.near_duplicate_vectors(df.limit(0)).count() == 0


def test_vector_query_covers_the_table(spark):
    got = QUERIES["op2_embedding_near_dedup"](spark, SF001)
    assert got.count() == spark.read.parquet(f"{SF001}/embeddings.parquet").count()
