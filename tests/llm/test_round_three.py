"""Decontamination, phrase collocations and the filter audit against brute force."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from ratesmith.llm import collocations, decontamination, filter_audit, word_arrays
from ratesmith.llm.hat_trie import HatTrie
from ratesmith.llm.queries import ORACLE_SQL, QUERIES

from .conftest import SCHEMA, SF001, rows

NEW = ["op11_benchmark_decontamination", "op12_phrase_collocations", "op13_filter_interaction_audit"]


@pytest.mark.parametrize("name", NEW)
def test_queries_match_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    got = QUERIES[name](spark, SF001)
    rel = con.sql(ORACLE_SQL[name])
    at = [list(rel.columns).index(c) for c in got.columns]
    assert rows(got) == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---------------------------------------------------------- decontamination

def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def brute_contamination(doc_rows, items, window):
    out = []
    grams = defaultdict(set)
    for item, text in items:
        ws = words_of(text)
        k = min(window, len(ws))
        for i in range(len(ws) - k + 1 if ws else 0):
            grams[tuple(ws[i:i + k])].add(item)
    for doc_id, text in doc_rows:
        ws = words_of(text)
        hit, found = set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(ws) - k + 1):
                if (g := tuple(ws[i:i + k])) in grams:
                    hit.update(range(i, i + k))
                    found |= grams[g]
        out.append((doc_id, len(ws), sorted(hit), sorted(str(f) for f in found if f is not None)))
    return sorted(out, key=repr)


def contamination_rows(df):
    return sorted(((r.doc_id, r.n_words, [i for s in r.spans for i in range(s.start, s.end)],
                    list(r["items"])) for r in df.collect()), key=repr)


BENCH = [
    (1, "one two three four five"), (2, "One, Two THREE four five six seven"), (2, "é😀 ü"),
    (3, "at"), (None, "word other word other word"), (4, None), (5, ""), (6, "..."), (1, "id at all"),
    (7, "other word other word other word other word other word other"), (7, "no such phrase here at any place at all ever"),
]


@pytest.fixture(scope="module")
def bench(spark):
    return spark.createDataFrame(BENCH, "item_id long, text string").withColumn("token", F.lit("x"))


def test_contamination_of_odd_rows(spark, odd, clashing, empty, bench):
    want = brute_contamination([(r.doc_id, r.text) for r in odd.collect()], BENCH, 10)
    assert contamination_rows(decontamination.contamination(odd, bench)) == want
    assert any(hit for _, _, hit, _ in want)
    assert contamination_rows(decontamination.contamination(clashing, bench)) == want
    assert decontamination.contamination(empty, bench).count() == 0
    none = decontamination.contamination(odd, bench.limit(0)).collect()
    assert len(none) == odd.count() and all(r.spans == [] and r["items"] == [] for r in none)


@pytest.mark.parametrize("window,shingle", [(4, 2), (3, 3), (6, 1)])
def test_contamination_of_random_texts(spark, window, shingle):
    rnd = random.Random(window)
    text = lambda n: " ".join(rnd.choice("abcd") + rnd.choice("xy") for _ in range(n))
    docs = [(i, text(rnd.randrange(60))) for i in range(80)]
    items = [(i % 25, text(rnd.randrange(9))) for i in range(40)]
    got = decontamination.contamination(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
        spark.createDataFrame(items, "item_id long, text string"), window=window, shingle=shingle)
    assert contamination_rows(got) == brute_contamination(docs, items, window)


def test_many_hits_of_one_text_are_parts(spark, bench, monkeypatch):
    monkeypatch.setattr(decontamination, "_ROWS", 16)
    docs = [(1, "at id at all " * 500), (2, "nothing")]
    got = decontamination.contamination(spark.createDataFrame(docs, "doc_id long, text string"), bench)
    assert contamination_rows(got) == brute_contamination(docs, BENCH, 10)


# ------------------------------------------------------------- collocations

def brute_collocations(texts, min_count, max_words=4, top=2000):
    counts = defaultdict(Counter)
    for lang, text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            ws = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, max_words + 1):
                for i in range(len(ws) - k + 1):
                    counts[lang or "und"][tuple(ws[i:i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        cands = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        held = defaultdict(int)
        for p, a in cands.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    held[p[i:i + k]] = max(held[p[i:i + k]], a)
        ranked = []
        for p, a in cands.items():
            if 100 * held[p] >= 80 * a:
                continue
            score, k = min((2_000_000 * a // (f[p[:j]] + f[p[j:]]), j) for j in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), " ".join(p), f[p[:k]], f[p[k:]]))
        for rank, (score, a, _, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase, -a, left, right, n, -score))
    return sorted(out, key=repr)


def test_collocations_of_odd_rows(odd, clashing, empty):
    want = brute_collocations([(r.lang, r.text) for r in odd.collect()], 2)
    assert len(want) > 5
    assert rows(collocations.collocations(odd, min_count=2)) == want
    assert rows(collocations.collocations(clashing, min_count=2)) == want
    assert collocations.collocations(empty).count() == 0
    assert rows(collocations.collocations(odd, min_count=2, top=3)) == brute_collocations(
        [(r.lang, r.text) for r in odd.collect()], 2, top=3)


@pytest.mark.parametrize("max_words", [2, 3, 4])
def test_collocations_of_random_texts(spark, max_words, monkeypatch):
    rnd = random.Random(max_words)
    text = lambda: "".join(rnd.choice(["a", "B", "Cé", "d😀", "the", "\x00"]) + rnd.choice(
        [" ", " ", "  ", "\t", ", ", "\n", "."]) for _ in range(rnd.randrange(90)))
    docs = [(rnd.choice(["en", "de", None]), text()) for _ in range(120)]
    monkeypatch.setattr(collocations, "_AT_ONCE", 64)
    got = collocations.collocations(spark.createDataFrame(docs, "lang string, text string").repartition(4),
                                    min_count=5, max_words=max_words)
    want = brute_collocations(docs, 5, max_words)
    assert rows(got) == want and len(want) > 5


def test_words_of_one_id_draw_ids_anew(spark, monkeypatch):
    """Seed 0 gives all words few ids; the vocabulary must notice."""
    honest = word_arrays.hash_words

    def poor(data, classes, seed=0):
        starts, ends, hashes = honest(data, classes, seed)
        return starts, ends, hashes % np.uint64(3) if seed == 0 else hashes

    monkeypatch.setattr(word_arrays, "hash_words", poor)
    texts = [("en", "a b c d e f g h a b"), ("de", "a b")]
    frame = spark.createDataFrame(texts, "lang string, text string")
    runs = [r for r in _local_word_runs(frame, 0)]
    assert len({r[2] for r in runs}) < len({r[:2] for r in runs}) == 10
    assert len({r[2] for r in _local_word_runs(frame, 1)}) == 10


def _local_word_runs(frame, seed):
    """The task function of the word count, run here so that the patched hash counts."""
    class Local:
        def mapInArrow(self, fn, _):  # noqa: N802
            return [tuple(r.values()) for b in fn(iter(frame.toArrow().select(["text", "lang"]).to_batches()))
                    for r in b.to_pylist()]
    return collocations._word_runs(Local(), seed)


@pytest.mark.parametrize("burst,spill", [(4, 20), (1000, 100000), (2, 1)])
def test_hat_trie_counts(burst, spill):
    rnd = np.random.default_rng(1)
    trie, want, got = HatTrie(2, burst, spill), Counter(), Counter()
    ids = np.array([5, 5 << 56, 5 << 56 | 1, 2**64 - 1, 0, 77, 78 << 40], np.uint64)
    spilled = 0
    for _ in range(20):
        columns = [rnd.choice(ids, 30), rnd.choice(ids, 30)]
        want.update(zip(*(c.tolist() for c in columns), strict=True))
        keys, at = trie.add(columns)
        assert keys == sorted(set(keys)) and all(
            k == b"".join(int(c[i]).to_bytes(8) for c in columns) for k, i in zip(keys, at, strict=True))
        for keys, counts in trie.overflow():
            spilled += 1
            assert sorted(map(tuple, keys.tolist())) == list(map(tuple, keys.tolist()))
            got.update(dict(zip(map(tuple, keys.tolist()), counts.tolist(), strict=True)))
    for keys, counts in trie.drain():
        got.update(dict(zip(map(tuple, keys.tolist()), counts.tolist(), strict=True)))
    assert got == want and trie.size == 0
    assert bool(spilled) == (spill < 1000)


def test_bitmap_holds_all_and_little_else(spark):
    rnd = np.random.default_rng(5)
    hashes = rnd.integers(0, 2**64, 70_000, np.uint64)
    table = spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "h long")
    bits = word_arrays.bitmap(table, "h")
    assert word_arrays.in_bitmap(bits, hashes).all()
    assert word_arrays.in_bitmap(bits, rnd.integers(0, 2**64, 100_000, np.uint64)).mean() < 0.01
    assert not word_arrays.in_bitmap(word_arrays.bitmap(table.limit(0), "h"), hashes).any()


def test_word_arrays_cut_long_texts(monkeypatch):
    monkeypatch.setattr(word_arrays, "BLOCK_BYTES", 7)
    classes = word_arrays.byte_classes(b" \n")
    text = "Ab cdefghijklmnop  q\nrs é😀 t".encode()
    starts, ends, hashes = word_arrays.hash_words(word_arrays.lowered(text), classes)
    words = [text[a:b].lower() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    assert words == text.lower().split()
    assert len(set(hashes.tolist())) == len(words)
    again = word_arrays.hash_words(word_arrays.lowered(b"q x cdefghijklmnop"), classes)[2]
    assert again[0] == hashes[2] and again[2] == hashes[1]


# ------------------------------------------------------------- filter audit

def brute_audit(doc_rows, labels):
    by_text = defaultdict(list)
    for doc_id, text, _ in doc_rows:
        if doc_id is not None:
            by_text[text or ""].append(doc_id)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    fails = []
    for doc_id, text, part in doc_rows:
        t = text or ""
        ws = re.findall(r"[^\x20\x09-\x0D]+", t)
        first = min(by_text[t], default=None)
        fails.append((part or "", doc_id, {
            "A": len(ws) < 50, "B": 100 * len(set(ws)) < 65 * len(ws),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), "D": bool(re.search("[#$%&*|]", t)),
            "E": first is not None and (doc_id is None or first < doc_id)}))
    out = []
    for part in {p for p, _, _ in fails}:
        mine = [(d, f) for p, d, f in fails if p == part]
        each, shapley = [], Counter()
        for order in itertools.permutations("ABCDE"):
            alive = mine
            for step, name in enumerate(order, 1):
                gone = [(d, f) for d, f in alive if f[name]]
                alive = [(d, f) for d, f in alive if not f[name]]
                shapley[name] += len(gone)
                each.append(("".join(order), step, len(alive), len(gone),
                             sum(f[name] and any(f[o] for o in order[:step - 1]) for _, f in mine),
                             sum(f[name] and sum(f.values()) == 1 for _, f in mine),
                             sum(d in good for d, _ in gone), sum(d in toxic for d, _ in gone), name))
        out += [(part, *e[:-1], shapley[e[-1]]) for e in each]
    return sorted(out, key=repr)


LABELS = [(1, 1, 0), (2, 0, 1), (2, 1, None), (3, None, None), (6, 1, 1), (None, 1, 1), (7, 0, 0), (7, 1, 0)]


def test_audit_of_odd_rows(spark, odd, clashing, empty):
    labels = spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int")
    more = spark.createDataFrame([
        (20, "WORD " * 60, "en", None, 1), (21, "Word$ " * 60, "en", "", 1), (None, "", "en", "a", 1),
        (19, "WORD " * 60, "en", "b", 1), (None, "id-less twice", "en", "z", 1),
        (None, "id-less twice", "en", "a", 1), (22, " ".join(f"w{i}" for i in range(70)), "en", "a", 1),
        (23, " ".join(f"w{i}" for i in range(70)), "en", "b", 1)], SCHEMA)
    docs = odd.union(more)
    want = brute_audit([(r.doc_id, r.text, r.source) for r in docs.collect()], LABELS)
    assert rows(filter_audit.audit(docs, labels)) == want
    assert rows(filter_audit.audit(clashing.withColumns({"mask": F.lit(1), "digest": F.lit("d")}), labels)) == \
        brute_audit([(r.doc_id, r.text, r.source) for r in odd.collect()], LABELS)
    assert filter_audit.audit(empty, labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).filter("good_lost > 0").count() == 0


def test_audit_of_random_texts(spark):
    rnd = random.Random(3)
    vocab = [f"w{i}" for i in range(80)] + ["AB", "x|y", "C"]
    texts = [" ".join(rnd.choices(vocab[:rnd.choice([10, 80, 83])], k=rnd.choice([20, 55, 70]))) for _ in range(60)]
    docs = [(i, rnd.choice(texts), "en", rnd.choice(["p", "q", None]), 1) for i in range(200)]
    labels = [(i, rnd.randrange(2), rnd.randrange(2)) for i in range(0, 200, 3)]
    got = filter_audit.audit(spark.createDataFrame(docs, SCHEMA).repartition(6),
                             spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    assert rows(got) == brute_audit([(d[0], d[1], d[3]) for d in docs], labels)
    assert math.factorial(5) * 5 * 3 == got.count()


def test_items_digest_of_nothing(spark):
    got = QUERIES["op11_benchmark_decontamination"](spark, SF001).filter("n_items = 0").first()
    assert got.items_sha256 == hashlib.sha256(b"").hexdigest() and not got.contaminated


def test_runs_hold_a_head_once_and_split_hot_words():
    """A run's phrases go by head, those of a hot word by ranges of the last word too."""
    from ratesmith.llm.collocations import HOT_BITS, _by_head
    rows = np.array([[1, 5], [1, 2**63 + 1], [7, 3], [7, 4], [7, 2**63]], np.uint64)
    batch = _by_head(rows, np.array([1, 2, 3, 4, 5], np.int64), np.array([7], np.uint64)).to_pydict()
    assert [int.from_bytes(h) for h in batch["head"]] == [1, 7, 7]
    assert batch["part"] == [0, 0, 2**(HOT_BITS - 1)]
    assert batch["last"] == [[5, -2**63 + 1], [3, 4], [-2**63]] and batch["n"] == [[1, 2], [3, 4], [5]]


def test_word_runs_cross_the_shuffle_without_ids(spark):
    """Ids do not compress, so merged words get them anew; the same as the texts' words have."""
    texts = spark.createDataFrame([("One two,one\tÜber", "en"), ("one two", "de"), ("", "en")], "text string, lang string")
    assert "key" not in collocations._word_runs(texts, 0).columns
    words, seed = collocations.vocabulary(texts)
    assert sorted((r.lang, r.word, r.n) for r in words.collect()) == [
        ("de", "one", 1), ("de", "two", 1), ("en", "one", 2), ("en", "two", 1), ("en", "Über", 1)]
    import pyarrow as pa
    batch = pa.RecordBatch.from_pylist([{"text": "one", "lang": "en"}])
    (found,) = collocations._word_ids(batch, seed)
    assert {bytes(r.key) for r in words.collect() if (r.lang, r.word) == ("en", "one")} == {int(found[3][0]).to_bytes(8)}
