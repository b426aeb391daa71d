"""SimHash near-duplicates through a segment-popcount embedding.

A text's fingerprint takes the majority of the 64 hash bits of its word
shingles.  To find fingerprints within ``max_bits`` of each other, a
fingerprint is mapped to the bit counts of its 2-bit segments.  The Manhattan
distance of two such vectors never exceeds the Hamming distance, so it is a
lower bound.  The 32 coordinates are cut into bands; if the whole distance is
at most ``max_bits``, some band has a distance of at most
``max_bits // bands``.  With three bands and four bits that is 1: a grid whose
cells are a band's integer points finds every such pair by looking into the
own cell and into those one step up in one coordinate (the cells one step
down are reached from the other side).  Pairs that meet in a cell are checked
by the whole Manhattan distance, then by the exact Hamming distance.

Equal fingerprints are one grid entry.  Cells of any size are cut into blocks
so that a task meets two blocks at a time, and a task returns a spanning
forest of the links it found, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.llm.components import connected_components
from ratesmith.llm.forest import join_links
from ratesmith.session import cut_lineage

SEED = 42
#: Shingles whose bits are unpacked at a time.
HASHES_AT_ONCE = 1 << 14
#: Two-bit segments of each of the three bands (22, 22 and 20 bits).
BANDS = ((0, 11), (11, 11), (22, 10))
#: Grid entries of a cell that one block holds, and pairs compared at a time.
BLOCK_ROWS, PAIRS_AT_ONCE = 4096, 1 << 20
#: Probes that meet a block, in blocks, and rows that a Python task holds
#: before it looks for links.
PROBE_BLOCKS, ROWS_AT_ONCE = 8, 1 << 17
_LOW = np.uint64(0x5555555555555555)


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """64-bit SimHash of a text; no words: 0.

    Letters A-Z are lower-cased, words are what spaces, tabs and line ends
    (0x09-0x0D) separate.  Shingles are joined by a space, repeats count; a
    text of fewer words is one shingle.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    width = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:len(words) - width]]).tolist()
    stops = (ends[width - 1:] - 1).tolist()
    total = len(starts)
    ones = np.zeros(64, np.int64)
    digest = xxhash.xxh64_digest
    for at in range(0, total, HASHES_AT_ONCE):
        packed = b"".join([digest(line[s:e], SEED) for s, e in zip(
            starts[at:at + HASHES_AT_ONCE], stops[at:at + HASHES_AT_ONCE], strict=True)])
        bits = np.unpackbits(np.frombuffer(packed, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle: int = 4, carry: Sequence[str] = ()) -> DataFrame:
    """Return doc_id and its fingerprint as a signed long (null text: 0), and
    the columns of ``carry``."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *carry)
    kept = ["doc_id", *carry]
    kinds = ", ".join(f"{c} {source.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch["text"]], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in kept), pa.array(fps.view(np.int64))], names=[*kept, "fp"])

    return source.mapInArrow(run, f"{kinds}, fp long")


def embed(fps: np.ndarray) -> np.ndarray:
    """Bit counts of the 32 two-bit segments, in unary (0: 00, 1: 01, 2: 11),
    so that the Manhattan distance is the bit count of an exclusive or."""
    one, other = fps & _LOW, (fps >> np.uint64(1)) & _LOW
    return (one | other) | ((one & other) << np.uint64(1))


def grid_entries(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(index of the fingerprint, cell, probe) of all grid entries.

    Each fingerprint has one home entry a band (probe false), and probes for
    the own cell and for those one step up in one coordinate.
    """
    unary = embed(fps)
    index, cells, probes = [], [], []
    rows = np.arange(len(fps))
    for band, (first, segments) in enumerate(BANDS):
        counts = np.stack([np.bitwise_count((unary >> np.uint64(2 * (first + k))) & np.uint64(3))
                           for k in range(segments)], axis=1).astype(np.int64)
        powers = 3 ** np.arange(segments, dtype=np.int64)
        home = counts @ powers + band * 3 ** 11
        for probe in (False, True):
            index.append(rows)
            cells.append(home)
            probes.append(np.full(len(rows), probe))
        up, k = np.nonzero(counts < 2)
        index.append(up)
        cells.append(home[up] + powers[k])
        probes.append(np.ones(len(up), bool))
    return np.concatenate(index), np.concatenate(cells), np.concatenate(probes)


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = batch["fp"].to_numpy()
        index, cells, probes = grid_entries(fps.view(np.uint64))
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells), pa.array(probes), pa.array(fps[index])], names=["cell", "probe", "fp"])


def _meet(task: np.ndarray, probe: np.ndarray, fps: np.ndarray, max_bits: int
          ) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (fingerprint, root) of the links between homes and
    probes of the same task; rows are sorted by task, homes first."""
    names, node = np.unique(fps, return_inverse=True)
    unary = embed(names.view(np.uint64))
    bits = names.view(np.uint64)
    label = np.arange(len(names))
    starts = np.flatnonzero(np.concatenate([[True], task[1:] != task[:-1]]))
    homes = np.add.reduceat(~probe, starts) if len(task) else np.zeros(0, int)
    group = np.cumsum(np.concatenate([[True], task[1:] != task[:-1]])) - 1
    asks = np.flatnonzero(probe & (homes[group] > 0))
    width = homes[group[asks]]
    upto = np.cumsum(width)
    at = 0
    while at < len(asks):
        done = upto[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(upto, done + PAIRS_AT_ONCE, "right")))
        w = width[at:end]
        right = np.repeat(asks[at:end], w)
        offset = np.arange(len(right)) - np.repeat(np.cumsum(w) - w, w)
        left = node[starts[group[right]] + offset]
        right = node[right]
        near = np.bitwise_count(unary[left] ^ unary[right]) <= max_bits
        left, right = left[near], right[near]
        near = (np.bitwise_count(bits[left] ^ bits[right]) <= max_bits) & (left != right)
        join_links(label, left[near], right[near])
        at = end
    hooked = np.flatnonzero(label != np.arange(len(names)))
    return names[hooked], names[label[hooked]]


def fingerprint_links(distinct: DataFrame, max_bits: int = 4,
                      block_rows: int = BLOCK_ROWS, rows_at_once: int = ROWS_AT_ONCE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints (column fp) within
    ``max_bits`` of each other; a forest per task, so some links of a larger
    group are left out, but none that its connection needs.  A cell's homes are
    cut into blocks of ``block_rows`` and its probes into such of PROBE_BLOCKS
    times that; a task larger than ``rows_at_once`` meets its probes in turns."""
    if not 0 <= max_bits // len(BANDS) <= 1:
        raise ValueError("the grid looks one step around a cell: max_bits 0 to 5")
    entries = distinct.select("fp").mapInArrow(_entries, "cell long, probe boolean, fp long")

    def blocks(rows: Column, size: int) -> Column:
        return F.greatest(F.ceil(F.count(F.when(rows, 1)) / size), F.lit(1)).cast("int")

    large = (entries.groupBy("cell").agg(
        blocks(~F.col("probe"), block_rows).alias("home_blocks"),
        blocks(F.col("probe"), PROBE_BLOCKS * block_rows).alias("probe_blocks"))
        .filter("home_blocks > 1 or probe_blocks > 1"))
    one = F.lit(1)
    dealt = (entries.join(large, "cell", "left")
             .withColumn("own", F.when(F.col("probe"), F.coalesce("probe_blocks", one))
                         .otherwise(F.coalesce("home_blocks", one)))
             .withColumn("others", F.when(F.col("probe"), F.coalesce("home_blocks", one))
                         .otherwise(F.coalesce("probe_blocks", one)))
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("own")).cast("long"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("others") - 1)))
             .select((F.xxhash64("cell", F.when(F.col("probe"), F.col("other").cast("long"))
                                 .otherwise(F.col("own")),
                                 F.when(F.col("probe"), F.col("own"))
                                 .otherwise(F.col("other").cast("long")))).alias("task"),
                     "probe", "fp"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        rows = 0

        def whole(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, rows
            task, probe, fps = (np.concatenate(c) for c in zip(*held, strict=True))
            cut = len(task) if last else int(np.searchsorted(task, task[-1], "left"))
            if cut:
                held = [(task[cut:], probe[cut:], fps[cut:])]
                rows = len(task) - cut
            else:  # all of one task: its homes stay for the probes to come
                held = [(task[~probe], probe[~probe], fps[~probe])]
                cut, rows = len(task), 0
            a, b = _meet(task[:cut], probe[:cut], fps[:cut], max_bits)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            held.append((batch["task"].to_numpy(), batch["probe"].to_numpy(zero_copy_only=False),
                         batch["fp"].to_numpy()))
            rows += batch.num_rows
            if rows >= rows_at_once:
                yield from whole(last=False)
        if rows:
            yield from whole(last=True)

    return (dealt.repartition("task").sortWithinPartitions("task", "probe")
            .mapInArrow(run, "a long, b long"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 4, max_bits: int = 4, carry: Sequence[str] = ()) -> DataFrame:
    """Return doc_id, fp (signed long), component_id: one row per input row.

    With ``carry``, columns of ``docs`` to pass on, also ``root``: one
    fingerprint of the component, which names it even if ids repeat.

    Documents link when their fingerprints differ in at most ``max_bits``;
    component_id is the smallest doc_id reachable, itself included (a null id
    only if the component has no other).  Null and empty texts, and those
    without words, have fingerprint 0 and link like any other.  Repeated rows
    are documents with equal fingerprints.  Other columns are ignored; an
    empty table gives an empty result.
    """
    marked = cut_lineage(fingerprints(docs, id_col, text_col, shingle, carry))
    classes = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("low")))
    comp = connected_components(fingerprint_links(classes, max_bits))
    members = (classes.join(comp.withColumnRenamed("node", "fp"), "fp", "left")
               .withColumn("root", F.coalesce("root", "fp")))
    smallest = members.groupBy("root").agg(F.min("low").alias("component_id"))
    named = members.join(smallest, "root").select("fp", "component_id", "root")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id", *carry, *(["root"] if carry else []))
