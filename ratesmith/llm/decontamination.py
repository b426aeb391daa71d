"""Benchmark passages in documents by a prefix-filtered set join.

A benchmark item's windows are its runs of ten words (an item of fewer words
is one window).  A window is the set of its shingles of five words with their
places, and a document contains it if it holds all of them at the same
distances.  At full containment one shingle of a window, whichever, must be
in the document, so:

1. shingles are ordered by rarity, the number of their occurrences in all
   documents; a window with a shingle that never occurs is dropped;
2. only each window's rarest shingle, its prefix, is joined with the
   documents' shingles;
3. candidates whose window would begin before the document or end behind it
   fall to the length and positional bounds;
4. the words themselves are compared over a window of the item's size.

Documents are read twice, to count and to find prefixes.  Which of their
shingles concern the benchmark is first asked of a bitmap of bounded size;
what it lets through by chance falls out of the exact joins.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.llm import word_arrays as wa
from ratesmith.session import cut_lineage

#: Words of a window and of a shingle.
WINDOW, SHINGLE = 10, 5
#: Words are digits, a-z and all that is not ASCII.
_CLASSES = wa.byte_classes(bytes(b for b in range(128) if not (48 <= b < 58 or 97 <= b < 123)))
#: Texts of one result batch.
_ROWS = 2048


def _bytes(texts: pa.Array) -> list[bytes]:
    return texts.cast(pa.binary()).to_pylist()


def _words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    return [data[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def _windows(benchmark: DataFrame, window: int, shingle: int) -> DataFrame:
    """(item, words, tokens): every window of every item; tokens are the
    hashes of its shingles in order."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, words, tokens = [], [], []
            for item, text in zip(batch["item"].to_pylist(), _bytes(batch["text"]), strict=True):
                data = wa.lowered(text)
                starts, ends, hashes = wa.hash_words(data, _CLASSES)
                all_words = _words(data, starts, ends)
                size = min(window, len(all_words))
                if not size:
                    continue
                k = min(shingle, size)
                runs = wa.hash_runs(hashes, k).view(np.int64).tolist()
                for at in range(len(all_words) - size + 1):
                    items.append(item)
                    words.append(all_words[at:at + size])
                    tokens.append(runs[at:at + size - k + 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(items, pa.string()), pa.array(words, pa.list_(pa.string())),
                 pa.array(tokens, pa.list_(pa.int64()))], names=["item", "words", "tokens"])

    return benchmark.mapInArrow(cut, "item string, words array<string>, tokens array<long>")


def _hits(texts: list[bytes], lengths: list[int], bits: np.ndarray) -> Iterator[tuple]:
    """For groups of texts: first text, words of each, lower-cased bytes, word
    starts and ends, and (position, length, token) of the shingles in the
    bitmap; positions count the group's words."""
    for first, end, data, begins in wa.blocks(texts):
        starts, ends, hashes = wa.hash_words(data, _CLASSES)
        text_of = np.searchsorted(begins, starts, "right") - 1
        n_words = np.bincount(text_of, minlength=end - first)
        found = []
        for k in lengths:
            runs = wa.hash_runs(hashes, k)
            inside = text_of[:len(runs)] == text_of[k - 1:]
            at = np.flatnonzero(wa.in_bitmap(bits, runs) & inside)
            found.append((k, at, runs[at]))
        yield first, n_words, data, starts, ends, text_of, found


def _counted(docs: DataFrame, lengths: list[int], bits, text_col: str) -> DataFrame:
    """(token, n): occurrences of the bitmap's shingles in all documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for *_, found in _hits(_bytes(batch[0]), lengths, bits.value):
                for _, _, tokens in found:
                    if len(tokens):
                        token, n = np.unique(tokens, return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))],
                            names=["token", "n"])

    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (texts.mapInArrow(count, "token long, n long")
            .groupBy("token").agg(F.sum("n").alias("n")))


_FOUND = "array<struct<token: bigint, at: bigint, lead: bigint, words: array<string>>>"
_ARROW_FOUND = pa.list_(pa.struct([("token", pa.int64()), ("at", pa.int64()), ("lead", pa.int64()),
                                   ("words", pa.list_(pa.string()))]))


def _prefixes_in(docs: DataFrame, lengths: list[int], bits, window: int, shingle: int) -> DataFrame:
    """(row, part, doc_id, n_words, found): each document's shingles in the
    bitmap, with their position and the words around them (``lead`` of them
    before).  A document with many has several parts; part 0 is always there."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch["doc_id"]
            for first, n_words, data, starts, ends, text_of, found in _hits(
                    _bytes(batch["text"]), lengths, bits.value):
                offset = np.cumsum(n_words) - n_words
                parts: list[list[tuple[int, list[dict]]]] = [[(0, [])] for _ in n_words]
                for k, places, tokens in found:
                    # a shorter shingle is a whole window
                    before, after = (window - shingle, window) if k == shingle else (0, k)
                    for i, token in zip(places.tolist(), tokens.view(np.int64).tolist(), strict=True):
                        t = int(text_of[i])
                        begin = int(offset[t])
                        low, high = max(begin, i - before), min(begin + int(n_words[t]), i + after)
                        if len(parts[t][-1][1]) == _ROWS:
                            parts[t].append((len(parts[t]), []))
                        parts[t][-1][1].append({"token": token, "at": i - begin, "lead": i - low,
                                                "words": _words(data, starts[low:high], ends[low:high])})
                rows = [(first + t, part, hits) for t, all_parts in enumerate(parts)
                        for part, hits in all_parts]
                for lo in range(0, len(rows), _ROWS):
                    at, part, hits = zip(*rows[lo:lo + _ROWS], strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [batch["row"].take(pa.array(at)), pa.array(part, pa.int32()),
                         ids.take(pa.array(at)), pa.array(n_words[np.array(at) - first].astype(np.int64)),
                         pa.array(hits, _ARROW_FOUND)],
                        names=["row", "part", "doc_id", "n_words", "found"])

    return docs.mapInArrow(find, f"row long, part int, doc_id {kind}, n_words long, found {_FOUND}")


def _spans(hits: DataFrame) -> DataFrame:
    """(row, spans): the union of a row's word ranges as sorted, disjoint ones.

    A running maximum over sorted ranges finds where a new stretch begins, so
    no list of ranges is held."""
    order = Window.partitionBy("row").orderBy("start", "end")
    seen = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = (hits.select("row", "start", "end").distinct()
               .withColumn("new", F.coalesce((F.col("start") > seen).cast("int"), F.lit(1)))
               .withColumn("island", F.sum("new").over(order))
               .groupBy("row", "island").agg(F.min("start").alias("start"), F.max("end").alias("end")))
    return islands.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE) -> DataFrame:
    """Return doc_id, n_words, spans and items: one row per input row.

    ``spans`` are the disjoint word ranges (end exclusive) covered by
    occurrences of benchmark windows, ``items`` the ids, as sorted strings, of
    the items with one.  Null and empty texts have no words.  Items without
    words match nothing; rows with one item id are one item; the words of an
    item without an id count, but it is not listed.  Repeated documents and
    null ids are kept as rows; other columns are ignored; an empty benchmark
    gives empty spans and an empty documents table no rows.
    """
    if not 1 <= shingle <= window:
        raise ValueError("a shingle must fit into a window")
    spark = docs.sparkSession
    bench = benchmark.select(F.col(item_col).cast("string").alias("item"),
                             F.coalesce(F.col(item_text_col), F.lit("")).alias("text"))
    every = cut_lineage(_windows(bench, window, shingle).distinct())
    windows = cut_lineage(every.select("words", "tokens").distinct()
                          .withColumn("window", F.monotonically_increasing_id())
                          .withColumn("size", F.size("words").cast("long")))
    tokens = cut_lineage(windows.select(F.explode("tokens").alias("token")).distinct())
    lengths = sorted(r.k for r in windows.select(
        F.least("size", F.lit(shingle)).alias("k")).distinct().collect())  # at most SHINGLE values

    bits = spark.sparkContext.broadcast(wa.bitmap(tokens, "token"))
    counts = _counted(docs, lengths, bits, text_col)
    rarest = (windows.select("window", F.size("tokens").alias("n_tokens"),
                             F.posexplode("tokens").alias("place", "token"))
              .join(counts, "token").groupBy("window", "n_tokens")
              .agg(F.count(F.lit(1)).alias("occurring"),
                   F.min(F.struct("n", "token", "place")).alias("rarest"))
              .filter(F.col("occurring") == F.col("n_tokens")))
    prefixes = cut_lineage(
        rarest.join(windows, "window").select(
            "window", F.col("words").alias("wanted"), "size", "rarest.token",
            F.col("rarest.place").cast("long").alias("place")))

    bits = spark.sparkContext.broadcast(wa.bitmap(prefixes.select("token").distinct(), "token"))
    source = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                         F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # written once: several branches read its row numbers
    scanned = cut_lineage(_prefixes_in(source, lengths, bits, window, shingle))
    candidates = (scanned.select("row", "n_words", F.explode("found").alias("f"))
                  .select("row", "n_words", "f.*").join(prefixes, "token")
                  .withColumn("start", F.col("at") - F.col("place")))
    fits = (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words"))
    around: Column = F.slice("words", (F.col("lead") - F.col("place") + 1).cast("int"),
                             F.col("size").cast("int"))
    hits = cut_lineage(candidates.filter(fits).filter(around == F.col("wanted")).select(
        "row", "start", (F.col("start") + F.col("size")).alias("end"), "window"))
    named = every.filter(F.col("item").isNotNull()).join(
        windows.select("words", "window"), "words").select("window", "item")
    items = (hits.select("row", "window").distinct().join(named, "window")
             .select("row", "item").distinct()
             .groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items")))
    none = F.array().cast("array<struct<start: bigint, end: bigint>>")
    return (scanned.filter("part = 0").select("row", "doc_id", "n_words").join(_spans(hits), "row", "left")
            .join(items, "row", "left")
            .select("doc_id", "n_words", F.coalesce("spans", none).alias("spans"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items")))
