"""Phrase collocations, counted in HAT-tries that spill sorted runs.

Phrases of 1 to ``max_words`` words are counted one length at a time.  A task
counts its texts' phrases in a HAT-trie over word ids (:mod:`hat_trie`), which
hands whole subtrees on as sorted runs whenever it is full; the shuffle brings
the runs of one prefix (a phrase's beginning) together, where they are merged.
A phrase cannot be frequent unless both its shorter parts are, so of the
longer phrases only those are counted whose parts are in a bitmap, of bounded
size, of the frequent ones; chance hits are counted and then dropped.

A word's id is a 64-bit hash of language and word.  All distinct words are
counted in full, and if any two share an id, the ids are drawn anew from
another seed, so ids stand for words exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.llm import word_arrays as wa
from ratesmith.llm.hat_trie import HatTrie
from ratesmith.session import cut_lineage

MAX_WORDS, MIN_COUNT, TOP = 4, 30, 2000
#: Scores are SCALE * a / (l + r), rounded down; a phrase is dropped if a
#: longer one that holds it has this percentage of its count.
SCALE, SUBSUMED = 2_000_000, 80
#: Words gap at blanks and tabs; pieces break at marks and line ends.
_CLASSES = wa.byte_classes(b" \t", b".,;:!?\n\x0b\x0c\r")
#: Words whose phrases are sorted at a time.
_AT_ONCE = 1 << 18
#: A word of over 1 in HOT_ONE_IN of all words is hot: the runs of its pairs
#: are dealt by 2^HOT_BITS ranges of the last word's id too.
HOT_ONE_IN, HOT_BITS = 1000, 6
#: Phrases that a trie holds before it spills.
SPILL_PHRASES = 1 << 19
#: Texts taken from a batch at a time.
_TEXTS = 512


@lru_cache(maxsize=4096)
def _salt(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8, salt=b"%d" % seed).digest())


def _word_ids(batch: pa.RecordBatch, seed: int) -> Iterator[tuple]:
    """For groups of texts: bytes, word starts and ends, ids, the piece and
    the language of each word."""
    for at in range(0, batch.num_rows, _TEXTS):
        some = batch.slice(at, _TEXTS)
        texts, langs = some["text"].cast(pa.binary()).to_pylist(), some["lang"].to_pylist()
        for first, end, data, begins in wa.blocks(texts):
            starts, ends, hashes = wa.hash_words(data, _CLASSES, seed)
            text_of = np.searchsorted(begins, starts, "right") - 1
            salts = np.array([_salt(lang, seed) for lang in langs[first:end]], np.uint64)
            # texts are joined by line ends, so a piece lies in one text
            piece = np.searchsorted(np.flatnonzero(_CLASSES[data] == wa.BREAK), starts)
            yield data, starts, ends, wa.mix(hashes ^ salts[text_of]), piece, \
                lambda i, langs=langs, of=text_of, first=first: langs[first + of[i]]


def _keys(rows: np.ndarray) -> pa.Array:
    """Rows of word ids as binary keys."""
    width = 8 * rows.shape[1]
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * np.int32(width)
    return pa.Array.from_buffers(pa.binary(), len(rows), [
        None, pa.py_buffer(offsets), pa.py_buffer(rows.astype(">u8").tobytes())])


def _word_runs(texts: DataFrame, seed: int) -> DataFrame:
    """(lang, word, id, n): runs of the counted words."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, names = HatTrie(2), {}

        def out(rows: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            raw = rows.astype(">u8").tobytes()
            lang, word = zip(*[names.pop(raw[i:i + 16]) for i in range(0, len(raw), 16)], strict=True)
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(word, pa.binary()).cast(pa.string()),
                 pa.array(rows[:, 0].astype(np.uint64).view(np.int64)), pa.array(counts)],
                names=["lang", "word", "id", "n"])

        for batch in batches:
            for data, starts, ends, ids, _, lang_of in _word_ids(batch, seed):
                # words of one id that differ in length or in an outer byte stay
                # apart; others are told apart where they occur without each other
                look = ((ends - starts) << 16 | data[starts].astype(np.int64) << 8 | data[ends - 1])
                for key, i in zip(*trie.add([ids, look.astype(np.uint64)]), strict=True):
                    if key not in names:
                        names[key] = lang_of(i), data[starts[i]:ends[i]].tobytes()
                for run in trie.overflow():
                    yield out(*run)
        for run in trie.drain():
            yield out(*run)

    return texts.mapInArrow(count, "lang string, word string, id long, n long")


def _keyed(words: DataFrame, seed: int) -> DataFrame:
    """Distinct words with their ids as ``key``."""
    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.RecordBatch.from_arrays([batch["word"], batch["lang"]], names=["text", "lang"])
            ids = [found[3] for found in _word_ids(texts, seed)]  # each text is one word
            if ids:
                yield batch.append_column("key", _keys(np.concatenate(ids).reshape(-1, 1)))

    return words.select("lang", "word", "n").mapInArrow(keys, "lang string, word string, n long, key binary")


def _by_head(rows: np.ndarray, counts: np.ndarray, hot: np.ndarray) -> pa.RecordBatch:
    """A sorted run as rows (head, part, lasts, counts): the phrases that share all
    words but the last; of a hot word, those of one range of last words."""
    last = rows[:, -1]
    part = np.zeros(len(rows), np.int64)
    if rows.shape[1] == 2 and len(hot):
        split = np.isin(rows[:, 0], hot)
        part[split] = last[split] >> np.uint64(64 - HOT_BITS)
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:, :-1] != rows[:-1, :-1]).any(axis=1) | (part[1:] != part[:-1])
    first = np.flatnonzero(new)
    offsets = pa.array(np.append(first, len(rows)), pa.int32())
    return pa.RecordBatch.from_arrays(
        [_keys(rows[first, :-1]), pa.array(part[first]),
         pa.ListArray.from_arrays(offsets, pa.array(np.ascontiguousarray(last).view(np.int64))),
         pa.ListArray.from_arrays(offsets, pa.array(counts))], names=["head", "part", "last", "n"])


def _phrase_runs(texts: DataFrame, seed: int, size: int, shorter, hot: np.ndarray) -> DataFrame:
    """(head, part, last, n): runs of the counted phrases of ``size`` words whose
    parts of one word less are in the bitmap ``shorter``, by head (:func:`_by_head`)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, bits = HatTrie(size, spill=SPILL_PHRASES), shorter.value

        for batch in batches:
            for _, _, _, ids, piece, _ in _word_ids(batch, seed):
                for a in range(0, len(ids) - size + 1, _AT_ONCE):
                    words, pieces = ids[a:a + _AT_ONCE + size - 1], piece[a:a + _AT_ONCE + size - 1]
                    n = len(words) - size + 1
                    part = wa.in_bitmap(bits, wa.hash_runs(words, size - 1))
                    at = np.flatnonzero((pieces[:n] == pieces[size - 1:]) & part[:n] & part[1:])
                    trie.add([words[at + i] for i in range(size)])
                    for run in trie.overflow():
                        yield _by_head(*run, hot)
        for run in trie.drain():
            yield _by_head(*run, hot)

    return texts.mapInArrow(count, "head binary, part long, last array<long>, n array<long>")


def _merged(runs: DataFrame) -> DataFrame:
    """(key, n) of whole phrases: runs meet by prefix, that is by all words but
    the last (and by a range of the last after a hot word), and are summed there."""
    # a head's bytes cross the shuffle once a run, not once a phrase
    each = runs.repartition("head", "part").select("head", "part", F.inline(F.arrays_zip("last", "n")))
    key = F.concat("head", F.unhex(F.lpad(F.hex("last"), 16, "0")))
    return each.groupBy("head", "part", "last").agg(F.sum("n").alias("n")).select(key.alias("key"), "n")


def _hot_words(words: DataFrame) -> np.ndarray:
    """Ids of the words that are over 1 in HOT_ONE_IN of all: fewer than that many."""
    total = words.agg(F.sum("n").alias("all")).first()["all"] or 0
    found = words.filter(F.col("n") * HOT_ONE_IN > total).select("key").collect()
    return np.array([int.from_bytes(row.key) for row in found], np.uint64)


def _bitmap(level: DataFrame) -> np.ndarray:
    """Bitmap of a level's keys."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch[0].to_pylist()
            if keys:
                rows = np.frombuffer(b"".join(keys), ">u8").reshape(len(keys), -1).astype(np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wa.hash_columns(list(rows.T)).view(np.int64))], names=["h"])

    return wa.bitmap(level.select("key").mapInArrow(hashed, "h long"), "h")


def vocabulary(texts: DataFrame) -> tuple[DataFrame, int]:
    """(lang, word, key, n) of every distinct word, and the ids' seed."""
    seed = 0
    while True:
        # ids are taken again once the runs are merged: they would not compress in the shuffle
        words = cut_lineage(_keyed(_word_runs(texts, seed).groupBy("lang", "word").agg(F.sum("n").alias("n")), seed))
        if words.groupBy("key").count().filter("count > 1").isEmpty():
            return words, seed
        seed += 1


def _slice(key: str, start: str, words: str):
    return F.expr(f"substring({key}, 8 * ({start}) + 1, 8 * ({words}))")


def _scored(frequent: DataFrame, phrases: DataFrame, scale: int) -> DataFrame:
    """Phrases with l, r and score of the cut that scores lowest."""
    part = frequent.select("key", "n")
    cuts = (phrases.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
            .withColumn("left", _slice("key", "0", "k"))
            .withColumn("right", _slice("key", "k", "words - k"))
            .join(part.select(F.col("key").alias("left"), F.col("n").alias("l")), "left")
            .join(part.select(F.col("key").alias("right"), F.col("n").alias("r")), "right"))
    wide = "decimal(20,0)"
    score = F.expr(f"(cast(a as {wide}) * {scale}) div (cast(l as {wide}) + cast(r as {wide}))")
    return (cuts.withColumn("score", score).groupBy("key", "words", "a")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
            .select("key", "words", "a", "cut.l", "cut.r", "cut.score"))


def _not_subsumed(phrases: DataFrame, max_words: int, percent: int) -> DataFrame:
    """Phrases that no longer one holds with ``percent`` of their count."""
    inner = [(at, n) for n in range(2, max_words) for at in range(max_words - n + 1)]
    parts = F.array(*[F.when(F.col("words") >= at + n, F.when(
        F.col("words") > n, _slice("key", str(at), str(n)))) for at, n in inner])
    longest = (phrases.filter("words > 2").select("a", F.explode(F.array_compact(parts)).alias("key"))
               .groupBy("key").agg(F.max("a").alias("inside")))
    wide = "decimal(20,0)"
    kept = F.expr(f"inside is null or 100 * cast(inside as {wide}) < {percent} * cast(a as {wide})")
    return phrases.join(longest, "key", "left").filter(kept).drop("inside")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
                 scale: int = SCALE, subsumed: int = SUBSUMED) -> DataFrame:
    """Return lang, rank, phrase, a, l, r, n and score: each language's first
    ``top`` phrases by score, count and phrase.

    Null texts are empty, a null language is ``und``; repeated rows count each
    time; other columns are ignored; a language without frequent phrases, and
    an empty table, give no rows.
    """
    if max_words < 2:
        raise ValueError("a phrase has two words at least")
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"))
    words, seed = vocabulary(texts)
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    names = words.filter(F.col("n") >= min_count).select("key", "lang", "word", "n")
    levels = [names.select("key", "n")]
    hot = _hot_words(words)
    for size in range(2, max_words + 1):
        shorter = spark.sparkContext.broadcast(_bitmap(levels[-1]))
        levels.append(cut_lineage(_merged(_phrase_runs(texts, seed, size, shorter, hot))
                                  .filter(F.col("n") >= min_count)))
        shorter.destroy()
    frequent, phrases = levels[0], None
    for size, level in enumerate(levels[1:], 2):
        frequent = frequent.unionByName(level)
        sized = level.select("key", F.lit(size).alias("words"), F.col("n").alias("a"))
        phrases = sized if phrases is None else phrases.unionByName(sized)

    scored = _scored(frequent, _not_subsumed(phrases, max_words, subsumed), scale)
    first = names.select(F.col("key").alias("first"), "lang")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    leading = cut_lineage(scored.withColumn("first", _slice("key", "0", "1")).join(first, "first")
                          .withColumn("place", F.rank().over(best)).filter(F.col("place") <= top)
                          .drop("first", "place"))
    spelled = (leading.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("words") - 1)))
               .withColumn("id", _slice("key", "at", "1"))
               .join(names.select(F.col("key").alias("id"), "word"), "id")
               .groupBy("key", "lang", "a", "l", "r", "score")
               .agg(F.sort_array(F.collect_list(F.struct("at", "word"))).alias("parts"))
               .withColumn("phrase", F.array_join("parts.word", " ")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (spelled.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n",
                    F.col("score").cast("long").alias("score")))
