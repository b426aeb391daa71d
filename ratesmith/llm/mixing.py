"""Mixing sources to target weights by a low-discrepancy block schedule.

Every source is a stream of words: its documents in shuffled order, read
round and round.  The stream is cut into blocks of equal word counts.  The
mix is a schedule of slots; slot k takes the van der Corput point of k (its
binary digits mirrored), looks it up in the sources' cumulative shares, and
takes that source's next block, so every stretch of the schedule holds the
sources close to their shares.  A slot's rank among its source's slots names
the block.  Slots past a source's quota of blocks are left out, and the few
that it lacks at the end (the sequence's discrepancy, a logarithm of the
length) are appended; the last block of a source ends at its target.

Ranks and stream positions are running counts in two levels: within bounded
chunks, then over the chunks' totals, so that no source is gathered in one
task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.session import cut_lineage

#: Words of a block, documents of a shuffled chunk, slots ranked together.
BLOCK_WORDS, CHUNK_DOCS, CHUNK_SLOTS = 1024, 4096, 4096
#: Grid cells of [0, 1) by which points find their source.
CELLS = 4096
DIGITS = 40
MAX_REPEAT = 3


def word_count(text: Column) -> Column:
    """Number of runs of characters other than 0x20 and 0x09-0x0D; null: 0."""
    runs = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    words = F.length(F.translate(runs, " \t\n\x0b\x0c\r", ""))
    return F.coalesce(words, F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], max_repeat: int) -> DataFrame:
    """Targets of sources (source, source_size): source_no, weight, target.

    Sources in code point order, null last, weigh ``weights`` in turn.  They
    share the whole of all sizes by weight; what a source cannot take above
    ``max_repeat`` times its size goes to the others.  Filling sources in the
    order of their limit per weight, the level at which the first is not
    filled is the level of all that are not.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    named = (sizes.withColumn("source_no", F.row_number().over(order) - 1)
             .withColumn("weight", F.element_at(
                 F.array(*[F.lit(float(w)) for w in weights]),
                 (F.col("source_no") % len(weights)) + 1))
             .withColumn("most", F.col("source_size") * max_repeat))
    fill = Window.orderBy(F.col("most") / F.col("weight"), "source_no")
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    after = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0)))
             / F.sum("weight").over(after))
    return (named.withColumn("level", level)
            .withColumn("level", F.min(F.when(
                F.col("most") > F.col("weight") * F.col("level"),
                F.struct(F.col("most") / F.col("weight"), F.col("source_no"), F.col("level"))))
                .over(everything)["level"])
            .withColumn("target", F.least(
                F.col("most").cast("double"),
                F.coalesce(F.col("weight") * F.col("level"), F.col("most").cast("double"))))
            .select("source", "source_no", "source_size", "weight", "target"))


def _point(k: Column) -> Column:
    """Van der Corput point of k in base 2, exact for k below 2^DIGITS."""
    mirrored = F.reverse(F.lpad(F.bin(k), DIGITS, "0"))
    return F.conv(mirrored, 2, 10).cast("double") / float(1 << DIGITS)


def block_schedule(targets: DataFrame, block_words: int) -> DataFrame:
    """The schedule: slot, source_no, rank (the block within the source).

    One row per block that a source needs for its target.
    """
    quotas = targets.select("source_no", F.ceil(F.col("words") / block_words).alias("quota")
                            ).filter("quota > 0")
    total = quotas.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0]
    running = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    spans = (quotas.withColumn("upto", F.sum("quota").over(running))
             .select("source_no", "quota", ((F.col("upto") - F.col("quota")) / max(total, 1)).alias("lo"),
                     (F.col("upto") / max(total, 1)).alias("hi"))
             .withColumn("cell", F.explode(F.sequence(
                 F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1))))))
    slots = (targets.sparkSession.range(total).select(F.col("id").alias("slot"))
             .withColumn("u", _point(F.col("slot")))
             .withColumn("cell", F.floor(F.col("u") * CELLS))
             .join(spans, "cell").filter((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi")))
             .withColumn("chunk", F.floor(F.col("slot") / CHUNK_SLOTS))
             .select("slot", "chunk", "source_no", "quota"))
    by_chunk = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    base = (slots.groupBy("source_no", "chunk").agg(F.count(F.lit(1)).alias("n"))
            .withColumn("base", F.coalesce(F.sum("n").over(by_chunk), F.lit(0))))
    within = Window.partitionBy("source_no", "chunk").orderBy("slot")
    ranked = (slots.join(base.select("source_no", "chunk", "base"), ["source_no", "chunk"])
              .withColumn("rank", F.col("base") + F.row_number().over(within) - 1))
    # quotas that the sequence left short are filled behind its last slot, one
    # source after the other
    earlier = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    lacking = (quotas.join(base.groupBy("source_no").agg(F.sum("n").alias("n")), "source_no", "left")
               .withColumn("n", F.coalesce("n", F.lit(0))).filter("n < quota")
               .withColumn("behind", F.coalesce(F.sum(F.col("quota") - F.col("n")).over(earlier), F.lit(0)))
               .withColumn("rank", F.explode(F.sequence("n", F.col("quota") - 1)))
               .select((F.col("rank") - F.col("n") + F.col("behind") + total).alias("slot"), "source_no", "rank"))
    return ranked.filter("rank < quota").select("slot", "source_no", "rank").union(lacking)


def _placed(docs: DataFrame, weights: Sequence[float], id_col: str, text_col: str, source_col: str,
            max_repeat: int, block_words: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """The rows with their places in their sources' streams, and the schedule
    joined to them: a row per slot and piece of a document in its block."""
    sized = cut_lineage(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.xxhash64(F.col(id_col), F.lit(seed)).alias("h"), F.xxhash64(text_col).alias("h2")))
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"),
                                        F.count(F.lit(1)).alias("docs"))
    targets = cut_lineage(source_targets(sizes.select("source", "source_size"), weights, max_repeat)
                          .withColumn("words", F.floor("target")))
    # chunks hold about CHUNK_DOCS documents of any source
    chunks = max(1, -(-sized.count() // CHUNK_DOCS))
    placed = (sized.join(targets.select(F.col("source").alias("s"), "source_no", "source_size",
                                        "target", "words"), F.col("source").eqNullSafe(F.col("s")))
              .drop("s").withColumn("chunk", F.pmod("h", F.lit(chunks))))
    by_chunk = Window.partitionBy("source_no").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    base = (placed.groupBy("source_no", "chunk").agg(F.sum("size").alias("n"))
            .withColumn("base", F.coalesce(F.sum("n").over(by_chunk), F.lit(0)))
            .select("source_no", "chunk", "base"))
    shuffled = Window.partitionBy("source_no", "chunk").orderBy("h", "doc_id", "size", "h2")
    running = shuffled.rowsBetween(Window.unboundedPreceding, -1)
    located = (placed.withColumn("at", F.coalesce(F.sum("size").over(running), F.lit(0)))
               .withColumn("row", F.row_number().over(shuffled))
               .join(base, ["source_no", "chunk"])
               .withColumn("at", F.col("at") + F.col("base")))
    # the rounds in which the stream reaches the document before its target,
    # and the blocks that each meets
    lo = F.col("at") + F.col("round") * F.col("source_size")
    hi = F.least(lo + F.col("size"), F.col("words"))
    block = F.col("rank") * block_words
    pieces = (located.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
              .withColumn("lo", lo).withColumn("hi", hi).filter("hi > lo")
              .withColumn("rank", F.explode(F.sequence(
                  F.floor(F.col("lo") / block_words), F.floor((F.col("hi") - 1) / block_words))))
              .withColumn("from", F.greatest("lo", block))
              .withColumn("to", F.least("hi", block + block_words))
              .select("source_no", "chunk", "row", "doc_id", "source", "rank",
                      (F.col("from") - block).alias("at"), (F.col("from") - F.col("lo")).alias("start"),
                      (F.col("to") - F.col("lo")).alias("end"))
              .join(block_schedule(targets, block_words), ["source_no", "rank"]))
    return located, pieces


def schedule(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), id_col: str = "doc_id",
             text_col: str = "text", source_col: str = "source", max_repeat: int = MAX_REPEAT,
             block_words: int = BLOCK_WORDS, seed: int = 11) -> DataFrame:
    """The mix itself: slot, at, source, rank, doc_id, start, end.

    Read by slot, then ``at``, the rows are the mixed stream of words: slot
    holds its source's block ``rank``, which has the words ``start`` to ``end``
    of a document from its word ``at`` on.  Every stretch of slots holds the
    sources near their shares.  Edge cases are those of :func:`mix`.
    """
    _, pieces = _placed(docs, weights, id_col, text_col, source_col, max_repeat, block_words, seed)
    return pieces.select("slot", "at", "source", "rank", "doc_id", "start", "end")


def mix(docs: DataFrame, weights: Sequence[float] = (1, 2, 3), id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", max_repeat: int = MAX_REPEAT,
        block_words: int = BLOCK_WORDS, seed: int = 11) -> DataFrame:
    """Return doc_id, source, size, source_size, target, taken, first_slot,
    last_slot: a row per row.

    ``taken`` counts the words that the schedule's slots hold of a document,
    repeats included: between 0 and ``max_repeat`` times its size, all of it
    once a round except where its source's target ends; ``first_slot`` and
    ``last_slot`` are the slots it comes in, null if none.  The words taken of
    a source are its target rounded down.  Null texts and texts without words
    have size and taken 0; a null source is a source of its own, the last;
    repeated rows are documents of their own; rows of equal id are shuffled as
    neighbours.  Other columns are ignored; an empty table gives an empty result.
    """
    located, pieces = _placed(docs, weights, id_col, text_col, source_col, max_repeat, block_words, seed)
    taken = pieces.groupBy("source_no", "chunk", "row").agg(
        F.sum(F.col("end") - F.col("start")).alias("taken"),
        F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))
    return (located.join(taken, ["source_no", "chunk", "row"], "left")
            .select("doc_id", "source", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "first_slot", "last_slot"))
