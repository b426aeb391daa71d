"""Encoders and column statistics.

The reference enumerates a sorted vocabulary on the driver.  Here the
enumeration is a distributed consecutive index: range-partition the rows on
the sort key, number rows inside each partition, and add the running count
of the partitions before it (a table of at most ``num_partitions`` rows).
No step moves all rows into one task, unlike a window without a partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.functions.scalars import NONE_SENTINEL, UNKNOWN, token_list
from ratesmith.session import cut_lineage

_POS_MASK = (1 << 33) - 1  # monotonically_increasing_id keeps the row number in the low 33 bits


def consecutive_index(df: DataFrame, order_by: Sequence[str], name: str = "idx",
                      num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 0-based position of each row in ``order_by`` order.

    ``order_by`` should be a total order over the rows (distinct values or a
    unique ordinal).  Rows are range-partitioned, numbered inside their
    partition, and frozen with a reliable checkpoint: the range bounds come
    from a sample of an input whose order may differ between runs, so the
    numbering is written once and both uses (per-partition counts, final
    positions) read the same files.  The only gathered table is one count per
    partition.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n, *order_by).sortWithinPartitions(*order_by)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id().bitwiseAND(F.lit(_POS_MASK))))
    frozen = cut_lineage(ranged)
    counts = frozen.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    offsets = counts.select("_pid", (F.sum("_n").over(w) - F.col("_n")).alias("_off"))
    # ``offsets`` holds one row per range partition: a proven, tiny bound.
    out = frozen.join(F.broadcast(offsets), "_pid")
    return out.withColumn(name, (F.col("_off") + F.col("_pos")).cast("long")).drop("_pid", "_pos", "_off")


def distinct_values(df: DataFrame, col: str | Column, name: str = "value") -> DataFrame:
    """A1: distinct values of one column (hash aggregate, partial map-side)."""
    c = F.col(col) if isinstance(col, str) else col
    return df.select(c.alias(name)).distinct()


def sentinel_codes_multi(df: DataFrame, cols: Sequence[str], sentinel: str = UNKNOWN,
                         excluded: str = NONE_SENTINEL, null_as: str | None = UNKNOWN
                         ) -> dict[str, DataFrame]:
    """W1 vocabularies of several columns from one distributed index.

    NULL is read as ``null_as``; with None it is in no vocabulary.

    Rows (column, value) are numbered in (column, value) order; a column's
    code is its position minus the position of the column's first value.
    """
    vocab = None
    for c in cols:
        v = df.select(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit(null_as)).alias("value"))
        vocab = v if vocab is None else vocab.unionByName(v)
    vocab = vocab.where(F.col("value") != F.lit(excluded)).distinct()
    idx = consecutive_index(vocab, ["column", "value"], "pos")
    first = idx.groupBy("column").agg(F.min("pos").alias("_first"))  # one row per column
    coded = idx.join(F.broadcast(first), "column").select(
        "column", "value",
        F.when(F.col("value") == F.lit(sentinel), F.lit(-1).cast("long"))
         .otherwise(F.col("pos") - F.col("_first")).alias("code"))
    return {c: coded.where(F.col("column") == F.lit(c)).select("value", "code") for c in cols}


def sentinel_codes(df: DataFrame, col: str, sentinel: str = UNKNOWN,
                   excluded: str = NONE_SENTINEL, null_as: str | None = UNKNOWN) -> DataFrame:
    """W1 vocabulary: (value, code) with code = sorted position, sentinel -> -1.

    NULL is read as ``null_as`` first; with None (for rows whose absent keys
    already read as ``sentinel``) it is in no vocabulary.  The sentinel keeps its slot in the
    enumeration (so it leaves a gap) and is then coded -1; ``excluded`` is
    left out of the vocabulary.
    """
    return sentinel_codes_multi(df, [col], sentinel, excluded, null_as)[col]


def apply_codes(df: DataFrame, col: str, codes: DataFrame, out: str,
                null_as: str | None = UNKNOWN, missing_code: int = -1) -> DataFrame:
    """Left-join a (value, code) table back; values outside it get ``missing_code``."""
    key = F.coalesce(F.col(col), F.lit(null_as)) if null_as is not None else F.col(col)
    c = codes.select(F.col("value").alias("_v"), F.col("code").alias("_code"))
    j = df.join(c, key == F.col("_v"), "left")
    return j.withColumn(out, F.coalesce(F.col("_code"), F.lit(missing_code).cast("long"))).drop("_v", "_code")


def sentinel_encode(df: DataFrame, col: str, out: str, vocab_source: DataFrame | None = None,
                    null_as: str | None = UNKNOWN) -> DataFrame:
    """Alphabetical code with sentinel -1 (city, state); NULL gets -1."""
    codes = sentinel_codes(vocab_source if vocab_source is not None else df, col, null_as=null_as)
    return apply_codes(df, col, codes, out, null_as)


def label_codes(df: DataFrame, col: str, fill: str = UNKNOWN) -> DataFrame:
    """W2 vocabulary: NULL filled with ``fill``, every value (fill included) a class."""
    vocab = distinct_values(df, F.coalesce(F.col(col), F.lit(fill)), "value")
    return consecutive_index(vocab, ["value"], "code")


def label_encode(df: DataFrame, col: str, out: str, fill: str = UNKNOWN) -> DataFrame:
    """Sorted label encoding, no sentinel."""
    return apply_codes(df, col, label_codes(df, col, fill), out, null_as=fill)


def minmax_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with ``{c}_min`` / ``{c}_max`` for every column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}_min"), F.max(c).cast("double").alias(f"{c}_max")]
    return df.agg(*aggs)


def minmax_stats_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A15 in long form: (feature, min_value, max_value)."""
    wide = minmax_stats(df, cols)
    pairs = ", ".join(f"'{c}', `{c}_min`, `{c}_max`" for c in cols)
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) as (feature, min_value, max_value)")


def minmax_scale(df: DataFrame, cols: Sequence[str], stats: DataFrame) -> DataFrame:
    """M1: ``(x-min)/(max-min)`` with train statistics, no clipping.

    A constant column gives ``x-min`` (0 on the fit data), the reference
    scaler's rule; Spark's ``MinMaxScaler`` would give 0.5.  ``stats`` is the
    one-row output of :func:`minmax_stats`, so the cross join is a broadcast
    of one row.
    """
    j = df.crossJoin(F.broadcast(stats))
    scaled = {}
    for c in cols:
        lo, hi = F.col(f"{c}_min"), F.col(f"{c}_max")
        x = F.col(c).cast("double")
        scaled[c] = F.coalesce(F.try_divide(x - lo, hi - lo), x - lo)
    out = j.withColumns(scaled)
    return out.drop(*[f"{c}_{s}" for c in cols for s in ("min", "max")])


def category_vocab(df: DataFrame, col: str = "categories") -> DataFrame:
    """A18 + O1: sorted distinct labels of a comma-list column, with index."""
    labels = df.select(F.explode(token_list(col)).alias("value")).distinct()
    return consecutive_index(labels, ["value"], "code")


def category_pairs(df: DataFrame, key: str, col: str = "categories",
                   vocab: DataFrame | None = None) -> DataFrame:
    """M2 (sparse long form): one row per (key, present label, label index).

    A multi-label one-hot matrix is mostly zeros; its non-zero cells are this
    table.  Set semantics: a label repeated in one row counts once.  With a
    ``vocab`` of other rows, labels outside it have no cell.
    """
    vocab = category_vocab(df, col) if vocab is None else vocab
    cells = df.select(key, F.explode(F.array_distinct(token_list(col))).alias("value"))
    return cells.join(vocab, "value").select(key, F.col("value").alias("category"),
                                             F.col("code").alias("category_index"))


def category_arrays(df: DataFrame, key: str, col: str = "categories",
                    vocab: DataFrame | None = None) -> DataFrame:
    """M2 (sparse rows): (key, labels), the sorted indices of a key's labels.

    A key's labels come from one text, so no array outgrows its row; keys
    without a known label have no row.
    """
    return category_pairs(df, key, col, vocab).groupBy(key).agg(
        F.array_sort(F.collect_set(F.col("category_index").cast("int"))).alias("labels"))
