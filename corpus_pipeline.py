"""Corpus preparation: documents pass through the stages below in order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet in the session's shared folder and read again as the next
stage's ``docs``.  All but the last return the columns of documents.  Rows
with null ids or texts and repeated rows pass through every stage as its
docstring says; an empty table gives empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ratesmith.llm import bpe, mixing, pii, simhash, toxicity
from ratesmith.llm.queries import ready, token_digests
from ratesmith.session import remove_scratch, scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Score from which a document is rejected, and the sources' weights in turn.
TOXIC_FROM, WEIGHTS = 0.7, (1, 2, 3)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents scored TOXIC_FROM or more by a classifier trained on all
    labels.  Documents without a text stay."""
    ready(spark)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model, carry=COLUMNS[1:])
    return scored.filter(F.col("score") < TOXIC_FROM).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each SimHash component: that with the smallest id, rows
    without one last; of texts with that id, the one of the smallest hash.  Rows
    are told apart by id and text, so ids may repeat."""
    ready(spark)
    rows = docs.select(*COLUMNS, F.xxhash64("text").alias("text_hash"))
    found = simhash.near_duplicates(rows, shingle=4, max_bits=4, carry=("text_hash",))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash"))
    kept = found.groupBy("root").agg(first.alias("row")).select(
        F.col("row.doc_id").alias("kept"), F.col("row.text_hash").alias("kept_hash"))
    once = Window.partitionBy("doc_id", "text_hash").orderBy("lang", "source", "n_chars")
    return (rows.join(kept, F.col("doc_id").eqNullSafe(F.col("kept"))
                      & (F.col("text_hash") == F.col("kept_hash")), "left_semi")
            .withColumn("nth", F.row_number().over(once)).filter("nth = 1").select(*COLUMNS))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every personal data span by its kind in brackets, and count the
    characters again.  A null text becomes empty."""
    found = pii.find_personal_data(docs, carry=("lang", "source"))
    kinds = {k: F.col(k) for k in pii.BASE + pii.EXTRA}
    return (found.withColumn("text", pii.redact(F.col("text"), kinds))
            .withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document as often as the mix takes it (0 to 3 times).

    The mix cuts one document a source, where its target ends; that one is
    taken if at least half of its words are.  Documents without words, of
    which a mix takes nothing, are left out.
    """
    taken = mixing.mix(docs, weights=WEIGHTS)
    # rows of one id share what was taken of them
    shares = (taken.groupBy("doc_id").agg(F.sum("taken").alias("t"), F.sum("size").alias("s"))
              .select(F.col("doc_id").alias("id"), F.round(F.col("t") / F.nullif("s", F.lit(0)))
                      .cast("int").alias("times")).filter("times > 0"))
    return (docs.join(shares, F.col("doc_id").eqNullSafe(F.col("id")))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), "times"))).select(*COLUMNS))


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with their number and the hashes of the ids and
    of the bytes they decode to."""
    ready(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return token_digests(bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True))


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("personal_data", redact_personal_data),
    ("source_mix", mix_sources),
    ("byte_bpe", encode_tokens),
]

#: No oracle: a trained classifier and 64-bit XXH64 fingerprints have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; returns the last stage's rows.

    A stage's table is removed when the next one is written; the last stays.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            remove_scratch(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
