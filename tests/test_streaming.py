"""Streaming scoring gives the same predictions as the batch operator."""

import os

from pyspark.sql import functions as F

from ratesmith.operators import neighbors as NB
from ratesmith.session import scratch_path
from ratesmith.sources import readers as RD
from ratesmith.sources import schemas as S
from ratesmith.sources.fixtures import dataset
from ratesmith.streaming import item_predictor, score_stream
from conftest import SF001


def test_stream_matches_batch(spark):
    d = dataset(spark, SF001)
    pairs_dir = scratch_path(spark, "pairs-in")
    out_dir = scratch_path(spark, "pairs-out")
    val = d.val_pairs.select(F.col("user_id").cast("string"), F.col("business_id").cast("string"))
    val.write.option("header", True).csv(pairs_dir)
    ckpt = scratch_path(spark, "pairs-ckpt")
    q = score_stream(spark, pairs_dir, out_dir, item_predictor(d.train, d.train_raw), ckpt)
    q.awaitTermination(300)
    got = RD.read_csv(spark, os.path.join(out_dir, "batch=*"), S.PREDICTIONS_SCHEMA)
    want = NB.predict(d.val_pairs, d.train, d.train_raw)
    g = {(r.user_id, r.business_id): round(r.prediction, 9) for r in got.collect()}
    w = {(str(r.user_id), str(r.business_id)): round(r.prediction, 9) for r in want.collect()}
    assert g == w

    # restarted with a new file: only that file is scored, as a new batch
    val.where("user_id = '-1'").write.mode("append").option("header", True).csv(pairs_dir)
    q = score_stream(spark, pairs_dir, out_dir, item_predictor(d.train, d.train_raw), ckpt)
    q.awaitTermination(300)
    batches = {b: RD.read_csv(spark, os.path.join(out_dir, f"batch={b}"), S.PREDICTIONS_SCHEMA).count()
               for b in (0, 1)}
    assert batches == {0: val.count(), 1: val.where("user_id = '-1'").count()}
