"""Boosted trees: beat a mean predictor on a planted signal; deterministic."""

from pyspark.sql import functions as F

from ratesmith.operators import models as MD


def planted(spark, n=3000):
    df = spark.range(n).select(
        (F.col("id") % 97).cast("double").alias("x1"),
        (F.col("id") % 13).cast("double").alias("x2"),
        F.col("id").alias("user_id"), F.lit(1).cast("long").alias("business_id"))
    return df.withColumn("stars", F.lit(1.0) + F.col("x1") / 24.0 + (F.col("x2") > 6).cast("double"))


def test_gbt_beats_mean_and_is_deterministic(spark):
    df = planted(spark)
    model = MD.fit(df, ["x1", "x2"], preset="short", maxIter=10)
    pred = MD.predict(model, df).join(df.select("user_id", "stars"), "user_id")
    mse = pred.select(F.avg(F.pow(F.col("prediction") - F.col("stars"), 2))).first()[0]
    mean = df.select(F.avg("stars")).first()[0]
    base = df.select(F.avg(F.pow(F.col("stars") - F.lit(mean), 2))).first()[0]
    assert mse < 0.1 * base
    again = MD.predict(MD.fit(df, ["x1", "x2"], preset="short", maxIter=10), df)
    a = {r.user_id: r.prediction for r in MD.predict(model, df).collect()}
    b = {r.user_id: r.prediction for r in again.collect()}
    assert a == b


def test_contiguous_folds_sizes(spark):
    df = spark.range(23).select(F.col("id").alias("o"))
    folds = MD.contiguous_folds(df, ["o"], 5).orderBy("o").collect()
    sizes = [sum(1 for r in folds if r.fold == f) for f in range(5)]
    assert sizes == [5, 5, 5, 4, 4]
    assert [r.fold for r in folds] == sorted(r.fold for r in folds)


def test_training_table_takes_core_many_partitions(spark, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    df = planted(spark, 2000).repartition(8 * cores, "user_id").persist()
    few = MD.in_training_parts(df)
    assert few.rdd.getNumPartitions() == cores
    assert few.count() == 2000
    monkeypatch.setattr(MD, "PART_ROWS", 2000 // (2 * cores))
    assert MD.in_training_parts(df).rdd.getNumPartitions() in (2 * cores, 3 * cores)
    monkeypatch.setattr(MD, "PART_ROWS", 2000 // (5 * cores))  # 8 are few enough for 5
    assert MD.in_training_parts(df).rdd.getNumPartitions() == 8 * cores
    df.unpersist()


def test_fit_gives_the_tree_learner_few_partitions(spark, monkeypatch):
    seen = []

    class Watch(MD.Pipeline):
        def fit(self, dataset, params=None):
            seen.append(dataset.rdd.getNumPartitions())
            return super().fit(dataset, params)

    monkeypatch.setattr(MD, "Pipeline", Watch)
    cores = spark.sparkContext.defaultParallelism
    MD.fit(planted(spark, 500).repartition(8 * cores, "user_id"), ["x1", "x2"], preset="short", maxIter=1)
    assert seen and max(seen) <= cores


def test_grid_scores_folds_as_a_cross_validator(spark, monkeypatch):
    # no Python check of every row's fold: candidates are scored as by CrossValidator
    monkeypatch.setattr("pyspark.ml.tuning.CrossValidator._kFold",
                        lambda *a: (_ for _ in ()).throw(AssertionError("rows pass through Python")))
    df = planted(spark, 600)
    res = MD.grid_search(df, ["x1", "x2"], {"maxDepth": [1, 4], "maxIter": [3]}, k=3, order_by=["user_id"])
    assert [p["maxDepth"] for p, _ in res.metrics] == [1, 4]
    assert 0 < res.metrics[1][1] < res.metrics[0][1]
    assert res.best_params == res.metrics[1][0]
    folds = MD.contiguous_folds(df, ["user_id"], 3)
    mses = []
    for f in range(3):
        model = MD.fit(folds.where(F.col("fold") != f), ["x1", "x2"], maxDepth=4, maxIter=3)
        mses.append(model.transform(folds.where(F.col("fold") == f)).select(
            F.avg(F.pow(F.col("prediction") - F.col("stars"), 2))).first()[0])
    assert abs(sum(mses) / 3 - res.metrics[1][1]) < 1e-6
