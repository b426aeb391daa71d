"""The tree learner: many tasks grow what one does, Spark ML's rule, whole sizes, few jobs."""

import numpy as np
import pytest
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from ratesmith.operators import boosting as BO
from ratesmith.operators import models as MD
from ratesmith.operators import tree_growth as TG

COLS = ["x1", "x2"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    data = []
    for i in range(700):
        a, b = rng.normal(size=2)
        held = sorted(int(c) for c in np.flatnonzero(rng.random(6) < 0.4))
        data.append((i, 1, float(a), float(b), held, float(np.sin(2 * a) + (b > 0.3) * a + (2 in held) + rng.normal() / 5),
                     i % 3))
    return spark.createDataFrame(
        data, "user_id long, business_id long, x1 double, x2 double, labels array<int>, stars double, fold int").repartition(6)


def predictions(found):
    return [r.prediction for r in found.orderBy("user_id").collect()]


@pytest.fixture
def many_tasks(monkeypatch):
    """Small limits: rows lie in several tasks, a level takes several asks, siblings are not kept."""
    for name, most in (("LOCAL_ROWS", 100), ("TASK_ROWS", 150), ("CELLS", 300), ("KEPT_CELLS", 900), ("CUT_EVERY", 2)):
        monkeypatch.setattr(TG, name, most)


@pytest.fixture(scope="module")
def in_one_task(rows):
    """What one task grows, before the limits are lowered."""
    p = BO.Params(5, 0.4, 4, l1=0.2, columns=0.5)
    edges = BO.feature_edges(rows, COLS, 40)
    found = [BO._fit_known(rows, COLS, [p], edges, "stars", labels=labels)[0][0] for labels in (None, "labels")]
    sizes = [{**MD.PRESETS["short"], "maxIter": 3, "maxDepth": d} for d in (2, 4)]
    data = MD.assembler(COLS).transform(rows)
    search = MD._fit_sizes(data, "stars", [s for s in sizes for _ in range(3)], "fold", [*range(3)] * 2)
    return p, edges, found, search


def test_many_tasks_grow_what_one_does(rows, in_one_task, many_tasks):
    p, edges, want, (models, losses) = in_one_task
    for model, labels in zip(want, (None, "labels")):
        got = BO._fit_known(rows, COLS, [p], edges, "stars", labels=labels)[0][0]
        assert (got.roots, got.feature, got.cut, got.left) == (model.roots, model.feature, model.cut, model.left)
        assert got.value == pytest.approx(model.value, abs=1e-12) and len(got.left) > 50
    sizes = [{**MD.PRESETS["short"], "maxIter": 3, "maxDepth": d} for d in (2, 4)]
    got, again = MD._fit_sizes(MD.assembler(COLS).transform(rows), "stars", [s for s in sizes for _ in range(3)],
                               "fold", [*range(3)] * 2)
    assert again == pytest.approx(losses) and len(set(losses)) == 6
    assert [m.trees.feature for m in got] == [m.trees.feature for m in models]


def test_drawn_rows_in_many_tasks(rows, many_tasks):
    model = BO.fit(rows, COLS, BO.Params(4, 0.5, 3, rows=0.5), bins=20)
    full = BO.fit(rows, COLS, BO.Params(4, 0.5, 3), bins=20)
    assert len(model.roots) == 4 and model.value != full.value
    error = [r[0] for m in (model, full) for r in BO.predict(m, rows).join(rows, ["user_id", "business_id"]).agg(
        F.avg((F.col("prediction") - F.col("stars")) ** 2)).collect()]
    assert error[0] < 1.5 * error[1]


@pytest.mark.parametrize("depth,rate", [(1, 0.1), (4, 0.3)])
def test_trees_are_those_of_spark_ml(rows, depth, rate):
    size = dict(maxIter=6, maxDepth=depth, stepSize=rate)
    theirs = GBTRegressor(featuresCol="features", labelCol="stars", seed=1, **size).fit(MD.assembler(COLS).transform(rows))
    ours = MD.fit(rows, COLS, "stars", "short", **size)
    want = predictions(theirs.transform(MD.assembler(COLS).transform(rows)))
    assert predictions(MD.predict(ours, rows)) == pytest.approx(want, abs=1e-6)


def test_columns_are_drawn_by_node(rows):
    model = MD.fit(rows, COLS, "stars", "short", maxIter=4, featureSubsetStrategy="0.5", subsamplingRate=0.8).stages[1]
    assert set(model.trees.feature) == {0, 1} and len(model.trees.roots) == 4
    whole = MD.fit(rows, COLS, "stars", "short", maxIter=4).stages[1]
    assert whole.trees.value != model.trees.value


def test_a_model_takes_few_jobs(spark, rows):
    """A small table's trees take no job a level."""
    sc = spark.sparkContext
    for name, fit in (("a", lambda: BO.fit(rows, COLS, BO.Params(30, 0.1, 4))),
                      ("b", lambda: MD.fit(rows, COLS, "stars", "short", maxIter=30))):
        sc.setJobGroup(f"few-{name}", "")
        try:
            fit()
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        assert 0 < len(sc.statusTracker().getJobIdsForGroup(f"few-{name}")) < 30


def test_queries_run_the_whole_models(spark, monkeypatch):
    """The registered queries grow as many and as deep trees as the reference, and its whole search."""
    from ratesmith.plans import load_all, pipelines as PL
    from ratesmith.plans.registry import QUERIES
    load_all()
    seen = []

    class Found(Exception):
        pass

    def stop(*args):
        seen.append(args)
        raise Found

    monkeypatch.setattr(PL, "from_fixtures", lambda *a: PL.Inputs(*[None] * 8))
    monkeypatch.setattr(PL, "_train_val_features", lambda *a: (spark.createDataFrame(
        [], ", ".join(f"{c} double" for c in [*PL.FT.FEATURE_SETS["fs23"], *PL.FT.FEATURE_SETS["fs20l"],
                                              *PL.FT.FEATURE_SETS["fs23l"], "stars"] if c not in got and not got.add(c))),) * 2
        if not (got := set()) else None)
    monkeypatch.setattr(PL.EN, "minmax_stats", lambda tr, cols: spark.range(1).select(
        *[F.lit(0.0).alias(f"{c}{x}") for c in cols for x in ("_min", "_max")]))
    monkeypatch.setattr(PL.EN, "minmax_scale", lambda df, *a: df)
    monkeypatch.setattr(PL.PR, "eda_sparse", lambda *a: (None, None, None))
    monkeypatch.setattr(MD, "contiguous_folds", lambda df, *a: df)
    monkeypatch.setattr(MD, "fit", lambda *a, **k: stop(MD.PRESETS[a[3]]))
    monkeypatch.setattr(BO, "fit", lambda data, cols, params, **k: stop(params))
    monkeypatch.setattr(BO, "staged_search", lambda data, cols, values, *a, **k: stop(values))
    for name, want in (("gbt_fs20", (300, 15)), ("gbt_fs23", (1000, 10)), ("gbt_fs23_log", (500, 10)),
                       ("gbt_fs23_penalised", (1000, 10)), ("gbt_eda_onehot", (300, 15)), ("gbt_grid_staged", 648)):
        with pytest.raises(Found):
            QUERIES[name](spark, "nowhere")
        size, = seen.pop()
        if name == "gbt_grid_staged":
            assert np.prod([len(v) for v in size.values()]) == want
        elif isinstance(size, dict):
            assert (size["maxIter"], size["maxDepth"]) == want, name
        else:
            assert (size.trees, size.depth) == want, name
