"""Plan-shape checks: no Python in the hot path, pushdown, per-group limit."""

from ratesmith.operators import neighbors as NB
from ratesmith.operators import features as FT
from ratesmith.sources.fixtures import dataset
from conftest import SF001


def plan_text(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_item_predictions_plan(spark):
    d = dataset(spark, SF001)
    p = plan_text(NB.predict(d.val_pairs, d.train, d.train_raw))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "WindowGroupLimit" in p          # top-k limited before the shuffle
    assert "PartialAggregate" in p or "HashAggregate" in p


def test_feature_table_plan_prunes_columns(spark):
    d = dataset(spark, SF001)
    t = FT.feature_table(d.train, d.user, d.business, d.review, d.photo, d.tip, "fs7")
    p = plan_text(t)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    # lineitem is scanned with a pruned schema, never all of its columns
    assert "l_extendedprice" not in p


def test_coratings_are_summed_before_they_are_shuffled(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        d = dataset(spark, SF001)
        needed = NB.needed_item_pairs(NB.candidate_pairs(d.val_pairs, d.train))
        lines = plan_text(NB.corated_stats(needed, d.train)).splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    at = next(i for i, x in enumerate(lines) if "Exchange hashpartitioning(a#" in x and any(
        "partial_sum" in y for y in lines[i:i + 3]))
    # between that exchange and the co-rating join there is no other exchange
    below = [x for x in lines[at + 1:]]
    join = next(i for i, x in enumerate(below) if "Join" in x)
    assert not any("Exchange" in x for x in below[:join])


def test_coratings_that_nobody_needs_are_dropped_before_the_sums(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        d = dataset(spark, SF001)
        needed = NB.needed_item_pairs(NB.candidate_pairs(d.val_pairs, d.train))
        lines = plan_text(NB.corated_stats(needed, d.train)).splitlines()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    partial = next(i for i, x in enumerate(lines) if "Aggregate" in x and "partial_sum(x" in x)
    prune = next(i for i, x in enumerate(lines) if "BroadcastNestedLoopJoin" in x and "words" in x
                 or "Filter" in x and "words" in x)
    assert partial < prune < next(i for i, x in enumerate(lines) if "Join" in x and "user_id" in x)


def test_many_coratings_are_never_shuffled(spark, monkeypatch):
    """Beyond one cell, neither co-ratings nor their sums nor bitmaps' meetings cross an exchange."""
    monkeypatch.setattr(NB, "CELL_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        d = dataset(spark, SF001)
        needed = NB.candidate_pairs(d.val_pairs, d.train).select("target", "rated")
        plans = [plan_text(f(needed, d.train)).splitlines() for f in (NB.corated_stats, NB.corated_counts)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for lines in plans:
        first = next(i for i, x in enumerate(lines) if "Exchange" in x)
        above = "".join(lines[:first])
        assert "cell" in lines[first] and above.count("Generate posexplode") == 2 and "bit_or(way" in above


def test_cold_start_joins_hold_each_id_once(spark):
    """The anti-joins' right sides are distinct ids, not all ratings."""
    from ratesmith.plans import load_all
    from ratesmith.plans.registry import QUERIES
    load_all()
    plan = QUERIES["cold_start_anti"](spark, SF001)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    joins = [i for i, x in enumerate(plan) if "Join LeftAnti" in x]
    assert len(joins) >= 2
    for i in joins:
        sides = [x for x in plan[i + 1:] if depth(x) == depth(plan[i]) + 3][:2]
        assert "Aggregate" in sides[1], sides


def test_correlations_read_their_columns_from_one_table(spark):
    """The passes of the correlation queries do not repeat the joins behind their columns."""
    from ratesmith.plans import load_all
    from ratesmith.plans.registry import QUERIES
    load_all()
    for name in ("feature_correlation", "feature_correlation_matrix", "onehot_correlation"):
        files = QUERIES[name](spark, SF001).inputFiles()
        assert files and not any("lineitem" in f for f in files), name


def test_boosting_reads_its_rows_from_one_table(spark, monkeypatch):
    from ratesmith.operators import boosting as BO
    seen, edges = [], BO.feature_edges
    monkeypatch.setattr(BO, "feature_edges", lambda data, *a: (seen.append(data.inputFiles()), edges(data, *a))[1])
    rows = spark.range(40).selectExpr("cast(id % 7 as double) x", "cast(id % 3 as double) stars")
    BO.fit(rows, ["x"], BO.Params(trees=1, depth=1))
    assert seen[0] and all("training" in f for f in seen[0])


def test_candidates_are_shuffled_only_to_their_user_and_target(spark, monkeypatch):
    """Beyond one cell, candidates and similarities meet where the ratings were dealt, once."""
    monkeypatch.setattr(NB, "CELL_ROWS", 100)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        d = dataset(spark, SF001)
        plans = [plan_text(f(d.val_pairs, d.train, d.train_raw)) for f in (NB.predict, NB.item_similarity)]
        plans.append(plan_text(NB.pair_counts(d.val_pairs, d.train)))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    for plan in plans:
        exchanges = [x for x in plan.splitlines() if "Exchange" in x]
        assert not any("hashpartitioning(target" in x or "hashpartitioning(rated" in x for x in exchanges)
        assert sum("cell" in x and "Reused" not in x for x in exchanges) == 1


def test_rating_queries_derive_the_ratings_once(spark, monkeypatch):
    """Every reader of the ratings reads the one table of them, not lineitem again."""
    from ratesmith.plans import load_all
    from ratesmith.plans.registry import QUERIES
    load_all()
    for name in ("item_predictions", "item_predictions_sparse", "item_similarity", "eval_join", "error_distribution"):
        files = QUERIES[name](spark, SF001).inputFiles()
        assert files and not any("lineitem" in f for f in files), name


def test_stored_tables_leave_no_shuffle_files(spark):
    from ratesmith.session import FILE_CLEANUP, stored
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        return {f.getName() for f in _seq(spark, blocks.getAllFiles()) if f.getName().startswith("shuffle_")}

    before, conf = shuffles(), spark.conf.get(FILE_CLEANUP, None)
    df = spark.range(1000).selectExpr("id % 7 k").groupBy("k").count()
    assert stored(df, "t").count() == 7 and df.count() == 7
    # what is left is of the two counts
    left = shuffles() - before
    assert len({f.split("_")[1] for f in left}) <= 3, left
    assert spark.conf.get(FILE_CLEANUP, None) in (conf, "false")


def _seq(spark, found):
    return [found.apply(i) for i in range(found.size())]
