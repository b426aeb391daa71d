"""Hand-made edge rows for the scalar functions and small operators (FIXTURES.md part 3)."""

import math

import pytest
from pyspark.sql import functions as F

from ratesmith.functions import scalars as fx
from ratesmith.operators import blend as BL
from ratesmith.operators import encoders as EN
from ratesmith.operators import evaluate as EV
from ratesmith.operators.dedupe import last_by_ordinal


def col_values(df, col):
    return [r[col] for r in df.collect()]


def test_count_list_sentinel(spark):
    df = spark.createDataFrame([("None",), ("2012,2013",), ("",), (None,)], "elite string")
    out = df.select(fx.count_list("elite").alias("a"), fx.count_list("elite", null_safe=True).alias("b"))
    rows = out.collect()
    assert [r.a for r in rows] == [0, 2, 1, None]
    assert [r.b for r in rows] == [0, 2, 1, 0]


def test_raw_vs_nonblank_tokens(spark):
    df = spark.createDataFrame([("a,, b ,",), (None,), ("",)], "c string")
    rows = df.select(fx.raw_token_count("c").alias("raw"), fx.nonblank_token_count("c").alias("nb"),
                     fx.token_list("c").alias("lst")).collect()
    assert rows[0].raw == 4 and rows[0].nb == 2 and rows[0].lst == ["a", "b"]
    assert rows[1].raw == 0 and rows[1].nb == 0
    assert rows[2].raw == 0 and rows[2].nb == 0


def test_attributes_count(spark):
    df = spark.createDataFrame([({},), (None,), ({"A": "x", "B": '{"c": 1}'},)], "a map<string,string>")
    assert col_values(df.select(fx.map_key_count("a").alias("n")), "n") == [0, 0, 2]


def test_safe_double(spark):
    df = spark.createDataFrame([("12.5",), ("bad",), (None,)], "v string")
    assert col_values(df.select(fx.safe_double("v").alias("x")), "x") == [12.5, 0.0, 0.0]


def test_membership_years(spark):
    df = spark.createDataFrame([("2012-05",), ("2012",), ("2012-05-03",), ("x",), ("2012-5",)], "d string")
    vals = col_values(df.select(fx.membership_years("d", "2026-01-01").alias("y")), "y")
    import datetime as dt
    exp_month = (dt.date(2026, 1, 1) - dt.date(2012, 5, 1)).days / 365.25
    exp_year = (dt.date(2026, 1, 1) - dt.date(2012, 1, 1)).days / 365.25
    assert vals[0] == pytest.approx(exp_month)
    assert vals[1] == pytest.approx(exp_year)
    assert vals[2] == 5.0 and vals[3] == 5.0
    assert vals[4] == pytest.approx(exp_month)


def test_year_difference(spark):
    df = spark.createDataFrame([("2012-05-03",)], "d string")
    assert col_values(df.select(fx.year_difference("d", "2026-01-01").alias("y")), "y") == [14]


def test_sentinel_encoder(spark):
    df = spark.createDataFrame([("b",), ("a",), ("Unknown",), (None,), ("None",)], "city string")
    out = EN.sentinel_encode(df, "city", "code")
    got = {r.city: r.code for r in out.collect()}
    # 'Unknown' sorts before lower case, so it takes slot 0, leaving a gap.
    assert got["a"] == 1 and got["b"] == 2
    assert got["Unknown"] == -1 and got[None] == -1 and got["None"] == -1


def test_label_encoder(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "s string")
    got = {r.s: r.code for r in EN.label_encode(df, "s", "code").collect()}
    assert got == {"Unknown": 0, "a": 1, "b": 2} or got == {None: 0, "a": 1, "b": 2}


def test_consecutive_index_is_dense(spark):
    df = spark.range(0, 1000).select((F.col("id") * 7 % 1000).alias("v"))
    idx = EN.consecutive_index(df, ["v"], "i", num_partitions=5)
    rows = idx.collect()
    assert sorted(r.i for r in rows) == list(range(1000))
    assert all(r.i == r.v for r in rows)


def test_variance(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 1.0), (2, 3.0)], "business_id long, stars double")
    got = {r.business_id: (r.review_count, r.rating_variance) for r in BL.review_stats(df).collect()}
    assert got[1] == (1, 0.0) and got[2] == (2, 2.0)


def test_blend_weight_at_means(spark):
    df = spark.createDataFrame([(10.0, 2.0, 10.0, 2.0)], "n double, v double, x0 double, y0 double")
    a = df.select(fx.logistic_alpha("n", "v", "x0", "y0", 0.01, 0.1).alias("a")).first().a
    assert a == pytest.approx(0.5)


def test_error_bins(spark):
    pred = spark.createDataFrame([(1, 1, 3.0), (2, 2, 3.999), (3, 3, 4.0), (4, 4, 1.0), (5, 5, 2.0)],
                                 "user_id long, business_id long, prediction double")
    truth = spark.createDataFrame([(1, 1, 3.0), (2, 2, 3.0), (3, 3, 3.0), (4, 4, 5.0), (5, 5, None)],
                                  "user_id long, business_id long, stars double")
    dist = {r.error_bin: r.n_pairs for r in EV.error_distribution(pred, truth).collect()}
    # errors 0, 0.999, 1.0, 4.0 (and one NULL left out); [2,3) and [3,4) empty but shown
    assert dist == {0: 2, 1: 1, 2: 0, 3: 0, 4: 1}


def test_minmax_constant_column(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (5.0,)], "x double")
    out = EN.minmax_scale(df, ["x"], EN.minmax_stats(df, ["x"]))
    assert col_values(out, "x") == [0.0, 0.0, 0.0]


def test_duplicate_rating_last_wins(spark):
    df = spark.createDataFrame([(1, 1, 2.0, 0), (1, 1, 4.0, 1)], "user_id long, business_id long, stars double, o long")
    last = last_by_ordinal(df, ["user_id", "business_id"], ["stars"], ["o"]).first()
    assert last.stars == 4.0
    assert df.groupBy("user_id").agg(F.avg("stars").alias("m")).first().m == 3.0


def test_amplify_and_clamp(spark):
    df = spark.createDataFrame([(-1.0,), (0.5,)], "w double")
    vals = col_values(df.select(fx.amplify("w").alias("a")), "a")
    assert vals[0] == 1.0 and math.isclose(vals[1], 0.5 ** 2.5)
    df2 = spark.createDataFrame([(0.2,), (7.0,), (3.3,)], "x double")
    assert col_values(df2.select(fx.clamp("x", 1, 5).alias("c")), "c") == [1.0, 5.0, 3.3]


def _pearson(xs, ys):
    pts = [(x, y) for x, y in zip(xs, ys) if x is not None and y is not None]
    mx = sum(p[0] for p in pts) / len(pts)
    my = sum(p[1] for p in pts) / len(pts)
    sxy = sum((x - mx) * (y - my) for x, y in pts)
    sxx = sum((x - mx) ** 2 for x, _ in pts)
    syy = sum((y - my) ** 2 for _, y in pts)
    return None if sxx == 0 or syy == 0 else sxy / (sxx * syy) ** 0.5


@pytest.mark.parametrize("with_nulls", [False, True])
def test_correlation_matrix(spark, with_nulls):
    from ratesmith.operators.profile import correlation_matrix
    import random
    rnd = random.Random(7)
    rows = []
    for i in range(60):
        a = float(rnd.randint(0, 9))
        b = a * 2 + rnd.random()
        c = 5.0
        if with_nulls and i % 7 == 0:
            b = None
        rows.append((a, b, c))
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = {(r.feature_a, r.feature_b): r.corr for r in correlation_matrix(df, ["a", "b", "c"]).collect()}
    cols = {"a": [r[0] for r in rows], "b": [r[1] for r in rows], "c": [r[2] for r in rows]}
    for (fa, fb), v in got.items():
        want = _pearson(cols[fa], cols[fb])
        if want is None:
            assert v is None
        else:
            assert v == pytest.approx(want, abs=1e-9)
    assert len(got) == 6
