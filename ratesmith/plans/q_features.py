"""Queries over entity features, lookups and feature sets (P*, A2-A4, J1-J5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratesmith.operators import features as FT
from ratesmith.plans.oracle_views import feature_select
from ratesmith.plans.registry import register
from ratesmith.sources.fixtures import dataset


@register("user_features", """
    SELECT * FROM f_user_feat""", doubles=FT.USER_COLS)
def q_user_features(spark, sf_dir):
    """The nine user features per user."""
    return FT.user_features(dataset(spark, sf_dir).user)


@register("business_features", """
    SELECT * FROM f_biz_feat""", doubles=FT.BUSINESS_COLS)
def q_business_features(spark, sf_dir):
    """The nine business features per business (codes via W1)."""
    return FT.business_features(dataset(spark, sf_dir).business)


@register("log1p_counts", """
    SELECT u.user_id AS id, 'user' AS entity, u.user_review_count AS log_review_count FROM f_user_feat_log u
    UNION ALL
    SELECT b.business_id, 'business', b.biz_review_count FROM f_biz_feat_log b""",
          doubles=("log_review_count",))
def q_log1p_counts(spark, sf_dir):
    """log1p review counts of users and businesses."""
    d = dataset(spark, sf_dir)
    u = FT.user_features(d.user, log_counts=True).select(
        F.col("user_id").alias("id"), F.lit("user").alias("entity"),
        F.col("user_review_count").alias("log_review_count"))
    b = FT.business_features(d.business, log_counts=True).select(
        F.col("business_id").alias("id"), F.lit("business").alias("entity"),
        F.col("biz_review_count").alias("log_review_count"))
    return u.unionByName(b)


@register("review_averages", """
    SELECT * FROM f_rev_avg""", doubles=FT.REVIEW_COLS)
def q_review_averages(spark, sf_dir):
    """A3: four per-business averages, a missing field counting as 0."""
    return FT.review_averages(dataset(spark, sf_dir).review)


@register("review_averages3", """
    SELECT business_id, rev_avg_useful, rev_avg_funny, rev_avg_cool FROM f_rev_avg""",
          doubles=FT.REVIEW_COLS[1:])
def q_review_averages3(spark, sf_dir):
    """A4: three per-business averages (useful, funny, cool)."""
    return FT.review_averages(dataset(spark, sf_dir).review, ("useful", "funny", "cool"))


@register("photo_count", "SELECT business_id, photo_count FROM f_photo_cnt")
def q_photo_count(spark, sf_dir):
    """A2 + P3: photos per non-null business."""
    return FT.count_by_business(dataset(spark, sf_dir).photo, "photo_count")


@register("tip_count", "SELECT business_id, tip_count FROM f_tip_cnt")
def q_tip_count(spark, sf_dir):
    """A2 + P3: tips per non-null business."""
    return FT.count_by_business(dataset(spark, sf_dir).tip, "tip_count")


def _feature_query(fs: str, pairs_attr: str, pairs_sql: str, label: bool):
    def fn(spark, sf_dir):
        d = dataset(spark, sf_dir)
        pairs = getattr(d, pairs_attr)
        return FT.feature_table(pairs, d.user, d.business, d.review, d.photo, d.tip,
                                feature_set=fs, label="stars" if label else None)
    fn.__doc__ = f"P12/D4: feature set {fs} over {pairs_attr} with lookup defaults."
    doubles = FT.FEATURE_SETS[fs] + (("stars",) if label else ())
    register(f"features_{fs}", feature_select(pairs_sql, fs, label), doubles=doubles)(fn)


for _fs in ("fs7", "fs20", "fs23", "fs20l", "fs23l"):
    _feature_query(_fs, "train_raw", "f_train_raw", True)


def _lookup_query(name: str, cols, doc: str):
    def fn(spark, sf_dir):
        d = dataset(spark, sf_dir)
        t = FT.feature_table(d.val_pairs, d.user, d.business, d.review, d.photo, d.tip,
                             feature_set="fs23", label=None)
        return t.select("user_id", "business_id", *cols)
    fn.__doc__ = doc
    full = feature_select("f_val", "fs23", label=False)
    sql = f"SELECT user_id, business_id, {', '.join(cols)} FROM ({full}) j"
    register(name, sql, doubles=cols)(fn)


_lookup_query("join_user_defaults", FT.USER_COLS,
              "J1: validation pairs left-joined to user features, missing users at (3.0, 0...).")
_lookup_query("join_business_defaults", FT.BUSINESS_COLS,
              "J2: validation pairs left-joined to business features, missing at (3.0,0,0,0,-1,-1,0,0,0).")
_lookup_query("join_review_defaults", FT.REVIEW_COLS[1:] + ("photo_count", "tip_count"),
              "J3/J4: review averages and photo/tip counts, missing at 0.")
