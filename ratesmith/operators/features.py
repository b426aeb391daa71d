"""Per-entity features and default-filling lookup joins.

Layout of the join work, which is what matters at scale:

* every per-business table (business attributes, review averages, photo and
  tip counts) is keyed by ``business_id`` and joined to the others *first*,
  on its own, small side;
* the large pairs table is then joined once per key: once with the user
  table and once with the combined business table.  Catalyst/AQE choose a
  broadcast only when the measured side is under the broadcast threshold,
  otherwise a sort-merge join (split by AQE when a key is hot).

Missing lookups take the reference's defaults (coalesce per column).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratesmith.functions import scalars as fx
from ratesmith.operators.encoders import apply_codes, sentinel_codes_multi

# ---------------------------------------------------------------------------
# Entity feature tables
# ---------------------------------------------------------------------------

USER_COLS = ("user_avg_stars", "user_review_count", "user_elite_count", "user_years",
             "user_useful", "user_funny", "user_cool", "user_fans", "user_friends_count")
BUSINESS_COLS = ("biz_stars", "biz_review_count", "biz_attributes_count", "biz_categories_count",
                 "biz_city_code", "biz_state_code", "biz_is_open", "biz_latitude", "biz_longitude")
REVIEW_COLS = ("rev_avg_stars", "rev_avg_useful", "rev_avg_funny", "rev_avg_cool")


def user_features(user: DataFrame, as_of: str = fx.DEFAULT_AS_OF, log_counts: bool = False) -> DataFrame:
    """user_id + the nine user features (doubles)."""
    rc = fx.log1p_count("review_count") if log_counts else F.col("review_count").cast("double")
    return user.select(
        "user_id",
        F.col("average_stars").cast("double").alias("user_avg_stars"),
        rc.alias("user_review_count"),
        fx.count_list("elite").cast("double").alias("user_elite_count"),
        fx.year_difference("yelping_since", as_of).cast("double").alias("user_years"),
        F.col("useful").cast("double").alias("user_useful"),
        F.col("funny").cast("double").alias("user_funny"),
        F.col("cool").cast("double").alias("user_cool"),
        F.col("fans").cast("double").alias("user_fans"),
        fx.count_list("friends").cast("double").alias("user_friends_count"),
    )


def business_features(business: DataFrame, log_counts: bool = False,
                      city_codes: DataFrame | None = None,
                      state_codes: DataFrame | None = None,
                      null_as: str | None = fx.UNKNOWN) -> DataFrame:
    """business_id + the nine business features (doubles).

    City and state codes come from :func:`sentinel_codes` over the business
    table itself unless given; a null one counts as ``null_as``, and with None
    is in no vocabulary (for rows whose absent keys already read as 'Unknown').
    """
    if city_codes is None or state_codes is None:
        codes = sentinel_codes_multi(business, ["city", "state"], null_as=null_as)
        city_codes = city_codes if city_codes is not None else codes["city"]
        state_codes = state_codes if state_codes is not None else codes["state"]
    b = apply_codes(business, "city", city_codes, "_city_code", null_as)
    b = apply_codes(b, "state", state_codes, "_state_code", null_as)
    rc = fx.log1p_count("review_count") if log_counts else F.col("review_count").cast("double")
    return b.select(
        "business_id",
        F.col("stars").cast("double").alias("biz_stars"),
        rc.alias("biz_review_count"),
        fx.map_key_count("attributes").cast("double").alias("biz_attributes_count"),
        fx.raw_token_count("categories").cast("double").alias("biz_categories_count"),
        F.col("_city_code").cast("double").alias("biz_city_code"),
        F.col("_state_code").cast("double").alias("biz_state_code"),
        F.col("is_open").cast("double").alias("biz_is_open"),
        fx.safe_double("latitude").alias("biz_latitude"),
        fx.safe_double("longitude").alias("biz_longitude"),
    )


# ---------------------------------------------------------------------------
# Aggregates keyed by business
# ---------------------------------------------------------------------------

def count_by_business(refs: DataFrame, name: str) -> DataFrame:
    """A2 + P3: rows per non-null business_id (photo/tip counts)."""
    return (refs.where(F.col("business_id").isNotNull())
                .groupBy("business_id").agg(F.count(F.lit(1)).alias(name)))


def review_averages(review: DataFrame, cols: Sequence[str] = ("stars", "useful", "funny", "cool"),
                    prefix: str = "rev_avg_") -> DataFrame:
    """A3/A4: per-business means where a missing value counts as 0."""
    return review.groupBy("business_id").agg(
        *[F.avg(F.coalesce(F.col(c).cast("double"), F.lit(0.0))).alias(f"{prefix}{c}") for c in cols])


# ---------------------------------------------------------------------------
# Lookup joins with defaults
# ---------------------------------------------------------------------------

def lookup_join(left: DataFrame, table: DataFrame, key: str | Sequence[str],
                defaults: Mapping[str, float]) -> DataFrame:
    """Left join ``table`` and fill its columns with ``defaults`` where missing."""
    keys = [key] if isinstance(key, str) else list(key)
    cols = [c for c in table.columns if c not in keys]
    j = left.join(table, keys, "left")
    fills = {c: F.coalesce(F.col(c), F.lit(defaults[c]).cast(table.schema[c].dataType))
             for c in cols if c in defaults}
    return j.withColumns(fills) if fills else j


# Defaults of the reference's lookups, per feature set (fixed values).
USER_DEFAULTS = {"user_avg_stars": 3.0, **{c: 0.0 for c in USER_COLS[1:]}}
BUSINESS_DEFAULTS_CODED = {"biz_stars": 3.0, "biz_review_count": 0.0, "biz_attributes_count": 0.0,
                           "biz_categories_count": 0.0, "biz_city_code": -1.0, "biz_state_code": -1.0,
                           "biz_is_open": 0.0, "biz_latitude": 0.0, "biz_longitude": 0.0}
BUSINESS_DEFAULTS_ZERO = {**BUSINESS_DEFAULTS_CODED, "biz_city_code": 0.0, "biz_state_code": 0.0}
REVIEW_DEFAULTS = {c: 0.0 for c in REVIEW_COLS}
COUNT_DEFAULTS = {"photo_count": 0.0, "tip_count": 0.0}

# Feature sets: ordered columns of the assembled vector.
FEATURE_SETS = {
    "fs7": ("user_avg_stars", "user_review_count", "biz_stars", "biz_review_count",
            "rev_avg_useful", "rev_avg_funny", "rev_avg_cool"),
    "fs20": USER_COLS + BUSINESS_COLS[:6] + REVIEW_COLS + ("photo_count",),
    "fs23": USER_COLS + BUSINESS_COLS + REVIEW_COLS[1:] + ("photo_count", "tip_count"),
    "fs20l": USER_COLS + BUSINESS_COLS[:7] + REVIEW_COLS[1:] + ("photo_count",),
}
FEATURE_SETS["fs23l"] = FEATURE_SETS["fs23"]   # same columns, log1p review counts
LOG_COUNT_SETS = {"fs20l", "fs23l"}


def business_side(business: DataFrame, review: DataFrame, photo: DataFrame | None,
                  tip: DataFrame | None, feature_set: str, log_counts: bool | None = None,
                  null_as: str | None = fx.UNKNOWN) -> DataFrame:
    """All per-business features of a set in one table keyed by business_id.

    Tables are outer-joined on the business key (each already hash-partitioned
    by it after its aggregate), so a business with reviews but no profile row
    still gets its review averages.
    """
    log_counts = feature_set in LOG_COUNT_SETS if log_counts is None else log_counts
    wanted = set(FEATURE_SETS[feature_set])
    biz = business_features(business, log_counts=log_counts, null_as=null_as)
    biz = biz.select("business_id", *[c for c in BUSINESS_COLS if c in wanted])
    rev = review_averages(review)
    rev = rev.select("business_id", *[c for c in REVIEW_COLS if c in wanted])
    side = biz.join(rev, "business_id", "full")
    if "photo_count" in wanted and photo is not None:
        side = side.join(count_by_business(photo, "photo_count"), "business_id", "full")
    if "tip_count" in wanted and tip is not None:
        side = side.join(count_by_business(tip, "tip_count"), "business_id", "full")
    return side


def feature_table(pairs: DataFrame, user: DataFrame, business: DataFrame, review: DataFrame,
                  photo: DataFrame | None = None, tip: DataFrame | None = None,
                  feature_set: str = "fs23", as_of: str = fx.DEFAULT_AS_OF,
                  label: str | None = "stars", keep_ids: bool = True,
                  side: DataFrame | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """D4 ``extract_features``: pairs + the ordered feature columns (+ label).

    ``side`` is an already built :func:`business_side` table, so train and
    validation pairs can share one.  ``carry`` names columns of the pairs to
    keep (a line ordinal, say).
    """
    cols = FEATURE_SETS[feature_set]
    log_counts = feature_set in LOG_COUNT_SETS
    biz_defaults = BUSINESS_DEFAULTS_ZERO if feature_set == "fs20" else BUSINESS_DEFAULTS_CODED
    u = user_features(user, as_of, log_counts=log_counts).select("user_id", *[c for c in USER_COLS if c in cols])
    b = side if side is not None else business_side(business, review, photo, tip, feature_set)
    defaults = {**USER_DEFAULTS, **biz_defaults, **REVIEW_DEFAULTS, **COUNT_DEFAULTS}
    base_cols = ["user_id", "business_id", *carry] + ([label] if label and label in pairs.columns else [])
    out = lookup_join(pairs.select(*base_cols), u, "user_id", defaults)
    out = lookup_join(out, b, "business_id", defaults)
    # counts come back as long; every feature is a double in the vector
    fill_missing = {c: F.lit(defaults[c]) for c in cols if c not in out.columns}
    out = out.withColumns(fill_missing) if fill_missing else out
    sel = ([F.col("user_id"), F.col("business_id")] if keep_ids else []) + \
          [F.col(c) for c in carry] + \
          [F.coalesce(F.col(c).cast("double"), F.lit(defaults[c])).alias(c) for c in cols]
    if label and label in pairs.columns:
        sel.append(F.col(label).cast("double").alias(label))
    return out.select(*sel)


def wide_train(train: DataFrame, business: DataFrame, user: DataFrame) -> DataFrame:
    """Train ⋈ business ⋈ user (left), clashing names disambiguated."""
    b = business.withColumnsRenamed({"stars": "b_stars", "review_count": "b_review_count"})
    u = user.withColumnsRenamed({"review_count": "u_review_count"})
    return train.join(b, "business_id", "left").join(u, "user_id", "left")
