"""Queries of blend, evaluation, profiling, scalar functions and encoders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratesmith.functions import scalars as fx
from ratesmith.operators import blend as BL
from ratesmith.operators import encoders as EN
from ratesmith.operators import evaluate as EV
from ratesmith.operators import features as FT
from ratesmith.operators import neighbors as NB
from ratesmith.operators import profile as PR
from ratesmith.plans.oracle_views import define_view, feature_select
from ratesmith.plans.registry import register
from ratesmith.sources.fixtures import ORDINAL, dataset
from ratesmith.sources.readers import preview

# ---------------------------------------------------------------------------
# oracle views
# ---------------------------------------------------------------------------

define_view("f_rev_stats", """
    SELECT business_id, count(*) AS review_count,
           coalesce(var_samp(stars), 0.0) AS rating_variance
    FROM f_review GROUP BY business_id""")
define_view("f_gmeans", """
    SELECT coalesce(avg(review_count), 0.0) AS x0, coalesce(avg(rating_variance), 0.0) AS y0
    FROM f_rev_stats""")


def _alpha_sql(n: str, v: str) -> str:
    return (f"greatest(0.0, least(1.0, 0.5 * (1.0 / (1.0 + exp({BL.K1} * ({n} - g.x0)))) "
            f"+ 0.5 * (1.0 / (1.0 + exp({BL.K2} * ({v} - g.y0))))))")


define_view("f_user_mean_pred", """
    SELECT v.user_id, v.business_id, m.avg_rating AS prediction
    FROM f_val v JOIN (SELECT user_id, avg(stars) AS avg_rating FROM f_train_raw GROUP BY user_id) m
      ON m.user_id = v.user_id""")
define_view("f_eval", """
    SELECT p.user_id, p.business_id, p.prediction, v.stars
    FROM f_item_pred p JOIN f_val v ON v.user_id = p.user_id AND v.business_id = p.business_id""")
define_view("f_wide", """
    SELECT t.user_id, t.business_id, t.stars,
           b.stars AS b_stars, b.review_count AS b_review_count, b.is_open, b.city, b.state,
           b.categories, b.attributes_count, b.latitude, b.longitude,
           u.average_stars, u.review_count AS u_review_count, u.fans, u.elite, u.friends,
           u.yelping_since
    FROM f_train_raw t LEFT JOIN f_business b ON b.business_id = t.business_id
    LEFT JOIN f_user u ON u.user_id = t.user_id""")
for _c in ("state", "city"):
    define_view(f"f_wide_{_c}_codes", f"""
    SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS BIGINT) AS code
    FROM (SELECT DISTINCT coalesce({_c}, 'Unknown') AS v FROM f_wide) d""")


def _membership_sql(col: str) -> str:
    d = f"coalesce(try_strptime({col}, '%Y-%m'), try_strptime({col}, '%Y'))"
    return f"coalesce(datediff('day', CAST({d} AS DATE), DATE '{fx.DEFAULT_AS_OF}') / 365.25, 5.0)"


define_view("f_eda", f"""
    SELECT w.user_id, w.business_id,
           CAST(w.b_stars AS DOUBLE) AS b_stars, CAST(w.b_review_count AS DOUBLE) AS b_review_count,
           CAST(w.is_open AS DOUBLE) AS is_open,
           CAST(coalesce(w.attributes_count, 0) AS DOUBLE) AS num_attrs,
           CAST(len(list_filter(string_split(coalesce(w.categories, ''), ','), lambda x: trim(x) <> ''))
                AS DOUBLE) AS num_categories,
           coalesce(TRY_CAST(w.latitude AS DOUBLE), 0.0) AS latitude,
           coalesce(TRY_CAST(w.longitude AS DOUBLE), 0.0) AS longitude,
           CAST(CASE WHEN w.elite IS NULL OR w.elite = 'None' THEN 0
                     ELSE len(string_split(w.elite, ',')) END AS DOUBLE) AS num_elite,
           CAST(CASE WHEN w.friends IS NULL OR w.friends = 'None' THEN 0
                     ELSE len(string_split(w.friends, ',')) END AS DOUBLE) AS num_friends,
           {_membership_sql('w.yelping_since')} AS membership_years,
           CAST(sc.code AS DOUBLE) AS state_encoded, CAST(cc.code AS DOUBLE) AS city_encoded,
           CAST(w.average_stars AS DOUBLE) AS average_stars,
           CAST(w.u_review_count AS DOUBLE) AS u_review_count, CAST(w.fans AS DOUBLE) AS fans,
           CAST(w.stars AS DOUBLE) AS stars
    FROM f_wide w
    LEFT JOIN f_wide_state_codes sc ON sc.v = coalesce(w.state, 'Unknown')
    LEFT JOIN f_wide_city_codes cc ON cc.v = coalesce(w.city, 'Unknown')""")


def _corr_sql() -> str:
    means = ", ".join(
        f"avg(CASE WHEN {f} IS NOT NULL AND stars IS NOT NULL THEN {f} END) AS mx{i}, "
        f"avg(CASE WHEN {f} IS NOT NULL AND stars IS NOT NULL THEN stars END) AS my{i}"
        for i, f in enumerate(PR.EDA_FEATURES))
    parts = []
    for i, f in enumerate(PR.EDA_FEATURES):
        parts.append(f"""SELECT '{f}' AS feature, sum(({f} - mx{i}) * (stars - my{i})) AS sxy,
               sum(({f} - mx{i}) * ({f} - mx{i})) AS sxx, sum((stars - my{i}) * (stars - my{i})) AS syy
        FROM f_eda, ({'SELECT ' + means + ' FROM f_eda'}) m
        WHERE {f} IS NOT NULL AND stars IS NOT NULL""")
    union = "\n UNION ALL ".join(parts)
    return f"""SELECT feature, CASE WHEN sxx = 0 OR syy = 0 THEN CAST(NULL AS DOUBLE)
                             ELSE sxy / sqrt(sxx * syy) END AS corr
    FROM ({union}) s"""


WIDE_COLS = ("user_id", "business_id", "stars", "b_stars", "b_review_count", "is_open", "city",
             "state", "categories", "attributes_count", "latitude", "longitude", "average_stars",
             "u_review_count", "fans", "elite", "friends", "yelping_since")


def _wide(spark, sf_dir):
    d = dataset(spark, sf_dir)
    w = FT.wide_train(d.train_raw, d.business, d.user)
    return w.withColumn("attributes_count", fx.map_key_count("attributes")).select(*WIDE_COLS)


def _item_pred(d):
    return NB.predict(d.val_pairs, d.train, d.train_raw)


# ---------------------------------------------------------------------------
# blend (Q4 parts)
# ---------------------------------------------------------------------------

@register("review_variance", "SELECT * FROM f_rev_stats", doubles=("rating_variance",))
def q_review_variance(spark, sf_dir):
    """A5: review count and sample variance of stars per business."""
    return BL.review_stats(dataset(spark, sf_dir).review)


@register("global_means", "SELECT * FROM f_gmeans", doubles=("x0", "y0"))
def q_global_means(spark, sf_dir):
    """Mean review count and mean variance over businesses."""
    return BL.global_means(BL.review_stats(dataset(spark, sf_dir).review))


@register("blend_alpha", f"""
    SELECT s.business_id, s.review_count, s.rating_variance,
           {_alpha_sql('s.review_count', 's.rating_variance')} AS alpha
    FROM f_rev_stats s CROSS JOIN f_gmeans g""", doubles=("rating_variance", "alpha"))
def q_blend_alpha(spark, sf_dir):
    """F16 (+J11 inputs): logistic blend weight per business."""
    return BL.alpha_table(dataset(spark, sf_dir).review)


@register("hybrid_blend", f"""
    SELECT ip.user_id, ip.business_id, a.alpha,
           a.alpha * coalesce(ip.prediction, 3.0) + (1.0 - a.alpha) * coalesce(op.prediction, 3.0) AS prediction
    FROM (SELECT DISTINCT user_id, business_id, prediction FROM f_item_pred) ip
    LEFT JOIN f_user_mean_pred op ON op.user_id = ip.user_id AND op.business_id = ip.business_id
    JOIN (SELECT k.business_id,
                 {_alpha_sql('coalesce(s.review_count, 0)', 'coalesce(s.rating_variance, 0.0)')} AS alpha
          FROM (SELECT DISTINCT business_id FROM f_val) k
          LEFT JOIN f_rev_stats s ON s.business_id = k.business_id CROSS JOIN f_gmeans g) a
      ON a.business_id = ip.business_id""", doubles=("alpha", "prediction"))
def q_hybrid_blend(spark, sf_dir):
    """J10 + F17: item predictions blended with the user-mean predictor."""
    d = dataset(spark, sf_dir, once=True)
    means = NB.entity_means(d.train_raw, "user_id", "prediction")
    other = d.val_pairs.select("user_id", "business_id").join(means, "user_id")
    return BL.blend(_item_pred(d), other, d.review)


# ---------------------------------------------------------------------------
# evaluation (Q7)
# ---------------------------------------------------------------------------

@register("eval_join", "SELECT * FROM f_eval", doubles=("prediction", "stars"))
def q_eval_join(spark, sf_dir):
    """Predictions inner-joined with the validation truth."""
    d = dataset(spark, sf_dir, once=True)
    return EV.eval_join(_item_pred(d), d.val_pairs)


@register("abs_error", """
    SELECT user_id, business_id, abs(prediction - stars) AS error FROM f_eval""", doubles=("error",))
def q_abs_error(spark, sf_dir):
    """absolute error per evaluated pair (NULL without truth)."""
    d = dataset(spark, sf_dir, once=True)
    return EV.with_errors(EV.eval_join(_item_pred(d), d.val_pairs)).select("user_id", "business_id", "error")


@register("error_bins", """
    SELECT user_id, business_id, abs(prediction - stars) AS error,
           CASE WHEN stars IS NULL THEN NULL
                ELSE CAST(least(floor(abs(prediction - stars)), 4) AS BIGINT) END AS error_bin
    FROM f_eval""", doubles=("error",))
def q_error_bins(spark, sf_dir):
    """left-closed error bin per evaluated pair."""
    d = dataset(spark, sf_dir, once=True)
    return EV.with_errors(EV.eval_join(_item_pred(d), d.val_pairs)).select(
        "user_id", "business_id", "error", "error_bin")


_BIN_VALUES = ", ".join(f"({i}, '{lbl}')" for i, lbl in enumerate(fx.ERROR_BIN_LABELS))


@register("error_distribution", f"""
    SELECT CAST(d.error_bin AS BIGINT) AS error_bin, d.label, CAST(coalesce(c.n, 0) AS BIGINT) AS n_pairs
    FROM (VALUES {_BIN_VALUES}) d(error_bin, label)
    LEFT JOIN (SELECT CAST(least(floor(abs(prediction - stars)), 4) AS BIGINT) AS b, count(*) AS n
               FROM f_eval WHERE stars IS NOT NULL GROUP BY 1) c ON c.b = d.error_bin""")
def q_error_distribution(spark, sf_dir):
    """A12 + O3: histogram of absolute errors of the item predictions."""
    d = dataset(spark, sf_dir, once=True)
    return EV.error_distribution(_item_pred(d), d.val_pairs)


@register("rmse", """
    SELECT count(*) AS n_pairs, avg(pow(prediction - stars, 2)) AS mse,
           sqrt(avg(pow(prediction - stars, 2))) AS rmse
    FROM f_eval WHERE stars IS NOT NULL AND prediction IS NOT NULL""", doubles=("mse", "rmse"))
def q_rmse(spark, sf_dir):
    """RMSE of the item predictions on the validation truth."""
    d = dataset(spark, sf_dir, once=True)
    return EV.rmse(_item_pred(d), d.val_pairs)


# ---------------------------------------------------------------------------
# profiling (Q6)
# ---------------------------------------------------------------------------

@register("wide_train", f"SELECT {', '.join(WIDE_COLS)} FROM f_wide",
          doubles=("stars", "b_stars", "average_stars"))
def q_wide_train(spark, sf_dir):
    """Train ⋈ business ⋈ user with clashing names renamed."""
    return _wide(spark, sf_dir)


_NULL_SQL = "\n UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({c} IS NULL) AS BIGINT) AS null_count FROM f_wide"
    for c in WIDE_COLS)


@register("null_counts", _NULL_SQL)
def q_null_counts(spark, sf_dir):
    """NULL count of every column of the merged train table."""
    return PR.null_counts(_wide(spark, sf_dir))


@register("feature_correlation", _corr_sql(), doubles=("corr",))
def q_feature_correlation(spark, sf_dir):
    """A11 + O2: correlation of every profiling feature with the rating."""
    d = dataset(spark, sf_dir)
    eda = PR.eda_features(d.train_raw, d.business, d.user)
    return PR.label_correlations(eda, PR.EDA_FEATURES, "stars")


_MATRIX_COLS = PR.EDA_FEATURES + ("stars",)


def _matrix_sql() -> str:
    pairs = [(a, b) for i, a in enumerate(_MATRIX_COLS) for b in _MATRIX_COLS[i:]]
    parts = []
    for a, b in pairs:
        both = f"{a} IS NOT NULL AND {b} IS NOT NULL"
        parts.append(f"""SELECT '{a}' AS feature_a, '{b}' AS feature_b,
               sum(({a} - ma) * ({b} - mb)) AS sxy, sum(({a} - ma) * ({a} - ma)) AS sxx,
               sum(({b} - mb) * ({b} - mb)) AS syy
        FROM f_eda, (SELECT avg(CASE WHEN {both} THEN {a} END) AS ma,
                            avg(CASE WHEN {both} THEN {b} END) AS mb FROM f_eda) m
        WHERE {both}""")
    union = "\n UNION ALL ".join(parts)
    return f"""SELECT feature_a, feature_b, CASE WHEN sxx = 0 OR syy = 0 THEN CAST(NULL AS DOUBLE)
                                   ELSE sxy / sqrt(sxx * syy) END AS corr
    FROM ({union}) s"""


@register("feature_correlation_matrix", _matrix_sql(), doubles=("corr",))
def q_feature_correlation_matrix(spark, sf_dir):
    """A11 (full matrix): pairwise correlations of the profiling features and the rating."""
    d = dataset(spark, sf_dir)
    eda = PR.eda_features(d.train_raw, d.business, d.user)
    return PR.correlation_matrix(eda, _MATRIX_COLS)


@register("category_correlation", """
    WITH base AS (SELECT w.user_id, w.business_id, CAST(w.stars AS DOUBLE) AS y, w.categories
                  FROM f_wide w WHERE w.stars IS NOT NULL),
         g AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(y) AS sy, sum(y * y) AS syy FROM base),
         cells AS (SELECT b.y, u.x AS category
                   FROM base b, unnest(list_distinct(list_transform(
                     string_split(coalesce(b.categories, ''), ','), lambda s: trim(s)))) u(x)
                   WHERE u.x <> ''),
         per AS (SELECT category, CAST(count(*) AS DOUBLE) AS n1, sum(y) AS s1 FROM cells GROUP BY category)
    SELECT category,
           CASE WHEN n1 * (n - n1) <= 0 OR n * syy - sy * sy <= 0 THEN CAST(NULL AS DOUBLE)
                ELSE (n * s1 - n1 * sy) / (sqrt(n1 * (n - n1)) * sqrt(n * syy - sy * sy)) END AS corr
    FROM per, g""", doubles=("corr",))
def q_category_correlation(spark, sf_dir):
    """A11 + M2: correlation of each category indicator with the rating."""
    d = dataset(spark, sf_dir)
    w = FT.wide_train(d.train_raw, d.business, d.user).select("user_id", "business_id", "stars", "categories")
    return PR.indicator_correlations(w, ["user_id", "business_id"], "categories", "stars")


def _onehot_sql() -> str:
    numbers = "\n UNION ALL ".join(f"""SELECT 'number' AS kind, category AS feature_a, '{f}' AS feature_b,
          CASE WHEN n1 * (n - n1) <= 0 OR q <= 0 THEN CAST(NULL AS DOUBLE)
               ELSE n * s1 / (sqrt(n1 * (n - n1)) * sqrt(n * q)) END AS corr
        FROM (SELECT category, CAST(count(*) AS DOUBLE) AS n1, sum({f} - m) AS s1
              FROM f_eda JOIN cat USING (business_id), (SELECT avg({f}) AS m FROM f_eda)
              WHERE {f} IS NOT NULL GROUP BY category),
             (SELECT CAST(count(*) AS DOUBLE) AS n, sum(({f} - m) ** 2) AS q
              FROM f_eda, (SELECT avg({f}) AS m FROM f_eda) WHERE {f} IS NOT NULL)""" for f in _MATRIX_COLS)
    return f"""
    WITH cat AS (SELECT DISTINCT business_id, trim(u.x) AS category
                 FROM (SELECT DISTINCT business_id, categories FROM f_wide) w,
                      unnest(string_split(coalesce(categories, ''), ',')) u(x) WHERE trim(u.x) <> ''),
    c AS (SELECT r.business_id, r.w, cat.category
          FROM (SELECT business_id, CAST(count(*) AS DOUBLE) AS w FROM f_eda GROUP BY business_id) r
          JOIN cat USING (business_id)),
    one AS (SELECT category, sum(w) AS n1 FROM c GROUP BY category),
    tot AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM f_eda),
    ab AS (SELECT x.category AS a, y.category AS b, sum(x.w) AS nab
           FROM c x JOIN c y ON x.business_id = y.business_id AND x.category < y.category GROUP BY ALL)
    SELECT 'label' AS kind, a AS feature_a, b AS feature_b,
           CASE WHEN oa.n1 * (n - oa.n1) <= 0 OR ob.n1 * (n - ob.n1) <= 0 THEN CAST(NULL AS DOUBLE)
                ELSE (n * nab - oa.n1 * ob.n1) / (sqrt(oa.n1 * (n - oa.n1)) * sqrt(ob.n1 * (n - ob.n1))) END AS corr
    FROM ab JOIN one oa ON oa.category = a JOIN one ob ON ob.category = b, tot
    UNION ALL {numbers}"""


@register("onehot_correlation", _onehot_sql(), doubles=("corr",))
def q_onehot_correlation(spark, sf_dir):
    """A11 + M2: correlations of one-hot categories with each other and with every number."""
    d = dataset(spark, sf_dir)
    eda = PR.eda_features(d.train_raw, d.business, d.user)
    return PR.onehot_correlations(eda, EN.category_pairs(d.business, "business_id"), "business_id", _MATRIX_COLS)


def _eda_vector_sql() -> str:
    numbers = "\n UNION ALL ".join(
        f"SELECT user_id, business_id, {i} AS i, {c} AS x FROM f_eda WHERE coalesce({c}, 0) <> 0"
        for i, c in enumerate(PR.EDA_FEATURES))
    at = len(PR.EDA_FEATURES)
    return f"""
    WITH b AS (SELECT DISTINCT business_id, categories FROM f_wide),
    cat AS (SELECT DISTINCT business_id, trim(u.x) AS value
            FROM b, unnest(string_split(coalesce(categories, ''), ',')) u(x) WHERE trim(u.x) <> ''),
    v AS (SELECT value, row_number() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT value FROM cat) d),
    cells AS ({numbers}
      UNION ALL SELECT e.user_id, e.business_id, {at} + v.code, 1.0
      FROM f_eda e JOIN cat USING (business_id) JOIN v USING (value))
    SELECT user_id, business_id, CAST(i AS BIGINT) AS feature, CAST(x AS DOUBLE) AS value,
           CAST(count(*) AS BIGINT) AS n_rows, CAST({at} + (SELECT count(*) FROM v) AS BIGINT) AS size
    FROM cells GROUP BY user_id, business_id, i, x"""


@register("features_eda_sparse", _eda_vector_sql(), doubles=("value",))
def q_features_eda_sparse(spark, sf_dir):
    """P12 + M2: non-zero cells of the sparse FS-EDA vectors (equal cells of repeated pairs counted)."""
    d = dataset(spark, sf_dir)
    train, _, vocab = PR.eda_sparse(d.train_raw, d.val_pairs, d.business, d.user)
    vectors = PR.sparse_vectors(train, PR.EDA_FEATURES, vocab).select(
        "user_id", "business_id", "vector.size",
        F.explode(F.arrays_zip("vector.indices", "vector.values")).alias("c"))
    return (vectors.groupBy("user_id", "business_id", F.col("c.indices").cast("long").alias("feature"),
                            F.col("c.values").alias("value"), "size")
            .agg(F.count(F.lit(1)).alias("n_rows")))


@register("membership_years", f"""
    SELECT user_id, {_membership_sql('yelping_since')} AS years_full,
           {_membership_sql('substr(yelping_since, 1, 7)')} AS years_month,
           {_membership_sql('substr(yelping_since, 1, 4)')} AS years_year
    FROM f_user""", doubles=("years_full", "years_month", "years_year"))
def q_membership_years(spark, sf_dir):
    """F8: membership years from `yyyy-M`, `yyyy`, else 5.0 (full dates take 5.0)."""
    u = dataset(spark, sf_dir).user
    ys = F.col("yelping_since")
    return u.select("user_id", fx.membership_years(ys).alias("years_full"),
                    fx.membership_years(F.substring(ys, 1, 7)).alias("years_month"),
                    fx.membership_years(F.substring(ys, 1, 4)).alias("years_year"))


@register("preview", """
    SELECT user_id, average_stars, review_count, yelping_since, elite, fans
    FROM f_user ORDER BY user_id LIMIT 5""", doubles=("average_stars",))
def q_preview(spark, sf_dir):
    """The first five users by id (a bounded preview, the feature itself)."""
    u = dataset(spark, sf_dir).user.select("user_id", "average_stars", "review_count",
                                           "yelping_since", "elite", "fans")
    return preview(u, ["user_id"], 5)


@register("fill_defaults", """
    SELECT business_id, coalesce(categories, '') AS categories, coalesce(city, 'Unknown') AS city,
           coalesce(state, 'Unknown') AS state FROM f_business""")
def q_fill_defaults(spark, sf_dir):
    """P5: fill missing categories with '' and city/state with 'Unknown'."""
    from ratesmith.sources.readers import fill_defaults
    b = dataset(spark, sf_dir).business.select("business_id", "categories", "city", "state")
    return fill_defaults(b, {"categories": "", "city": fx.UNKNOWN, "state": fx.UNKNOWN})


@register("ensure_columns", """
    SELECT user_id, user_avg_stars, CAST(0 AS BIGINT) AS useful_votes_total, CAST(0 AS BIGINT) AS compliments
    FROM f_user_feat""", doubles=("user_avg_stars",))
def q_ensure_columns(spark, sf_dir):
    """Add constant-0 columns for requested names the table lacks."""
    from ratesmith.sources.readers import ensure_columns
    u = FT.user_features(dataset(spark, sf_dir).user).select("user_id", "user_avg_stars")
    out = ensure_columns(u, ["user_avg_stars", "useful_votes_total", "compliments"], 0)
    return out.withColumns({c: F.col(c).cast("long") for c in ("useful_votes_total", "compliments")})


# ---------------------------------------------------------------------------
# scalar functions
# ---------------------------------------------------------------------------

@register("elite_count", """
    SELECT user_id, elite, CAST(CASE WHEN elite = 'None' THEN 0 ELSE len(string_split(elite, ',')) END
                                AS BIGINT) AS elite_count FROM f_user""")
def q_elite_count(spark, sf_dir):
    """elite-year count, 'None' -> 0."""
    u = dataset(spark, sf_dir).user
    return u.select("user_id", "elite", fx.count_list("elite").alias("elite_count"))


@register("friends_count", """
    SELECT user_id, CAST(CASE WHEN friends = 'None' THEN 0 ELSE len(string_split(friends, ',')) END
                         AS BIGINT) AS friends_count FROM f_user""")
def q_friends_count(spark, sf_dir):
    """friend count, 'None' -> 0."""
    u = dataset(spark, sf_dir).user
    return u.select("user_id", fx.count_list("friends").alias("friends_count"))


@register("count_list_nullsafe", """
    SELECT t.user_id, t.business_id,
           CAST(CASE WHEN u.elite IS NULL OR u.elite = 'None' THEN 0
                     ELSE len(string_split(u.elite, ',')) END AS BIGINT) AS elite_count
    FROM f_val t LEFT JOIN f_user u ON u.user_id = t.user_id""")
def q_count_list_nullsafe(spark, sf_dir):
    """null-safe list count over a left join (unknown users give NULL -> 0)."""
    d = dataset(spark, sf_dir)
    j = d.val_pairs.select("user_id", "business_id").join(d.user.select("user_id", "elite"), "user_id", "left")
    return j.select("user_id", "business_id", fx.count_list("elite", null_safe=True).alias("elite_count"))


@register("attributes_count", "SELECT business_id, attributes_count FROM f_business")
def q_attributes_count(spark, sf_dir):
    """number of attribute keys (NULL/empty -> 0)."""
    b = dataset(spark, sf_dir).business
    return b.select("business_id", fx.map_key_count("attributes").alias("attributes_count"))


@register("categories_count_raw", """
    SELECT business_id, categories,
           CAST(CASE WHEN categories IS NULL OR categories = '' THEN 0
                     ELSE len(string_split(categories, ',')) END AS BIGINT) AS raw_count
    FROM f_business""")
def q_categories_count_raw(spark, sf_dir):
    """raw comma-token count, NULL/'' -> 0."""
    b = dataset(spark, sf_dir).business
    return b.select("business_id", "categories", fx.raw_token_count("categories").alias("raw_count"))


@register("categories_count", """
    SELECT business_id, CAST(len(list_filter(string_split(coalesce(categories, ''), ','),
                                             lambda x: trim(x) <> '')) AS BIGINT) AS nonblank_count
    FROM f_business""")
def q_categories_count(spark, sf_dir):
    """non-blank comma-token count."""
    b = dataset(spark, sf_dir).business
    return b.select("business_id", fx.nonblank_token_count("categories").alias("nonblank_count"))


@register("categories_list", """
    SELECT business_id,
           array_to_string(list_filter(list_transform(string_split(coalesce(categories, ''), ','),
                                                      lambda x: trim(x)), lambda x: x <> ''), '|') AS categories_list
    FROM f_business""")
def q_categories_list(spark, sf_dir):
    """split, trim, drop blanks (shown joined with '|')."""
    b = dataset(spark, sf_dir).business
    return b.select("business_id", F.array_join(fx.token_list("categories"), "|").alias("categories_list"))


@register("years_since", f"""
    SELECT user_id, CAST({int(fx.DEFAULT_AS_OF[:4])} - year(try_strptime(yelping_since, '%Y-%m-%d'))
                         AS BIGINT) AS years FROM f_user""")
def q_years_since(spark, sf_dir):
    """as-of year minus the membership year."""
    u = dataset(spark, sf_dir).user
    return u.select("user_id", fx.year_difference("yelping_since").alias("years"))


@register("safe_latlon", """
    SELECT business_id, coalesce(TRY_CAST(latitude AS DOUBLE), 0.0) AS latitude,
           coalesce(TRY_CAST(longitude AS DOUBLE), 0.0) AS longitude FROM f_business""",
          doubles=("latitude", "longitude"))
def q_safe_latlon(spark, sf_dir):
    """coordinates from number/text, bad or NULL -> 0.0."""
    b = dataset(spark, sf_dir).business
    return b.select("business_id", fx.safe_double("latitude").alias("latitude"),
                    fx.safe_double("longitude").alias("longitude"))


@register("clamp", """
    SELECT user_id, target, sum(weight * rating) / sum(abs(weight)) AS raw_prediction,
           greatest(1.0, least(5.0, sum(weight * rating) / sum(abs(weight)))) AS clamped
    FROM f_top GROUP BY user_id, target HAVING sum(abs(weight)) > 0""",
          doubles=("raw_prediction", "clamped"))
def q_clamp(spark, sf_dir):
    """weighted neighbour average before and after clamping to [1, 5]."""
    d = dataset(spark, sf_dir, once=True)
    pairs, train = NB.kept(d.val_pairs, d.train)
    top = NB.top_neighbors(NB.candidate_pairs(pairs, train), NB.item_similarity(pairs, train, d.train_raw))
    agg = top.groupBy("user_id", "target").agg(
        F.sum(F.col("weight") * F.col("rating")).alias("num"), F.sum(F.abs("weight")).alias("den"))
    agg = agg.where(F.col("den") > 0).withColumn("raw_prediction", F.col("num") / F.col("den"))
    return agg.select("user_id", "target", "raw_prediction",
                      fx.clamp("raw_prediction", 1.0, 5.0).alias("clamped"))


# ---------------------------------------------------------------------------
# encoders (A1, W1, W2, A15, A18, M1, M2, W4)
# ---------------------------------------------------------------------------

@register("distinct_city", """
    SELECT DISTINCT coalesce(city, 'Unknown') AS value FROM f_business
    WHERE coalesce(city, 'Unknown') <> 'None'""")
def q_distinct_city(spark, sf_dir):
    """A1: distinct city values (NULL read as 'Unknown', 'None' dropped)."""
    b = dataset(spark, sf_dir).business
    return EN.distinct_values(b, F.coalesce("city", F.lit(fx.UNKNOWN))).where(F.col("value") != fx.NONE_SENTINEL)


for _c in ("city", "state"):
    def _enc(spark, sf_dir, _c=_c):
        b = dataset(spark, sf_dir).business.select("business_id", _c)
        return EN.sentinel_encode(b, _c, f"{_c}_code")
    _enc.__doc__ = f"W1: alphabetical {_c} code, 'Unknown'/NULL/'None' -> -1 (gap kept)."
    register(f"{_c}_encode", f"""
    SELECT b.business_id, b.{_c}, coalesce(c.code, -1) AS {_c}_code
    FROM f_business b LEFT JOIN f_{_c}_codes c ON c.v = coalesce(b.{_c}, 'Unknown')""")(_enc)


@register("label_encode", """
    SELECT w.user_id, w.business_id, sc.code AS state_code, cc.code AS city_code
    FROM f_wide w
    LEFT JOIN f_wide_state_codes sc ON sc.v = coalesce(w.state, 'Unknown')
    LEFT JOIN f_wide_city_codes cc ON cc.v = coalesce(w.city, 'Unknown')""")
def q_label_encode(spark, sf_dir):
    """Sorted label codes over the merged table, 'Unknown' an ordinary class."""
    d = dataset(spark, sf_dir)
    places = PR.encoded_places(d.train_raw, d.business).select("business_id", "state_code", "city_code")
    return d.train_raw.select("user_id", "business_id").join(places, "business_id").select(
        "user_id", "business_id", "state_code", "city_code")


def _minmax_sql():
    cols = FT.FEATURE_SETS["fs23"]
    inner = feature_select("f_train_raw", "fs23", label=True)
    return "\n UNION ALL ".join(
        f"SELECT '{c}' AS feature, min({c}) AS min_value, max({c}) AS max_value FROM ({inner}) t{i}"
        for i, c in enumerate(cols))


@register("minmax_stats", _minmax_sql(), doubles=("min_value", "max_value"))
def q_minmax_stats(spark, sf_dir):
    """Min and max of every FS23 feature over the training pairs."""
    d = dataset(spark, sf_dir)
    t = FT.feature_table(d.train_raw, d.user, d.business, d.review, d.photo, d.tip, "fs23")
    return EN.minmax_stats_long(t, FT.FEATURE_SETS["fs23"])


def _scaled_sql():
    cols = FT.FEATURE_SETS["fs23"]
    tr = feature_select("f_train_raw", "fs23", label=True)
    va = feature_select("f_val", "fs23", label=False)
    stats = ", ".join(f"min({c}) AS lo{i}, max({c}) AS hi{i}" for i, c in enumerate(cols))
    sel = ", ".join(f"coalesce(({c} - lo{i}) / NULLIF(hi{i} - lo{i}, 0), {c} - lo{i}) AS {c}"
                    for i, c in enumerate(cols))
    return f"SELECT user_id, business_id, {sel} FROM ({va}) v CROSS JOIN (SELECT {stats} FROM ({tr}) t) s"


@register("minmax_scaled", _scaled_sql(), doubles=FT.FEATURE_SETS["fs23"])
def q_minmax_scaled(spark, sf_dir):
    """M1: validation features scaled by the training min/max (no clipping)."""
    d = dataset(spark, sf_dir)
    cols = FT.FEATURE_SETS["fs23"]
    side = FT.business_side(d.business, d.review, d.photo, d.tip, "fs23")
    tr = FT.feature_table(d.train_raw, d.user, d.business, d.review, d.photo, d.tip, "fs23", side=side)
    va = FT.feature_table(d.val_pairs, d.user, d.business, d.review, d.photo, d.tip, "fs23",
                          label=None, side=side)
    return EN.minmax_scale(va, cols, EN.minmax_stats(tr, cols))


define_view("f_cat_vocab", """
    SELECT value, CAST(row_number() OVER (ORDER BY value) - 1 AS BIGINT) AS code FROM (
      SELECT DISTINCT trim(x) AS value FROM f_business, unnest(string_split(coalesce(categories, ''), ',')) u(x)
      WHERE trim(x) <> '') d""")


@register("category_vocab", "SELECT value, code FROM f_cat_vocab")
def q_category_vocab(spark, sf_dir):
    """A18 + O1: sorted distinct category labels with their index."""
    return EN.category_vocab(dataset(spark, sf_dir).business)


@register("category_onehot", """
    SELECT DISTINCT b.business_id, trim(x) AS category, v.code AS category_index
    FROM f_business b, unnest(string_split(coalesce(b.categories, ''), ',')) u(x)
    JOIN f_cat_vocab v ON v.value = trim(x)""")
def q_category_onehot(spark, sf_dir):
    """M2: multi-label one-hot as its non-zero cells (business, label, index)."""
    return EN.category_pairs(dataset(spark, sf_dir).business, "business_id")


@register("kfold", """
    SELECT user_id, business_id, CAST(ntile(5) OVER (
             ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, user_id, business_id, stars) - 1
             AS BIGINT) AS fold
    FROM f_train_raw""")
def q_kfold(spark, sf_dir):
    """Contiguous 5-fold assignment in line order (bigger folds first)."""
    from ratesmith.operators.models import contiguous_folds
    t = dataset(spark, sf_dir).train_raw
    order = [*ORDINAL, "user_id", "business_id", "stars"]
    return contiguous_folds(t.select(*dict.fromkeys(order)), order, 5).select("user_id", "business_id", "fold")
