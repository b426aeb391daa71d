"""Queries of the item-based neighbour predictor (Q3) and its parts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ratesmith.operators import neighbors as NB
from ratesmith.plans.oracle_views import define_view
from ratesmith.plans.registry import register
from ratesmith.session import stored
from ratesmith.sources.fixtures import dataset

K = NB.DEFAULT_K


def _neighbor_views(px: str) -> None:
    """Oracle views of the neighbour plan over split ``px`` (f: dense, p: sparse)."""
    define_view(f"{px}_cand", f"""
    SELECT p.user_id, p.target, r.business_id AS rated, r.stars AS rating
    FROM (SELECT DISTINCT user_id, business_id AS target FROM {px}_val) p
    JOIN {px}_train r ON r.user_id = p.user_id
    WHERE r.business_id <> p.target""")
    define_view(f"{px}_needed", f"SELECT DISTINCT target, rated FROM {px}_cand")
    define_view(f"{px}_item_mean", f"""
    SELECT business_id, avg(stars) AS item_mean FROM {px}_train_raw GROUP BY business_id""")
    define_view(f"{px}_costats", f"""
    SELECT nd.target, nd.rated, count(*) AS n,
           sum(a.stars) AS sx, sum(b.stars) AS sy, sum(a.stars * a.stars) AS sxx,
           sum(b.stars * b.stars) AS syy, sum(a.stars * b.stars) AS sxy
    FROM {px}_needed nd
    JOIN {px}_train a ON a.business_id = nd.target
    JOIN {px}_train b ON b.business_id = nd.rated AND b.user_id = a.user_id
    GROUP BY nd.target, nd.rated""")
    define_view(f"{px}_sim", f"""
    SELECT target, rated, n,
           CASE WHEN n <= 1 THEN (5.0 - abs(mean_t - mean_r)) / 5.0
                WHEN n * sxx - sx * sx = 0 OR n * syy - sy * sy = 0 THEN 0.0
                ELSE (n * sxy - sx * sy) / (sqrt(n * sxx - sx * sx) * sqrt(n * syy - sy * sy)) END
             AS similarity
    FROM (SELECT nd.target, nd.rated, CAST(coalesce(c.n, 0) AS BIGINT) AS n,
                 coalesce(c.sx, 0.0) AS sx, coalesce(c.sy, 0.0) AS sy, coalesce(c.sxx, 0.0) AS sxx,
                 coalesce(c.syy, 0.0) AS syy, coalesce(c.sxy, 0.0) AS sxy,
                 mt.item_mean AS mean_t, mr.item_mean AS mean_r
          FROM {px}_needed nd
          LEFT JOIN {px}_costats c ON c.target = nd.target AND c.rated = nd.rated
          LEFT JOIN {px}_item_mean mt ON mt.business_id = nd.target
          LEFT JOIN {px}_item_mean mr ON mr.business_id = nd.rated) z""")
    define_view(f"{px}_top", f"""
    SELECT * FROM (
      SELECT c.user_id, c.target, c.rated, c.rating, s.similarity,
             pow(abs(s.similarity), 2.5) AS weight,
             row_number() OVER (PARTITION BY c.user_id, c.target
                                ORDER BY round(abs(s.similarity), 9) DESC, c.rated) AS rank
      FROM {px}_cand c JOIN {px}_sim s ON s.target = c.target AND s.rated = c.rated) t
    WHERE rank <= {K}""")
    define_view(f"{px}_item_pred", f"""
    SELECT v.user_id, v.business_id,
           CASE WHEN u.user_id IS NULL OR m.item_mean IS NULL THEN 3.0
                WHEN a.den IS NULL OR a.den = 0 THEN m.item_mean
                ELSE greatest(1.0, least(5.0, a.num / a.den)) END AS prediction
    FROM {px}_val v
    LEFT JOIN (SELECT DISTINCT user_id FROM {px}_train_raw) u ON u.user_id = v.user_id
    LEFT JOIN {px}_item_mean m ON m.business_id = v.business_id
    LEFT JOIN (SELECT user_id, target, sum(weight * rating) AS num, sum(abs(weight)) AS den
               FROM {px}_top GROUP BY user_id, target) a
      ON a.user_id = v.user_id AND a.target = v.business_id""")


_neighbor_views("f")
_neighbor_views("p")


@register("dedupe_last", "SELECT user_id, business_id, stars FROM f_ratings", doubles=("stars",))
def q_dedupe_last(spark, sf_dir):
    """Last rating by ordinal per (user, business)."""
    return dataset(spark, sf_dir).ratings


@register("user_avg", """
    SELECT user_id, avg(stars) AS avg_rating, count(*) AS n_ratings FROM f_train_raw GROUP BY user_id""",
          doubles=("avg_rating",))
def q_user_avg(spark, sf_dir):
    """Mean rating per user over every training row."""
    raw = dataset(spark, sf_dir).train_raw
    return raw.groupBy("user_id").agg(F.avg("stars").alias("avg_rating"),
                                      F.count(F.lit(1)).alias("n_ratings"))


@register("business_avg", """
    SELECT business_id, item_mean AS avg_rating FROM f_item_mean""", doubles=("avg_rating",))
def q_business_avg(spark, sf_dir):
    """Mean rating per business over every training row."""
    raw = dataset(spark, sf_dir).train_raw
    return NB.entity_means(raw, "business_id", "avg_rating")


@register("user_rating_map", """
    SELECT t.user_id, t.business_id, t.stars, m.avg_rating
    FROM f_train t JOIN (SELECT user_id, avg(stars) AS avg_rating FROM f_train_raw GROUP BY user_id) m
      ON m.user_id = t.user_id""", doubles=("stars", "avg_rating"))
def q_user_rating_map(spark, sf_dir):
    """User -> {business: last rating} (long form) with the user's mean."""
    d = dataset(spark, sf_dir)
    return NB.rating_map_long(d.train, d.train_raw)


@register("user_rating_maps", "SELECT user_id, business_id, stars FROM f_train", doubles=("stars",))
def q_user_rating_maps(spark, sf_dir):
    """Every entry of the users' rating maps."""
    maps = NB.rating_maps(dataset(spark, sf_dir).train)
    return maps.select("user_id", F.explode("ratings").alias("business_id", "stars"))


@register("map_lookup", """
    SELECT v.user_id, v.business_id, t.stars FROM f_val v
    LEFT JOIN f_train t ON t.user_id = v.user_id AND t.business_id = v.business_id
    UNION ALL SELECT user_id, business_id, stars FROM f_train""", doubles=("stars",))
def q_map_lookup(spark, sf_dir):
    """Ratings of validation and training pairs looked up in the users' maps."""
    d = dataset(spark, sf_dir)
    pairs = [p.select("user_id", "business_id") for p in (d.val_pairs, d.train)]
    return NB.map_ratings(pairs[0].union(pairs[1]), NB.rating_maps(d.train))


@register("warm_pairs_semi", """
    SELECT v.user_id, v.business_id FROM f_val v
    WHERE EXISTS (SELECT 1 FROM f_train_raw t WHERE t.user_id = v.user_id)
      AND EXISTS (SELECT 1 FROM f_train_raw t WHERE t.business_id = v.business_id)""")
def q_warm_pairs(spark, sf_dir):
    """J7 (semi): validation pairs whose user and business both have training rows."""
    d = dataset(spark, sf_dir)
    users = d.train_raw.select("user_id")
    items = d.train_raw.select("business_id")
    return (d.val_pairs.select("user_id", "business_id")
            .join(users, "user_id", "left_semi").join(items, "business_id", "left_semi"))


@register("cold_start_anti", """
    SELECT v.user_id, v.business_id, CAST(3.0 AS DOUBLE) AS prediction FROM f_val v
    WHERE NOT EXISTS (SELECT 1 FROM f_train_raw t WHERE t.user_id = v.user_id)
       OR NOT EXISTS (SELECT 1 FROM f_train_raw t WHERE t.business_id = v.business_id)""",
          doubles=("prediction",))
def q_cold_start(spark, sf_dir):
    """J7 (anti): pairs with an unknown user or business, predicted 3.0."""
    d = dataset(spark, sf_dir)
    # each id once: what a join holds grows with the ids, not the ratings
    users = d.train_raw.select("user_id").distinct()
    items = d.train_raw.select("business_id").distinct()
    v = d.val_pairs.select("user_id", "business_id")
    cold = (v.join(users, "user_id", "left_anti")
            .unionByName(v.join(items, "business_id", "left_anti"))).distinct()
    return cold.withColumn("prediction", F.lit(NB.UNKNOWN_PREDICTION))


@register("candidate_pairs", "SELECT user_id, target, rated, rating FROM f_cand", doubles=("rating",))
def q_candidates(spark, sf_dir):
    """J8 + P9: each (user, target) with the user's other rated businesses."""
    d = dataset(spark, sf_dir)
    return NB.candidate_pairs(d.val_pairs, d.train)


@register("corated_pairs", "SELECT target, rated, n AS n_corated FROM f_sim")
def q_corated(spark, sf_dir):
    """Number of co-raters of every needed item pair (0 included)."""
    d = dataset(spark, sf_dir, once=True)
    pairs, train = NB.kept(d.val_pairs, d.train)
    return NB.pair_stats(pairs, train).select("target", "rated", F.col("n").alias("n_corated"))


# Item pairs whose common raters are asked for.
NAMED_PAIRS = ((1, 2), (1, 3), (2, 7))


@register("corated_users_intersect", "\n UNION ALL ".join(f"""
    SELECT CAST({a} AS BIGINT) AS item_a, CAST({b} AS BIGINT) AS item_b, user_id FROM (
      SELECT user_id FROM f_train WHERE business_id = {a}
      INTERSECT SELECT user_id FROM f_train WHERE business_id = {b}) q{i}"""
                                                          for i, (a, b) in enumerate(NAMED_PAIRS)))
def q_corated_users(spark, sf_dir):
    """Users who rated both items, by set intersection, for named item pairs."""
    train = dataset(spark, sf_dir).train
    parts = [NB.corated_users(train, a, b).select(
        F.lit(a).cast("long").alias("item_a"), F.lit(b).cast("long").alias("item_b"), "user_id")
        for a, b in NAMED_PAIRS]
    return reduce(lambda p, q: p.unionByName(q), parts)


@register("corated_counts", "SELECT target, rated, n AS n_corated FROM f_sim")
def q_corated_counts(spark, sf_dir):
    """Common raters of every needed item pair, from rater bitmaps."""
    d = dataset(spark, sf_dir, once=True)
    pairs, train = NB.kept(d.val_pairs, d.train)
    return NB.pair_counts(pairs, train).withColumnRenamed("n", "n_corated")


@register("item_similarity", "SELECT target, rated, n, similarity FROM f_sim", doubles=("similarity",))
def q_item_similarity(spark, sf_dir):
    """A9 + F13: co-rated Pearson similarity with fallbacks, per needed pair."""
    d = dataset(spark, sf_dir, once=True)
    return NB.item_similarity(*NB.kept(d.val_pairs, d.train), d.train_raw)


@register("amplify", """
    SELECT target, rated, pow(abs(similarity), 2.5) AS weight FROM f_sim""", doubles=("weight",))
def q_amplify(spark, sf_dir):
    """case amplification |w|^2.5 of every needed similarity."""
    d = dataset(spark, sf_dir, once=True)
    sims = NB.item_similarity(*NB.kept(d.val_pairs, d.train), d.train_raw)
    from ratesmith.functions.scalars import amplify
    return sims.select("target", "rated", amplify("similarity").alias("weight"))


@register("topk_neighbors", """
    SELECT user_id, target, rated, rating, weight, rank FROM f_top""", doubles=("rating", "weight"))
def q_topk(spark, sf_dir):
    """Top-20 neighbours per (user, target) by amplified similarity."""
    d = dataset(spark, sf_dir, once=True)
    pairs, train = NB.kept(d.val_pairs, d.train)
    means = stored(NB.entity_means(d.train_raw, "business_id", "item_mean"), "means")
    top = NB.neighbors(pairs, train, means, K)
    return top.select("user_id", "target", "rated", "rating", "weight",
                      F.col("rank").cast("long").alias("rank"))


@register("item_predictions", "SELECT * FROM f_item_pred", doubles=("prediction",))
def q_item_predictions(spark, sf_dir):
    """Q3 (flagship): item-based prediction for every validation pair."""
    d = dataset(spark, sf_dir, once=True)
    return NB.predict(d.val_pairs, d.train, d.train_raw)


@register("item_predictions_sparse", "SELECT * FROM p_item_pred", doubles=("prediction",))
def q_item_predictions_sparse(spark, sf_dir):
    """Q3 on the part-level split, where most pairs take the ≤1-co-rater fallback."""
    d = dataset(spark, sf_dir, item="sparse", once=True)
    return NB.predict(d.val_pairs, d.train, d.train_raw)
