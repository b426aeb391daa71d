"""Item-based neighbours: hand cases and a brute-force check.

§2.7): per pair, Pearson over co-raters with the ≤1-co-rater and
zero-variance fallbacks, |w|^2.5, top-k, weighted mean clamped to [1, 5].
"""

import random

import pytest

from ratesmith.operators import neighbors as NB


def brute_force(train_rows, pairs, k=20, p=2.5):
    last = {}
    for u, b, s in train_rows:
        last[(u, b)] = s
    by_item, by_user = {}, {}
    for (u, b), s in last.items():
        by_item.setdefault(b, {})[u] = s
        by_user.setdefault(u, {})[b] = s
    item_all = {}
    for u, b, s in train_rows:
        item_all.setdefault(b, []).append(s)
    users = {u for u, _, _ in train_rows}
    mean = {b: sum(v) / len(v) for b, v in item_all.items()}

    def sim(a, b):
        co = set(by_item[a]) & set(by_item[b])
        if len(co) <= 1:
            return (5 - abs(mean[a] - mean[b])) / 5
        xs = [by_item[a][u] for u in co]
        ys = [by_item[b][u] for u in co]
        mx, my = sum(xs) / len(xs), sum(ys) / len(ys)
        num = sum((x - mx) * (y - my) for x, y in zip(xs, ys))
        dx = sum((x - mx) ** 2 for x in xs) ** 0.5
        dy = sum((y - my) ** 2 for y in ys) ** 0.5
        if dx == 0 or dy == 0:
            return 0.0
        return num / (dx * dy)

    out = {}
    for u, t in pairs:
        if u not in users or t not in mean:
            out[(u, t)] = 3.0
            continue
        cands = [(abs(sim(t, b)), b, r) for b, r in by_user[u].items() if b != t]
        if not cands:
            out[(u, t)] = mean[t]
            continue
        cands.sort(key=lambda c: (-round(c[0], 9), c[1]))
        top = [(a ** p, b, r) for a, b, r in cands[:k]]
        den = sum(abs(w) for w, _, _ in top)
        if den == 0:
            out[(u, t)] = mean[t]
        else:
            out[(u, t)] = max(1.0, min(5.0, sum(w * r for w, _, r in top) / den))
    return out


def run(spark, train_rows, pairs, **kw):
    raw = spark.createDataFrame([(u, b, float(s), i) for i, (u, b, s) in enumerate(train_rows)],
                                "user_id long, business_id long, stars double, o long")
    from ratesmith.operators.dedupe import last_by_ordinal
    ratings = last_by_ordinal(raw, ["user_id", "business_id"], ["stars"], ["o"])
    pdf = spark.createDataFrame(pairs, "user_id long, business_id long")
    got = NB.predict(pdf, ratings, raw, **kw).collect()
    return {(r.user_id, r.business_id): r.prediction for r in got}


@pytest.mark.parametrize("seed,block", [(1, 256), (2, 3), (3, 1)])
def test_matches_brute_force(spark, seed, block):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(12), rnd.randrange(10), rnd.randint(1, 5)) for _ in range(150)]
    pairs = sorted({(rnd.randrange(14), rnd.randrange(12)) for _ in range(40)})
    want = brute_force(rows, pairs, k=4)
    got = run(spark, rows, pairs, k=4, block=block)
    assert set(got) == set(want)
    for key in want:
        assert got[key] == pytest.approx(want[key], abs=1e-9), key


def test_unknown_and_self_only(spark):
    rows = [(1, 10, 4), (2, 10, 2), (1, 11, 5)]
    got = run(spark, rows, [(9, 10), (1, 99), (2, 10)])
    assert got[(9, 10)] == 3.0 and got[(1, 99)] == 3.0
    assert got[(2, 10)] == pytest.approx(3.0)  # only the target rated: its mean (4+2)/2


def test_similarity_cases(spark):
    # constant raters on one item -> 0; opposite -> -1
    rows = [(1, 1, 3), (2, 1, 3), (1, 2, 1), (2, 2, 5), (1, 3, 5), (2, 3, 1)]
    raw = spark.createDataFrame(rows, "user_id long, business_id long, stars long") \
        .selectExpr("user_id", "business_id", "cast(stars as double) stars")
    pairs = spark.createDataFrame([(3, 1), (3, 2)], "target long, rated long")
    stats = NB.corated_stats(pairs, raw)
    sims = {(r.target, r.rated): r.similarity
            for r in NB.similarity_from_stats(stats, NB.entity_means(raw, "business_id", "item_mean")).collect()}
    assert sims[(3, 1)] == 0.0
    assert sims[(3, 2)] == pytest.approx(-1.0)


def test_single_corater_fallback(spark):
    rows = [(1, 1, 4), (1, 2, 2)]
    raw = spark.createDataFrame(rows, "user_id long, business_id long, stars long") \
        .selectExpr("user_id", "business_id", "cast(stars as double) stars")
    pairs = spark.createDataFrame([(1, 2)], "target long, rated long")
    s = NB.similarity_from_stats(NB.corated_stats(pairs, raw),
                                 NB.entity_means(raw, "business_id", "item_mean")).first()
    assert s.similarity == pytest.approx(0.6)


def test_pair_bitmap_keeps_needed_pairs_and_few_others(spark, monkeypatch):
    from pyspark.sql import functions as F
    pairs = spark.range(3000).select((F.col("id") % 100).alias("a"), (F.col("id") + 200).alias("b"))
    bitmap, bits = NB.pair_bitmap(pairs)
    assert bits == 1 << 16 and bitmap.count() == 1
    assert NB.maybe_needed(pairs, bitmap, bits).count() == 3000
    others = spark.range(20000).select(F.col("id").alias("a"), (F.col("id") + 10**6).alias("b"))
    assert NB.maybe_needed(others, bitmap, bits).count() < 200
    none, bits = NB.pair_bitmap(pairs.limit(0))
    assert NB.maybe_needed(pairs, none, bits).count() == 0


def test_pruned_sums_are_those_of_all_pairs(spark):
    rnd = random.Random(4)
    ratings = spark.createDataFrame(
        [(u, b, float(rnd.randrange(1, 6))) for u in range(120) for b in rnd.sample(range(60), 12)],
        "user_id long, business_id long, stars double")
    needed = spark.createDataFrame([(str(rnd.randrange(60)), str(rnd.randrange(60, 70) - 10)) for _ in range(80)]
                                   + [("none", "1"), (None, "2")], "target string, rated string").distinct()
    both = [sorted(map(tuple, NB.corated_stats(needed, ratings, 4, pruned).collect()), key=repr)
            for pruned in (True, False)]
    assert both[0] == both[1] and any(r[2] > 0 for r in both[0])


def test_rater_bitmaps_count_common_raters(spark):
    """Users past one word, and items without raters, against plain sets."""
    rows = [(f"u{i}", j, 1.0) for i in range(200) for j in range(6) if i % (j + 1) == 0] + [("u3", 9, 2.0)]
    ratings = spark.createDataFrame(rows, "user_id string, business_id long, stars double")
    raters = {}
    for u, b, _ in rows:
        raters.setdefault(b, set()).add(u)
    pairs = [(a, b) for a in range(12) for b in range(12) if a != b]
    needed = spark.createDataFrame([(str(a), b) for a, b in pairs] + [("x", 1)], "target string, rated long")
    got = {(r.target, r.rated): r.n for r in NB.corated_counts(needed, ratings).collect()}
    assert got == {(str(a), b): len(raters.get(a, set()) & raters.get(b, set())) for a, b in pairs} | {("x", 1): 0}
    words = NB.rater_words(ratings)
    assert words.filter("item = 0").count() == 4 and words.filter("bits = 0").isEmpty()


def test_rating_maps_of_hot_keys_are_dealt(spark):
    rows = [("hot", j, float(j % 5 + 1)) for j in range(1000)] + [("u", 7, 2.0), ("v", None, 3.0)]
    ratings = spark.createDataFrame(rows, "user_id string, business_id long, stars double")
    maps = NB.rating_maps(ratings.dropna(), entries=100)
    assert maps.filter("user_id = 'hot'").count() == 10
    assert maps.agg({"pieces": "max"}).first()[0] == 10
    assert max(len(r.ratings) for r in maps.collect()) < 200
    entries = {(r.user_id, k): v for r in maps.collect() for k, v in r.ratings.items()}
    assert entries == {(u, b): s for u, b, s in rows if b is not None}
    asked = spark.createDataFrame([("hot", 5), ("hot", 5), ("hot", 2000), ("u", 7), ("w", 1), (None, None)],
                                  "user_id string, business_id long")
    got = sorted(map(str, (tuple(r) for r in NB.map_ratings(asked, maps).collect())))
    assert got == sorted(map(str, [("hot", 5, 1.0), ("hot", 5, 1.0), ("hot", 2000, None), ("u", 7, 2.0),
                                   ("w", 1, None), (None, None, None)]))


@pytest.mark.parametrize("block", [4, 256])
def test_cells_sum_what_the_plain_path_sums(spark, monkeypatch, block):
    """Many co-ratings are summed by item groups: same sums, and counts from bitmaps."""
    rnd = random.Random(6)
    ratings = spark.createDataFrame(
        [(u, b, float(rnd.randrange(1, 6)) if b else None) for u in range(80) for b in rnd.sample(range(50), 11)]
        + [(900, b, 2.0) for b in range(50)] + [(1, None, 3.0)], "user_id long, business_id long, stars double")
    asked = [(t, r) for t in range(0, 60, 3) for r in range(50) if t != r] + [(None, 3), (4, None)]
    number = spark.createDataFrame(asked * 2, "target long, rated long")
    text = spark.createDataFrame([(None if t is None else str(t), r) for t, r in asked] + [("none", 1)],
                                 "target string, rated long")
    assert NB.item_groups(ratings) == 1

    def rows(df):
        return sorted(map(tuple, df.collect()), key=repr)

    plain = [rows(NB.corated_stats(n, ratings, block)) for n in (number, text)]
    monkeypatch.setattr(NB, "CELL_ROWS", 100)
    assert NB.item_groups(ratings) > 1
    assert [rows(NB.corated_stats(n, ratings, block)) for n in (number, text)] == plain
    for needed, stats in zip((number, text), plain):
        assert rows(NB.corated_counts(needed, ratings, block)) == [r[:3] for r in stats]
    assert any(r[2] > 5 for r in plain[0]) and len(plain[0]) == len(asked)


@pytest.mark.parametrize("block", [8])
def test_cells_find_what_requested_pairs_need(spark, monkeypatch, block):
    """Requests dealt with the ratings give the same pairs, sums, counts and neighbours as their rows do."""
    rnd = random.Random(8)
    ratings = spark.createDataFrame(
        [(u, b, float(rnd.randrange(1, 6)) if b % 7 else None) for u in range(80) for b in rnd.sample(range(50), 11)]
        + [(900, b, 2.0) for b in range(50)] + [(1, None, 3.0), (None, 4, 1.0)],
        "user_id long, business_id long, stars double")
    wanted = [(u, b) for u in [*range(0, 90, 2), 900] for b in rnd.sample(range(60), 4)]
    pairs = spark.createDataFrame(wanted * 2 + [(2, None), (None, 3)], "user_id long, business_id long")
    means = NB.entity_means(ratings, "business_id", "item_mean")

    def found():
        return [sorted(map(tuple, df.collect()), key=repr) for df in (
            NB.pair_stats(pairs, ratings, block), NB.pair_counts(pairs, ratings, block),
            NB.neighbors(pairs, ratings, means, 5, block=block).select(
                "user_id", "target", "rated", "rating", "similarity", "weight", "rank"))]

    plain = found()
    monkeypatch.setattr(NB, "CELL_ROWS", 1000)
    monkeypatch.setattr(NB, "LEAST_GROUPS", 3)
    assert NB.item_groups(ratings) > 1
    assert found() == plain
    assert plain[1] == [r[:3] for r in plain[0]] and len(plain[2]) > 100


@pytest.mark.parametrize("far", [1, 10**10])
def test_cells_keep_wide_ids_and_uneven_ratings(spark, monkeypatch, far):
    """Records hold narrow types only where these hold every value: ids past an int, halves, NaN and null stay."""
    rnd = random.Random(9)
    stars = [1.5, 4.0, 0.1, float("nan"), None, 200.0, -0.0]
    ratings = spark.createDataFrame(
        [(u * far, b * far, stars[rnd.randrange(7)] if b > 12 else float(rnd.randrange(1, 6)))
         for u in range(60) for b in rnd.sample(range(40), 9)], "user_id long, business_id long, stars double")
    pairs = spark.createDataFrame([(u * far, b * far) for u in range(0, 62, 2) for b in rnd.sample(range(42), 4)],
                                  "user_id long, business_id long")
    asked = spark.createDataFrame([(1, 2), (2, 1), (3, 10**15), (None, 1)], "target long, rated long")
    means = NB.entity_means(ratings, "business_id", "item_mean")

    def found():
        return [sorted(map(repr, df.collect())) for df in (
            NB.pair_stats(pairs, ratings).drop("sx", "sy", "sxx", "syy", "sxy"), NB.corated_counts(asked, ratings),
            NB.neighbors(pairs, ratings, means, 50).select("user_id", "target", "rated", "rating"))]

    plain = found()
    monkeypatch.setattr(NB, "CELL_ROWS", 100)
    assert found() == plain and len(plain[1]) == 4
    kinds = NB._narrow_types(ratings.select("business_id", "stars"))
    assert [kinds[c].simpleString() for c in ("business_id", "stars")] == ["int" if far == 1 else "bigint", "double"]
    whole = ratings.where("stars between 1 and 5")
    assert NB._narrow_types(whole.select("stars"))["stars"].simpleString() == "float"  # 1.5
    assert NB._narrow_types(whole.where("stars % 1 = 0").select("stars"))["stars"].simpleString() == "tinyint"


def test_many_coratings_of_few_pairs_take_few_groups(spark, monkeypatch):
    rnd = random.Random(3)
    few, many = [spark.createDataFrame(
        [(u, b, 3.0) for u in range(400) for b in rnd.sample(range(n), 16)],
        "user_id long, business_id long, stars double") for n in (20, 5000)]
    monkeypatch.setattr(NB, "CELL_ROWS", 1000)
    assert NB.item_groups(many) == 8 and NB.item_groups(few) == NB.FEW_GROUPS
    assert NB.corated_pairs_estimate(few, 1) == 190
    monkeypatch.setattr(NB, "SAMPLE_ROWS", 5000)
    assert NB.item_groups(many) == 8 and NB.item_groups(few) == NB.FEW_GROUPS
    assert 100 < NB.corated_pairs_estimate(few, 0.1) < 400
