"""Item-based neighbour prediction with amplified Pearson weights (Q3).

The reference computes, per validation pair, a Pearson similarity between
the target item and every item the user rated, on the fly from two driver
dictionaries.  Here the same answer is one DataFrame plan:

1. ``candidates`` (J8): requested (user, target) pairs joined with the
   user's own ratings, the target itself excluded (P9).
2. ``needed``: the distinct (target, rated) item pairs – only what is asked.
3. ``co-ratings`` (J9): a self-join of the ratings on the user, each
   unordered item pair once.  A user's ratings are dealt into blocks of about
   ``BLOCK`` and joined block by block, so a rater of any size spreads over
   tasks.  One ``groupBy`` of the item pair directly behind the join folds the
   co-ratings into Pearson sufficient statistics (n, Σx, Σy, Σx², Σy², Σxy)
   inside the join's tasks; only sums are shuffled, and then joined to the
   needed pairs.  Where users share too few pairs for that to help (more than
   ``CELL_ROWS`` co-ratings), the items are dealt into groups and a task gets
   all ratings of a cell, i.e. of two groups, and the users' targets with them:
   co-ratings then meet, are summed and are matched with the needed pairs in one
   task, and only the ratings, once for each group, are shuffled.
4. ``similarity`` (A9, F13): Pearson from the sums; ≤1 co-rater falls back to
   ``(5 - |mean_t - mean_r|) / 5``; a zero variance gives 0.
5. ``top-k`` (W3): ``row_number() <= k`` per (user, target) by amplified
   weight – Catalyst inserts a partial per-group limit before the shuffle
   (WindowGroupLimit), so even a hot group ships at most k rows per task.
6. ``prediction`` (A10, F14, F15, F18): Σ w·r / Σ w, clamped to [1, 5];
   target mean when no neighbour or zero weight; 3.0 for unknown ids.

With integer stars every sum is exact while ``n·Σx²`` stays below 2^53
(about 19M co-raters of one pair), so the zero-variance test is exact.
Ratings are the de-duplicated (last-wins) table; item means use every raw
row, duplicates included, as the reference's averages do.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratesmith.functions.scalars import AMPLIFY_POWER, amplify, clamp
from ratesmith.operators.encoders import consecutive_index
from ratesmith.session import cut_lineage, stored

DEFAULT_K = 20
UNKNOWN_PREDICTION = 3.0
MAX_STARS = 5.0
MIN_STARS, TOP_STARS = 1.0, 5.0
TIE_DIGITS = 9
# bits of the needed pairs' bitmap: for each pair, at least, at most (powers of 2)
BITS_EACH, LEAST_BITS, MOST_BITS = 16, 16, 26
MAP_ENTRIES = 1024  # mean entries of one piece of a rating map
BLOCK = 256  # ratings of one user that a task pairs with as many others
WORD_BLOCK = 2048  # the same for the items of one word of raters
CELL_ROWS = 1 << 21  # co-ratings, of different pairs, that one cell of two item groups should have
LEAST_GROUPS = 8  # groups that a user of any number of ratings may be split into
GROUP_ENTRIES = 4  # else, a user's mean ratings in one group
BUNDLE = 256  # requests whose candidates leave a cell in one row
FEW_GROUPS = 5  # groups however few pairs there are: 15 cells, for as many tasks
SAMPLE_ROWS, SAMPLE_RATINGS = 1 << 21, 4 * BLOCK  # co-ratings, and a rater's ratings, of the estimate of pairs
VALUE, TARGET, RATED = 0, 1, 2  # what a holder has of an item: a value, a request, a partner of one


def entity_means(raw: DataFrame, key: str, name: str) -> DataFrame:
    """Mean rating per user or per item over all rows (duplicates kept)."""
    return raw.groupBy(key).agg(F.avg("stars").alias(name))


def candidate_pairs(pairs: DataFrame, ratings: DataFrame) -> DataFrame:
    """J8 + P9: (user_id, target, rated, rating) for every requested pair."""
    p = pairs.select("user_id", F.col("business_id").alias("target")).distinct()
    r = ratings.select("user_id", F.col("business_id").alias("rated"), F.col("stars").alias("rating"))
    return p.join(r, "user_id").where(F.col("rated") != F.col("target"))


def kept(pairs: DataFrame, ratings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The requested pairs and the ratings as stored tables, for their many readers."""
    return (stored(pairs.select("user_id", "business_id"), "pairs"),
            stored(ratings.select("user_id", "business_id", "stars"), "ratings"))


def needed_item_pairs(candidates: DataFrame) -> DataFrame:
    return candidates.select("target", "rated").distinct()


def corating_rows(ratings: DataFrame, block: int = BLOCK) -> DataFrame:
    """(a, b, user_id, x, y), a < b, for every two items a user rated.

    ``ratings`` holds one row per (user, item).  A user's rows are dealt into
    ``ceil(ratings / block)`` blocks by a hash of the item; block i meets every
    block j >= i, each such pair under a join key of its own.
    """
    blocks = ratings.groupBy("user_id").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("long").alias("_blocks"))
    r = (ratings.select("user_id", F.col("business_id").alias("item"), "stars")
         .join(blocks, "user_id")
         .withColumn("_own", F.pmod(F.xxhash64("item"), F.col("_blocks"))))
    left = r.select("user_id", F.col("_own").alias("_i"),
                    F.explode(F.sequence("_own", F.col("_blocks") - 1)).alias("_j"),
                    F.col("item").alias("l"), F.col("stars").alias("lx"))
    right = r.select("user_id", F.explode(F.sequence(F.lit(0).cast("long"), "_own")).alias("_i"),
                     F.col("_own").alias("_j"), F.col("item").alias("r"), F.col("stars").alias("rx"))
    # within a block each pair of items meets twice, between blocks once
    once = F.when(F.col("_i") == F.col("_j"), F.col("l") < F.col("r")).otherwise(F.lit(True))
    ordered = F.col("l") < F.col("r")
    return left.join(right, ["user_id", "_i", "_j"]).where(once).select(
        F.least("l", "r").alias("a"), F.greatest("l", "r").alias("b"), "user_id",
        F.when(ordered, F.col("lx")).otherwise(F.col("rx")).alias("x"),
        F.when(ordered, F.col("rx")).otherwise(F.col("lx")).alias("y"))


def _slots(bits: int) -> list[Column]:
    """Places of the item pair (a, b) in a bitmap of ``bits`` bits, a power of two."""
    h = F.xxhash64("a", "b")
    return [(F.shiftrightunsigned(h, s)).bitwiseAND(F.lit(bits - 1)) for s in (0, 21, 37)]


def pair_bitmap(pairs: DataFrame) -> tuple[DataFrame, int]:
    """Bloom filter of item pairs (a, b): one row ``words`` (64 bits each), and
    its number of bits, about BITS_EACH a pair and MOST_BITS at most (8 MiB),
    so it may be broadcast however many pairs there are."""
    wanted = BITS_EACH * pairs.count()
    bits = 1 << min(MOST_BITS, max(LEAST_BITS, (wanted - 1).bit_length() if wanted else 0))
    words = (pairs.select(F.explode(F.array(*_slots(bits))).alias("slot"))
             .groupBy(F.expr("slot div 64").alias("id"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("word")))
    return (pairs.sparkSession.range(bits // 64).join(words, "id", "left")
            .agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word"))))
                 .alias("w")).select(F.col("w.word").alias("words"))), bits


def maybe_needed(rows: DataFrame, bitmap: DataFrame, bits: int) -> DataFrame:
    """The rows whose pair may be in the bitmap; none that is in it is lost."""
    hit = F.lit(True)
    for slot in _slots(bits):
        hit = hit & (F.getbit(F.get("words", (F.shiftright(slot, 6)).cast("int")),
                              slot.bitwiseAND(F.lit(63)).cast("int")) == 1)
    # one row, of a size that its number of bits bounds
    return rows.crossJoin(F.broadcast(bitmap)).where(hit).drop("words")


def item_groups(ratings: DataFrame) -> int:
    """Groups that the items should be dealt into: 1 if all co-ratings fit one cell.

    A rating is shuffled once for each group, so beyond ``LEAST_GROUPS`` a
    group should hold ``GROUP_ENTRIES`` of a typical rater's ratings.  A cell
    holds sums of each of its pairs, so where many co-ratings are of few pairs,
    ``FEW_GROUPS`` or what the pairs take are enough.
    """
    n = F.col("n").cast("double")
    found = (ratings.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
             .agg(F.sum(n).alias("ratings"), F.sum(n * (n - 1)).alias("twice")).first())  # one row
    if not found["twice"] or found["twice"] <= 2 * CELL_ROWS:
        return 1
    most = max(LEAST_GROUPS, int(found["twice"] / found["ratings"] / GROUP_ENTRIES))
    groups = min(most, math.ceil(math.sqrt(found["twice"] / CELL_ROWS)))
    if groups <= FEW_GROUPS:
        return groups
    pairs = min(found["twice"] / 2, corated_pairs_estimate(ratings, 2 * SAMPLE_ROWS / found["twice"]))
    return min(groups, max(FEW_GROUPS, math.ceil(math.sqrt(2 * pairs / CELL_ROWS))))


def corated_pairs_estimate(ratings: DataFrame, share: float) -> float:
    """About how many item pairs have a co-rating, from those of a share of the raters.

    Of D pairs, n co-ratings at random meet about D (1 - exp(-n / D)).  Raters of more
    than ``SAMPLE_RATINGS`` are left out.  This only chooses a plan, no result.
    """
    some = ratings.where(F.pmod(F.xxhash64("user_id", F.lit(1)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    usual = some.groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= SAMPLE_RATINGS)
    seen = (corating_rows(some.join(usual.select("user_id"), "user_id", "left_semi")).groupBy("a", "b")
            .agg(F.count(F.lit(1)).alias("n"))
            .agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("pairs")).first())  # one row
    rows = seen["rows"] or 0
    if share >= 1:
        return float(seen["pairs"])
    if rows == seen["pairs"]:
        return math.inf
    low, high = float(seen["pairs"]), float(rows) * rows
    for _ in range(64):
        middle = math.sqrt(low * high)
        low, high = (low, middle) if -middle * math.expm1(-rows / middle) > seen["pairs"] else (middle, high)
    return high


def _group(item: Column, groups: int) -> Column:
    # a seed of its own: blocks are dealt by the plain hash
    return F.pmod(F.xxhash64(item, F.lit(groups)), F.lit(groups)).cast("int")


def _narrow_types(*frames: DataFrame) -> dict[str, T.DataType]:
    """For each column of the frames, which share their columns' types, the smallest
    type that holds all its values as they are: ids as ints, stars as bytes or floats.

    One pass a frame, of one row; a column without values keeps its type.
    """
    def fits(c: str, kind: T.DataType) -> dict[T.DataType, Column]:
        v = F.col(c)
        if isinstance(kind, T.LongType):
            return {T.IntegerType(): v.between(-2**31, 2**31 - 1)}
        if isinstance(kind, T.DoubleType):
            return {T.ByteType(): v.between(1, 127) & (v % 1 == 0), T.FloatType(): v == v.cast("float").cast("double")}
        return {}

    checks = {c: fits(c, f.schema[c].dataType) for f in frames for c in f.columns}
    types = {c: f.schema[c].dataType for f in frames for c in f.columns}
    rows = [f.agg(F.count(F.lit(1)).alias("_n"), *[F.bool_and(ok).alias(f"{c} {i}") for c in f.columns
                                                    for i, ok in enumerate(checks[c].values())]).first()
            for f in frames]
    for c, found in checks.items():
        for i, kind in enumerate(found):
            said = [r[f"{c} {i}"] for r, f in zip(rows, frames, strict=True) if c in f.columns]
            if any(x is not None for x in said) and all(x is not False for x in said):
                types[c] = kind
                break
    return types


def _cell_records(held: DataFrame, groups: int, block: int, needed: DataFrame | None = None
                  ) -> tuple[DataFrame, dict[str, T.DataType]]:
    """(g, h, holder, n, items, values, kinds): what a holder has in every two groups,
    the first n items of the one and the rest of the other; and the types of ``held``.

    ``held`` has rows (holder, item, value, kind), one per holder, item and kind.  A
    holder's items are dealt into blocks of about ``block``; two blocks, and within
    them two groups, make a record, so a holder of any size spreads over records.
    Where all n items are the first, each meets the ones behind it.  Pairs (target,
    rated) of ``needed`` are records without a holder.  Records hold narrow types.
    """
    types = {c: held.schema[c].dataType for c in ("holder", "item", "value")}
    asked = [] if needed is None else [needed.select(F.col(c).alias("item")) for c in ("target", "rated")]
    narrow = _narrow_types(held.select(*types), *asked)
    item = F.col("item").cast(types["item"])  # hashed as it is, not as it is kept
    held = held.withColumns({c: F.col(c).cast(t) for c, t in narrow.items()})
    blocks = held.groupBy("holder").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("_blocks"))
    most = blocks.agg(F.max("_blocks")).first()[0]  # one row
    # where one block is enough for everybody, there is nothing to join
    dealt = held.join(blocks, "holder") if most and most > 1 else held.where(
        F.col("holder").isNotNull()).withColumn("_blocks", F.lit(1).cast("long"))
    packed = (dealt.withColumn("_own", F.pmod(F.xxhash64(item), F.col("_blocks")))
              .repartition("holder", "_own")
              .groupBy("holder", "_own", "_blocks", _group(item, groups).alias("g"))
              .agg(F.collect_list(F.struct("item", "value", "kind")).alias("e"))
              .groupBy("holder", "_own", "_blocks")
              .agg(F.collect_list(F.struct("g", F.col("e.item").alias("items"), F.col("e.value").alias("values"),
                                           F.col("e.kind").alias("kinds"))).alias("p")))

    def records(both: DataFrame, same: bool) -> DataFrame:
        each = both.select("holder", F.explode("p").alias("l"), "q").select("holder", "l", F.explode("q").alias("r"))
        if same:
            each = each.where(F.col("l.g") <= F.col("r.g"))
        own = F.lit(same) & (F.col("l.g") == F.col("r.g"))
        return each.select(
            F.least("l.g", "r.g").alias("g"), F.greatest("l.g", "r.g").alias("h"), "holder",
            F.size("l.items").alias("n"),
            *[F.when(own, F.col(f"l.{c}")).otherwise(F.concat(f"l.{c}", f"r.{c}")).alias(c)
              for c in ("items", "values", "kinds")])

    many = packed.where(F.col("_blocks") > 1)
    left = many.where(F.col("_own") < F.col("_blocks") - 1).select(
        "holder", F.col("_own").alias("_i"),
        F.explode(F.sequence(F.col("_own") + 1, F.col("_blocks") - 1)).alias("_j"), "p")
    right = many.where(F.col("_own") > 0).select(
        "holder", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_own") - 1)).alias("_i"),
        F.col("_own").alias("_j"), F.col("p").alias("q"))
    found = records(packed.withColumn("q", F.col("p")), True).unionByName(
        records(left.join(right, ["holder", "_i", "_j"]), False))
    if needed is not None:
        found = found.unionByName(_needed_records(needed, groups, narrow))
    return found, types


def _entries(rows: DataFrame, item: str, value: Column, kind: int, holder: str = "user_id") -> DataFrame:
    """Rows (holder, item, value, kind) for :func:`_cell_records`."""
    return rows.where(F.col(item).isNotNull()).select(
        F.col(holder).alias("holder"), F.col(item).alias("item"), value.alias("value"),
        F.lit(kind).cast("tinyint").alias("kind"))


def _dealt(records: DataFrame, groups: int) -> DataFrame:
    """Records of cells (g, h), g <= h, numbered in a row: one partition each."""
    cell = F.expr(f"cast(g * {groups} - (g * (g - 1)) div 2 + h - g as int)")
    return (records.withColumn("cell", cell).drop("g", "h")
            .repartitionById(groups * (groups + 1) // 2, F.col("cell")))


def cell_rows(dealt: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """(cell, holder, a, b, x, y, way): the pairs of two items in the records of
    :func:`_dealt`, all rows of two items in one task.

    Two values (way 0) are a row with the items a < b and their values.  A target
    and another of its holder's items are a pair that is asked for, way 1 if the
    target is a, else 2; two targets are no pair.  Rows are partitioned by ``cell``, a function of the
    two items, so an aggregate by (cell, a, b) shuffles nothing more.
    """
    own = F.col("n") == F.size("items")
    start = F.when(own, F.col("i") + 2).otherwise(F.col("n") + 1)
    i, j = F.col("i"), start - 1 + F.col("j")
    rows = (dealt.select("cell", "holder", "n", "items", "values", "kinds",
                         F.posexplode(F.slice("items", F.lit(1), F.col("n"))).alias("i", "l"))
            .select("cell", "holder", "n", "items", "values", "kinds", "i", "l",
                    F.posexplode(F.slice("items", start, F.size("items"))).alias("j", "r"))
            # an item that its holder rated and asks for meets itself
            .where(~own | (F.col("l") != F.col("r")))
            .select("cell", "holder", "l", F.get("values", i).alias("lx"), F.get("kinds", i).alias("lk"),
                    "r", F.get("values", j).alias("rx"), F.get("kinds", j).alias("rk")))
    values = (F.col("lk") == VALUE) & (F.col("rk") == VALUE)
    rows = rows.where(values | ((F.col("lk") == TARGET) != (F.col("rk") == TARGET)))
    turned = F.coalesce(F.col("l") > F.col("r"), F.lit(False))

    def first(mine: str, other: str) -> Column:
        return F.when(turned, F.col(other)).otherwise(F.col(mine))

    def whole(found: Column, name: str) -> Column:
        return found.cast(types[name])

    return rows.select("cell", whole(F.col("holder"), "holder").alias("holder"),
                       whole(first("l", "r"), "item").alias("a"), whole(first("r", "l"), "item").alias("b"),
                       whole(first("lx", "rx"), "value").alias("x"), whole(first("rx", "lx"), "value").alias("y"),
                       F.when(values, 0).when(first("lk", "rk") == TARGET, 1).otherwise(2).alias("way"))


def _needed_records(needed: DataFrame, groups: int, narrow: dict[str, T.DataType]) -> DataFrame:
    """Needed pairs (target, rated), one a record of :func:`_cell_records`, without a holder."""
    t, r = _group(F.col("target"), groups), _group(F.col("rated"), groups)
    none = F.lit(None).cast(narrow["value"])
    return needed.select(
        F.least(t, r).alias("g"), F.greatest(t, r).alias("h"), F.lit(None).cast(narrow["holder"]).alias("holder"),
        F.lit(1).alias("n"), F.array(*[F.col(c).cast(narrow["item"]) for c in ("target", "rated")]).alias("items"),
        F.array(none, none).alias("values"), F.array(*[F.lit(k).cast("tinyint") for k in (TARGET, RATED)]).alias("kinds"))


def _same_kinds(pairs: DataFrame, ratings: DataFrame) -> bool:
    return all(pairs.schema[c].dataType == ratings.schema[c].dataType for c in ("user_id", "business_id"))


def _rating_cells(pairs: DataFrame, ratings: DataFrame, groups: int, block: int
                  ) -> tuple[DataFrame, dict[str, T.DataType]]:
    """The users' ratings and targets, dealt to the cells of two item groups, and their types.

    A user's targets lie in the records of the user's ratings, so the pairs that
    are asked for need no rows of their own.
    """
    targets = pairs.select("user_id", "business_id").distinct()
    stars = F.col("stars")
    held = _entries(ratings, "business_id", stars, VALUE).unionByName(_entries(
        targets, "business_id", F.lit(None).cast(ratings.schema["stars"].dataType), TARGET))
    records, types = _cell_records(held, groups, block)
    return _dealt(records, groups), types


def _asked_ways(sums: DataFrame) -> DataFrame:
    """A row (target, rated, turned) for each way in which a pair (a, b) is asked for."""
    ways = (F.when(F.col("ways") == 3, F.array(F.lit(False), F.lit(True)))
            .when(F.col("ways") == 2, F.array(F.lit(True))).otherwise(F.array(F.lit(False))))
    return (sums.where(F.col("ways") > 0).withColumn("turned", F.explode(ways))
            .withColumn("target", F.when(F.col("turned"), F.col("b")).otherwise(F.col("a")))
            .withColumn("rated", F.when(F.col("turned"), F.col("a")).otherwise(F.col("b"))))


def _of_kind(needed: DataFrame, kind: T.DataType, found) -> DataFrame:
    """``found(pairs)`` for needed pairs whose ids may be text where the ratings'
    are of ``kind``: ids that are none of these become null, and meet nothing."""
    if all(needed.schema[c].dataType == kind for c in ("target", "rated")):
        return found(needed.select("target", "rated"))
    t, r = F.col("target").try_cast(kind), F.col("rated").try_cast(kind)
    out = found(needed.select(t.alias("target"), r.alias("rated"))).withColumnsRenamed(
        {"target": "_t", "rated": "_r"})
    asked = needed.select("target", "rated").distinct()
    return asked.join(out, t.eqNullSafe(F.col("_t")) & r.eqNullSafe(F.col("_r"))).drop("_t", "_r")


def _cell_stats(dealt: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """:func:`corated_stats` of the pairs that are asked for in the cells, with their cell."""
    own, turned = F.col("way") == 0, F.col("turned")
    x, y = F.when(own, F.col("x")), F.when(own, F.col("y"))
    sums = cell_rows(dealt, types).groupBy("cell", "a", "b").agg(
        F.bit_or("way").alias("ways"), F.count(F.when(own, F.col("holder"))).alias("n"),
        F.sum(x).alias("sx"), F.sum(y).alias("sy"), F.sum(x * x).alias("sxx"),
        F.sum(y * y).alias("syy"), F.sum(x * y).alias("sxy"))
    return _asked_ways(sums).select(
        "cell", "target", "rated", "n", *[F.coalesce(F.when(turned, F.col(d)).otherwise(F.col(c)),
                                                     F.lit(0.0)).alias(c)
                                          for c, d in (("sx", "sy"), ("sy", "sx"), ("sxx", "syy"),
                                                       ("syy", "sxx"), ("sxy", "sxy"))])


def pair_stats(pairs: DataFrame, ratings: DataFrame, block: int = BLOCK) -> DataFrame:
    """:func:`corated_stats` of the item pairs that the requested pairs need."""
    groups = item_groups(ratings) if _same_kinds(pairs, ratings) else 1
    if groups > 1:
        return _cell_stats(*_rating_cells(pairs, ratings, groups, block)).drop("cell")
    return corated_stats(candidate_pairs(pairs, ratings).select("target", "rated"), ratings, block)


def corated_stats(needed: DataFrame, ratings: DataFrame, block: int = BLOCK,
                  pruned: bool = True) -> DataFrame:
    """Pearson sufficient statistics per distinct needed pair (pairs with none: n = 0).

    Up to ``CELL_ROWS`` co-ratings, those of pairs that nobody asked for are
    dropped in the task that joins them, by a bitmap of the needed pairs, before
    any sum is taken or shuffled; the few that pass by chance fall out of the
    last join.  More are summed in cells of two item groups, where a task has
    the needed pairs themselves, and no co-rating or sum is shuffled.
    """
    groups = item_groups(ratings)
    if groups > 1:
        held = _entries(ratings, "business_id", F.col("stars"), VALUE)

        def found(asked: DataFrame) -> DataFrame:
            records, types = _cell_records(held, groups, block, asked)
            return _cell_stats(_dealt(records, groups), types).drop("cell")

        return _of_kind(needed, ratings.schema["business_id"].dataType, found)
    needed = needed.distinct()
    rows = corating_rows(ratings, block)
    if pruned:
        # read twice: for the bitmap and for the last join
        needed = cut_lineage(needed.select("target", "rated"))
        kind = ratings.schema["business_id"].dataType
        asked = [F.col(c).try_cast(kind) for c in ("target", "rated")]
        rows = maybe_needed(rows, *pair_bitmap(needed.select(
            F.least(*asked).alias("a"), F.greatest(*asked).alias("b")).dropna().distinct()))
    sums = rows.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("x").alias("sx"), F.sum("y").alias("sy"),
        F.sum(F.col("x") * F.col("x")).alias("sxx"),
        F.sum(F.col("y") * F.col("y")).alias("syy"),
        F.sum(F.col("x") * F.col("y")).alias("sxy"),
    )
    # requested ids may be text where the ratings' are numbers
    kind = ratings.schema["business_id"].dataType
    target, rated = F.col("target").try_cast(kind), F.col("rated").try_cast(kind)
    asked = needed.select("target", "rated", F.least(target, rated).alias("a"),
                          F.greatest(target, rated).alias("b"))
    j = asked.join(sums, ["a", "b"], "left").fillna(
        {"n": 0, "sx": 0.0, "sy": 0.0, "sxx": 0.0, "syy": 0.0, "sxy": 0.0})
    same = target == F.col("a")

    def turned(mine: str, other: str):
        return F.when(same, F.col(mine)).otherwise(F.col(other))

    return j.select("target", "rated", "n", turned("sx", "sy").alias("sx"), turned("sy", "sx").alias("sy"),
                    turned("sxx", "syy").alias("sxx"), turned("syy", "sxx").alias("syy"), "sxy")


def similarity_from_stats(stats: DataFrame, item_means: DataFrame) -> DataFrame:
    """A9 + F13 + F19: co-rated Pearson with the reference's fallbacks."""
    mt = item_means.select(F.col("business_id").alias("target"), F.col("item_mean").alias("mean_t"))
    mr = item_means.select(F.col("business_id").alias("rated"), F.col("item_mean").alias("mean_r"))
    s = stats.join(mt, "target", "left").join(mr, "rated", "left")
    n = F.col("n").cast("double")
    num = n * F.col("sxy") - F.col("sx") * F.col("sy")
    vx = n * F.col("sxx") - F.col("sx") * F.col("sx")
    vy = n * F.col("syy") - F.col("sy") * F.col("sy")
    pearson = F.when((vx == 0) | (vy == 0), F.lit(0.0)).otherwise(num / (F.sqrt(vx) * F.sqrt(vy)))
    fallback = (F.lit(MAX_STARS) - F.abs(F.col("mean_t") - F.col("mean_r"))) / F.lit(MAX_STARS)
    sim = F.when(F.col("n") <= 1, fallback).otherwise(pearson)
    cell = [c for c in stats.columns if c == "cell"]
    return s.select(*cell, "target", "rated", "n", sim.alias("similarity"))


def item_similarity(pairs: DataFrame, ratings: DataFrame, raw: DataFrame,
                    block: int = BLOCK) -> DataFrame:
    """Similarity of every (target, rated) pair the requested pairs need.

    The ratings are read more than once: pass a table, not a long derivation.
    """
    means = stored(entity_means(raw, "business_id", "item_mean"), "means")
    return similarity_from_stats(pair_stats(pairs, ratings, block), means)


def top_neighbors(candidates: DataFrame, sims: DataFrame, k: int = DEFAULT_K,
                  power: float = AMPLIFY_POWER) -> DataFrame:
    """The k neighbours with the largest amplified weight per (user, target).

    Ordering uses ``|similarity|`` rounded to 9 places (monotone in the
    amplified weight, and free of ``pow`` rounding noise), ties by item id.
    """
    return _ranked(candidates.join(sims.select("target", "rated", "similarity"), ["target", "rated"]), k, power)


def _ranked(similar: DataFrame, k: int, power: float) -> DataFrame:
    bundle = [c for c in similar.columns if c == "bundle"]  # of requests, where they were dealt by it
    w = Window.partitionBy(*bundle, "user_id", "target").orderBy(
        F.round(F.abs(F.col("similarity")), TIE_DIGITS).desc(), F.col("rated").asc())
    return (similar.withColumn("weight", amplify("similarity", power))
            .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).drop("bundle"))


def neighbors(pairs: DataFrame, ratings: DataFrame, item_means: DataFrame, k: int = DEFAULT_K,
              power: float = AMPLIFY_POWER, block: int = BLOCK) -> DataFrame:
    """:func:`top_neighbors` of the requested pairs, by the similarity of their items.

    Beyond one cell, candidates meet their similarities in the cells too.  Only
    then are they shuffled, to their user and target, a row for each cell and ``BUNDLE``.
    """
    groups = item_groups(ratings) if _same_kinds(pairs, ratings) else 1
    if groups == 1:
        cands = candidate_pairs(pairs, ratings)
        sims = similarity_from_stats(
            corated_stats(cands.select("target", "rated"), ratings, block), item_means)
        return top_neighbors(cands, sims, k, power)
    dealt, types = _rating_cells(pairs, ratings, groups, block)
    narrow = {"holder": dealt.schema["holder"].dataType, "item": dealt.schema["items"].dataType.elementType,
              "value": dealt.schema["values"].dataType.elementType}
    turned = F.col("way") == 2
    cands = cell_rows(dealt, types).where(F.col("way") > 0).select(
        "cell", F.col("holder").alias("user_id"), F.when(turned, F.col("b")).otherwise(F.col("a")).alias("target"),
        F.when(turned, F.col("a")).otherwise(F.col("b")).alias("rated"),
        F.when(turned, F.col("x")).otherwise(F.col("y")).alias("rating"))
    sims = similarity_from_stats(_cell_stats(dealt, types), item_means)
    # A row holds what a cell found for a bundle of requests, as columns side by side
    # and in order, so what its candidates share is shuffled about once.
    bundles = pairs.count() // BUNDLE + 1
    fields = ("user_id", "target", "rated", "rating", "similarity")
    bundle = F.pmod(F.xxhash64("user_id", "target"), F.lit(bundles))
    # both sides lie by cell: merged there, where a broadcast would lose that
    packed = (cands.withColumn("bundle", bundle).join(
        sims.hint("merge"), ["cell", "target", "rated"]).groupBy("cell", "bundle")
              .agg(F.sort_array(F.collect_list(F.struct(*fields))).alias("of")))
    kinds = {"user_id": "holder", "target": "item", "rated": "item", "rating": "value"}
    packed = packed.select("bundle", *[
        F.col(f"of.{c}").cast(T.ArrayType(narrow[kinds[c]])).alias(c) if c in kinds else F.col(f"of.{c}").alias(c)
        for c in fields])
    similar = (packed.repartition("bundle").select("bundle", F.inline(F.arrays_zip(*fields)))
               .withColumns({c: F.col(c).cast(types[kind]) for c, kind in kinds.items()}))
    return _ranked(similar, k, power)


def predict(pairs: DataFrame, ratings: DataFrame, raw: DataFrame, k: int = DEFAULT_K,
            power: float = AMPLIFY_POWER, block: int = BLOCK) -> DataFrame:
    """Q3: (user_id, business_id, prediction) for every row of ``pairs``.

    ``ratings``: de-duplicated (user_id, business_id, stars); ``raw``: every
    rating row (for the means and the known-id test).
    """
    pairs, ratings = kept(pairs, ratings)
    item_means = stored(entity_means(raw, "business_id", "item_mean"), "means")
    top = neighbors(pairs, ratings, item_means, k, power, block)
    agg = top.groupBy("user_id", "target").agg(
        F.sum(F.col("weight") * F.col("rating")).alias("num"),
        F.sum(F.abs(F.col("weight"))).alias("den"))
    users = raw.select("user_id").distinct().withColumn("_known_user", F.lit(True))
    tmean = item_means.select(F.col("business_id"), F.col("item_mean").alias("_target_mean"))
    p = (pairs.select("user_id", "business_id")
              .join(users, "user_id", "left")
              .join(tmean, "business_id", "left")
              .join(agg.withColumnRenamed("target", "business_id"), ["user_id", "business_id"], "left"))
    known = F.col("_known_user").isNotNull() & F.col("_target_mean").isNotNull()
    pred = (F.when(~known, F.lit(UNKNOWN_PREDICTION))
            .when(F.col("den").isNull() | (F.col("den") == 0), F.col("_target_mean"))
            .otherwise(clamp(F.col("num") / F.col("den"), MIN_STARS, TOP_STARS)))
    return p.select("user_id", "business_id", pred.alias("prediction"))


def corated_users(ratings: DataFrame, item_a, item_b) -> DataFrame:
    """U1 (set form): users who rated both items, via ``intersect``."""
    a = ratings.where(F.col("business_id") == F.lit(item_a)).select("user_id")
    b = ratings.where(F.col("business_id") == F.lit(item_b)).select("user_id")
    return a.intersect(b)


def rater_words(ratings: DataFrame) -> DataFrame:
    """U1 as bitmaps: (item, word, bits), bit j of word w being user 64 w + j.

    ``ratings`` holds one row per (user, item); users are numbered by a
    distributed index of their ids.  Only words with a rater are kept.
    """
    return _words(ratings, _user_codes(ratings))


def _user_codes(ratings: DataFrame) -> DataFrame:
    return consecutive_index(ratings.select("user_id").distinct(), ["user_id"], "_code")


def _words(rows: DataFrame, users: DataFrame) -> DataFrame:
    bit = F.expr("shiftleft(1L, cast(_code % 64 as int))")
    return (rows.select("user_id", F.col("business_id").alias("item")).join(users, "user_id")
            .groupBy("item", F.expr("_code div 64").alias("word")).agg(F.bit_or(bit).alias("bits")))


def corated_counts(needed: DataFrame, ratings: DataFrame, block: int = WORD_BLOCK) -> DataFrame:
    """(target, rated, n), the number of common raters of each distinct needed pair.

    Rater bitmaps are written once and intersected word by word, so up to 64
    raters of an item are one row.  Words meet in cells of two item groups
    (:func:`cell_rows`), where their bits are counted and summed: only the
    words, once for each group, are shuffled.  Pairs without a common rater
    have 0.
    """
    groups = item_groups(ratings)
    words = cut_lineage(rater_words(ratings.where(F.col("business_id").isNotNull())))
    held = _word_entries(words, VALUE)
    return _of_kind(needed, ratings.schema["business_id"].dataType, lambda asked: _cell_counts(
        *_cell_records(held, groups, block, asked), groups))


def pair_counts(pairs: DataFrame, ratings: DataFrame, block: int = WORD_BLOCK) -> DataFrame:
    """:func:`corated_counts` of the item pairs that the requested pairs need.

    Who wants a target is a bitmap too: a pair is asked for where a word of its
    target's seekers meets one of the rated item's raters.
    """
    if not _same_kinds(pairs, ratings):
        return corated_counts(candidate_pairs(pairs, ratings).select("target", "rated"), ratings, block)
    groups = item_groups(ratings)
    known = F.col("business_id").isNotNull()
    users = cut_lineage(_user_codes(ratings))
    words = cut_lineage(_words(ratings.where(known), users))
    held = _word_entries(words, VALUE).unionByName(_word_entries(_words(pairs.where(known), users), TARGET))
    return _cell_counts(*_cell_records(held, groups, block), groups)


def _word_entries(words: DataFrame, kind: int) -> DataFrame:
    return _entries(words, "item", F.col("bits"), kind, "word")


def _cell_counts(records: DataFrame, types: dict[str, T.DataType], groups: int) -> DataFrame:
    """(target, rated, n) of the pairs asked for, from records of words."""
    common = F.col("x").bitwiseAND(F.col("y"))
    found = F.when(F.col("way") == 0, F.bit_count(common).cast("long"))
    sums = (cell_rows(_dealt(records, groups), types).where(F.coalesce(common != 0, F.col("way") > 0))
            .groupBy("cell", "a", "b").agg(F.bit_or("way").alias("ways"), F.sum(found).alias("n")))
    return _asked_ways(sums).select("target", "rated", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def rating_maps(ratings: DataFrame, key: str = "user_id", other: str = "business_id",
                entries: int = MAP_ENTRIES) -> DataFrame:
    """A8 as maps: (key, pieces, piece, ratings), ``ratings`` a map other -> stars.

    ``ratings`` holds one row per (user, item).  A key's entries are dealt by a
    hash of ``other`` into ``ceil(n / entries)`` pieces, so a map of a key of any
    size stays near ``entries`` and a hot key spreads over tasks; a piece is
    found again from the hash (:func:`map_ratings`).
    """
    sizes = ratings.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / entries).cast("long").alias("pieces"))
    return (ratings.join(sizes, key)
            .groupBy(key, "pieces", F.pmod(F.xxhash64(other), F.col("pieces")).alias("piece"))
            .agg(F.map_from_entries(F.collect_list(F.struct(other, "stars"))).alias("ratings")))


def map_ratings(pairs: DataFrame, maps: DataFrame, key: str = "user_id",
                other: str = "business_id") -> DataFrame:
    """``pairs`` with ``stars`` looked up in :func:`rating_maps`, NULL if absent."""
    sizes = maps.select(key, "pieces").distinct()
    return (pairs.join(sizes, key, "left")
            .withColumn("piece", F.pmod(F.xxhash64(other), F.col("pieces")))
            .join(maps.drop("pieces"), [key, "piece"], "left")
            .withColumn("stars", F.try_element_at("ratings", F.col(other)))
            .select(*pairs.columns, "stars"))


def rating_map_long(ratings: DataFrame, raw: DataFrame, key: str = "user_id") -> DataFrame:
    """A8 in normalised form: key -> (other, last rating) rows plus the key's mean.

    The reference's nested dict ``key -> {other: rating}`` is this table;
    keeping it long means no single key's entries are gathered into one row.
    """
    means = entity_means(raw, key, "avg_rating")
    return ratings.select("user_id", "business_id", "stars").join(means, key)
