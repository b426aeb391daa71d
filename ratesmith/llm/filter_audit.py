"""How five document filters act on each other, over every order of them.

Each document fails some of five filters; its failures are a five-bit mask.
Documents are counted per part, mask and labels ("cells", at most 32 a part),
and all that follows is arithmetic on cells.  A cell is folded across the
array of the 120 filter orders by higher-order SQL functions: ``transform``
walks the orders and ``aggregate`` walks one order's filters while it carries
whether the cell is still alive.  Each cell becomes 600 structs (120 orders
of 5 steps) weighted by its documents, and a part's structs are the
elementwise sums of its cells'.

Filters: A few words, B repetitive words, C many capitals, D unwanted
characters, E a text that a document with a smaller id already has.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratesmith.session import cut_lineage

FILTERS = "ABCDE"
#: Thresholds: words a text needs, percent of them that must be distinct,
#: percent of characters that may be capitals, and the unwanted characters.
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS, UNWANTED = 50, 65, 5, "[#$%&*|]"
#: Rows without an id are dealt into this many keys for the label join.
_SPREAD = 4096

_SUMS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def with_failures(docs: DataFrame) -> DataFrame:
    """Add ``fails``: mask of the filters A to D that the column text fails.

    Words are split once a text: expressions used twice stay projections.
    """
    counted = docs.withColumn("words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")) \
        .withColumns({"n_words": F.size("words"), "n_distinct": F.size(F.array_distinct("words"))})
    capitals = F.char_length(F.regexp_replace("text", "[^A-Z]+", "")).cast("long")
    fails = (F.col("n_words") < MIN_WORDS,
             100 * F.col("n_distinct").cast("long") < MIN_DISTINCT * F.col("n_words").cast("long"),
             100 * capitals > MAX_CAPITALS * F.char_length("text").cast("long"),
             F.col("text").rlike(UNWANTED))
    mask = sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))
    return counted.withColumn("fails", mask).drop("words", "n_words", "n_distinct")


def cells(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """Documents counted per part and mask: part, mask, n, good, toxic.

    Only ids, digests and masks are shuffled, never texts.  The first document
    of a text is found by aggregates that count before they shuffle, so a
    large group of copies does not land in one task.
    """
    # rows without an id are spread over keys of their own, which no label has
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(
        F.lit("?"), F.pmod(F.monotonically_increasing_id(), F.lit(_SPREAD)).cast("string")))
    narrow = (with_failures(docs.select(
        F.col(id_col).alias("id"), key.alias("key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part")))
        .select("id", "key", "part", "fails", F.sha2("text", 256).alias("digest")))
    known = (labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                  F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
             .withColumn("key", F.col("id").cast("string")))
    group = ["digest", "fails", "part", "good", "toxic"]
    each = (narrow.join(known, ["key", "id"], "left").fillna(0, ["good", "toxic"])
            .groupBy("key", "id", *group).agg(F.count(F.lit(1)).alias("n")))
    # rows without an id come after all ids, and none of them precedes another
    place = F.struct(F.col("id").isNull().alias("unnamed"), F.col("id"))
    groups = cut_lineage(each.groupBy(*group).agg(
        F.sum("n").alias("n"), F.min(F.struct(place.alias("place"), "n")).alias("first")))
    # of the rows of a text's smallest id, none fails E
    smallest = groups.groupBy("digest").agg(F.min("first.place").alias("smallest"))
    passing = (F.when(F.col("smallest.unnamed"), F.col("n"))
               .when(F.col("first.place") == F.col("smallest"), F.col("first.n")).otherwise(F.lit(0)))
    counted = groups.join(smallest, "digest").withColumn("passing", passing)
    both = F.explode(F.array(
        F.struct(F.col("fails").alias("mask"), F.col("passing").alias("n")),
        F.struct((F.col("fails") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("n"))))
    return (counted.select("part", "good", "toxic", both.alias("cell"))
            .groupBy("part", "cell.mask")
            .agg(F.sum("cell.n").alias("n"), F.sum(F.col("cell.n") * F.col("good")).alias("good"),
                 F.sum(F.col("cell.n") * F.col("toxic")).alias("toxic")))


def _steps(order: Column) -> Column:
    """One order folded over one cell: five structs of weighted counts."""
    none = F.lit(0).cast("long")
    empty = F.array().cast(f"array<struct<{', '.join(f'{c}: bigint' for c in _SUMS)}>>")
    start = F.struct(F.lit(True).alias("alive"), empty.alias("steps"))

    def walk(so_far: Column, at: Column) -> Column:
        alive, fails = so_far["alive"], F.getbit(F.col("mask"), at) == 1
        taken = alive & fails
        weigh = lambda when, of: F.when(when, F.col(of)).otherwise(none)
        only = F.col("mask") == F.pow(F.lit(2.0), at).cast("int")
        step = F.struct(
            weigh(alive & ~fails, "n").alias("kept"), weigh(taken, "n").alias("removed"),
            weigh(~alive & fails, "n").alias("redundant"), weigh(only, "n").alias("unique_fails"),
            weigh(taken, "good").alias("good_lost"), weigh(taken, "toxic").alias("toxic_lost"))
        return F.struct((alive & ~fails).alias("alive"),
                        F.concat(so_far["steps"], F.array(step)).alias("steps"))

    return F.aggregate(order, start, walk, lambda done: done["steps"])


def _add(left: Column, right: Column) -> Column:
    """Elementwise sums of two arrays of structs."""
    return F.zip_with(left, right, lambda a, b: F.struct(*[(a[c] + b[c]).alias(c) for c in _SUMS]))


def audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          part_col: str = "source") -> DataFrame:
    """Return part, filter_order, step, the six counts and shapley: 600 rows a part.

    Null texts are empty; a null part is the empty string; a null id has no
    smaller id's text before it unless a named document has that text; rows
    with one id do not precede each other; repeated rows all count.  A
    document is good or toxic if any of its label rows says 1.  Other columns
    are ignored; an empty table gives no rows.
    """
    orders = [list(o) for o in permutations(range(len(FILTERS)))]
    # the constant array of orders goes to the executors with the plan
    folded = (cells(docs, labels, id_col, text_col, part_col)
              .withColumn("orders", F.lit(orders))
              .withColumn("steps", F.flatten(F.transform("orders", _steps))))
    size = len(orders) * len(FILTERS)
    zero = F.array_repeat(F.struct(*[F.lit(0).cast("long").alias(c) for c in _SUMS]), size)
    # at most 32 cells a part are gathered, one a mask
    merged = (folded.groupBy("part").agg(F.collect_list("steps").alias("cells"))
              .select("part", F.aggregate("cells", zero, _add).alias("steps")))
    filters = F.lit([f for o in orders for f in o])
    shares = F.transform(F.sequence(F.lit(0), F.lit(len(FILTERS) - 1)), lambda f: F.aggregate(
        F.zip_with("steps", filters, lambda s, g: F.when(f == g, s["removed"]).otherwise(
            F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda a, b: a + b))
    names = F.lit(["".join(FILTERS[f] for f in o) for o in orders])
    rows = merged.select("part", shares.alias("shares"), F.posexplode("steps").alias("at", "s"))
    per = len(FILTERS)
    return rows.select(
        "part", F.get(names, F.floor(F.col("at") / per).cast("int")).alias("filter_order"),
        (F.col("at") % per + 1).cast("int").alias("step"), *[F.col(f"s.{c}").alias(c) for c in _SUMS],
        F.get("shares", F.get(filters, F.col("at"))).alias("shapley"))
