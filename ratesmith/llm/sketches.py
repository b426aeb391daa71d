"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A document's distinct paragraphs (lines) are hashed to 64-bit digests.  A
sketch has three tables of cells; a digest is added to one cell of each: the
cell counts it and keeps the exclusive or of the digests and of a second hash
of them.  Subtracting two sketches cell by cell leaves only the digests that
differ.  A cell with a count of one either way whose second hash fits its
digest is pure: the digest is recovered and taken out of its three cells,
which may make others pure.  If cells remain when no more can be peeled in the
steps given, the pair is sketched again with four times the cells.

Cells are rows, grouped by document: every step is one aggregation within the
partitions that the documents were dealt to, over any number of paragraphs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratesmith.session import cut_lineage

#: Cells of each of the three tables at first, and the growth on failure.
TABLES, CELLS, GROWTH = 3, 16, 4
#: Peeling steps (one table each) before a pair counts as failed.
STEPS = 12
#: Documents whose cells a task peels.
DOCS_TOGETHER = 8192
#: Copies of a row made from one array.
LOT = 1 << 16
_CHECK = 99


def paragraph_digests(text: Column) -> Column:
    """Distinct 64-bit digests of a text's lines (an empty text has one)."""
    return F.array_distinct(F.transform(F.split(text, "\n", -1), lambda p: F.xxhash64(p)))


def _cells(digest: Column, cells: int) -> Column:
    """The three cells of a digest, one in each table."""
    return F.array(*[(F.pmod(F.xxhash64(digest, F.lit(t)), F.lit(cells)) + t * cells).cast("int")
                     for t in range(TABLES)])


def neighbours(ids: DataFrame) -> DataFrame:
    """For distinct rows (k, k2, doc_id, n): the key and n of the next row and
    of the row before.

    Order: doc_id descending, null last, then k and k2; the last row's next is
    the first.  Rows are range-partitioned; the first and last row of each
    partition are linked through a table of one row per partition.
    """
    order = [F.col("doc_id").desc_nulls_last(), F.col("k"), F.col("k2")]
    parts = cut_lineage(ids.repartitionByRange(*order).withColumn("part", F.spark_partition_id()))
    me = F.struct("k", "k2", "n")
    inside = Window.partitionBy("part").orderBy(*order)
    linked = (parts.withColumn("next", F.lead(me).over(inside))
              .withColumn("prev", F.lag(me).over(inside)))
    # a row per partition
    ends = linked.groupBy("part").agg(
        F.first(F.when(F.col("prev").isNull(), me), ignorenulls=True).alias("first"),
        F.first(F.when(F.col("next").isNull(), me), ignorenulls=True).alias("last"))
    ring, everyone = Window.orderBy("part"), Window.partitionBy()
    ends = (ends.withColumn("after", F.coalesce(
        F.lead("first").over(ring), F.min_by("first", "part").over(everyone)))
        .withColumn("before", F.coalesce(
            F.lag("last").over(ring), F.max_by("last", "part").over(everyone)))
        .select("part", "after", "before"))
    return (linked.join(ends, "part")
            .select("k", "k2", "copies", F.coalesce("prev", "before").alias("prev"),
                    F.coalesce("next", "after").alias("next")))


def edited_versions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document with its edited text and the next document's paragraphs.

    Returns k, k2 (a row's key), copies, doc_id, n_chars, edited_sha256 and the
    digest arrays own, edited and next.  The edited text has the last half of
    the characters (rounded down) replaced by the first as many, or all, of the
    next document.  Texts are shuffled once, and the beginnings that the edits
    need once more.

    Rows of one id and text are next to each other, so they need at most two
    versions: the last is followed by the next document, all others by a copy.
    Such rows stay one, with the number of ``copies`` that it stands for.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    no_id = F.col("doc_id").isNull()
    rows = (rows.withColumn("n", F.char_length("text"))
            .withColumn("k", F.xxhash64(F.lit(1), "doc_id", no_id, "text"))
            .withColumn("k2", F.xxhash64(F.lit(2), "doc_id", no_id, "text")))
    key = ["k", "k2"]
    links = neighbours(rows.groupBy(*key, "doc_id", "n").agg(F.count(F.lit(1)).alias("copies")))
    # the one partitioning by the key serves the window and the joins; n in the
    # order keeps it in both uses of the shuffled texts, so that these are one
    once = rows.withColumn("nth", F.row_number().over(Window.partitionBy(*key).orderBy("doc_id", "n")))
    own = once.filter("nth = 1").join(links.select(*key, "copies", "prev"), key)
    half = F.floor(F.col("n") / 2).cast("int")
    given = own.select(
        F.col("prev.k").alias("k"), F.col("prev.k2").alias("k2"),
        F.substr("text", F.lit(1), F.floor(F.col("prev.n") / 2).cast("int")).alias("begin"),
        paragraph_digests(F.col("text")).alias("next"))
    kept = F.substr("text", F.lit(1), F.col("n") - half)

    def version(key2: Column, copies: Column, edit: Column, follow: Column) -> Column:
        return F.struct(key2.alias("k2"), copies.alias("copies"), F.sha2(edit, 256).alias("edited_sha256"),
                        paragraph_digests(edit).alias("edited"), follow.alias("next"))

    last = version(F.col("k2"), F.lit(1).cast("long"), F.concat(kept, "begin"), F.col("next"))
    others = version(F.bitwise_not("k2"), F.col("copies") - 1,
                     F.concat(kept, F.substr("text", F.lit(1), half)), F.col("own"))
    edited = own.join(given, key).withColumn("own", paragraph_digests(F.col("text")))
    return edited.select(
        "k", "doc_id", F.col("n").cast("long").alias("n_chars"), "own", F.explode(
            F.when(F.col("copies") > 1, F.array(last, others)).otherwise(F.array(last))).alias("e")
    ).select("k", "doc_id", "n_chars", "own", "e.*")


def repeat_rows(df: DataFrame, times: str) -> DataFrame:
    """Each row as often as its column ``times`` says, in lots, as arrays are
    held whole."""
    lots = F.sequence(F.lit(0).cast("long"), F.floor((F.col(times) - 1) / LOT))
    here = F.sequence(F.lit(1).cast("long"),
                      F.least(F.lit(LOT).cast("long"), F.col(times) - F.col("lot") * LOT))
    return (df.withColumn("lot", F.explode(lots)).withColumn("nth", F.explode(here))
            .drop("lot", "nth", times))


def sketch_cells(sets: DataFrame, cells: int) -> DataFrame:
    """Cells of the sketches of rows (k, k2, own, edited, next): per cell, the
    count, digest and check of each of the three."""
    def marked(name: str, side: int) -> Column:
        return F.transform(name, lambda d: F.struct(d.alias("d"), F.lit(side).alias("side")))

    items = sets.select("k", "k2", F.explode(F.concat(
        marked("own", 0), marked("edited", 1), marked("next", 2))).alias("i"))
    placed = items.select("k", "k2", "i.d", "i.side", F.xxhash64("i.d", F.lit(_CHECK)).alias("c"),
                          F.explode(_cells(F.col("i.d"), cells)).alias("cell"))
    sums = []
    for side, name in enumerate(("own", "edited", "next")):
        here = F.col("side") == side
        sums += [F.sum(here.cast("int")).alias(f"{name}_n"),
                 F.bit_xor(F.when(here, F.col("d")).otherwise(F.lit(0))).alias(f"{name}_d"),
                 F.bit_xor(F.when(here, F.col("c")).otherwise(F.lit(0))).alias(f"{name}_c")]
    return placed.groupBy("k", "k2", "cell").agg(*sums)


def peel(cells_table: DataFrame, cells: int, steps: int = STEPS) -> DataFrame:
    """Peel differences (k, k2, pair, cell, n, d, c) table by table.

    Returns k, k2, pair, the digests found on the first side only (removed)
    and on the other only (added), and ``left``, the cells not peeled.  A digest
    has one cell in each table, so a step over one table takes it out once; it
    then goes on as a row of its own (cell -1, its digest in ``item``).
    """
    zero = F.lit(0).cast("long")
    state = cells_table.filter("n != 0 or d != 0 or c != 0").withColumn("item", zero)
    for step in range(steps):
        table = step % TABLES
        pure = ((F.col("cell") >= table * cells) & (F.col("cell") < (table + 1) * cells)
                & (F.abs("n") == 1) & (F.xxhash64("d", F.lit(_CHECK)) == F.col("c")))
        n = F.col("n").cast("long")
        here = F.struct("cell", "item", n.alias("n"), "d", "c")
        out = F.transform(_cells(F.col("d"), cells), lambda cell: F.struct(
            cell.alias("cell"), zero.alias("item"), (-n).alias("n"), F.col("d").alias("d"),
            F.col("c").alias("c")))
        found = F.struct(F.lit(-1).alias("cell"), F.col("d").alias("item"), n.alias("n"),
                         zero.alias("d"), zero.alias("c"))
        rows = F.when(pure, F.concat(F.array(here), out, F.array(found))).otherwise(F.array(here))
        state = (state.select("k", "k2", "pair", F.explode(rows).alias("r"))
                 .groupBy("k", "k2", "pair", "r.cell", "r.item")
                 .agg(F.sum("r.n").alias("n"), F.bit_xor("r.d").alias("d"), F.bit_xor("r.c").alias("c"))
                 .filter("n != 0 or d != 0 or c != 0"))
    recovered = F.col("cell") == -1
    return state.groupBy("k", "k2", "pair").agg(
        F.sort_array(F.collect_list(F.when(recovered & (F.col("n") > 0), F.col("item")))).alias("removed"),
        F.sort_array(F.collect_list(F.when(recovered & (F.col("n") < 0), F.col("item")))).alias("added"),
        F.count_if(~recovered).alias("left"))


def _differences(cells_table: DataFrame) -> DataFrame:
    """Cells of own minus edited (pair 0) and own minus next (pair 1)."""
    pairs = F.array(*[F.struct(
        F.lit(pair).alias("pair"), (F.col("own_n") - F.col(f"{name}_n")).alias("n"),
        F.col("own_d").bitwiseXOR(F.col(f"{name}_d")).alias("d"),
        F.col("own_c").bitwiseXOR(F.col(f"{name}_c")).alias("c"))
        for pair, name in enumerate(("edited", "next"))])
    return cells_table.select("k", "k2", "cell", F.explode(pairs).alias("x")).select(
        "k", "k2", "cell", "x.*")


def _fingerprint(name: str) -> Column:
    """Digest of a sketch's cells in any order: two 64-bit exclusive ors."""
    used = F.col(f"{name}_n") > 0
    halves = [F.bit_xor(F.when(used, F.xxhash64("cell", f"{name}_n", f"{name}_d", f"{name}_c",
                                                F.lit(seed))).otherwise(F.lit(0))) for seed in (1, 2)]
    return F.lower(F.concat(*[F.lpad(F.hex(h), 16, "0") for h in halves]))


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          cells: int = CELLS, steps: int = STEPS) -> DataFrame:
    """Sketch every document, its edited text and the next document; compare.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint
    (32 hexadecimal digits of the sketch), near_edited and near_next: the share
    of paragraph digests that two sketches have in common,
    1 - differing / (digests of both), where the differing digests are those
    that peeling recovers; and removed and added, the paragraph digests that
    the edit takes away and brings in.

    Null texts count as empty; equal texts have equal sketches; repeated rows
    and rows of one id are documents of their own, ordered by hashes of id and
    text; a single document is its own next; other columns are ignored; an
    empty table gives an empty result.
    """
    sets = cut_lineage(edited_versions(docs, id_col, text_col))
    # a number of partitions of its own: cells are many times the sets' bytes
    dealt = sets.repartition(max(1, -(-sets.count() // DOCS_TOGETHER)), "k")
    base = sketch_cells(dealt, cells)
    prints = base.groupBy("k", "k2").agg(_fingerprint("own").alias("fingerprint"),
                                          _fingerprint("edited").alias("edited_fingerprint"))
    size = cells
    found = cut_lineage(peel(_differences(base), size, steps))
    done = found.filter("left = 0")
    while not (failed := found.filter("left > 0")).isEmpty():
        size *= GROWTH
        again = failed.select("k", "k2").distinct()
        retried = dealt.join(again, ["k", "k2"], "left_semi")
        wanted = failed.select("k", "k2", "pair")
        found = cut_lineage(peel(_differences(sketch_cells(retried, size)).join(
            wanted, ["k", "k2", "pair"], "left_semi"), size, steps))
        done = done.union(found.filter("left = 0"))
    differing = F.size("removed") + F.size("added")
    counts = done.groupBy("k", "k2").agg(
        *[F.sum(F.when(F.col("pair") == pair, differing).otherwise(0)).alias(name)
          for pair, name in enumerate(("d_edited", "d_next"))],
        *[F.first(F.when(F.col("pair") == 0, F.col(name)), ignorenulls=True).alias(name)
          for name in ("removed", "added")])

    def near(differing: str, other: str) -> Column:
        both = F.size("own") + F.size(other)
        return 1 - F.coalesce(F.col(differing), F.lit(0)) / both

    joined = dealt.join(prints, ["k", "k2"]).join(counts, ["k", "k2"], "left")
    return repeat_rows(joined, "copies").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        near("d_edited", "edited").alias("near_edited"), near("d_next", "next").alias("near_next"),
        *[F.coalesce(c, F.array().cast("array<bigint>")).alias(c) for c in ("removed", "added")])
