"""Near-duplicate embeddings by int8 tile products with error bounds.

Equal vectors are collapsed first.  The distinct vectors are dealt into tiles
by a hash of their id, and every pair of tiles is one Spark group.  Inside a
group the unit vectors are quantised to int8 with one step size per tile; the
exact length of each vector's quantisation error is kept.  For unit vectors
x = X + e, y = Y + f (X, Y the dequantised ones):

    x.y = X.Y + X.f + e.y  <=  X.Y + |X||f| + |e|

so a pair whose quantised product plus that bound stays below the threshold
cannot reach it.  All other pairs are recomputed in double precision from the
given components.  A group returns each vector's number of links and a
spanning forest of the links, never the pairs themselves.

Cost: all tile pairs are multiplied, which is quadratic in the number of
distinct vectors (about 2 * dims * n^2 / 2 float operations at BLAS speed);
shuffled data is n * (n / tile_rows) * 4 * dims bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratesmith.llm.components import connected_components
from ratesmith.llm.forest import join_links
from ratesmith.session import cut_lineage

#: Vectors a tile holds on average: two tiles of 64 floats take 4 MB.
TILE_ROWS = 8192
#: Pairs recomputed at a time, and rows multiplied at a time.
RECHECK_PAIRS, PANEL_ROWS = 1 << 16, 512
#: Room for float32 rounding in a quantised product, per term of the sum
#: (twice the unit roundoff; the terms' absolute sum is about 1 at most).
SLACK_PER_TERM = 1.2e-7
LEVELS = 127


def quantise(unit: np.ndarray) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """int8 codes, step, and per vector the error's length and the code's length."""
    step = float(np.abs(unit).max(initial=0.0)) / LEVELS or 1.0
    codes = np.rint(unit / step).astype(np.int8)
    back = codes.astype(np.float64) * step
    return codes, step, np.linalg.norm(unit - back, axis=1), np.linalg.norm(back, axis=1)


def _candidates(xu: np.ndarray, yu: np.ndarray, threshold: float, same: bool
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of two tiles that may reach the threshold, panel by panel."""
    xq, xs, xerr, _ = quantise(xu)
    yq, ys, yerr, ylen = quantise(yu)
    # x.y <= X.Y + |Y||e| + |f|; the bound's two parts ride along as columns
    width = xq.shape[1]
    scale = xs * ys
    yt = np.concatenate([yq.astype(np.float32),
                         np.full((len(yq), 1), ylen.max(initial=0.0), np.float32),
                         (yerr / scale).astype(np.float32)[:, None]], axis=1).T.copy()
    least = np.float32((threshold - SLACK_PER_TERM * (width + 2)) / scale)
    for at in range(0, len(xq), PANEL_ROWS):
        panel = xq[at:at + PANEL_ROWS].astype(np.float32)
        err = (xerr[at:at + PANEL_ROWS] / scale).astype(np.float32)[:, None]
        panel = np.concatenate([panel, err, np.ones_like(err)], axis=1)
        # rows of the same tile meet the later columns only
        low = at + 1 if same else 0
        i, j = np.nonzero(panel @ yt[:, low:] >= least)
        i, j = i + at, j + low
        if same:
            i, j = i[j > i], j[j > i]
        for k in range(0, len(i), RECHECK_PAIRS):
            yield i[k:k + RECHECK_PAIRS], j[k:k + RECHECK_PAIRS]


def tile_links(x: np.ndarray, nx: np.ndarray, y: np.ndarray | None, ny: np.ndarray | None,
               threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of one tile (y None) or between two tiles.

    x, y: float64 rows; nx, ny: how many equal vectors a row stands for.
    Returns, for the rows of x followed by those of y, the number of vectors
    linked and the index of the set that the row belongs to.
    """
    same = y is None
    rows = x if same else np.concatenate([x, y])
    copies = nx if same else np.concatenate([nx, ny])
    length = np.linalg.norm(rows, axis=1)
    unit = rows / length[:, None]
    first = 0 if same else len(x)
    count = np.zeros(len(rows), np.int64)
    label = np.arange(len(rows))
    for i, j in _candidates(unit[:len(x)], unit[first:], threshold, same):
        j = j + first
        cos = np.einsum("ij,ij->i", rows[i], rows[j]) / (length[i] * length[j])
        i, j = i[cos >= threshold], j[cos >= threshold]
        np.add.at(count, i, copies[j])
        np.add.at(count, j, copies[i])
        join_links(label, i, j)
    return count, label


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False)
                             for c in (flat.chunks if isinstance(flat, pa.ChunkedArray) else [flat])])
    return values.astype(np.float64).reshape(len(column), -1)


def near_duplicate_vectors(vectors: DataFrame, id_col: str = "vec_id",
                           vector_col: str = "embedding", threshold: float = 0.95,
                           tile_rows: int = TILE_ROWS) -> DataFrame:
    """Return vec_id, n_links, component_id, kept: one row per input row.

    Vectors that are null, empty, zero, or hold a null or non-finite component
    link with nothing: n_links 0, component_id their own id, kept true.
    Vectors of different lengths never link.  Every row counts as a vector, so
    a repeated row links with its copies; a null id takes part like any other
    and is skipped in the smallest id of a component that has others.  Other
    columns are ignored.  An empty table gives an empty result.
    """
    base = vectors.select(F.col(id_col).alias("vec_id"),
                          F.col(vector_col).alias("v"))
    finite = ~F.exists("v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = F.coalesce(F.col("v").isNotNull() & finite
                        & F.exists("v", lambda c: c != 0), F.lit(False))
    good = base.filter(usable)

    classes = cut_lineage(
        good.groupBy("v").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
        .withColumn("rep", F.monotonically_increasing_id())
        .withColumn("dims", F.size("v")))
    tiles = max(1, -(-classes.count() // tile_rows))
    dealt = classes.withColumn("tile", F.pmod(F.xxhash64("rep"), F.lit(tiles)).cast("int"))
    cells = dealt.select("rep", "copies", "dims", "tile", "v", F.explode(
        F.sequence(F.lit(0), F.lit(tiles - 1))).alias("other"))
    cells = cells.select("rep", "copies", "dims", "tile", "v",
                         F.least("tile", "other").alias("ti"),
                         F.greatest("tile", "other").alias("tj"))

    def links(group: pa.Table) -> pa.Table:
        tile, ti = group["tile"].to_numpy(), group["ti"][0].as_py()
        rep, copies = group["rep"].to_numpy(), group["copies"].to_numpy()
        if group["tj"][0].as_py() == ti:
            order = np.arange(len(rep))
            rows = _matrix(group["v"])
            count, label = tile_links(rows, copies, None, None, threshold)
        else:
            order = np.argsort(tile != ti, kind="stable")
            cut = int((tile == ti).sum())
            rows = _matrix(group["v"])[order]
            counts = copies[order]
            count, label = tile_links(rows[:cut], counts[:cut], rows[cut:], counts[cut:], threshold)
        rep = rep[order]
        has = count > 0
        return pa.table({"rep": rep[has], "links": count[has], "root": rep[label[has]]})

    found = cut_lineage(cells.groupBy("dims", "ti", "tj").applyInArrow(
        links, "rep long, links long, root long"))
    comp = connected_components(found, "rep", "root")
    members = (classes.select("rep", "low", "copies")
               .join(found.groupBy("rep").agg(F.sum("links").alias("links")), "rep", "left")
               .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
               .withColumn("root", F.coalesce("root", "rep")))
    smallest = members.groupBy("root").agg(F.min("low").alias("component_id"))
    known = (members.join(smallest, "root")
             .select("rep", "component_id",
                     (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    by_vector = classes.select("rep", "v").join(known, "rep").drop("rep")
    linked = good.join(by_vector, "v").select("vec_id", "n_links", "component_id")
    alone = base.filter(~usable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
