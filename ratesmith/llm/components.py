"""Connected components of a link table, by repeated contraction.

Links are hooked to their smallest neighbour, the resulting trees are
flattened by pointer jumping, and the link table is rewritten in terms of the
tree roots until no link is left.  Every table stays distributed; only row
counts reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratesmith.session import cut_lineage


def _flatten(parents: DataFrame) -> DataFrame:
    """Replace every parent by its tree's root (parents: node, root)."""
    while True:
        up = parents.select(F.col("node").alias("root"), F.col("root").alias("up"))
        jumped = cut_lineage(
            parents.join(up, "root", "left")
            .select("node", F.coalesce("up", "root").alias("root"),
                    (F.coalesce("up", "root") != F.col("root")).alias("moved")))
        if jumped.filter("moved").isEmpty():
            return jumped.select("node", "root")
        parents = jumped.select("node", "root")


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Return (node, root) for every node with a link to another node.

    ``links`` holds undirected links; repeated links, both directions and
    self links are allowed, links with a null end are ignored.  ``root`` is
    one node of the component, the same for all its members (not necessarily
    the smallest).  No links: an empty table.
    """
    def both(df: DataFrame) -> DataFrame:
        kept = df.filter(F.col("u") != F.col("v"))
        return kept.union(kept.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct()

    edges = cut_lineage(both(links.select(F.col(a).alias("u"), F.col(b).alias("v"))))
    roots = None
    while not edges.isEmpty():
        # v is a neighbour of u; a node smaller than all neighbours stays root
        hooks = edges.groupBy("u").agg(F.min("v").alias("v")).select(
            F.col("u").alias("node"), F.least("u", "v").alias("root"))
        step = _flatten(cut_lineage(hooks))
        if roots is None:
            roots = step
        else:
            nxt = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
            roots = cut_lineage(roots.join(nxt, "root", "left")
                                .select("node", F.coalesce("up", "root").alias("root")))
        ends = step.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        moved = edges.join(ends, "u").select("v", "ru")
        ends = step.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        edges = cut_lineage(both(moved.join(ends, "v").select(
            F.col("ru").alias("u"), F.col("rv").alias("v"))))
    if roots is None:
        return links.select(F.col(a).alias("node"), F.col(a).alias("root")).limit(0)
    return roots
