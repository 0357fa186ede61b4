"""Connected components of an edge table, by repeated contraction to the smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def smallest_reachable(edges: DataFrame) -> DataFrame | None:
    """(node, root): root is the smallest node reachable from node; None without edges.

    ``edges`` has the long columns u and v. In each round every node points to
    its smallest neighbour (a partial aggregate, so a hub costs one row per
    task), pointers are followed twice, and the edges are rewritten to the
    roots; edges inside a root vanish. Roots only fall, so the last root is
    the smallest node. Rounds grow with the logarithm of the longest path.
    All links stay in tables; the driver sees counts only.
    """
    edges = stored(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        step = both.groupBy("u").agg(F.min("v").alias("v")).select(F.col("u").alias("node"), F.least("u", "v").alias("root"))
        step = stored(step, "pointers")
        for _ in range(2):  # node -> root -> root's root; a root that points to itself stays
            ahead = step.select(F.col("node").alias("root"), F.col("root").alias("ahead"))
            step = step.join(ahead, "root", "left").select("node", F.coalesce("ahead", "root").alias("root"))
        step = stored(step, "pointers")
        if roots is None:
            roots = step
        else:
            moved = step.select(F.col("node").alias("root"), F.col("root").alias("next"))
            joined = roots.join(moved, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
            # roots of this round that no earlier round knew can't occur: contracted edges join old roots only
            roots = stored(joined, "roots")
        at_u = step.select(F.col("node").alias("u"), F.col("root").alias("ru"))
        at_v = step.select(F.col("node").alias("v"), F.col("root").alias("rv"))
        edges = (
            edges.join(at_u, "u").join(at_v, "v").where("ru <> rv")
            .select(F.greatest("ru", "rv").alias("u"), F.least("ru", "rv").alias("v")).distinct()
        )
        edges = stored(edges, "edges")
    return roots
