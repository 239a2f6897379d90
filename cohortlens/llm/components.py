"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import saved


def _least(edges: DataFrame) -> DataFrame:
    """u, m: the smallest of u and its neighbours (partial sums first, so hubs do no harm)."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def connected_components(edges: DataFrame, limit: int = 60) -> DataFrame:
    """node, root (smallest node reachable) for every node that has an edge.

    ``edges``: columns u, v of one orderable type, in any direction, repeats
    and loops allowed. Large-star hangs each node's larger neighbours on its
    smallest neighbour, small-star its smaller ones; both keep components.
    Each round is written to the shared folder. Raises after ``limit`` rounds.
    """
    e = edges.select("u", "v").filter("u != v")
    e = saved(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    state = None
    for _ in range(limit):
        # Large-star over both directions: (v, m(u)) for v > u.
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .filter("u != v").distinct()
        # Small-star over edges to smaller neighbours: (v, m(u)) for v <= u, and (u, m(u)).
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            least.select("u", F.col("m").alias("v"))).filter("u != v").distinct()
        e = saved(small, "cc")
        now = e.agg(F.count(F.lit(1)), F.countDistinct("u"), F.expr("bit_xor(xxhash64(u, v))")).first()
        # All stars: every node hangs on one root, and no root hangs on anything.
        if now == state or (now[0] == now[1] and e.join(e.select(F.col("v").alias("u")), "u", "left_semi").isEmpty()):
            return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state = now
    raise RuntimeError(f"components did not settle in {limit} rounds")
