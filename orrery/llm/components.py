"""Connected components by alternating large-star and small-star contraction.

Each round is two aggregations and two joins over the edge table, and is
written to the shared folder, so neither lineage nor driver state grows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import materialise


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return (
        both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = down.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def connected(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(u, root): every vertex of ``edges`` (u, v) that is not its own root.

    The root is the smallest vertex of the component. Self-loops and repeated
    edges are allowed. An empty edge table gives an empty result.
    """
    now = materialise(edges.select("u", "v").where("u <> v").distinct(), "edges")
    seen = None
    for k in range(max_rounds):
        now = materialise(_small_star(_large_star(now)), f"star-{k}")
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            return now.select("u", F.col("v").alias("root"))
        seen = mark
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")
