"""Connected components of an edge table: alternating large-star and small-star joins.

Each star step takes every node's smallest neighbour as a partial aggregate and joins it
back, so a node with a great many neighbours is summed map-side and its rows can be split
by the adaptive skew join.  Rounds are cut by tables in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from promoflow.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    low = e.groupBy("u").agg(F.min("v").alias("m"))
    moved = e.join(low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node that has an edge; ``root`` is the smallest node of its
    component.  ``edges`` has two BIGINT columns; repeated edges, both directions and loops
    are allowed, edges with a null end are dropped.  An empty table gives an empty table.
    """
    a, b = edges.columns[:2]
    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))).distinct())
    e = written(e, "edges")
    before = None
    for _ in range(max_rounds):
        e = written(_small_star(_large_star(e).distinct()).distinct(), "stars")
        n, h = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if before == (n, h):
            break
        before = (n, h)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
