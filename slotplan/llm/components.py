"""Connected components of an edge table by alternating stars.

Every round hangs the larger neighbours of each node on its smallest neighbour
(large star), then the smaller ones (small star). The edge count never grows and
the rounds grow with the logarithm of the node count. Minima are aggregated before
the shuffle and written as a table of known size, so a node with very many edges
is a join key that Spark can split, never a group in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import settled


#: edges that one task may well hold; small tables are not spread over more tasks than they need
EDGES_A_TASK = 50_000


def _star(pairs: DataFrame, keep: str, tasks: int) -> DataFrame:
    """(u, v) pairs -> (v, m): each kept neighbour v of u with the minimum m of u's closed neighbourhood."""
    least = settled(pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")).coalesce(tasks), "star-min")
    return (pairs.join(least, "u").where(keep).select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks)
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where("u <> v").distinct().coalesce(tasks))


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges``: a, b. Result: node, root (the smallest node of its component).

    Nodes without an edge do not appear; loops and repeated edges are harmless.
    """
    now = settled(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    tasks = max(now.sparkSession.sparkContext.defaultParallelism, now.count() // EDGES_A_TASK)
    last = None
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = settled(_star(both, "v > u", tasks), "star-large")
        now = settled(_star(large, "true", tasks), "star-small")      # every edge points to a smaller node
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("root"))).distinct()
        last = state
    raise RuntimeError("components did not settle")
