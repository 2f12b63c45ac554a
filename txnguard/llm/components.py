"""Connected components over an edge table by alternating large and small stars.

Every round is two written tables in the shared folder; only the number of edges and a checksum reach the
driver. A hub's edges are met by a partially aggregated minimum and a join, never gathered in one group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import staged


def _state(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()


def _large_star(edges: DataFrame) -> DataFrame:
    """Each node's larger neighbours are linked to the least of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
    return (both.filter("b > a").join(least, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are linked to the least of these neighbours."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(least.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges`` (a, b): node, root (the least node reachable) for every node that has an edge to another.
    Null ends and loops are ignored; an empty table gives an empty one."""
    edges = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a != b").distinct(), "edges")
    state = _state(edges)
    for _ in range(max_rounds):
        if not state[0]:
            break
        edges = staged(_small_star(_large_star(edges)), "edges")
        new = _state(edges)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
