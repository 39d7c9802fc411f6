"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """``node, root`` for every node of ``edges (a, b)``; the root is the smallest node reachable.

    Alternates large-star and small-star steps until every node hangs on its root. Each step is a
    minimum per node, combined before its shuffle, and a join that adaptive execution can split, so a
    node with very many links never has to fit one task. Every round is a written table.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct()
    links, seen = staged(links, name), None
    for _ in range(rounds):
        mark = links.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if mark == seen or not mark[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                links.select("v", "v").distinct()
            )
        seen = mark
        both = links.union(links.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e")
        )
        links = staged(small.select("e.u", F.col("e.m").alias("v")).where("u > v").distinct(), name)
    raise RuntimeError(f"no convergence in {rounds} rounds")
