"""Connected components of an edge table, by alternating star rounds.

A round first ties every larger neighbour of a node to the node's smallest neighbour, then every smaller one; after a few
rounds each component is a star around its smallest node. Minima combine map-side and the joins split hot nodes, so a hub
with many edges meets no single task. Every round is a written table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martkit.llm.common import stage


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` for every node that has an edge to another; roots, the smallest nodes, are listed too."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct()
    e = stage(e, "edges")
    mark, before = _mark(e), None
    while mark[0] and mark != before:
        both = e.select(F.col("u").alias("x"), F.col("v").alias("y")).unionAll(e.select(F.col("v").alias("x"), F.col("u").alias("y")))
        low = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.join(low, "x").where("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(low, "u")
        small = met.select("u", F.col("m").alias("v")).unionAll(met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        e = stage(small.distinct(), "edges")
        before, mark = mark, _mark(e)
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
