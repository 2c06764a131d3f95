"""Connected components of links, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage


def _size(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; a component is named by its smallest node.

    Each step points nodes to the smallest node among their neighbours and is stored; steps end when
    nothing changes, after a number of steps that grows with the logarithm of a component's length.
    Links to itself leave a node alone. Runs jobs.
    """
    edges = cut_lineage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    before = _size(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut_lineage(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        after = _size(edges)
        if after == before:
            break
        before = after
    named = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return named.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
