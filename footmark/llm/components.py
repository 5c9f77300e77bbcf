"""Connected components of an edge table, in Spark, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from footmark.llm.common import cut


def _star(pairs: DataFrame, larger_only: bool) -> DataFrame:
    """pairs(u, v): connect the neighbours of each u (for the large star those above u) to the
    smallest of u and its neighbours. The minima are written first, so that adaptive execution
    can split a hot u in the join that follows."""
    least = cut(pairs.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "star")
    out = pairs.join(least, "u")
    if larger_only:
        out = out.filter("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))
    else:
        out = out.select(F.col("v").alias("hi"), F.col("m").alias("lo")) \
            .union(least.select(F.col("u").alias("hi"), F.col("m").alias("lo")))
    return out.filter("hi <> lo").distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of ``edges``; component is the smallest node reachable.

    Every step is a join or an aggregation over the edges; the driver sees two numbers a step.
    Null ends and loops are ignored (a node that has only loops isn't returned)."""
    e = cut(edges.select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo"))
            .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct(), "edges")

    def state(df):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo") % 1000003)).first())

    seen = state(e)
    while seen[0]:
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")) \
            .union(e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        large = _star(both, larger_only=True)
        e = cut(_star(cut(large, "large").select(F.col("hi").alias("u"), F.col("lo").alias("v")),
                      larger_only=False), "edges")
        now = state(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")) \
        .union(e.select(F.col("lo").alias("node"), F.col("lo").alias("component"))).distinct()
