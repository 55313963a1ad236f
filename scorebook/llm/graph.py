"""Connected components of an edge list, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorebook.llm.frames import stage


def _with_min(pairs: DataFrame) -> DataFrame:
    """u, v, m: each pair with the smallest v of its u (a partial aggregate; a hot u is split by the skew join)."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return (_with_min(both).where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """`edges` has u > v."""
    found = _with_min(edges)
    return (found.where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(found.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node reachable) of every node with an edge; `edges` has columns a, b.

    Each round writes its edges to the checkpoint folder, so the lineage stays short. The rounds end when no edge
    leads to the larger end of another, that is, all components are stars; their number grows with the logarithm of a
    component's size."""
    now = stage(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                .distinct(), "edges")
    while not now.join(now.select(F.col("v").alias("u")), "u", "left_semi").isEmpty() or _many_centres(now):
        now = stage(_small_star(_large_star(now)), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _many_centres(edges: DataFrame) -> bool:
    """Whether a node has two smaller neighbours."""
    return not edges.groupBy("u").count().where("count > 1").isEmpty()
