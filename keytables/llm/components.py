"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keytables.sources.scratch import write_scratch


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for each node of ``edges`` (``a``, ``b``) that is not the smallest of its component.

    The component is named by its smallest node. Edges may repeat, be given in either direction or join a
    node to itself; edges with a null end are left out; without edges the result is empty.

    Large-star hangs every larger neighbour of a node on the smallest one around it, small-star does so
    with the smaller neighbours; both keep components whole, and in the end each component is one star. Every
    step groups by node with a partial minimum and joins the minimum back, so a node with very many
    edges is a join key with many rows, which adaptive execution divides. Each step's result is a
    written table. Two numbers per round reach the driver.
    """
    u, v = F.col(a), F.col(b)
    edges = edges.where(u.isNotNull() & v.isNotNull() & (u != v))
    edges = edges.select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()
    edges, seen = _written(edges)
    while seen[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = write_scratch(both.groupBy("u").agg(F.min("v").alias("m")), "components-least")
        least = least.select("u", F.least("u", "m").alias("m"))
        large = both.join(least, on="u").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = write_scratch(large.distinct(), "components-large")
        least = write_scratch(large.groupBy("u").agg(F.min("v").alias("m")), "components-small")
        small = large.join(least, on="u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges, now = _written(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    edges = write_scratch(edges, "components-edges")
    digest = F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))
    return edges, tuple(edges.agg(F.count(F.lit(1)), digest).first())
