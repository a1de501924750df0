"""Connected components by alternating large-star and small-star.

Every round is joins and partially aggregated minima over an edge table, so a
node with very many neighbours never has to sit in one task.  The edge table
of each round is written to the shared folder, which cuts the lineage; the one
before is then deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import deleted, stored


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("low"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Hook every larger neighbour of a node to the least node it knows."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = _minima(both).select("u", F.least("u", "low").alias("low"))
    return both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Hook a node and its smaller neighbours to the least of them (v < u)."""
    low = _minima(edges)
    joined = edges.join(low, "u").filter("v <> low").select(F.col("v").alias("u"), F.col("low").alias("v"))
    return joined.unionByName(low.select("u", F.col("low").alias("v"))).distinct()


def _mark(edges: DataFrame):
    """Row count and an order-free checksum; equal marks mean a fixed point."""
    return edges.agg(F.count(F.lit(1)).alias("n"),
                     F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()


def components(edges: DataFrame, a: str, b: str, max_rounds: int = 60) -> DataFrame:
    """``(node, component)`` for each node of an edge table; component is the
    smallest node reachable.  Self-loops and null ends are ignored, repeated
    edges count once, an empty table gives an empty result.
    """
    spark = edges.sparkSession
    edges, path = stored(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                   .filter(F.col(a).isNotNull() & F.col(b).isNotNull()).filter("u > v").distinct(), "edges")
    mark = _mark(edges)
    for _ in range(max_rounds):
        if not mark["n"]:
            break
        edges, after = stored(_small_star(_large_star(edges)), "edges")
        deleted(spark, path)
        path = after
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return (edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))
