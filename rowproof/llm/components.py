"""Connected components by alternating large and small stars, as joins and partial minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowproof.sources.staging import staged


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
        ).first()
    )


def components(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for all nodes of the edges (u, v).

    A round links every neighbour larger than a node to the node's smallest neighbour, and then every
    smaller one; after few rounds (about the logarithm of the longest path) each edge leads from a node
    to the smallest node of its component. Neighbours are never gathered: a node gets its minimum by a
    partial aggregate, its edges get it by a join. Edges are written after each round.
    """
    edges = staged(edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _fingerprint(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy(F.col("u").alias("m_u")).agg(F.least(F.min("u"), F.min("v")).alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("m_u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.distinct())
        least = large.groupBy(F.col("u").alias("m_u")).agg(F.min("v").alias("m"))
        linked = large.join(least, F.col("u") == F.col("m_u"))
        edges = staged(
            linked.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select(F.col("m_u").alias("u"), F.col("m").alias("v")))
            .distinct()
        )
        after = _fingerprint(edges)
        if after == before:
            break
        before = after
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return nodes.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
