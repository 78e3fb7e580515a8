"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.common import stored


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node that can be reached.

    Alternates the large-star and small-star steps: every round points the neighbours of a node at the smallest of
    them, so the number of rounds grows with the logarithm of the graph, not with its diameter. Each round is written
    to the shared folder, which cuts the lineage. Self-links, repeated and reversed links change nothing; links
    with a null end are ignored. A node without a link has no row.
    """
    a, b = F.col("a"), F.col("b")
    edges = links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges = stored(spark, edges, "links")
    before = _mark(edges)
    while before[0]:
        edges = stored(spark, _small_star(_large_star(edges)), "links")
        after = _mark(edges)
        if after == before:
            break
        before = after
    members = edges.select(a.alias("node"), b.alias("root"))
    return members.unionByName(members.select(F.col("root").alias("node"), "root").distinct())


def _mark(edges: DataFrame) -> tuple[int, int | None]:
    """The number of edges and an order-free checksum."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.xxhash64("b", "a").bitwiseAND(0xFFFFFF))).first()
    return tuple(row)


def _large_star(edges: DataFrame) -> DataFrame:
    """Points the larger neighbours of each node at the smallest of its neighbours and itself."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("least")).select("a", F.least("a", "least").alias("least"))
    pointed = both.join(least, "a").where(F.col("b") > F.col("a"))
    return pointed.select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Points each node and its smaller neighbours at the smallest of these."""
    least = edges.groupBy("a").agg(F.min("b").alias("least"))
    others = edges.join(least, "a").where(F.col("b") != F.col("least")).select(F.col("b").alias("a"), F.col("least").alias("b"))
    return least.select("a", F.col("least").alias("b")).unionByName(others).distinct()
