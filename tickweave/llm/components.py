"""Connected components of links, by alternating large and small stars.

In a large star every node ties its larger neighbours to the least node it sees; in a small star
it ties its smaller ones and itself. Repeated, every component becomes one star around its least
node, after a number of rounds that grows with the logarithm of its size. A round is two
aggregations and two equality joins in which one side has one row per node, so a hub with very
many links is split like any skewed join. Each round is landed, and the round before deleted."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import drop_landed, land


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(
        edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("b").agg(F.min("a").alias("m"))
    tied = edges.join(least, "b").where("a <> m").select(F.col("m").alias("x"), F.col("a").alias("y"))
    own = least.select(F.col("m").alias("x"), F.col("b").alias("y"))
    return tied.union(own).select("x", "y").distinct().toDF("a", "b")


def stars(pairs: DataFrame) -> DataFrame:
    """Landed edges (a, b): each node b of a component but the least, tied to the least, a."""
    edges = land(pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                 .distinct(), "edges")
    seen = None
    while True:
        mark = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("h")).first()
        if mark == seen or not mark["n"]:
            return edges
        seen, before = mark, edges
        edges = land(_small_star(_large_star(edges)), "edges")
        drop_landed(before)


def connected_components(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Columns node, root and label: for each row of `nodes` (node unique, label) the least node and
    the least label in its component over `pairs` (a, b)."""
    tied = stars(pairs)
    member = tied.select(F.col("b").alias("node"), F.col("a").alias("root")).union(
        tied.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
    member = land(member, "members")
    least = member.join(nodes, "node").groupBy("root").agg(F.min("label").alias("least"))
    named = member.join(least, "root")
    return nodes.join(named, "node", "left").select(
        "node", F.coalesce("root", "node").alias("root"), F.coalesce("least", "label").alias("label"))
