"""Connected components of a link table, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .staging import stage


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One large-star (or small-star) step: hang neighbours below the smallest one.

    Edges have a > b.  A large-star step can repeat edges, never more than it is given.
    """
    a, b, m = F.col("a"), F.col("b"), F.col("m")
    around = edges.select(F.inline(F.array(F.struct(a, b), F.struct(b.alias("a"), a.alias("b"))))) if larger else edges
    lowest = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
    joined = around.join(lowest, "a")
    if larger:
        return joined.filter("b > a").select(b.alias("a"), m.alias("b"))
    return (joined.select(F.inline(F.array(F.struct(b.alias("a"), m.alias("b")), F.struct(a, m.alias("b")))))
            .filter("a <> b").distinct())


def _settled(edges: DataFrame) -> bool:
    """Whether every node either hangs below one other or has nodes below it: stars, each around its smallest node."""
    ends = edges.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")),
                                         F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.count("*").alias("edges")).filter(
        "up > 0 and edges > 1").count() == 0


def component_stars(edges: DataFrame) -> DataFrame:
    """Root (smallest node) of every other node of a component, as a staged table (node, root).

    ``edges`` as for ``connected_components``.
    """
    edges = stage(edges.dropna(subset=["a", "b"]).filter("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")), "edges")
    while not _settled(edges):
        edges = stage(_star(_star(edges, larger=True), larger=False), "edges")
    return edges.toDF("node", "root")


def connected_components(edges: DataFrame) -> DataFrame:
    """Root (smallest node) of every node that has an edge.

    ``edges`` has two long columns ``a`` and ``b``, ``a <> b``; null ends are
    ignored, repeated and reversed edges are harmless, no edges give no rows.
    Alternates large-star and small-star steps until only stars are left; each
    result is a staged table, and the state never leaves the executors.  Returns
    (node, root).
    """
    stars = component_stars(edges)
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
