"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import salt


def _is_forest_of_stars(edges: DataFrame) -> bool:
    """Whether every node hangs on one root and no root hangs on another node."""
    ends = edges.select("u", F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("v").alias("u"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    seen = ends.groupBy("u").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return seen.filter((F.col("hangs") > 1) | ((F.col("hangs") > 0) & (F.col("holds") > 0))).isEmpty()


def _with_least(edges: DataFrame) -> DataFrame:
    """The edges with the smallest v of their u (column m); a u that many edges share is dealt into pieces.

    A u's list of pieces is as long as there are pieces at most, so its minimum reaches them without a join.
    """
    dealt = edges.withColumn("piece", salt("v"))
    parts = dealt.groupBy("u", "piece").agg(F.min("v").alias("least"))
    back = parts.groupBy("u").agg(F.min("least").alias("m"), F.collect_list("piece").alias("pieces")).select("u", "m", F.explode("pieces").alias("piece"))
    return dealt.join(back, ["u", "piece"]).select("u", "v", "m")


def components(links: DataFrame) -> DataFrame:
    """u, root for every end of a link (columns a, b) but the roots: the smallest node that can be reached.

    Each round links every node with the smallest one that it sees; the rounds end when all edges lead
    straight to a root. Neither links nor components are gathered anywhere; every round is checkpointed.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct().checkpoint()
    while not _is_forest_of_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # an edge comes out once or more, never oftener than edges went in; the round's end makes them distinct
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        seen = _with_least(large)
        edges = (seen.select("u", F.col("m").alias("v")).unionByName(seen.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")))
                 .distinct().checkpoint())
    return edges.select("u", F.col("v").alias("root"))
