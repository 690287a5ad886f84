"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premia.session import drop, materialize


def _are_stars(edges: DataFrame) -> bool:
    """Does every u of ``edges`` have one v, which is no u itself?"""
    up, down = F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    ends = edges.select(F.inline(F.array(up, down))).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return not ends.agg(F.max(F.expr("up > 1 or (up = 1 and down = 1)"))).first()[0]


def stars(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Written ``(u, v)`` for every node of an edge but the smallest of its component, which is v; see `components`.

    Each round is written under the shared folder and takes the place of the one before; there is none if the edges are stars already.
    """
    cur = materialize(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    while not _are_stars(cur):
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = cur.select(F.col("v").alias("u"), F.col("u").alias("v")).join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        before, cur = cur, materialize(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        drop(before)
    return cur


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``(node, component)`` for every node of an edge that joins two different nodes; component is its smallest node.

    ``a`` and ``b`` are columns of one orderable type; edges may repeat and point either way; nulls are no nodes.
    A node's neighbours never meet in one task: a star only needs
    the smallest neighbour, which is combined map-side, and one join back, which Spark may split.
    """
    cur = stars(edges, a, b)
    return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
