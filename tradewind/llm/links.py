"""Connected components of link tables, without collecting links anywhere."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradewind.llm.common import discard, stored


def _all_stars(edges: DataFrame) -> bool:
    """Whether each ``u`` has one ``v`` and none is a ``v`` itself, so that ``v``, the smaller one, is its root."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("leaf"), F.lit(0).alias("centre")).union(
        edges.select("v", F.lit(0), F.lit(1)))
    ends = ends.groupBy("node").agg(F.sum("leaf").alias("leaf"), F.max("centre").alias("centre"))
    return ends.filter("leaf > 1 or (leaf > 0 and centre > 0)").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (longs a, b): root is the smallest node it reaches.

    Large-star and small-star steps in turn. A star whose centre is its least node is kept as it is, so a
    centre with very many links is joined to nothing; the minima are stored, so that other joins can be split.
    """
    edges = stored(links.filter("a <> b").select(
        F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    ).distinct(), "edges")
    while not _all_stars(edges):
        # Large star: larger neighbours of u go to the least node around u.
        around = stored(edges.groupBy("u").agg(F.min("v").alias("m")), "least")
        least = around.withColumnRenamed("u", "w")
        outward = edges.select(F.col("v").alias("centre"), F.col("u").alias("leaf"))
        large = stored(outward.join(least, outward["centre"] == least["w"], "left").select(
            F.col("leaf").alias("u"), F.coalesce("m", "centre").alias("v")
        ).distinct(), "large")
        discard(edges, around)
        # Small star: smaller neighbours of u, and u itself, go to the least of them.
        around = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        least = around.withColumnRenamed("u", "w")
        inward = large.join(least, large["u"] == least["w"])
        moved = inward.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.union(least.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct(), "edges")
        discard(large, around)
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("node", F.col("node").alias("root")))
