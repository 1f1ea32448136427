"""Connected groups of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isobar.llm.staging import staged


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; the root is the smallest node of its group.

    Alternates two steps until nothing changes: every node's larger neighbours go to its smallest one, then its smaller
    neighbours do. Each step is one minimum per node and one join; the number of links does not grow.
    """
    edges = staged(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a < b").distinct(), "links")
    before = None
    while True:
        both = _both(edges)
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b"), F.col("m").alias("a")).filter("a < b").distinct()
        large = staged(large.select("a", "b"), "links")
        # Now a < b for each link: the smaller neighbours of b go to its smallest.
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(F.col("a").alias("x"), "m").filter("m < x").select(F.col("m").alias("a"), F.col("x").alias("b"))
        edges = staged(small.unionAll(least.select(F.col("m").alias("a"), "b")).distinct(), "links")
        after = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.unionAll(edges.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
