"""Connected components of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmeter.llm.common import written


def _least(edges: DataFrame) -> DataFrame:
    """The least of each node and its neighbours; counted before the shuffle, so hubs don't matter."""
    return edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def components(links: DataFrame) -> DataFrame:
    """item and component, the least item that links lead to, of all items with a link.

    Links have columns a and b. Every round joins each edge with the least neighbour of one
    end; neighbour lists are never collected. A round is a table in the shared folder. The
    rounds end when all edges lead to a node without a smaller neighbour, after about the
    logarithm of the longest path.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = written(edges, "edges")
    while True:
        both = _both(edges)
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        lower = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = _least(lower)
        small = lower.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        small = written(small, "edges")
        same = edges.join(small, ["u", "v"], "left_semi").count()
        if same == edges.count() == small.count():
            break
        edges = small
    return small.select(F.col("u").alias("item"), F.col("v").alias("component")).unionByName(
        small.select(F.col("v").alias("item"), F.col("v").alias("component")).distinct()
    )
