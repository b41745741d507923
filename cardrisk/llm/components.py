"""Connected components of a graph given as a table of links.

Alternating large-star and small-star rounds: each round points every node's
larger neighbours, then its smaller ones, at the smallest node it sees, until
the links are stars around the smallest node of each component (a number of
rounds logarithmic in the diameter). Rounds are written to the shared folder,
so a lost executor costs a re-read; only a count and a checksum reach the
driver. Rounds work on far fewer rows than the tables they come from, so their
tasks are sized by rows rather than by the session's shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .common import join_sized, task_sized


def _star(spark: SparkSession, links: DataFrame, n: int) -> DataFrame:
    """(u, v, m): every link (u, v) with the smallest of u and its neighbours."""
    least = links.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
    least = materialize(spark, task_sized(least.select("u", F.least("u", "m").alias("m"), "n"), n), "links-least")
    return task_sized(join_sized(links, least, "u", n), n)


def components(spark: SparkSession, links: DataFrame) -> DataFrame:
    """(node, root) for every node that occurs in ``links`` (u, v); root is the component's smallest node.

    Links may repeat, run in either direction, or be loops (which are left out).
    """
    links = links.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links = materialize(spark, links, "links")
    seen = None
    while True:
        state = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen or not state[0]:
            return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        seen = tuple(state)
        n = seen[0]
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(spark, both, 2 * n).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(spark, task_sized(large.distinct(), n), "links")
        small = _star(spark, large, n)
        links = small.select("u", F.col("m").alias("v")).unionByName(
            small.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        links = materialize(spark, task_sized(links.distinct(), n), "links")
