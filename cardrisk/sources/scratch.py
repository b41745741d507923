"""Intermediate tables under the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path


def materialize(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to a fresh path under the shared folder and scan it.

    For plans that read one input in several branches (rows, per-key
    statistics joined back, context rows of a time window, the gold join):
    each branch scans the written table with its own pruned columns instead
    of re-running the input's lineage (scan, explode, dedup shuffle) per
    branch, and a lost executor costs a re-read, not the whole chain. The
    table is deleted when the application ends (see ``session.scratch_path``).
    """
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
