"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import gc
import hashlib
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import hadoop_path

# Rows of a batch of texts that are worked on together. Spark bounds a batch by
# bytes (64 MB by default) and rows; what a worker makes of the texts is bounded by this.
ARROW_ROWS = 256


def pieces(batches: Iterator[pa.RecordBatch], rows: int = ARROW_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of so many rows (slices, not copies)."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Hand Python workers so many rows at a time in the jobs run inside; the setting is the session's again after."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sha256_hex(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


class Shared:
    """A broadcast value with a key by which workers can cache what they build from it."""

    def __init__(self, spark: SparkSession, value):
        self.key = uuid.uuid4().hex
        self.broadcast = spark.sparkContext.broadcast(value)

    @property
    def value(self):
        return self.broadcast.value


def texts_of(column: pa.Array) -> list[str]:
    """Python strings of an Arrow text column; null counts as the empty text."""
    return [t or "" for t in column.to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply, xor-shift), element-wise."""
    with np.errstate(over="ignore"):
        x = x * np.uint64(0x9E3779B97F4A7C15)
        x = x ^ (x >> np.uint64(32))
        x = x * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(29))


# ---- disk -----------------------------------------------------------------


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished jobs now.

    It acts when the driver's JVM has found their plans unreachable, otherwise
    at its next periodic collection, half an hour away by default.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(written: DataFrame) -> None:
    """Delete a table that this module wrote to the shared folder and has read for the last time."""
    for folder in {f.rpartition("/")[0] for f in written.inputFiles()}:
        fs, path = hadoop_path(written.sparkSession, folder)
        fs.delete(path, True)


# ---- tasks by rows --------------------------------------------------------

ROWS_PER_TASK = 25_000


def task_sized(df: DataFrame, n_rows: int, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` in no more tasks than its narrow rows need; large tables keep theirs."""
    return df.coalesce(max(1, -(-n_rows // rows_per_task)))


# ---- joins that no hot key can overload -----------------------------------

HOT_KEYS = 1024


def join_sized(rows: DataFrame, sized: DataFrame, key: str, n_rows: int, size: str = "n") -> DataFrame:
    """``rows`` inner-joined with ``sized``, which has one row per ``key`` and in
    ``size`` the number of rows of ``rows`` that have it.

    Keys with at least 1/HOT_KEYS of all ``n_rows`` rows -- there can be no more
    than HOT_KEYS of them, hence the broadcast -- are looked up where their rows
    are; all others go through a join on the key, where none is large.
    """
    least = max(2, -(-n_rows // HOT_KEYS))
    hot = F.broadcast(sized.filter(F.col(size) >= least).drop(size))
    cold = sized.filter(F.col(size) < least).drop(size)
    return rows.join(hot, key).unionByName(rows.join(hot.select(key), key, "left_anti").join(cold, key))
