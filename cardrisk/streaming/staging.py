"""Stage raw deliveries as time-ordered files for the file stream source.

A stand-in for a broker in tests and catalogue runs: the raw records
(payload + source metadata) derived from ``events`` are cut into slices by
delivery time and each slice is appended as its own set of files, so the
file source (oldest first) replays them in order. Every slice is written by
as many tasks as the cluster has cores, as exactly ``files_per_slice``
files; reading with ``maxFilesPerTrigger = files_per_slice`` makes one slice
one micro-batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..config import MICROS_PER_DAY
from ..functions.columns import epoch_micros
from ..session import hadoop_path, scratch_path


def _time(order):
    return epoch_micros(order if order is not None else F.col("kafka_ingest_time"))


def _bounds(raw: DataFrame, order=None) -> tuple[int, int]:
    r = raw.agg(F.min(_time(order)).alias("lo"), F.max(_time(order)).alias("hi")).first()
    return r["lo"], r["hi"]


def _slices(lo: int | None, hi: int | None, days: int | None, aligned: bool) -> int:
    return 1 if days is None or lo is None else (hi - _first(lo, days, aligned)) // (days * MICROS_PER_DAY) + 1


def _first(lo: int | None, days: int | None, aligned: bool) -> int | None:
    """Where the first slice begins: at the first delivery, or at the whole span of days it falls into."""
    return lo // (days * MICROS_PER_DAY) * days * MICROS_PER_DAY if aligned and days and lo is not None else lo


def slice_count(raw: DataFrame, days: int | None, order=None, aligned: bool = False) -> int:
    """Slices of ``days`` each that the deliveries span (one for None)."""
    return _slices(*_bounds(raw, order), days, aligned)


def event_order():
    """Slice by the event time carried in the payload (delivery time when
    the payload has none), so that each card's rows arrive in event order."""
    ts = F.try_to_timestamp(F.get_json_object("value", "$.timestamp")).cast("timestamp_ntz")
    return F.coalesce(ts, F.col("kafka_ingest_time"))


def data_files(spark: SparkSession, path: str) -> int:
    """Number of data files under ``path`` (a metadata listing on the driver)."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return 0
    return sum(1 for s in fs.listStatus(p) if s.isFile() and not s.getPath().getName().startswith(("_", ".")))


def stage(raw: DataFrame, path: str, days: int | None, only: range | None = None, order=None,
          files_per_slice: int | None = None, aligned: bool = False) -> int:
    """Append slices of ``days`` each (all, or the ``only`` range; None: one
    slice of everything) to ``path`` in time order; ``aligned`` ones begin at whole spans since 1970.

    Returns the number of files per slice, the ``maxFilesPerTrigger`` that
    reads one slice per micro-batch. The records are derived once, by a write
    with their time into folders of whole spans; the bounds are read off that
    time, and each slice is copied from the one or two folders that it meets. A
    slice with fewer rows than files gets the rest as empty files.
    """
    spark = raw.sparkSession
    f = files_per_slice or spark.sparkContext.defaultParallelism
    by_span = scratch_path(spark, "slices")
    width = None if days is None else days * MICROS_PER_DAY
    span = F.lit(0) if width is None else F.floor(F.col("_t") / F.lit(width))
    raw.withColumn("_t", _time(order)).withColumn("_span", span.cast("int")).write.partitionBy("_span").parquet(by_span)
    rows = spark.read.schema(StructType([*raw.schema, StructField("_t", LongType())]))
    lo, hi = rows.parquet(by_span).agg(F.min("_t"), F.max("_t")).first()
    first = _first(lo, days, aligned)
    for i in (only if only is not None else range(_slices(lo, hi, days, aligned))):
        before = data_files(spark, path)
        for part in _slice(spark, rows, by_span, None if first is None or width is None else first + i * width, width):
            part.select(*raw.columns).repartition(f).write.mode("append").parquet(path)
        missing = f - (data_files(spark, path) - before)
        if missing:
            _empty_files(spark, raw, path, missing)
    return f


def _slice(spark: SparkSession, rows: DataFrameReader, by_span: str, start: int | None, width: int | None) -> list[DataFrame]:
    """The staged rows of the slice from ``start`` on (all, without a width), as one frame; none if it has no folder."""
    spans = [0] if width is None else [] if start is None else sorted({start // width, (start + width - 1) // width})
    folders = [d for n in spans if (p := hadoop_path(spark, d := f"{by_span}/_span={n}"))[0].exists(p[1])]
    if not folders:
        return []
    part = rows.parquet(*folders)
    return [part if width is None else part.filter(F.col("_t").between(start, start + width - 1))]


def _empty_files(spark: SparkSession, raw: DataFrame, path: str, n: int) -> None:
    """Append ``n`` files without rows: one is written, the others are copies of it."""
    one = scratch_path(spark, "empty")
    spark.createDataFrame([], raw.schema).write.parquet(one)
    fs, folder = hadoop_path(spark, one)
    (source,) = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-")]
    copy, conf = spark.sparkContext._jvm.org.apache.hadoop.fs.FileUtil.copy, spark.sparkContext._jsc.hadoopConfiguration()
    for _ in range(n):
        to_fs, to = hadoop_path(spark, f"{path}/part-{uuid.uuid4().hex}.parquet")
        copy(fs, source, to_fs, to, False, conf)
