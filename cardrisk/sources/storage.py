"""Layer storage (IO6-IO10), parquet by default.

* ``write_layer`` / ``read_layer`` -- full-refresh tables (IO9) and scans
  (IO6); layers with ``tx_date`` are partitioned by it so date filters prune
  files. ``fmt`` names the table format.
* ``append_new`` -- incremental append above a high-water mark (IO7).
* ``merge_version`` -- keyed upsert (IO8) without MERGE. A version of a layer
  with ``tx_date`` is a manifest: the folder of every date. A merge writes the
  dates that incoming rows belong to, or replaced rows lived in, into folders
  of its own and lists the other dates where they are; then a one-row
  entry is appended to the layer's version log. Readers take the latest
  version in the log and scan its folders as one table, pruned by date. A
  folder is never written twice, so the one being read is never overwritten,
  and a job that dies mid-write leaves the previous version current. Layers
  without ``tx_date`` are written whole. ``expire_versions`` deletes what only
  older versions list.
* schema evolution (IO10) -- files with added columns read together with
  ``mergeSchema``; old rows read NULL in the new columns.

Whether a layer or its log is there is asked of the file system. What is there
but cannot be read raises: an unreadable log must not look like an empty layer.

Paths live under the cluster's shared folder (``spark.checkpoint.dir``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.bronze import incremental_new_rows
from ..operators.silver import upsert
from ..session import hadoop_path
from .scratch import materialize  # noqa: F401 - part of this module's interface

LOG = "_versions"
MANIFESTS, DATA = "_manifests", "data"
DATE, PIECE = "tx_date", "_piece"
NO_DATE = "__HIVE_DEFAULT_PARTITION__"      # fixed: the folder name of a null partition value


Plan = Callable[[DataFrame], DataFrame]


def same(df: DataFrame) -> DataFrame:
    return df


def write_layer(df: DataFrame, path: str, mode: str = "overwrite", partition_by: str | None = "auto",
                fmt: str = "parquet", observed: Plan = same) -> None:
    """Write a layer; partitioned by ``tx_date`` when it has one. ``observed`` (here and
    below) sees the plan last, right before the write, such as ``quality.Observed.attach``.

    Rows reach a partitioned write hashed by some other key (transaction,
    user, card), so every task would hold every date and write one small
    file per date: tasks x dates files. The ``rebalance`` hint shuffles by
    the partition column and lets AQE split a large date into advisory-sized
    pieces and merge small ones -- files of a useful size, per date.
    """
    if partition_by == "auto":
        partition_by = "tx_date" if "tx_date" in df.columns else None
    if partition_by:
        df = df.hint("rebalance", partition_by)
    w = observed(df).write.format(fmt).mode(mode)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.save(path)


def write_ordered(df: DataFrame, path: str, *order, fmt: str = "parquet", observed: Plan = same) -> None:
    """Full refresh of a layer that keeps its order (T1): a range sort over all
    tasks, so files, read by name, and the rows in each follow it."""
    observed(df.orderBy(*order)).write.format(fmt).mode("overwrite").save(path)


def read_layer(spark: SparkSession, path: str, merge_schema: bool = True, fmt: str = "parquet") -> DataFrame:
    r = spark.read.format(fmt)
    if merge_schema:
        r = r.option("mergeSchema", "true")
    return r.load(path)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` at ``path`` in buckets of ``key``, sorted by it, and scan it as a bucketed table.

    Tables with the same number of buckets join, deduplicate and count by the key
    where their files lie: the one shuffle is the write's. ``buckets`` is the
    layout's size, to be chosen by the layer's bytes (about 128 MB a bucket).
    The table's name belongs to the session; ``path`` is what stays.
    """
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
       .option("path", path).saveAsTable(name))
    return spark.table(name)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether something was written at ``path``; an error of the file system rises."""
    fs, p = hadoop_path(spark, path)
    return fs.exists(p)


def append_new(spark: SparkSession, source: DataFrame, target_path: str, exists: bool,
               col: str = "ingested_at", fmt: str = "parquet", observed: Plan = same) -> DataFrame:
    """IO7: append the source rows newer than the target's mark; returns them."""
    target = read_layer(spark, target_path, fmt=fmt) if exists else None
    new = incremental_new_rows(source, target, col)
    write_layer(new, target_path, mode="append", fmt=fmt, observed=observed)
    return new


def current_version(spark: SparkSession, base: str) -> int | None:
    """The latest committed version; None before the first. A log that cannot be read raises."""
    if not exists(spark, f"{base}/{LOG}"):
        return None
    return spark.read.parquet(f"{base}/{LOG}").agg(F.max("version")).first()[0]


def manifest(spark: SparkSession, base: str, version: int) -> list[tuple[str, str]] | None:
    """(date, piece) of every folder of a version; None for a version that was written whole."""
    path = f"{base}/{MANIFESTS}/v{version:06d}"
    if not exists(spark, path):
        return None
    return sorted(tuple(r) for r in spark.read.schema(f"{DATE} string, {PIECE} string").json(path).collect())


def read_version(spark: SparkSession, base: str, version: int, fmt: str = "parquet") -> DataFrame:
    listed = manifest(spark, base, version)
    if listed is None:
        return read_layer(spark, f"{base}/v{version:06d}", fmt=fmt)
    return _read_pieces(spark, base, listed, fmt)


def _read_pieces(spark: SparkSession, base: str, listed: list[tuple[str, str]], fmt: str) -> DataFrame:
    """One scan over the listed folders; the date stays a partition column, so filters on it prune folders."""
    root = f"{base}/{DATA}"
    folders = [f"{root}/{DATE}={d}/{PIECE}={p}" for d, p in listed]
    rows = spark.read.format(fmt).option("mergeSchema", "true").option("basePath", root).load(folders)
    return rows.drop(PIECE).withColumn(DATE, F.col(DATE).cast("date"))


def read_current(spark: SparkSession, base: str, fmt: str = "parquet") -> DataFrame | None:
    v = current_version(spark, base)
    return None if v is None else read_version(spark, base, v, fmt)


def _dates(df: DataFrame) -> set[str]:
    """The distinct dates of ``df`` as folder names: at most one per day that it spans."""
    day = F.coalesce(F.col(DATE).cast("string"), F.lit(NO_DATE)).alias("d")
    return {r.d for r in df.select(day).distinct().collect()}


def merge_version(spark: SparkSession, incoming: DataFrame, base: str, key: str = "transaction_id",
                  fmt: str = "parquet", observed: Plan = same) -> int:
    """IO8: merge ``incoming`` into the current version on ``key``; commit a new one.

    Of a layer with dates only the touched ones are read whole, joined and
    written: those of the incoming rows, and those that hold a row with an
    incoming key (a key whose date moved leaves its old date), which a
    semi-join over the target's keys and dates alone finds. One writer at a
    time; what a writer that died left behind is never read nor written again.
    """
    v = current_version(spark, base)
    nv = 1 if v is None else v + 1
    while exists(spark, f"{base}/v{nv:06d}") or exists(spark, f"{base}/{MANIFESTS}/v{nv:06d}"):
        nv += 1
    listed = [] if v is None else manifest(spark, base, v)
    if DATE not in incoming.columns or listed is None:
        merged = incoming if v is None else upsert(read_version(spark, base, v, fmt), incoming, key)
        write_layer(merged, f"{base}/v{nv:06d}", mode="errorifexists", fmt=fmt, observed=observed)
    else:
        _write_manifest(spark, _merge_dates(spark, incoming, base, key, listed, nv, fmt, observed), f"{base}/{MANIFESTS}/v{nv:06d}")
    _commit(spark, base, nv)
    return nv


def _merge_dates(spark: SparkSession, incoming: DataFrame, base: str, key: str, listed: list[tuple[str, str]],
                 version: int, fmt: str, observed: Plan) -> list[tuple[str, str]]:
    """Write the touched dates of a merge; the new version's (date, piece) list."""
    incoming = materialize(spark, incoming, "merge-incoming")
    touched = _dates(incoming)
    merged = incoming
    if listed:
        target = _read_pieces(spark, base, listed, fmt)
        touched |= _dates(target.select(key, DATE).join(incoming.select(key), key, "left_semi"))
        old = [x for x in listed if x[0] in touched]
        if old:
            merged = upsert(_read_pieces(spark, base, old, fmt), incoming, key)
    return _write_dates(spark, merged, base, listed, touched, version, fmt, observed)


def _write_dates(spark: SparkSession, rows: DataFrame, base: str, listed: list[tuple[str, str]], dates: set[str],
                 version: int, fmt: str, observed: Plan = same) -> list[tuple[str, str]]:
    """Write ``rows``, all of ``dates``, as folders of their own; the list in which they stand for these dates."""
    piece = f"{version:06d}-{uuid.uuid4().hex[:8]}"
    (observed(rows.withColumn(PIECE, F.lit(piece)).hint("rebalance", DATE))
         .write.format(fmt).mode("append").partitionBy(DATE, PIECE).save(f"{base}/{DATA}"))
    written = [(d, piece) for d in sorted(dates) if exists(spark, f"{base}/{DATA}/{DATE}={d}/{PIECE}={piece}")]
    return [x for x in listed if x[0] not in dates] + written


def read_dates(spark: SparkSession, base: str, dates: Callable[[str], bool], fmt: str = "parquet") -> DataFrame | None:
    """The current version's rows of the dates (ISO text) that are asked for; only their folders are listed or
    read. None if there are none."""
    v = current_version(spark, base)
    listed = [] if v is None else [x for x in manifest(spark, base, v) if dates(x[0])]
    return _read_pieces(spark, base, listed, fmt) if listed else None


def fold_version(spark: SparkSession, rows: DataFrame, base: str, version: int, fold: Callable[[DataFrame], DataFrame],
                 fmt: str = "parquet") -> None:
    """Commit ``version``: the current one with ``rows`` folded into their dates (``fold`` of both), the other dates
    as they are. The caller's number says what has been folded, so a fold that died is simply done again."""
    v = current_version(spark, base)
    rows = materialize(spark, rows, "fold")
    dates = _dates(rows)
    listed = [] if v is None else manifest(spark, base, v)
    old = [x for x in listed if x[0] in dates]
    if old:
        rows = rows.unionByName(_read_pieces(spark, base, old, fmt).select(*rows.columns))
    listed = _write_dates(spark, fold(rows), base, listed, dates, version, fmt) if dates else listed
    _write_manifest(spark, listed, f"{base}/{MANIFESTS}/v{version:06d}", mode="overwrite")
    _commit(spark, base, version)


def write_version(spark: SparkSession, rows: DataFrame, base: str, version: int, fmt: str = "parquet") -> None:
    """Commit ``rows`` as the whole of ``version``; one that was cut short before its commit is written again."""
    write_layer(rows, f"{base}/v{version:06d}", mode="overwrite", partition_by=None, fmt=fmt)
    _commit(spark, base, version)


def _commit(spark: SparkSession, base: str, version: int) -> None:
    spark.range(1).select(F.lit(version).alias("version"), F.localtimestamp().alias("committed_at")) \
        .write.mode("append").parquet(f"{base}/{LOG}")


def _write_manifest(spark: SparkSession, listed: list[tuple[str, str]], path: str, mode: str = "errorifexists") -> None:
    """One row per date, as one small file."""
    spark.createDataFrame(listed, f"{DATE} string, {PIECE} string").coalesce(1).write.mode(mode).json(path)


def expire_versions(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Delete the date folders that none of the latest ``keep`` versions lists, and the older manifests; returns
    the deleted folders. Readers of an older version must be done, and no merge may be running."""
    v = current_version(spark, base)
    fs, manifests = hadoop_path(spark, f"{base}/{MANIFESTS}")
    if v is None or not fs.exists(manifests):
        return []
    numbers = sorted((int(s.getPath().getName()[1:]) for s in fs.listStatus(manifests)), reverse=True)
    kept = [n for n in numbers if n <= v][:keep]
    used = {x for n in kept for x in manifest(spark, base, n)}
    gone = []
    for day in fs.listStatus(hadoop_path(spark, f"{base}/{DATA}")[1]):
        date = day.getPath().getName().partition("=")[2]
        if not day.isDirectory() or not date:
            continue
        for folder in fs.listStatus(day.getPath()):
            if (date, folder.getPath().getName().partition("=")[2]) not in used:
                fs.delete(folder.getPath(), True)
                gone.append(folder.getPath().toString())
    for n in numbers:
        if n not in kept:
            fs.delete(hadoop_path(spark, f"{base}/{MANIFESTS}/v{n:06d}")[1], True)
    return gone
