"""Session construction and shared-folder helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. AQE re-plans joins (runtime broadcast of a
# side that turns out small, skew-join splitting) and coalesces shuffle
# partitions; the session time zone is pinned so that timestamp arithmetic
# has no daylight-saving jumps.
LIBRARY_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, app: str = "cardrisk", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(LIBRARY_CONF)
    conf.update({
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    })
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def pin_utc(spark: SparkSession) -> None:
    """All library timestamps are naive UTC; make the session agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for checkpoints and staged tables.

    Read from ``spark.checkpoint.dir`` (the setting a cluster provides). Only
    on a local master, where driver and executors are one process, is a fresh
    local folder made when it is unset; on a cluster each executor would write
    to its own disk, so there the setting is required.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="cardrisk-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        spark.sparkContext.setCheckpointDir(d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Spark's own file access, for any store it can read."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    fs, p = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    return path
