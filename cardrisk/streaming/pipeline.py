"""Structured Streaming: source -> bronze -> silver -> scored fan-out.

* IO1 / ST6  -- ``read_raw_stream`` (file stand-in with ``maxFilesPerTrigger``)
  or ``read_kafka_stream`` (``maxOffsetsPerTrigger``; needs the Kafka jar).
* ST1, ST5   -- event-time watermark, ``dropDuplicatesWithinWatermark``.
* ST7, ST9   -- ONE source query and ONE ``foreachBatch``: the micro-batch
  is written to silver once, scored once (as-coded rules are batch-relative,
  D2), and fanned out to every sink; outputs are keyed by ``batch_id`` so a
  replayed batch overwrites its own partition (idempotent, D20), and alerts
  leave through an outbox that is marked when they are published.
* ST2, ST3   -- windowed aggregates in append mode over the scored / silver
  streams; windows close when the watermark passes their end.
* IO11       -- every query has its own checkpoint; restart resumes.

The same column functions as the batch plans are used throughout.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, ScoringConfig
from ..operators import bronze as B
from ..operators import features as FT
from ..operators import gold as G
from ..operators import reports as RP
from ..operators import score as S
from ..operators import silver as SV
from ..session import hadoop_path
from ..sources import storage
from ..sources.schema import RAW_SCHEMA

ET = "event_time_ltz"   # zoned copy of the event time: what withWatermark needs


def read_raw_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(RAW_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(path)


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, max_offsets_per_trigger: int = 10_000,
                      starting_offsets: str = "latest") -> DataFrame:
    """IO1 against a broker (requires the spark-sql-kafka package on the cluster)."""
    raw = (spark.readStream.format("kafka")
           .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
           .option("startingOffsets", starting_offsets).option("failOnDataLoss", "false")
           .option("maxOffsetsPerTrigger", max_offsets_per_trigger).load())
    return raw.select(F.col("value").cast("string").alias("value"),
                      F.col("offset").alias("kafka_offset"),
                      F.col("partition").cast("bigint").alias("kafka_partition"),
                      F.col("timestamp").cast("timestamp_ntz").alias("kafka_ingest_time"),
                      F.localtimestamp().alias("ingested_at"))


def _parsed(raw: DataFrame, cfg: ScoringConfig) -> DataFrame:
    """Parsed records. Rows without an event time cannot be placed against the
    watermark; in the stream they go to the dead letter."""
    no_time = F.when(F.col("event_time").isNull(), F.lit("missing_event_time"))
    return B.parse_records(raw, cfg).withColumn("reject_reason", F.coalesce(F.col("reject_reason"), no_time))


def bronze_stream(raw: DataFrame, cfg: ScoringConfig = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(accepted, dead letter) of one parse."""
    parsed = _parsed(raw, cfg)
    return B.accepted(parsed), B.dead_letter(parsed)


def bronze_fan_out(sinks: "Sinks", cfg: ScoringConfig = DEFAULT):
    """IO2 + B5 from one read: each micro-batch is parsed once, persisted, and
    split into the bronze layer and the dead letter (keyed by batch_id)."""

    def run(raw_batch: DataFrame, batch_id: int) -> None:
        parsed = _parsed(raw_batch, cfg).persist()
        try:
            for name, df in (("bronze", B.accepted(parsed)), ("dead_letter", B.dead_letter(parsed))):
                (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
                   .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(sinks.path(name)))
        finally:
            parsed.unpersist()

    return run


def start_bronze(raw: DataFrame, sinks: "Sinks", checkpoint: str, cfg: ScoringConfig = DEFAULT,
                 trigger: dict | None = None):
    return (raw.writeStream.foreachBatch(bronze_fan_out(sinks, cfg)).option("checkpointLocation", checkpoint)
               .trigger(**(trigger or {"availableNow": True})).start())


def silver_stream(bronze: DataFrame, cfg: ScoringConfig = DEFAULT, dedup: bool = True) -> DataFrame:
    """Typed, valid, enriched rows; duplicates dropped within the watermark."""
    out = SV.enrich(SV.valid(B.typed_projection(bronze), cfg), cfg)
    out = out.withColumn(ET, F.col("event_timestamp").cast("timestamp")).withWatermark(ET, cfg.watermark)
    if dedup:
        out = out.dropDuplicatesWithinWatermark(["transaction_id"])
    return out


@dataclass
class Sinks:
    """Where a stream's outputs go: layers under ``base``, alerts to any format.

    ``alert_format`` other than None names a Spark sink for the alert records
    (key, value), e.g. ``kafka`` with ``topic`` and ``kafka.bootstrap.servers``
    in ``alert_options``, and the alerts layer is its outbox; by default the
    layer is all there is."""

    base: str
    alert_format: str | None = None
    alert_options: dict = field(default_factory=dict)

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"


def write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """Write one micro-batch's rows as partition ``batch_id=N`` (dynamic
    overwrite: a replayed batch replaces its own partition, D20)."""
    (df.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path))


def read_batch(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """Scan partition ``batch_id=N`` alone (no listing of other batches);
    None when the batch wrote no rows."""
    part = f"{path}/batch_id={batch_id}"
    fs, p = hadoop_path(spark, part)
    if not fs.exists(p):
        return None
    return spark.read.parquet(part).withColumn("batch_id", F.lit(batch_id))


def published(sinks: Sinks, batch_id: int) -> str:
    """Path of the record that says a batch's alerts were handed to the sink."""
    return f"{sinks.path('alerts_published')}/batch_id={batch_id}"


def mark_published(spark: SparkSession, sinks: Sinks, batch_id: int) -> None:
    fs, p = hadoop_path(spark, published(sinks, batch_id))
    fs.mkdirs(p.getParent())
    fs.createNewFile(p)


def publish(records: DataFrame, sinks: Sinks, batch_id: int) -> None:
    """IO5: hand a batch's key/value records to the alert sink, once.

    The alerts layer is the outbox: the records are first written there as
    partition ``batch_id=N``, published from there, and the batch is then
    marked. A replay after the mark publishes nothing; a replay before it
    publishes what the outbox holds, the same records to the byte (their
    transaction ids tell a reader so), even if the batch was scored again at
    another time. What remains: an application that dies after the sink took
    the records and before the mark repeats them -- at least once, never lost.
    A batch without alerts writes nothing.
    """
    spark, outbox = records.sparkSession, sinks.path("alerts")
    if sinks.alert_format is None:
        write_batch(records, outbox, batch_id)
        return
    fs, mark = hadoop_path(spark, published(sinks, batch_id))
    if fs.exists(mark):
        return
    waiting = read_batch(spark, outbox, batch_id)
    if waiting is None:
        write_batch(records, outbox, batch_id)
        waiting = read_batch(spark, outbox, batch_id)
    if waiting is not None:
        (waiting.select("key", "value").write.format(sinks.alert_format).options(**sinks.alert_options)
                .mode("append").save())
        mark_published(spark, sinks, batch_id)


FOLD_EVERY = 8      # micro-batches whose partials wait to be folded into the day table, at most


def merged_partials(parts: DataFrame) -> DataFrame:
    """One partial per (user, day) of partials of the same."""
    return parts.groupBy("user_id", "tx_date").agg(*[F.sum(c).cast(parts.schema[c].dataType).alias(c) for c in ("n", "s", "ss")])


def _batches(spark: SparkSession, path: str, first: int, last: int) -> DataFrame | None:
    """The partitions of a range of batches (by name, no listing of the others); None if none wrote rows."""
    fs, _ = hadoop_path(spark, path)
    folders = [f for n in range(first, last + 1) if fs.exists(hadoop_path(spark, f := f"{path}/batch_id={n}")[1])]
    return spark.read.option("basePath", path).parquet(*folders).drop("batch_id") if folders else None


def fold_user_partials(spark: SparkSession, sinks: Sinks, batch_id: int, every: int = FOLD_EVERY) -> None:
    """Fold the partials of the batches before this one into the day table, ``every`` batches at a time.

    The day table's version is the number of batches it holds, so a fold that
    was cut short, or a batch that is replayed, counts nothing twice: a batch is
    folded by a later one only, when it can no longer be replayed. Only the
    dates of the folded batches are written."""
    base, path = sinks.path("user_days"), sinks.path("user_partials")
    done = storage.current_version(spark, base) or 0
    if batch_id - done < every:
        return
    waiting = _batches(spark, path, done, batch_id - 1)
    if waiting is not None:
        storage.fold_version(spark, merged_partials(waiting), base, batch_id, merged_partials)


def user_partials(spark: SparkSession, sinks: Sinks, batch_id: int, first: dt.date, last: dt.date) -> DataFrame:
    """A4's daily partials of the days from ``first`` to ``last``, of all batches up to this one: those days of
    the day table and the few batches that it does not hold yet, however long the stream has run."""
    base = sinks.path("user_days")
    done = storage.current_version(spark, base) or 0
    days = storage.read_dates(spark, base, lambda d: first.isoformat() <= d <= last.isoformat())
    recent = _batches(spark, sinks.path("user_partials"), done, batch_id)
    parts = [p for p in (days, recent) if p is not None]
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1].select(*parts[0].columns))
    return merged_partials(out.filter(F.col("tx_date").between(F.lit(first), F.lit(last))))


def stored_user_stats(spark: SparkSession, sinks: Sinks, batch_id: int, rows: DataFrame, cfg: ScoringConfig) -> DataFrame:
    """A4 from the stored partials: the statistics of the days before each day of ``rows``."""
    first, last = rows.agg(F.min("tx_date"), F.max("tx_date")).first()
    return FT.user_stats(None, cfg, partials=user_partials(spark, sinks, batch_id, first - dt.timedelta(days=cfg.history_days), last))


def score_and_fan_out(sinks: Sinks, cfg: ScoringConfig = DEFAULT, user_scope=None, card_scope=None,
                      user_stats: bool = False, fold_every: int = FOLD_EVERY, feed_rows: int = 0):
    """The ``foreachBatch`` function: write silver, score it, write every output.

    Each step reads the rows the previous step wrote. The micro-batch (and
    the stateful dedup upstream of it) runs exactly once, in the silver
    write; scoring joins per-user / per-card statistics back to rows of the
    written partition, so no branch re-runs the stream's plan. (Persisting
    the micro-batch does not serve here: the statistics branches of the
    self-join do not match the cached plan and would re-run the dedup.)
    Written partitions also survive a lost executor, where cached blocks
    would be recomputed. A batch without rows writes nothing further.

    With ``user_stats`` the velocity rule reads the stored user statistics
    (A4, J2) instead of the batch's own: the batch's daily partials are stored
    under its id first, then the statistics of the rows' days are joined. Partials
    of older batches are in a table by day, of which a batch reads the days it needs.
    With ``feed_rows`` the live feed and the flagged cards are kept up (T2, T3).
    """

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        write_batch(batch.drop(ET), sinks.path("silver"), batch_id)
        silver = read_batch(spark, sinks.path("silver"), batch_id)
        if silver is None:
            return
        silver = silver.drop("batch_id")
        if user_stats:
            fold_user_partials(spark, sinks, batch_id, fold_every)
            write_batch(FT.user_daily_partials(silver), sinks.path("user_partials"), batch_id)
            stats = stored_user_stats(spark, sinks, batch_id, silver, cfg)
            scored = S.score_with_stats(silver, stats, cfg, card_scope)
        else:
            scored = S.score_as_coded(silver, cfg, user_scope, card_scope)
        write_batch(scored, sinks.path("scored"), batch_id)
        scored = read_batch(spark, sinks.path("scored"), batch_id)
        write_batch(G.flagged(scored).drop("batch_id"), sinks.path("gold_anomalies"), batch_id)
        if feed_rows:
            keep_live_feed(scored, sinks, batch_id, feed_rows)
        publish(RP.alert_payload(scored), sinks, batch_id)

    return run


def start_scoring(silver: DataFrame, sinks: Sinks, checkpoint: str, cfg: ScoringConfig = DEFAULT,
                  trigger: dict | None = None, **scope):
    w = silver.writeStream.foreachBatch(score_and_fan_out(sinks, cfg, **scope)).option("checkpointLocation",
                                                                                        checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, fmt: str = "parquet"):
    """IO2: append-mode layer sink with its own checkpoint."""
    return (df.writeStream.format(fmt).outputMode("append").option("path", path)
              .option("checkpointLocation", checkpoint)
              .trigger(**(trigger or {"availableNow": True})).start())


FEED = ("transaction_id", "event_timestamp", "card_id", "amount", "anomaly_score", "risk_level")


def _state_before(spark: SparkSession, path: str, batch_id: int) -> DataFrame | None:
    """The state that the latest batch before this one left, by folder name; None at the beginning."""
    fs, p = hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    names = [s.getPath().getName().partition("=") for s in fs.listStatus(p) if s.isDirectory()]
    before = [int(n) for key, _, n in names if key == "batch_id" and n.isdigit() and int(n) < batch_id]
    return read_batch(spark, path, max(before)).drop("batch_id") if before else None


def _drop_before(spark: SparkSession, path: str, batch_id: int) -> None:
    """Delete states that no replay needs any more: all but the two latest of those before this batch."""
    fs, p = hadoop_path(spark, path)
    if fs.exists(p):
        old = sorted(int(n) for s in fs.listStatus(p) if (n := s.getPath().getName().partition("=")[2]).isdigit() and int(n) < batch_id)
        for n in old[:-2]:
            fs.delete(hadoop_path(spark, f"{path}/batch_id={n}")[1], True)


def keep_live_feed(scored: DataFrame, sinks: Sinks, batch_id: int, n: int = 100) -> None:
    """T2 and T3 kept up batch by batch.

    The ``n`` latest rows of a stream are those of (the ``n`` latest so far and
    the batch's ``n`` latest); the counts per card are sums. A batch reads the state
    that the one before it left and writes its own under its id, so a replay
    reads the same state again and replaces what it wrote: every batch counts
    once. The cost of a batch is its rows, ``n`` rows, and one row per card seen.
    """
    spark = scored.sparkSession
    feed, cards = sinks.path("live_feed"), sinks.path("card_counts")
    rows, counts = RP.latest(scored.select(*FEED), n), RP.card_counts(scored)
    held, held_counts = _state_before(spark, feed, batch_id), _state_before(spark, cards, batch_id)
    if held is not None:
        rows = RP.latest(held.select(*FEED).unionByName(rows), n)
    if held_counts is not None:
        counts = RP.merged_card_counts(held_counts.unionByName(counts))
    write_batch(rows, feed, batch_id)
    write_batch(counts, cards, batch_id)
    _drop_before(spark, feed, batch_id)
    _drop_before(spark, cards, batch_id)


def live_feed(spark: SparkSession, sinks: Sinks, n: int = 100) -> DataFrame:
    """T2 as of the last batch."""
    return RP.latest(_state_before(spark, sinks.path("live_feed"), 1 << 62), n)


def flagged_cards(spark: SparkSession, sinks: Sinks, n: int = 10) -> DataFrame:
    """T3 as of the last batch."""
    return RP.top_cards(_state_before(spark, sinks.path("card_counts"), 1 << 62), n)


def minute_summary_stream(scored: DataFrame, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    """ST2: A2 over a stream of scored rows, append mode behind the watermark.

    A scored batch that is written again after a failure arrives here as new
    files; its transactions are dropped within the watermark before they count."""
    s = scored.withColumn(ET, F.col("event_timestamp").cast("timestamp")).withWatermark(ET, cfg.watermark)
    s = s.dropDuplicatesWithinWatermark(["transaction_id"])
    out = RP.minute_summary(s, ts=ET)
    return (out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
               .withColumn("window_end", F.col("window_end").cast("timestamp_ntz")))


def sliding_stream(silver: DataFrame, length: str = "10 minutes", slide: str = "1 minute") -> DataFrame:
    """ST3: per (card, sliding window, country) partials in append mode; the
    fold to one row per (card, window) is ``fold_sliding`` on read-back.

    Two window aggregates follow each other. The first combines rows into cells
    of one slide, one state row per (card, cell, country); a cell that the
    watermark has closed goes on, at its ``window_time``, to the windows that
    cover it. So a row is one update of state instead of length / slide, and
    only closed cells are copied. A window closes in the batch in which its last
    cell does, as in one step."""
    aggregates = [("n", F.sum), ("s", F.sum), ("m", F.max)]
    cells = (silver.groupBy("card_id", F.window(ET, slide).alias("cell"), "country")
                   .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"), F.max("amount").alias("m")))
    cells = cells.select("card_id", "country", "n", "s", "m", F.window_time("cell").alias(ET))
    out = (cells.groupBy("card_id", F.window(ET, length, slide).alias("window"), "country")
                .agg(*[f(c).alias(c) for c, f in aggregates]))
    return (out.withColumn("window_start", F.col("window.start").cast("timestamp_ntz"))
               .withColumn("window_end", F.col("window.end").cast("timestamp_ntz")).drop("window"))


def fold_sliding(partials: DataFrame) -> DataFrame:
    pair = F.when(F.col("country").isNotNull(), F.concat(F.col("country"), F.lit(":"), F.col("n").cast("string")))
    return partials.groupBy("card_id", "window_start", "window_end").agg(
        F.sum("n").alias("tx_count_window"), F.sum("s").alias("amount_sum_window"),
        F.max("m").alias("amount_max_window"),
        F.array_join(F.array_sort(F.collect_list(pair)), ",").alias("countries_in_window"))
