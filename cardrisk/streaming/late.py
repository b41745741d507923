"""ST4 with the late rows kept: bronze, silver and a table of what came behind the watermark.

Spark's stateful steps drop a row that is behind the watermark without a trace.
Here one ``foreachBatch`` keeps the watermark itself -- the newest event time of
the batches before, less the delay -- and parts every batch by it: bronze has
all accepted records, ``late_rows`` those behind the watermark with the watermark that
they missed, silver the others, once per transaction. What a batch leaves
for the next (its newest time; the ids of the last watermark's length, by which
a redelivered transaction is known) is written under its id and read by later
ids only, so a replayed batch parts its rows as it did the first time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, ScoringConfig
from ..functions.columns import epoch_micros
from ..operators import bronze as B
from ..operators import silver as SV
from . import pipeline as P
from .state import watermark_us

TIME = "event_timestamp"


def split_late(rows: DataFrame, watermark: int | None) -> tuple[DataFrame, DataFrame]:
    """(in time, late) of rows by a watermark in microseconds; without one none is late."""
    if watermark is None:
        return rows, rows.limit(0).withColumn("watermark", F.lit(None).cast("timestamp_ntz"))
    mark = F.timestamp_micros(F.lit(watermark)).cast("timestamp_ntz")
    late = epoch_micros(TIME) < F.lit(watermark)
    return rows.filter(~late), rows.filter(late).withColumn("watermark", mark)


def late_fan_out(sinks: P.Sinks, cfg: ScoringConfig = DEFAULT):
    """The ``foreachBatch`` function over raw records."""

    def run(raw: DataFrame, batch_id: int) -> None:
        spark, delay = raw.sparkSession, watermark_us(cfg)
        parsed = P._parsed(raw, cfg)
        P.write_batch(B.accepted(parsed), sinks.path("bronze"), batch_id)
        bronze = P.read_batch(spark, sinks.path("bronze"), batch_id)
        if bronze is None:
            return
        marks = P._state_before(spark, sinks.path("newest"), batch_id)
        before = marks.first()["newest"] if marks is not None else None
        typed = SV.valid(B.typed_projection(bronze.drop("batch_id")), cfg)
        in_time, late = split_late(typed, None if before is None else before - delay)
        P.write_batch(late, sinks.path("late_rows"), batch_id)
        seen = P._state_before(spark, sinks.path("seen"), batch_id)
        if seen is not None:
            in_time = in_time.join(seen.select("transaction_id"), "transaction_id", "left_anti")
        P.write_batch(SV.enrich(SV.dedup_latest(in_time), cfg), sinks.path("silver"), batch_id)

        newest = bronze.agg(F.max(epoch_micros("event_time"))).first()[0]
        newest = newest if before is None else max(newest, before)
        silver = P.read_batch(spark, sinks.path("silver"), batch_id)
        ids = [d.select("transaction_id", TIME) for d in (silver, seen) if d is not None]
        if ids:
            kept = ids[0] if len(ids) == 1 else ids[0].unionByName(ids[1])
            # a copy of an older transaction is late itself
            P.write_batch(kept.filter(epoch_micros(TIME) >= newest - delay), sinks.path("seen"), batch_id)
        P.write_batch(spark.range(1).select(F.lit(newest).alias("newest")), sinks.path("newest"), batch_id)
        for name in ("newest", "seen"):
            P._drop_before(spark, sinks.path(name), batch_id)

    return run


def start_late(raw: DataFrame, sinks: P.Sinks, checkpoint: str, cfg: ScoringConfig = DEFAULT, trigger: dict | None = None):
    return (raw.writeStream.foreachBatch(late_fan_out(sinks, cfg)).option("checkpointLocation", checkpoint)
               .trigger(**(trigger or {"availableNow": True})).start())
