"""ST8 without a task per key: the documented history rules, micro-batch by micro-batch.

``state`` keeps a card's or user's history in keyed state, where all rows that a
batch brings for one key meet in one task. Here each micro-batch is scored by
the batch plans instead -- windows per (card, minute), statistics per (user, day)
that are merged from partials -- over its rows and the little history that they
can reach back to, which the batch before it left:

* R2h, R4h: the rows of the last 70 minutes (frame and watermark), narrow. A card
  with a third of a batch is spread over one task per minute of its traffic.
* R1h (day granularity, as A4/J2): the user partials by day and batch.
* R5h: who used which high-risk category before, at most three rows per user; batches
  append the new ones, which are folded together every ``FOLD_EVERY`` batches.

What a batch leaves is written under its id and read by later ids only, so a
replayed batch reads the same history again and replaces its own output. A row
is scored on the rows that arrived before it or with it, as in ``state``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, MICROS_PER_MINUTE, ScoringConfig
from ..functions.columns import epoch_micros
from ..operators import features as FT
from ..operators import rules as R
from ..sources import storage
from . import pipeline as P
from .state import history_scores, watermark_us

RECENT = ("card_id", "event_timestamp", "country")
USE = ("user_id", "merchant_category")


def card_facts(silver: DataFrame, recent: DataFrame | None, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    """R2h and R4h facts of the batch's rows, by transaction id."""
    rows = silver.select("transaction_id", *RECENT).withColumn("_own", F.lit(True))
    if recent is not None:
        rows = rows.unionByName(recent.select(*RECENT).withColumn("_own", F.lit(False)), allowMissingColumns=True)
    return R.card_history(rows, cfg).filter("_own").select("transaction_id", "tx_count_10min", "countries_60min_multi")


def keep_recent(silver: DataFrame, recent: DataFrame | None, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    """The rows that a later batch's frames can still reach back to."""
    rows = silver.select(*RECENT)
    if recent is not None:
        rows = rows.unionByName(recent.select(*RECENT))
    t = epoch_micros("event_timestamp")
    newest = rows.agg(F.max(t)).first()[0]
    return rows.filter(t >= newest - cfg.cross_border_window_minutes * MICROS_PER_MINUTE - watermark_us(cfg))


def used_before(spark: SparkSession, sinks: P.Sinks, batch_id: int, every: int = P.FOLD_EVERY) -> DataFrame | None:
    """(user, category) of the batches before this one: the folded table and the few batches after it."""
    base, path = sinks.path("first_use_all"), sinks.path("first_use")
    done = storage.current_version(spark, base) or 0          # number of batches folded
    if batch_id - done >= every:
        new = P._batches(spark, path, done, batch_id - 1)
        if new is not None:
            old = storage.read_current(spark, base)
            rows = new.select(*USE) if old is None else old.select(*USE).unionByName(new.select(*USE))
            storage.write_version(spark, rows.distinct(), base, batch_id)
            done = batch_id
    parts = [storage.read_current(spark, base), P._batches(spark, path, done, batch_id - 1)]
    parts = [p.select(*USE) for p in parts if p is not None]
    return None if not parts else parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def first_uses(silver: DataFrame, before: DataFrame | None) -> DataFrame:
    """transaction_id and is_first_high_risk of the batch's rows."""
    rows = silver.select("transaction_id", *USE, "event_timestamp", "is_high_risk_mcc")
    rows = R.first_high_risk_use(rows).select("transaction_id", *USE, "is_first_high_risk")
    if before is None:
        return rows
    known = before.withColumn("_known", F.lit(True))
    first = rows.filter("is_first_high_risk").join(known, list(USE), "left").select(
        "transaction_id", *USE, F.col("_known").isNull().alias("is_first_high_risk"))
    return rows.filter("not is_first_high_risk").unionByName(first)


def history_fan_out(sinks: P.Sinks, cfg: ScoringConfig = DEFAULT, fold_every: int = P.FOLD_EVERY):
    """The ``foreachBatch`` function: silver, its documented scores (``history_scored``) and what later batches need."""

    def run(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        P.write_batch(batch.drop(P.ET), sinks.path("silver"), batch_id)
        silver = P.read_batch(spark, sinks.path("silver"), batch_id)
        if silver is None:
            return
        recent = P._state_before(spark, sinks.path("recent"), batch_id)
        P.fold_user_partials(spark, sinks, batch_id, fold_every)
        P.write_batch(FT.user_daily_partials(silver), sinks.path("user_partials"), batch_id)
        stats = P.stored_user_stats(spark, sinks, batch_id, silver, cfg).withColumnRenamed("stats_date", "tx_date")
        stats = storage.materialize(spark, stats, "user-days")        # of known size: AQE splits a hot user's rows
        first = storage.materialize(spark, first_uses(silver, used_before(spark, sinks, batch_id, fold_every)), "first-uses")
        user = (silver.select("transaction_id", "user_id", "tx_date", "amount", "is_off_hours")
                      .join(stats, ["user_id", "tx_date"], "left").withColumn("user_30d_n", F.coalesce("user_30d_n", F.lit(0)))
                      .join(first.select("transaction_id", "is_first_high_risk"), "transaction_id")
                      .drop("user_id", "tx_date", "user_30d_sum"))
        scored = history_scores(card_facts(silver, recent, cfg), user, cfg)
        P.write_batch(scored, sinks.path("history_scored"), batch_id)
        P.write_batch(first.filter("is_first_high_risk").select(*USE), sinks.path("first_use"), batch_id)
        P.write_batch(keep_recent(silver, recent, cfg), sinks.path("recent"), batch_id)
        P._drop_before(spark, sinks.path("recent"), batch_id)

    return run


def start_history(silver: DataFrame, sinks: P.Sinks, checkpoint: str, cfg: ScoringConfig = DEFAULT,
                  trigger: dict | None = None, fold_every: int = P.FOLD_EVERY):
    return (silver.writeStream.foreachBatch(history_fan_out(sinks, cfg, fold_every)).option("checkpointLocation", checkpoint)
                  .trigger(**(trigger or {"availableNow": True})).start())
