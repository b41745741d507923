"""The query catalogue: one Spark plan per operator of the survey's inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the given
tables (work grows with them; nothing is sampled or capped). Outputs carry
no clock columns; doubles are rounded to the precision the gold layer uses
(scores 2 dp, z 4 dp) so that results compare exactly across engines.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import DEFAULT, MICROS_PER_DAY
from ..operators import bronze as B
from ..operators import rules as R
from ..operators import score as S
from ..operators import silver as SV
from ..session import pin_utc
from ..sources import fixture, storage
from .oracle import CUT_TS, RUN_ID, RUN_TS, STREAM_SLICE_DAYS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    """Register a catalogue plan. DATE columns leave as ISO text, so that
    every client (pandas, Arrow, tuples) sees the same value."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = fn(spark, sf_dir)
        dates = {f.name for f in df.schema.fields if f.dataType.typeName() == "date"}
        if not dates:
            return df
        return df.select(*[F.col(c).cast("string").alias(c) if c in dates else F.col(c) for c in df.columns])

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    QUERIES[fn.__name__] = run
    return run


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


def scored_at():
    """Deterministic stand-in for the scoring clock: event time + 5 s."""
    return F.timestamp_add("SECOND", F.lit(5), "event_timestamp")


# -- shared inputs --------------------------------------------------------------

def bronze_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_utc(spark)
    return fixture.load_transactions(spark, sf_dir)


def bronze_typed_rows(spark, sf_dir) -> DataFrame:
    return B.typed_projection(bronze_rows(spark, sf_dir))


def silver_rows(spark, sf_dir) -> DataFrame:
    return SV.to_silver(bronze_typed_rows(spark, sf_dir))


def silver_table(spark, sf_dir) -> DataFrame:
    """Silver written once to the shared folder and scanned back -- the
    layer the models materialise. Plans that read silver in several branches
    (rows + per-key statistics joined back, window context rows, the gold
    join, three layers of checks) scan it with pruned columns instead of
    repeating the fixture scan and the dedup shuffle once per branch."""
    return storage.materialize(spark, silver_rows(spark, sf_dir), "silver")


def scored_rows(spark, sf_dir, silver: DataFrame | None = None) -> DataFrame:
    """As-coded scores; R1 over all of a user's rows, R2 per card and hour."""
    sv = silver if silver is not None else silver_table(spark, sf_dir)
    return S.score_as_coded(sv, DEFAULT, user_scope=None,
                            card_scope=F.date_trunc("hour", "event_timestamp"), scored_at=scored_at())


def history_rows(spark, sf_dir) -> DataFrame:
    silver = storage.materialize(spark, silver_rows(spark, sf_dir).select(*S.RULE_COLUMNS), "silver")
    return S.score_history(silver, DEFAULT, scored_at=scored_at())


def r2(c):
    return F.round(c, 2).alias(c)


def r4(c):
    return F.round(c, 4).alias(c)


# -- bronze ---------------------------------------------------------------------

@query
def bronze_typed(spark, sf_dir):
    return B.typed_projection(bronze_rows(spark, sf_dir), run_ts=_ts(RUN_TS), run_id=RUN_ID)


def _parsed(spark, sf_dir):
    pin_utc(spark)
    raw = fixture.wire_records(fixture.read_table(spark, sf_dir, "events"))
    return B.parse_records(raw)


@query
def bronze_parse_json(spark, sf_dir):
    return B.accepted(_parsed(spark, sf_dir))


@query
def bronze_dead_letter(spark, sf_dir):
    return B.dead_letter(_parsed(spark, sf_dir)).drop("raw_payload")


@query
def bronze_incremental(spark, sf_dir):
    src = bronze_typed_rows(spark, sf_dir)
    target = src.filter(F.col("event_timestamp") < _ts(CUT_TS))
    return B.incremental_new_rows(src, target).select("transaction_id", "ingested_at", "kafka_offset",
                                                      "kafka_partition")


# -- silver ---------------------------------------------------------------------

@query
def silver_valid(spark, sf_dir):
    return SV.valid(bronze_typed_rows(spark, sf_dir)).select("transaction_id", "kafka_offset", "amount", "currency")


@query
def silver_dedup(spark, sf_dir):
    return SV.dedup_latest(SV.valid(bronze_typed_rows(spark, sf_dir))).select(
        "transaction_id", "ingested_at", "kafka_offset", "kafka_partition")


@query
def silver_text(spark, sf_dir):
    return silver_rows(spark, sf_dir).select("transaction_id", "merchant_name", "merchant_category", "amount",
                                             "currency", "country", "city", "device_type")


@query
def silver_time(spark, sf_dir):
    return silver_rows(spark, sf_dir).select("transaction_id", "event_timestamp", "tx_hour", "tx_day_of_week",
                                             "tx_date", "tx_week", "tx_month")


@query
def silver_bucket(spark, sf_dir):
    return silver_rows(spark, sf_dir).select("transaction_id", "amount", "amount_bucket")


@query
def silver_flags(spark, sf_dir):
    return silver_rows(spark, sf_dir).select("transaction_id", "is_high_risk_mcc", "is_cnp", "is_off_hours",
                                             "is_foreign_country")


@query
def silver_latency(spark, sf_dir):
    return silver_rows(spark, sf_dir).select("transaction_id", "event_timestamp", "kafka_ingest_time",
                                             "kafka_latency_ms")


@query
def silver_full(spark, sf_dir):
    return silver_rows(spark, sf_dir)


# -- rules ----------------------------------------------------------------------

@query
def rule_velocity_batch(spark, sf_dir):
    df = R.amount_velocity(silver_table(spark, sf_dir), DEFAULT)
    return df.select("transaction_id", "user_id", "amount", r4("user_batch_std"),
                     r4("amount_zscore"), r2("score_amount_velocity"))


@query
def rule_velocity_30d(spark, sf_dir):
    df = R.amount_velocity_history(silver_table(spark, sf_dir), DEFAULT)
    return df.select("transaction_id", "user_id", "amount", "user_30d_n", r4("user_30d_std"),
                     r4("amount_zscore"), r2("score_amount_velocity"))


@query
def rule_frequency_batch(spark, sf_dir):
    df = R.tx_frequency(silver_table(spark, sf_dir), DEFAULT, F.date_trunc("hour", "event_timestamp"))
    return df.select("transaction_id", "card_id", "tx_count_batch", r2("score_tx_frequency"))


@query
def rule_frequency_10m(spark, sf_dir):
    df = R.tx_frequency_history(silver_table(spark, sf_dir), DEFAULT)
    return df.select("transaction_id", "card_id", "tx_count_10min", r2("score_tx_frequency"))


@query
def rule_off_hours(spark, sf_dir):
    df = R.off_hours(silver_rows(spark, sf_dir))
    return df.select("transaction_id", "tx_hour", "is_off_hours", "score_off_hours")


@query
def rule_off_hours_local(spark, sf_dir):
    """R3h (D8): off-hours by the local clock of the transaction's country."""
    df = R.off_hours_local(silver_rows(spark, sf_dir), DEFAULT)
    return df.select("transaction_id", "country", "tx_hour", "local_hour", "is_off_hours_local", "score_off_hours")


@query
def rule_cross_border_flag(spark, sf_dir):
    df = R.cross_border(silver_rows(spark, sf_dir), DEFAULT)
    return df.select("transaction_id", "is_international", "amount", "score_cross_border")


@query
def rule_cross_border_60m(spark, sf_dir):
    df = R.cross_border_history(silver_table(spark, sf_dir), DEFAULT)
    return df.select("transaction_id", "card_id", "country", "countries_60min_multi", "score_cross_border")


@query
def rule_high_risk_mcc(spark, sf_dir):
    df = R.high_risk_mcc(silver_rows(spark, sf_dir))
    return df.select("transaction_id", "merchant_category", "is_high_risk_mcc", "score_high_risk_mcc")


@query
def rule_first_mcc(spark, sf_dir):
    df = R.first_high_risk_use(silver_table(spark, sf_dir))
    return df.select("transaction_id", "user_id", "merchant_category", "is_first_high_risk", "score_high_risk_mcc")


SCORE_COLS = ["transaction_id", "card_id", "user_id", "event_timestamp", "amount"]


@query
def composite_score(spark, sf_dir):
    df = scored_rows(spark, sf_dir)
    return df.select(*SCORE_COLS, r4("amount_zscore"), r2("score_amount_velocity"), "tx_count_batch",
                     r2("score_tx_frequency"), "score_off_hours", "score_cross_border", "score_high_risk_mcc",
                     "anomaly_score", "risk_level")


@query
def risk_levels(spark, sf_dir):
    return scored_rows(spark, sf_dir).select("transaction_id", "anomaly_score", "risk_level")


@query
def triggered_rules(spark, sf_dir):
    return scored_rows(spark, sf_dir).select("transaction_id", "triggered_rules")


@query
def triggered_rule_counts(spark, sf_dir):
    return S.rule_counts(scored_rows(spark, sf_dir))


@query
def composite_history(spark, sf_dir):
    df = history_rows(spark, sf_dir)
    return df.select(*SCORE_COLS, "user_30d_n", r4("amount_zscore"), r2("score_amount_velocity"), "tx_count_10min",
                     r2("score_tx_frequency"), "score_off_hours", "score_cross_border", "score_high_risk_mcc",
                     "anomaly_score", "risk_level", "triggered_rules")


# -- storage --------------------------------------------------------------------

@query
def silver_upsert(spark, sf_dir):
    """IO8 + J4: first run built silver from the deliveries before the cut;
    the next run merges the rows above the high-water mark on the key. The
    mark filters bronze before the dedup (same rows as dedup-then-mark: a
    key's latest delivery is above the mark whenever any of its deliveries
    is), so a run shuffles only the new deliveries, and the merge rewrites only
    the dates they touch."""
    from ..session import scratch_path
    bt = bronze_typed_rows(spark, sf_dir)
    base = scratch_path(spark, "silver-versions")
    storage.merge_version(spark, SV.to_silver(bt.filter(F.col("ingested_at") < _ts(CUT_TS))), base)
    storage.merge_version(spark, SV.to_silver(B.incremental_new_rows(bt, storage.read_current(spark, base))), base)
    return storage.read_current(spark, base).select("transaction_id", "ingested_at", "kafka_offset", "kafka_partition", "amount")


@query
def schema_evolution(spark, sf_dir):
    """IO10 (+IO6, IO9): an old-schema layer gains columns on append; read
    back with mergeSchema, old rows hold NULL in the new columns."""
    from ..session import scratch_path
    sv = silver_table(spark, sf_dir)
    path = scratch_path(spark, "schema-evolution")
    old = sv.filter(F.col("event_timestamp") < _ts(CUT_TS)).drop("tx_week", "tx_month", "kafka_latency_ms")
    storage.write_layer(old, path, mode="overwrite", partition_by=None)
    storage.write_layer(sv.filter(F.col("event_timestamp") >= _ts(CUT_TS)), path, mode="append", partition_by=None)
    return storage.read_layer(spark, path, merge_schema=True).select(
        "transaction_id", "event_timestamp", "tx_week", "tx_month", "kafka_latency_ms")


# -- features -------------------------------------------------------------------

from ..operators import features as FT  # noqa: E402
from ..operators import gold as G  # noqa: E402
from ..operators import quality as Q  # noqa: E402
from ..operators import reports as RP  # noqa: E402


@query
def card_sliding_features(spark, sf_dir):
    df = FT.card_sliding_features(silver_rows(spark, sf_dir))
    return df.select("card_id", "window_start", "window_end", "tx_count_window", r2("amount_sum_window"),
                     "amount_max_window", "countries_in_window")


@query
def user_stats_30d(spark, sf_dir):
    df = FT.user_stats(silver_rows(spark, sf_dir))
    return df.select("user_id", "stats_date", "user_30d_n", r2("user_30d_sum"), r4("user_30d_std"))


@query
def score_with_user_stats(spark, sf_dir):
    sv = silver_table(spark, sf_dir)
    df = FT.score_with_user_stats(sv, FT.user_stats(sv))
    return df.select("transaction_id", "user_30d_n", r4("user_30d_std"), r4("amount_zscore"),
                     r2("score_amount_velocity"))


@query
def cross_border_pairs(spark, sf_dir):
    return FT.cross_border_pairs(silver_table(spark, sf_dir))


# -- gold and reports -------------------------------------------------------------

def gold_rows(spark, sf_dir, order: bool = True, silver: DataFrame | None = None):
    sv = silver if silver is not None else silver_table(spark, sf_dir)
    return G.gold_anomalies(sv, scored_rows(spark, sf_dir, sv), DEFAULT, order=order)


@query
def gold_anomalies(spark, sf_dir):
    return gold_rows(spark, sf_dir)


def bucketed_gold(spark, sf_dir):
    """Silver and scored as layers bucketed on the transaction, and gold from them."""
    from ..session import scratch_path
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    silver = storage.write_bucketed(silver_rows(spark, sf_dir), scratch_path(spark, "silver-buckets"), "transaction_id", buckets)
    scored = storage.write_bucketed(scored_rows(spark, sf_dir, silver), scratch_path(spark, "scored-buckets"), "transaction_id", buckets)
    return silver, scored, G.gold_anomalies(silver, scored, DEFAULT, order=False)


@query
def gold_bucketed(spark, sf_dir):
    """J1 + D13 + Q2 on bucketed layers: the latest score, the join and the count of repeated ids
    need no shuffle. Gold with, on every row, how often its id occurs in silver (once)."""
    silver, _, gold = bucketed_gold(spark, sf_dir)
    times = silver.groupBy("transaction_id").agg(F.count(F.lit(1)).alias("times_in_silver"))
    return gold.join(times, "transaction_id").select("transaction_id", "card_id", "anomaly_score", "risk_level", "risk_label",
                                                     "triggered_rules", "end_to_end_latency_ms", "times_in_silver")


@query
def risk_counts(spark, sf_dir):
    return RP.risk_counts(gold_rows(spark, sf_dir, order=False))


@query
def minute_summary(spark, sf_dir):
    df = RP.minute_summary(scored_rows(spark, sf_dir))
    return df.select("window_start", "window_end", "merchant_category", "risk_level", "country", "tx_count",
                     r2("total_amount"), F.round("avg_anomaly_score", 6).alias("avg_anomaly_score"))


@query
def daily_summary(spark, sf_dir):
    """A5 reads the scored layer (written once): its per-(day, card)
    aggregate feeds both the day totals and the ranking."""
    return RP.daily_summary(storage.materialize(spark, scored_rows(spark, sf_dir), "scored"))


@query
def daily_summary_payload(spark, sf_dir):
    """A5 as published: one JSON record of eight fields per day."""
    summary = RP.daily_summary(storage.materialize(spark, scored_rows(spark, sf_dir), "scored"))
    return RP.daily_summary_payload(summary, RUN_ID, F.lit(RUN_TS))


@query
def gold_layer(spark, sf_dir):
    """T1 + B7: the gold layer as the chain writes it -- in order, with its load
    time -- after bronze and silver passed their gates; read back with its place."""
    from ..session import scratch_path
    from . import batch
    base = scratch_path(spark, "layers")
    batch.run_layers(spark, bronze_rows(spark, sf_dir), base, run_id=RUN_ID, run_ts=_ts(RUN_TS), scored_at=scored_at())
    return spark.read.parquet(f"{base}/gold").select(
        "transaction_id", "anomaly_score", "risk_level", "triggered_rules", "event_timestamp",
        F.col("dbt_loaded_at").cast("timestamp_ntz").alias("loaded_at"))


@query
def anomaly_rate_5m(spark, sf_dir):
    df = RP.anomaly_rate(scored_rows(spark, sf_dir))
    return df.select("window_start", "window_end", "tx_count", "flagged_count", r4("anomaly_rate_pct"))


@query
def score_by_hour(spark, sf_dir):
    return RP.score_by_hour(scored_rows(spark, sf_dir))


@query
def tx_rate_by_category(spark, sf_dir):
    df = RP.tx_rate_by_category(scored_rows(spark, sf_dir))
    return df.select("window_start", "window_end", "merchant_category", "tx_count",
                     F.round("tx_per_sec", 6).alias("tx_per_sec"))


@query
def latest_100(spark, sf_dir):
    return RP.latest(scored_rows(spark, sf_dir), 100).select(
        "transaction_id", "event_timestamp", "card_id", "amount", "anomaly_score", "risk_level")


@query
def top_flagged_cards(spark, sf_dir):
    return RP.top_flagged_cards(scored_rows(spark, sf_dir), 10)


@query
def alert_timeline(spark, sf_dir):
    return RP.alert_timeline(scored_rows(spark, sf_dir))


@query
def alert_payload(spark, sf_dir):
    return RP.alert_payload(scored_rows(spark, sf_dir))


@query
def label_quality(spark, sf_dir):
    """Injected labels vs flags for the as-coded and the documented rules
    (one silver table scored both ways; labels from the deliveries). Silver is
    written once with its labels, in the columns that the rules read."""
    labels = bronze_rows(spark, sf_dir).select("transaction_id", F.col("_is_injected_anomaly").alias("label"))
    sv = RP.with_labels(silver_rows(spark, sf_dir).select(*S.RULE_COLUMNS), RP.labels_by_id(labels))
    sv = storage.materialize(spark, sv, "silver")
    as_coded = RP.label_quality(scored_rows(spark, sf_dir, sv), "as_coded")
    history = RP.label_quality(S.score_history(sv, DEFAULT, scored_at=scored_at()), "history")
    return as_coded.unionByName(history).select(
        "rule_set", "tx_count", "labelled_count", "flagged_count", "true_positives",
        F.round("flag_precision", 6).alias("flag_precision"), F.round("flag_recall", 6).alias("flag_recall"))


@query
def quality_report(spark, sf_dir):
    silver = silver_table(spark, sf_dir)
    layers = {
        "bronze": bronze_typed_rows(spark, sf_dir),
        "silver": silver,
        "gold": storage.materialize(spark, gold_rows(spark, sf_dir, order=False, silver=silver), "gold"),
    }
    return Q.quality_report(layers)


@query
def gated_layers(spark, sf_dir):
    """Q1-Q5 in the chain: the checks counted by the writes of bronze, silver and gold, which passed
    their gates; the report of the run."""
    from ..session import scratch_path
    from . import batch
    return batch.run_layers(spark, bronze_rows(spark, sf_dir), scratch_path(spark, "gated"), run_id=RUN_ID, run_ts=_ts(RUN_TS),
                            scored_at=scored_at()).report


# -- streams --------------------------------------------------------------------
# Each stream key stages the raw deliveries derived from ``events`` as
# time-ordered files in a fresh folder under the shared directory, runs the
# streaming queries with ``availableNow`` and returns the sink read back.

# A micro-batch is a span of STREAM_SLICE_DAYS, so their number grows with the data's span.
STREAM_CONTENT = ["transaction_id", "card_id", "user_id", "merchant_category", "amount", "currency", "country",
                  "event_timestamp", "amount_bucket", "is_high_risk_mcc", "is_off_hours"]


def _stream_dirs(spark, name):
    from ..session import scratch_path
    base = scratch_path(spark, name)
    return base, f"{base}/raw", f"{base}/ckpt", f"{base}/out"


def _raw(spark, sf_dir):
    """The raw deliveries. A file may have fewer splits than there are cores, and a record costs
    far more to make than its event to send: the events are dealt out first."""
    pin_utc(spark)
    events = fixture.read_table(spark, sf_dir, "events")
    return fixture.wire_records(events.repartition(spark.sparkContext.defaultParallelism))


def _silver_from(spark, raw_path, max_files=None):
    from ..streaming import pipeline as P
    bronze, _dead = P.bronze_stream(P.read_raw_stream(spark, raw_path, max_files))
    return P.silver_stream(bronze)


def _await(*queries):
    """Wait for queries that run side by side; if one fails, the others are stopped."""
    try:
        for q in queries:
            q.awaitTermination()
    finally:
        for q in queries:
            q.stop()


@query
def stream_dedup(spark, sf_dir):
    """ST5 + IO2: watermark dedup of redelivered records, append sink; one
    file slice per micro-batch."""
    from ..streaming import pipeline as P
    from ..streaming import staging
    base, raw, ckpt, out = _stream_dirs(spark, "stream-dedup")
    files = staging.stage(_raw(spark, sf_dir), raw, STREAM_SLICE_DAYS)
    silver = _silver_from(spark, raw, max_files=files).drop(P.ET)
    P.start_append(silver, out, f"{ckpt}/silver").awaitTermination()
    return spark.read.parquet(out).select(*STREAM_CONTENT)


@query
def stream_restart(spark, sf_dir):
    """IO11 + IO1 + ST6: run on the first half of the slices, stop, deliver
    the rest, restart from the same checkpoint; every record lands once."""
    from ..streaming import pipeline as P
    from ..streaming import staging
    base, raw, ckpt, out = _stream_dirs(spark, "stream-restart")
    rows = _raw(spark, sf_dir)
    slices = staging.slice_count(rows, STREAM_SLICE_DAYS)
    half = slices // 2
    files = staging.stage(rows, raw, STREAM_SLICE_DAYS, only=range(0, half))
    P.start_append(_silver_from(spark, raw, max_files=files).drop(P.ET), out, f"{ckpt}/silver").awaitTermination()
    staging.stage(rows, raw, STREAM_SLICE_DAYS, only=range(half, slices), files_per_slice=files)
    P.start_append(_silver_from(spark, raw, max_files=files).drop(P.ET), out, f"{ckpt}/silver").awaitTermination()
    return spark.read.parquet(out).select(*STREAM_CONTENT)


def slice_scope():
    """The slice of a row's event time: the scope of batch-relative scores, so
    that they do not depend on how a slice is cut into micro-batches' files."""
    return F.floor(F.unix_micros(F.col("event_timestamp").cast("timestamp")) / F.lit(STREAM_SLICE_DAYS * MICROS_PER_DAY))


def _scored_stream_run(spark, sf_dir, name, sink: dict | None = None):
    """One source query, one foreachBatch fan-out, one micro-batch per slice of
    event time; scores are relative to the slice."""
    from ..streaming import pipeline as P
    from ..streaming import staging
    base, raw, ckpt, out = _stream_dirs(spark, name)
    files = staging.stage(_raw(spark, sf_dir), raw, STREAM_SLICE_DAYS, order=staging.event_order(), aligned=True)
    sinks = P.Sinks(out, **(sink or {}))
    P.start_scoring(_silver_from(spark, raw, max_files=files), sinks, f"{ckpt}/score",
                    user_scope=slice_scope(), card_scope=slice_scope()).awaitTermination()
    return base, sinks


@query
def stream_scored_fanout(spark, sf_dir):
    """ST7 + ST9 + IO3 + IO5: the gold-anomalies branch of the fan-out."""
    _, sinks = _scored_stream_run(spark, sf_dir, "stream-fanout")
    return spark.read.parquet(sinks.path("gold_anomalies")).select(
        "transaction_id", "card_id", "amount", "anomaly_score", "risk_level", "triggered_rules")


@query
def stream_minute_summary(spark, sf_dir):
    """ST1 + ST2 + IO4: minute summary over the scored stream, append mode;
    only windows the watermark has closed are emitted."""
    from ..streaming import pipeline as P
    base, sinks = _scored_stream_run(spark, sf_dir, "stream-summary")
    scored_path = sinks.path("scored")
    schema = spark.read.parquet(scored_path).schema
    scored = spark.readStream.schema(schema).parquet(scored_path)
    summary = P.minute_summary_stream(scored)
    out = f"{base}/summary"
    P.start_append(summary, out, f"{base}/ckpt/summary").awaitTermination()
    df = spark.read.parquet(out)
    return df.select("window_start", "window_end", "merchant_category", "risk_level", "country", "tx_count",
                     r2("total_amount"), F.round("avg_anomaly_score", 6).alias("avg_anomaly_score"))


@query
def stream_sliding(spark, sf_dir):
    """ST3: sliding 10/1-minute card windows over the deduplicated stream."""
    from ..streaming import pipeline as P
    from ..streaming import staging
    base, raw, ckpt, out = _stream_dirs(spark, "stream-sliding")
    files = staging.stage(_raw(spark, sf_dir), raw, STREAM_SLICE_DAYS)
    partials = P.sliding_stream(_silver_from(spark, raw, max_files=files))
    P.start_append(partials, out, f"{ckpt}/sliding").awaitTermination()
    df = P.fold_sliding(spark.read.parquet(out))
    return df.select("card_id", "window_start", "window_end", "tx_count_window", r2("amount_sum_window"),
                     "amount_max_window", "countries_in_window")


@query
def stream_stateful_rules(spark, sf_dir):
    """ST8: R2h, R4h, R5h and day-granular 30-day stats kept in keyed state
    (transformWithState), one micro-batch per staged slice."""
    from ..streaming import pipeline as P
    from ..streaming import staging
    from ..streaming import state as ST
    ST.ensure_rocksdb(spark)
    base, raw, ckpt, out = _stream_dirs(spark, "stream-state")
    files = staging.stage(_raw(spark, sf_dir), raw, STREAM_SLICE_DAYS, order=staging.event_order())
    silver = _silver_from(spark, raw, max_files=files)
    card = P.start_append(ST.card_history(silver), f"{out}/card", f"{ckpt}/card")
    silver = _silver_from(spark, raw, max_files=files)
    _await(card, P.start_append(ST.user_history(silver), f"{out}/user", f"{ckpt}/user"))
    return _history_columns(ST.history_scores(spark.read.parquet(f"{out}/card"), spark.read.parquet(f"{out}/user")))


def _history_columns(df):
    return df.select("transaction_id", "tx_count_10min", "countries_60min_multi", "user_30d_n",
                     r4("user_30d_std"), r4("amount_zscore"), "is_first_high_risk", r2("score_amount_velocity"),
                     r2("score_tx_frequency"), "score_off_hours", "score_cross_border", "score_high_risk_mcc",
                     "anomaly_score", "risk_level", "triggered_rules")


@query
def stream_warm_start(spark, sf_dir):
    """ST8 started half-way: the keyed state is given from stored history -- daily
    partials of the users and the last 70 minutes of silver -- and the stream brings the deliveries
    from the cut on; their scores are those of a stream that ran from the beginning."""
    from ..streaming import pipeline as P
    from ..streaming import staging
    from ..streaming import state as ST
    ST.ensure_rocksdb(spark)
    base, raw, ckpt, out = _stream_dirs(spark, "stream-warm")
    rows, cut = storage.materialize(spark, _raw(spark, sf_dir), "deliveries"), _ts(CUT_TS)
    before, after = rows.filter(staging.event_order() < cut), rows.filter(staging.event_order() >= cut)
    history = SV.to_silver(B.typed_projection(P.bronze_stream(before)[0]))
    history = storage.materialize(spark, history, "warm-history")
    partials = storage.materialize(spark, FT.user_daily_partials(history), "warm-partials")
    files = staging.stage(after, raw, STREAM_SLICE_DAYS, order=staging.event_order())
    card = ST.card_history(_silver_from(spark, raw, max_files=files), start=ST.card_state(history, cut))
    card = P.start_append(card, f"{out}/card", f"{ckpt}/card")
    user = ST.user_history(_silver_from(spark, raw, max_files=files), start=ST.user_state(partials, history, cut))
    _await(card, P.start_append(user, f"{out}/user", f"{ckpt}/user"))
    return _history_columns(ST.history_scores(spark.read.parquet(f"{out}/card"), spark.read.parquet(f"{out}/user")))


@query
def stream_user_stats(spark, sf_dir):
    """J2 + A4 online: daily partials stored per micro-batch, merged and
    joined to the batch's rows inside ``foreachBatch``."""
    from ..streaming import pipeline as P
    from ..streaming import staging
    base, raw, ckpt, out = _stream_dirs(spark, "stream-user-stats")
    files = staging.stage(_raw(spark, sf_dir), raw, STREAM_SLICE_DAYS, order=staging.event_order())
    sinks = P.Sinks(out)
    P.start_scoring(_silver_from(spark, raw, max_files=files), sinks, f"{ckpt}/score", user_stats=True,
                    fold_every=2).awaitTermination()
    return spark.read.parquet(sinks.path("scored")).select(
        "transaction_id", "user_30d_n", r4("user_30d_std"), r4("amount_zscore"), r2("score_amount_velocity"))


@query
def stream_alerts(spark, sf_dir):
    """IO5: the alert branch of the fan-out through a sink chosen by format and
    options (JSON files here), read back; the clock field is left out."""
    from ..session import scratch_path
    path = scratch_path(spark, "alerts")
    _scored_stream_run(spark, sf_dir, "stream-alerts", {"alert_format": "json", "alert_options": {"path": path}})
    value = lambda f: F.get_json_object("value", f"$.{f}")
    return spark.read.schema("key string, value string").json(path).select(
        "key", value("transaction_id").alias("transaction_id"), value("amount").cast("double").alias("amount"),
        value("anomaly_score").cast("double").alias("anomaly_score"), value("risk_level").alias("risk_level"),
        value("triggered_rules").alias("triggered_rules"))


@query
def stream_live_feed(spark, sf_dir):
    """T2 + T3 online: the live feed and the flagged cards kept up by every micro-batch, over a stop, a restart
    from the checkpoint and a batch that is scored again."""
    from ..streaming import pipeline as P
    from ..streaming import staging
    base, raw, ckpt, out = _stream_dirs(spark, "stream-feed")
    rows = storage.materialize(spark, _raw(spark, sf_dir), "deliveries")
    order = staging.event_order()
    slices = staging.slice_count(rows, STREAM_SLICE_DAYS, order, aligned=True)
    sinks, files = P.Sinks(out), None
    scope = {"user_scope": slice_scope(), "card_scope": slice_scope(), "feed_rows": 100}
    for part in (range(0, slices // 2), range(slices // 2, slices)):
        files = staging.stage(rows, raw, STREAM_SLICE_DAYS, only=part, order=order, files_per_slice=files, aligned=True)
        P.start_scoring(_silver_from(spark, raw, max_files=files), sinks, f"{ckpt}/score", **scope).awaitTermination()
    last = max(r[0] for r in spark.read.parquet(sinks.path("scored")).select("batch_id").distinct().collect())
    P.keep_live_feed(P.read_batch(spark, sinks.path("scored"), last), sinks, last)      # as a replay does
    feed = P.live_feed(spark, sinks).select(
        F.lit("latest").alias("kind"), "card_id", "transaction_id", "event_timestamp", "amount", "anomaly_score", "risk_level")
    cards = P.flagged_cards(spark, sinks).select(
        F.lit("cards").alias("kind"), "card_id", "flagged_count", F.col("max_score").alias("anomaly_score"), "tx_count")
    return feed.unionByName(cards, allowMissingColumns=True)


@query
def stream_history_batches(spark, sf_dir):
    """ST8 by micro-batches: the documented rules from the batch plans over each batch and the history that the
    batches before it left, with no task per key; the scores of ``stream_stateful_rules``."""
    from ..streaming import history as H
    from ..streaming import pipeline as P
    from ..streaming import staging
    base, raw, ckpt, out = _stream_dirs(spark, "stream-history")
    files = staging.stage(_raw(spark, sf_dir), raw, STREAM_SLICE_DAYS, order=staging.event_order())
    sinks = P.Sinks(out)
    H.start_history(_silver_from(spark, raw, max_files=files), sinks, f"{ckpt}/history", fold_every=2).awaitTermination()
    return _history_columns(spark.read.parquet(sinks.path("history_scored")))


def delayed_delivery():
    """Delivery time, with every fiftieth record held up by six days: what a watermark is for."""
    held = F.col("kafka_offset") % 50 == 7
    return F.when(held, F.timestamp_add("DAY", F.lit(6), "kafka_ingest_time")).otherwise(F.col("kafka_ingest_time"))


@query
def stream_late_rows(spark, sf_dir):
    """ST4: records delivered behind the watermark, in a table of their own, with whether silver has the
    transaction from another delivery."""
    from ..streaming import late as L
    from ..streaming import pipeline as P
    from ..streaming import staging
    base, raw, ckpt, out = _stream_dirs(spark, "stream-late")
    rows = storage.materialize(spark, _raw(spark, sf_dir), "deliveries")
    files = staging.stage(rows, raw, STREAM_SLICE_DAYS, order=delayed_delivery(), aligned=True)
    sinks = P.Sinks(out)
    L.start_late(P.read_raw_stream(spark, raw, files), sinks, f"{ckpt}/late").awaitTermination()
    silver = spark.read.parquet(sinks.path("silver")).select("transaction_id", F.lit(True).alias("in_silver"))
    return spark.read.parquet(sinks.path("late_rows")).join(silver, "transaction_id", "left").select(
        "transaction_id", "kafka_offset", "kafka_partition", "event_timestamp", "watermark",
        F.coalesce("in_silver", F.lit(False)).alias("in_silver"))
