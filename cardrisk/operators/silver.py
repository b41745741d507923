"""Silver: validity filter (B8), latest-per-key dedup (W1), derivations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, ScoringConfig
from ..functions.columns import (
    amount_bucket,
    is_foreign_country,
    is_high_risk_category,
    is_off_hours,
    ms_between,
    norm_lower,
    norm_upper,
)


def dedup_order():
    return (F.col("ingested_at").desc(), F.col("kafka_partition").desc(), F.col("kafka_offset").desc())


def valid(df: DataFrame, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    """B8. As coded, currency and the cap are tested on the raw values (D12);
    ``normalize_first`` tests the normalised ones instead."""
    amount = F.col("amount")
    currency = F.col("currency")
    if cfg.normalize_first:
        amount = F.round(amount, 2)
        currency = norm_upper(currency)
    return df.filter(
        F.col("transaction_id").isNotNull()
        & F.col("card_id").isNotNull()
        & amount.isNotNull()
        & (amount > 0.0)
        & (amount <= cfg.max_amount)
        & currency.isin(list(cfg.currencies))
    )


def dedup_latest(df: DataFrame, key: str = "transaction_id", order=None) -> DataFrame:
    """Keep the latest delivery per key (ties broken by partition, offset).

    ``row_number() = 1`` is planned by Catalyst as a WindowGroupLimit, which
    keeps one row per key on the map side before the shuffle, so a replayed
    key does not pile up in one task.
    """
    w = Window.partitionBy(key).orderBy(*(order or dedup_order()))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def enrich(df: DataFrame, cfg: ScoringConfig = DEFAULT, loaded_at: Column | None = None) -> DataFrame:
    """S1-S9 on typed bronze rows; the bucket uses the unrounded amount."""
    ts = F.col("event_timestamp")
    cols = [
        "transaction_id",
        "card_id",
        "user_id",
        "merchant_id",
        F.trim("merchant_name").alias("merchant_name"),
        norm_upper("merchant_category").alias("merchant_category"),
        F.round("amount", 2).alias("amount"),
        norm_upper("currency").alias("currency"),
        norm_upper("country").alias("country"),
        F.trim("city").alias("city"),
        "event_timestamp",
        "is_international",
        "card_present",
        norm_lower("device_type").alias("device_type"),
        "ingested_at",
        "kafka_ingest_time",
        "kafka_offset",
        "kafka_partition",
        "pipeline_version",
        F.hour(ts).alias("tx_hour"),
        F.dayofweek(ts).alias("tx_day_of_week"),
        F.to_date(ts).alias("tx_date"),
        F.weekofyear(ts).alias("tx_week"),
        F.month(ts).alias("tx_month"),
        amount_bucket("amount").alias("amount_bucket"),
        is_high_risk_category("merchant_category", cfg).alias("is_high_risk_mcc"),
        (~F.col("card_present")).alias("is_cnp"),
        is_off_hours(F.hour(ts), cfg).alias("is_off_hours"),
        is_foreign_country("country", cfg).alias("is_foreign_country"),
        ms_between("event_timestamp", "kafka_ingest_time").alias("kafka_latency_ms"),
    ]
    out = df.select(*cols)
    if loaded_at is not None:
        out = out.withColumn("dbt_loaded_at", loaded_at)
    return out


def to_silver(bronze_typed: DataFrame, cfg: ScoringConfig = DEFAULT, loaded_at: Column | None = None) -> DataFrame:
    return enrich(dedup_latest(valid(bronze_typed, cfg)), cfg, loaded_at)


def upsert(target: DataFrame, incoming: DataFrame, key: str = "transaction_id") -> DataFrame:
    """IO8 + J4: merge on ``key`` -- rows of the target that are not replaced,
    plus all incoming rows. Both sides shuffle on the key once (anti-join);
    the result is written to a new version, never over the path being read."""
    kept = target.join(incoming.select(key), on=key, how="left_anti")
    return kept.unionByName(incoming, allowMissingColumns=True)
