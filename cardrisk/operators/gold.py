"""Gold: scored-layer projection (S11), silver x scores join (J1), labels (S14),
latency (S10), risk filter (B9) and ordering (T1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, ScoringConfig
from ..functions.columns import ms_between, risk_label

RULE_SCORES = ("score_amount_velocity", "score_tx_frequency", "score_off_hours", "score_cross_border",
               "score_high_risk_mcc")
FLAGGED = ("MEDIUM", "HIGH")


def flagged(scored: DataFrame) -> DataFrame:
    """MEDIUM and HIGH rows -- the streaming gold-anomalies output."""
    return scored.filter(F.col("risk_level").isin(*FLAGGED))


def score_projection(scores: DataFrame) -> DataFrame:
    """The score columns the gold model reads, rounded."""
    return scores.select(
        "transaction_id",
        F.round("anomaly_score", 2).alias("anomaly_score"),
        "risk_level",
        "triggered_rules",
        F.round("amount_zscore", 4).alias("amount_zscore"),
        *[F.round(c, 2).alias(c) for c in RULE_SCORES],
        "scored_at",
    )


def latest_score(scores: DataFrame) -> DataFrame:
    """One score per transaction (the latest), so producer retries do
    not fan out the join. Planned as a WindowGroupLimit (map-side top-1)."""
    w = Window.partitionBy("transaction_id").orderBy(F.col("scored_at").desc(), F.col("anomaly_score").desc())
    return scores.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def gold_anomalies(silver: DataFrame, scores: DataFrame, cfg: ScoringConfig = DEFAULT,
                   dedup_scores: bool = True, order: bool = True, loaded_at: Column | None = None) -> DataFrame:
    """Silver INNER JOIN flagged scores on transaction_id.

    The latest score of a transaction decides (D13), so the flag is tested after it is
    found: a transaction rescored to LOW leaves gold, one rescored to HIGH enters it.
    Both sides are large at scale: a sort-merge join on the key, with the
    strategy left to AQE (broadcast when the flagged side turns out small).
    """
    s = score_projection(scores)
    if dedup_scores:
        s = latest_score(s)
    s = flagged(s)
    t = silver.select(
        "transaction_id", "card_id", "user_id", "merchant_id", "merchant_name", "merchant_category",
        "amount", "currency", "amount_bucket", "country", "city", "is_international", "is_foreign_country",
        "card_present", "is_cnp", "device_type", "event_timestamp", "tx_hour", "tx_day_of_week", "tx_date",
        "is_off_hours", "is_high_risk_mcc",
    )
    out = t.join(s, on="transaction_id", how="inner")
    out = (out.withColumn("risk_label", risk_label("anomaly_score", cfg))
              .withColumn("end_to_end_latency_ms", ms_between("event_timestamp", "scored_at")))
    if loaded_at is not None:
        out = out.withColumn("dbt_loaded_at", loaded_at)
    return out.orderBy(*gold_order()) if order else out


def gold_order() -> tuple[Column, Column]:
    """T1."""
    return F.col("anomaly_score").desc(), F.col("event_timestamp").desc()
