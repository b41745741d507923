"""Composite scoring (R6, R7), risk level (S13), triggered rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, ScoringConfig
from ..functions.columns import composite_score, default_triggers, risk_level, triggered_rules
from ..sources.scratch import materialize
from . import features, rules

# Fixed: the silver columns that the rules and their scores read.
RULE_COLUMNS = ("transaction_id", "card_id", "user_id", "merchant_category", "amount", "country", "event_timestamp",
                "is_international", "is_off_hours", "is_high_risk_mcc")


def finish(df: DataFrame, cfg: ScoringConfig = DEFAULT, triggers: Column | None = None,
           scored_at: Column | None = None) -> DataFrame:
    out = (df.withColumn("anomaly_score", composite_score(cfg))
             .withColumn("risk_level", risk_level("anomaly_score", cfg))
             .withColumn("triggered_rules", triggers if triggers is not None else default_triggers(cfg)))
    return out.withColumn("scored_at", scored_at if scored_at is not None else F.localtimestamp())


def score_as_coded(silver: DataFrame, cfg: ScoringConfig = DEFAULT, user_scope: Column | None = None,
                   card_scope: Column | None = None, scored_at: Column | None = None) -> DataFrame:
    """The five rules as the streaming job computes them; statistics over the
    scope (whole input when None -- in a stream, the micro-batch)."""
    df = rules.amount_velocity(silver, cfg, user_scope)
    df = rules.tx_frequency(df, cfg, card_scope)
    df = rules.off_hours(df)
    df = rules.cross_border(df, cfg)
    df = rules.high_risk_mcc(df)
    return finish(df, cfg, scored_at=scored_at)


def score_with_stats(silver: DataFrame, stats: DataFrame, cfg: ScoringConfig = DEFAULT,
                     card_scope: Column | None = None, scored_at: Column | None = None) -> DataFrame:
    """As coded, but the velocity rule reads stored user statistics."""
    df = features.score_with_user_stats(silver, stats, cfg)
    df = rules.tx_frequency(df, cfg, card_scope)
    df = rules.high_risk_mcc(rules.cross_border(rules.off_hours(df), cfg))
    return finish(df, cfg, scored_at=scored_at)


def score_history(silver: DataFrame, cfg: ScoringConfig = DEFAULT, scored_at: Column | None = None) -> DataFrame:
    """The five rules as documented: 30-day velocity, 10-minute frequency,
    off-hours, two countries in 60 minutes, first use of a high-risk category.

    R5h comes first and is written: it takes its input in two parts (high-risk
    rows and the rest), each of which would run the windows again."""
    df = materialize(silver.sparkSession, rules.first_high_risk_use(silver), "silver-first-uses")
    df = rules.amount_velocity_history(df, cfg)
    df = rules.card_history(df, cfg)              # R2h + R4h in one window pass
    df = rules.off_hours(df)
    return finish(df, cfg, triggers=history_triggers(cfg), scored_at=scored_at)


def history_triggers(cfg: ScoringConfig = DEFAULT) -> Column:
    """The rules that fired, as documented (the count itself is tested for R2h)."""
    return triggered_rules(
        F.col("score_amount_velocity") >= cfg.velocity_tag_score,
        F.col("tx_count_10min") > cfg.freq_threshold,
        F.col("score_off_hours") > 0,
        F.col("score_cross_border") > 0,
        F.col("score_high_risk_mcc") > 0,
    )


def rule_counts(scored: DataFrame) -> DataFrame:
    """S12 array form: how often each rule fired."""
    tags = F.explode(F.split(F.col("triggered_rules"), ","))
    return (scored.filter(F.col("triggered_rules") != "")
                  .select(tags.alias("rule"))
                  .groupBy("rule").agg(F.count(F.lit(1)).alias("fired")))
