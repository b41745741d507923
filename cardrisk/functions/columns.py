"""Column expressions shared by batch and streaming plans.

All are built-in Spark expressions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import (
    AMOUNT_BUCKET_TOP,
    AMOUNT_BUCKETS,
    DEFAULT,
    RISK_LABEL_ANOMALY,
    RISK_LABEL_NORMAL,
    RISK_LABEL_SUSPICIOUS,
    ScoringConfig,
)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- time ---------------------------------------------------------------------

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_micros(ts) -> Column:
    """Microseconds since the epoch of a naive (UTC) timestamp, zone-free."""
    return F.timestamp_diff("MICROSECOND", F.expr(_EPOCH_NTZ), col(ts))


def parse_event_time(s) -> Column:
    """ISO-8601 text -> naive UTC timestamp; junk -> NULL (ANSI-safe)."""
    return F.try_to_timestamp(col(s)).cast("timestamp_ntz")


def ms_between(start, end) -> Column:
    return F.timestamp_diff("MILLISECOND", col(start), col(end))


# -- silver derivations (S1-S8) ----------------------------------------------

def norm_upper(c) -> Column:
    return F.upper(F.trim(col(c)))


def norm_lower(c) -> Column:
    return F.lower(F.trim(col(c)))


def amount_bucket(amount) -> Column:
    a = col(amount)
    expr = None
    for bound, label in AMOUNT_BUCKETS:
        expr = F.when(a < bound, F.lit(label)) if expr is None else expr.when(a < bound, F.lit(label))
    return expr.otherwise(F.lit(AMOUNT_BUCKET_TOP))


def is_high_risk_category(category, cfg: ScoringConfig = DEFAULT) -> Column:
    return F.coalesce(norm_upper(category).isin(list(cfg.high_risk_categories)), F.lit(False))


def is_off_hours(hour, cfg: ScoringConfig = DEFAULT) -> Column:
    h = col(hour)
    return F.coalesce((h >= cfg.off_hours_start) & (h < cfg.off_hours_end), F.lit(False))


def is_foreign_country(country, cfg: ScoringConfig = DEFAULT) -> Column:
    return F.coalesce(norm_upper(country) != cfg.home_country, F.lit(False))


# -- scores (R1-R7, S11-S14) --------------------------------------------------

def clamp(c, lo: float = 0.0, hi: float = 100.0) -> Column:
    return F.least(F.lit(hi), F.greatest(F.lit(lo), col(c)))


def zscore(amount, mean, std) -> Column:
    """(x - mean) / std, 0.0 when std is NULL or not positive."""
    s = col(std)
    return F.when(s > 0, (col(amount) - col(mean)) / s).otherwise(F.lit(0.0))


def velocity_score(z, cfg: ScoringConfig = DEFAULT) -> Column:
    return clamp(col(z) / cfg.zscore_cap * 100.0)


def frequency_score(count, cfg: ScoringConfig = DEFAULT) -> Column:
    return F.least(F.lit(100.0), col(count) / F.lit(float(cfg.freq_threshold)) * 100.0)


def flag_score(flag) -> Column:
    return F.when(col(flag), F.lit(100.0)).otherwise(F.lit(0.0))


def cross_border_score(international, amount, cfg: ScoringConfig = DEFAULT) -> Column:
    i = col(international)
    return (F.when(i & (col(amount) > cfg.cross_border_amount), F.lit(100.0))
            .when(i, F.lit(50.0)).otherwise(F.lit(0.0)))


def composite_score(cfg: ScoringConfig = DEFAULT, clamp_result: bool = True) -> Column:
    total = None
    for name, w in cfg.weights.items():
        term = F.col(name) * F.lit(float(w))
        total = term if total is None else total + term
    total = F.round(total, 2)
    return clamp(total) if clamp_result else total


def risk_level(score, cfg: ScoringConfig = DEFAULT) -> Column:
    s = col(score)
    return (F.when(s >= cfg.anomaly_threshold, F.lit("HIGH"))
            .when(s >= cfg.suspicious_threshold, F.lit("MEDIUM")).otherwise(F.lit("LOW")))


def risk_label(score, cfg: ScoringConfig = DEFAULT) -> Column:
    s = col(score)
    return (F.when(s >= cfg.anomaly_threshold, F.lit(RISK_LABEL_ANOMALY))
            .when(s >= cfg.suspicious_threshold, F.lit(RISK_LABEL_SUSPICIOUS))
            .otherwise(F.lit(RISK_LABEL_NORMAL)))


def triggered_rules(velocity_fired, frequency_fired, off_fired, border_fired, mcc_fired) -> Column:
    """Comma list of fired rule tags; '' when none (concat_ws skips NULLs)."""
    return F.concat_ws(
        ",",
        F.when(velocity_fired, F.lit("amount_velocity")),
        F.when(frequency_fired, F.lit("tx_frequency")),
        F.when(off_fired, F.lit("off_hours")),
        F.when(border_fired, F.lit("cross_border")),
        F.when(mcc_fired, F.lit("high_risk_mcc")),
    )


def default_triggers(cfg: ScoringConfig = DEFAULT) -> Column:
    return triggered_rules(
        F.col("score_amount_velocity") >= cfg.velocity_tag_score,
        F.col("score_tx_frequency") >= cfg.freq_tag_score,
        F.col("score_off_hours") > 0,
        F.col("score_cross_border") > 0,
        F.col("score_high_risk_mcc") > 0,
    )
