"""The five scoring rules, each in its as-coded and its history form.

As coded (R1, R2) the statistics are taken over a *scope* -- a micro-batch in
the stream, or a grouping column in batch. They are computed as a grouped
aggregate (partial aggregation on the map side, so a hot user or card is
combined before the shuffle), written once and joined back on the key. The
written table is what lets AQE act on a hot key: it broadcasts a small
statistics side, and where it is large both sides of the join are plain
shuffles, whose skewed partitions it splits (a join straight on the aggregate
would reuse the aggregate's shuffle, which it cannot split).

History forms (R1h, R2h, R4h, R5h) follow the documented rules with trailing
time frames; see ``windows.py`` for how hot keys are split by time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import DEFAULT, MICROS_PER_DAY, MICROS_PER_HOUR, MICROS_PER_MINUTE, ScoringConfig
from ..functions.columns import (
    cross_border_score,
    flag_score,
    frequency_score,
    velocity_score,
    zscore,
)
from ..sources.scratch import materialize
from .windows import bucketed_frames, prior_moments

TS = "event_timestamp"


def _scoped(df: DataFrame, name: str, scope: Column | None) -> tuple[DataFrame, list[str]]:
    if scope is None:
        return df, []
    return df.withColumn(name, scope), [name]


def _written(stats: DataFrame, name: str) -> DataFrame:
    return materialize(stats.sparkSession, stats, name)


# -- R1 / R1h: amount velocity -------------------------------------------------

def amount_velocity(df: DataFrame, cfg: ScoringConfig = DEFAULT, scope: Column | None = None) -> DataFrame:
    """Z of the amount against the user's mean/stddev over the scope
    (the scored row included, as coded)."""
    df, sk = _scoped(df, "_scope_u", scope)
    stats = df.groupBy("user_id", *sk).agg(F.avg("amount").alias("user_batch_mean"),
                                           F.stddev("amount").alias("user_batch_std"))
    out = df.join(_written(stats, "user-stats"), on=["user_id", *sk], how="left")
    out = out.withColumn("amount_zscore", zscore("amount", "user_batch_mean", "user_batch_std"))
    out = out.withColumn("score_amount_velocity", velocity_score("amount_zscore", cfg))
    return out.drop(*sk)


def amount_velocity_history(df: DataFrame, cfg: ScoringConfig = DEFAULT,
                            bucket_us: int = MICROS_PER_HOUR) -> DataFrame:
    """R1h: z against the user's prior ``history_days`` (current row and
    same-instant rows excluded); fewer than ``min_history_rows`` -> 0.

    Hour buckets: the running window over raw rows is partitioned by
    (user, hour), so a hot user's rows spread over one task per hour; the
    30-day part sums at most 720 hourly partials per user."""
    out = prior_moments(df, "user_id", TS, "amount", cfg.history_days * MICROS_PER_DAY, bucket_us,
                        prefix="user_30d")
    enough = F.col("user_30d_n") >= cfg.min_history_rows
    out = out.withColumn("amount_zscore",
                         F.when(enough, zscore("amount", "user_30d_mean", "user_30d_std")).otherwise(F.lit(0.0)))
    return out.withColumn("score_amount_velocity", velocity_score("amount_zscore", cfg))


# -- R2 / R2h: frequency -------------------------------------------------------

def tx_frequency(df: DataFrame, cfg: ScoringConfig = DEFAULT, scope: Column | None = None) -> DataFrame:
    """R2: the card's row count in the scope / threshold * 100, capped."""
    df, sk = _scoped(df, "_scope_c", scope)
    counts = df.groupBy("card_id", *sk).agg(F.count(F.lit(1)).alias("tx_count_batch"))
    out = df.join(_written(counts, "card-counts"), on=["card_id", *sk], how="left")
    out = out.withColumn("score_tx_frequency", frequency_score("tx_count_batch", cfg))
    return out.drop(*sk)


def tx_frequency_history(df: DataFrame, cfg: ScoringConfig = DEFAULT, bucket_us: int | None = None) -> DataFrame:
    """R2h: the card's rows in the trailing window, current row included."""
    out = bucketed_frames(df, "card_id", TS, bucket_us or cfg.history_bucket_minutes * MICROS_PER_MINUTE,
                          count_frame_us=cfg.freq_window_minutes * MICROS_PER_MINUTE, count_name="tx_count_10min")
    return out.withColumn("score_tx_frequency", frequency_score("tx_count_10min", cfg))


# -- R3 off-hours; R4 / R4h cross-border; R5 / R5h category -------------------

def off_hours(df: DataFrame) -> DataFrame:
    return df.withColumn("score_off_hours", flag_score("is_off_hours"))


# Representative zone per country for the local-time variant (a parameter,
# not a reference value); unknown countries fall back to UTC.
COUNTRY_ZONES = {
    "US": "America/New_York", "CA": "America/Toronto", "GB": "Europe/London", "DE": "Europe/Berlin",
    "FR": "Europe/Paris", "AU": "Australia/Sydney", "CN": "Asia/Shanghai", "RU": "Europe/Moscow",
    "NG": "Africa/Lagos", "BR": "America/Sao_Paulo", "MX": "America/Mexico_City",
}


def off_hours_local(df: DataFrame, cfg: ScoringConfig = DEFAULT, zones: dict | None = None) -> DataFrame:
    """R3h (D8): off-hours by the local clock of the transaction's country.

    The zone table is a literal map in the expression (fixed, tiny: no join,
    no broadcast); the conversion is the built-in ``from_utc_timestamp``.
    """
    z = zones or COUNTRY_ZONES
    zone_map = F.create_map(*[F.lit(x) for kv in z.items() for x in kv])
    zone = F.coalesce(F.element_at(zone_map, F.col("country")), F.lit("UTC"))
    local = F.from_utc_timestamp(F.col(TS).cast("timestamp"), zone)
    hour = F.hour(local)
    flag = F.coalesce((hour >= cfg.off_hours_start) & (hour < cfg.off_hours_end), F.lit(False))
    return (df.withColumn("local_hour", hour).withColumn("is_off_hours_local", flag)
              .withColumn("score_off_hours", flag_score("is_off_hours_local")))


def cross_border(df: DataFrame, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    return df.withColumn("score_cross_border", cross_border_score("is_international", "amount", cfg))


def _multi_country(out: DataFrame) -> DataFrame:
    # two or more countries in the frame: its smallest and largest differ
    multi = F.coalesce(F.col("_cmin") != F.col("_cmax"), F.lit(False))
    return (out.withColumn("countries_60min_multi", multi)
               .withColumn("score_cross_border", flag_score("countries_60min_multi"))
               .drop("_cmin", "_cmax"))


def cross_border_history(df: DataFrame, cfg: ScoringConfig = DEFAULT, bucket_us: int | None = None) -> DataFrame:
    """R4h: 100 when the card's trailing window (current row included) holds
    two or more countries. min <> max needs no set of countries in memory."""
    out = bucketed_frames(df, "card_id", TS, bucket_us or cfg.history_bucket_minutes * MICROS_PER_MINUTE,
                          minmax_col="country", minmax_frame_us=cfg.cross_border_window_minutes * MICROS_PER_MINUTE,
                          min_name="_cmin", max_name="_cmax")
    return _multi_country(out)


def card_history(df: DataFrame, cfg: ScoringConfig = DEFAULT, bucket_us: int | None = None) -> DataFrame:
    """R2h and R4h together: one set of (card, bucket) partitions and one
    window pass serve the 10- and the 60-minute frames. Buckets are a minute
    by default, so a hot card is spread over one task per minute of its
    traffic (``windows.bucketed_frames``)."""
    out = bucketed_frames(df, "card_id", TS, bucket_us or cfg.history_bucket_minutes * MICROS_PER_MINUTE,
                          count_frame_us=cfg.freq_window_minutes * MICROS_PER_MINUTE, count_name="tx_count_10min",
                          minmax_col="country", minmax_frame_us=cfg.cross_border_window_minutes * MICROS_PER_MINUTE,
                          min_name="_cmin", max_name="_cmax")
    return _multi_country(out.withColumn("score_tx_frequency", frequency_score("tx_count_10min", cfg)))


def high_risk_mcc(df: DataFrame) -> DataFrame:
    return df.withColumn("score_high_risk_mcc", flag_score("is_high_risk_mcc"))


def first_high_risk_use(df: DataFrame) -> DataFrame:
    """R5h: 100 on the user's first row in a high-risk category.

    First = smallest (event time, transaction id) -- a min() aggregate per
    (user, category) over high-risk rows only, combined map-side and joined
    back to those rows; all others score 0 without a shuffle.
    """
    order = F.struct(F.col(TS).alias("t"), F.col("transaction_id").alias("id"))
    risky = F.coalesce(F.col("is_high_risk_mcc"), F.lit(False))
    keys = ["user_id", "merchant_category"]
    high = df.filter(risky)
    firsts = _written(high.groupBy(*keys).agg(F.min(order).alias("_first")), "first-use")
    high = high.join(firsts, on=keys, how="left").withColumn(
        "is_first_high_risk", F.coalesce(order == F.col("_first"), F.lit(False)))
    out = high.select(*df.columns, "is_first_high_risk").unionByName(
        df.filter(~risky).withColumn("is_first_high_risk", F.lit(False)))
    return out.withColumn("score_high_risk_mcc", flag_score("is_first_high_risk"))
