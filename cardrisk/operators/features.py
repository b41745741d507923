"""Card and user features: sliding card windows (A1), 30-day user statistics
(A4) and their join to transactions (J2), cross-border evidence pairs (J3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import DEFAULT, MICROS_PER_MINUTE, ScoringConfig
from ..functions.columns import epoch_micros, velocity_score, zscore
from ..functions.moments import CENTS, cents, mean_of, squared, std_of


def covering_windows(start: Column, length: str, slide: str) -> Column:
    """One row per sliding window that covers the cell [start, start + slide):
    the windows of ``F.window(ts, length, slide)`` as structs (start, end).
    ``length`` must be a whole number of slides."""
    n = F.lit(seconds(length) // seconds(slide))
    step, span = seconds(slide), seconds(length)
    if span % step:
        raise ValueError("length must be a whole number of slides")
    back = lambda k: F.timestamp_add("SECOND", k * (-step), start)
    return F.explode(F.transform(F.sequence(F.lit(0), n - 1), lambda k: F.struct(
        back(k).alias("start"), F.timestamp_add("SECOND", F.lit(span), back(k)).alias("end"))))


def seconds(interval: str) -> int:
    """Whole seconds of an interval such as '10 minutes'."""
    count, unit = interval.split()
    return int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def card_sliding_features(silver: DataFrame, length: str = "10 minutes", slide: str = "1 minute",
                          ts: str = "event_timestamp") -> DataFrame:
    """A1: per card and sliding window -- count, sum, max and the countries seen.

    The reference collects the country of every row into a list. Here the
    list is kept as its multiset, ``country:count`` pairs in country order:
    the same information, bounded by the number of countries rather than by
    the number of rows a hot card produces in a window. Rows are combined
    map-side into cells of one slide (card, minute, country) first; only these
    cells are copied to the windows that cover them.
    """
    per_slide = (silver.groupBy("card_id", F.window(ts, slide).alias("cell"), "country")
                       .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("s"), F.max("amount").alias("m")))
    per_country = (per_slide.select("card_id", "country", "n", "s", "m",
                                    covering_windows(F.col("cell.start"), length, slide).alias("window"))
                            .groupBy("card_id", "window", "country")
                            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.max("m").alias("m")))
    pair = F.when(F.col("country").isNotNull(), F.concat(F.col("country"), F.lit(":"), F.col("n").cast("string")))
    out = per_country.groupBy("card_id", "window").agg(
        F.sum("n").alias("tx_count_window"),
        F.sum("s").alias("amount_sum_window"),
        F.max("m").alias("amount_max_window"),
        F.array_join(F.array_sort(F.collect_list(pair)), ",").alias("countries_in_window"),
    )
    return (out.withColumn("window_start", F.col("window.start"))
               .withColumn("window_end", F.col("window.end")).drop("window"))


def user_daily_partials(silver: DataFrame) -> DataFrame:
    """Mergeable per-(user, day) partials in whole cents: count, sum, sum of squares."""
    a = cents(F.col("amount"))
    return silver.groupBy("user_id", "tx_date").agg(F.count(a).alias("n"), F.sum(a).alias("s"),
                                                   F.sum(squared(a)).alias("ss"))


def _moments(n, s, ss, prefix: str):
    return [n.alias(f"{prefix}_n"), (s / CENTS).alias(f"{prefix}_sum"), mean_of(n, s).alias(f"{prefix}_mean"),
            std_of(n, s, ss).alias(f"{prefix}_std")]


def user_stats(silver: DataFrame | None, cfg: ScoringConfig = DEFAULT, partials: DataFrame | None = None) -> DataFrame:
    """A4: per user and day d, statistics over days d-30 .. d-1.

    Built from daily partials (written once per day, merged here) so the
    30-day figures never rescan raw rows; the window runs over at most one
    row per user and day.
    """
    p = partials if partials is not None else user_daily_partials(silver)
    day = F.unix_date("tx_date")
    w = Window.partitionBy("user_id").orderBy(day).rangeBetween(-cfg.history_days, -1)
    n = F.coalesce(F.sum("n").over(w), F.lit(0))
    s = F.coalesce(F.sum("s").over(w), F.lit(0))
    ss = F.coalesce(F.sum("ss").over(w), F.lit(0))
    return p.select("user_id", F.col("tx_date").alias("stats_date"), *_moments(n, s, ss, "user_30d"))


def score_with_user_stats(silver: DataFrame, stats: DataFrame, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    """Transactions LEFT JOIN the stats of their day; no stats -> z 0."""
    j = silver.join(stats.withColumnRenamed("stats_date", "tx_date"), on=["user_id", "tx_date"], how="left")
    enough = F.coalesce(F.col("user_30d_n"), F.lit(0)) >= cfg.min_history_rows
    j = j.withColumn("amount_zscore",
                     F.when(enough, zscore("amount", "user_30d_mean", "user_30d_std")).otherwise(F.lit(0.0)))
    return j.withColumn("score_amount_velocity", velocity_score("amount_zscore", cfg))


def latest_two(rows: DataFrame, *cell: str) -> DataFrame:
    """Per cell its latest row ``_c1`` and its latest row ``_c2`` of a country other than that one's, as structs
    (_t, transaction_id, event_timestamp, country).

    The pair is a mergeable aggregate -- of two cells' pairs, the later pair's first row stays first and the
    second is the latest of the others with another country -- and holds, for any country, the latest row of
    another one. Here: the latest row per (cell, country), combined map-side, then the two latest of a cell's
    countries, limited map-side too.
    """
    row = F.struct("_t", "transaction_id", "event_timestamp", "country")
    per_country = rows.groupBy(*cell, "country").agg(F.max(row).alias("_row"))
    w = Window.partitionBy(*cell).orderBy(F.col("_row").desc())
    top = per_country.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= 2)
    nth = lambda n: F.max(F.when(F.col("_n") == n, F.col("_row"))).alias(f"_c{n}")
    return top.groupBy(*cell).agg(nth(1), nth(2))


def _another_country(first: str, second: str) -> Column:
    """Of a pair the latest row of a country other than the current row's."""
    return F.when(F.col(f"{first}.country") != F.col("country"), F.col(first)).otherwise(F.col(second))


def cross_border_pairs(silver: DataFrame, cfg: ScoringConfig = DEFAULT, bucket_minutes: int = 1) -> DataFrame:
    """For each transaction, its evidence partner -- the card's latest
    earlier transaction (by time, then id) in a different country within the
    window. One partner per row, not every pair.

    Cells of one minute keep their ``latest_two``; a window over a card's cells (split into spans of one
    frame, each with the span before it as context, so at most two frames of cells) merges the pairs of the cells
    before each. In its own cell a row's partner is the row just before the
    current run of same-country rows, by ``lag`` and a carried ``last``; where the run began before the cell,
    the merged pair has it. Rows meet only within a (card, minute), by running windows; no pairs are materialised.
    """
    frame, cell = cfg.cross_border_window_minutes * MICROS_PER_MINUTE, bucket_minutes * MICROS_PER_MINUTE
    cells_per_span = -(-frame // cell)
    base = (silver.filter(F.col("country").isNotNull())
                  .select("card_id", "transaction_id", "event_timestamp", "country")
                  .withColumn("_t", epoch_micros("event_timestamp"))
                  .withColumn("_cell", F.floor(F.col("_t") / F.lit(cell))))

    # what the cells before a cell know
    span = F.floor(F.col("_cell") / F.lit(cells_per_span))
    pairs = latest_two(base, "card_id", "_cell").withColumn("_own", F.explode(F.array(F.lit(True), F.lit(False))))
    pairs = pairs.withColumn("_span", F.when(F.col("_own"), span).otherwise(span + 1))
    by_cell = Window.partitionBy("card_id", "_span").orderBy("_cell")
    before = by_cell.rowsBetween(Window.unboundedPreceding, -1)
    previous = F.lag("_c1").over(by_cell)
    pairs = pairs.withColumn("_other", F.coalesce(
        "_c2", F.when(previous["country"] != F.col("_c1.country"), previous)))
    pairs = (pairs.withColumn("_p1", F.lag("_c1").over(by_cell))
                  .withColumn("_p2", F.last("_other", ignorenulls=True).over(before))
                  .filter(F.col("_own") & F.col("_p1").isNotNull()).select("card_id", "_cell", "_p1", "_p2"))

    # what a row's own cell knows
    w = Window.partitionBy("card_id", "_cell").orderBy("_t", "transaction_id")
    last = F.lag(F.struct("_t", "transaction_id", "event_timestamp", "country")).over(w)
    u = base.withColumn("_last", last)
    u = u.withColumn("_start", F.when(F.col("_last.country") != F.col("country"), F.col("_last")))
    u = u.withColumn("_inner", F.last("_start", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))

    u = u.join(pairs, ["card_id", "_cell"], "left")
    u = u.withColumn("_p", F.coalesce("_inner", _another_country("_p1", "_p2")))
    return u.filter(F.col("_p._t") >= F.col("_t") - F.lit(frame)).select(
        "card_id", "transaction_id", "event_timestamp", "country",
        F.col("_p.transaction_id").alias("partner_transaction_id"), F.col("_p.event_timestamp").alias("partner_timestamp"),
        F.col("_p.country").alias("partner_country"),
        (F.col("_t") - F.col("_p._t")).alias("gap_us"),
    )
