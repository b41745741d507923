"""Summaries and report queries over scored rows.

A2 minute summary, A3 counts by risk level, A5 daily summary, A7 anomaly
rate, A8 score distribution, A9 transaction rate, T2 latest rows, T3 top
cards, T4 alert timeline, S15 alert payload.

All aggregates are built-in (partial aggregation before the shuffle);
top-k uses ``orderBy().limit()`` (TakeOrderedAndProject) or a ranked window
with a limit filter (WindowGroupLimit, map-side), never a collected group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .features import covering_windows
from .gold import FLAGGED


def is_flagged():
    return F.col("risk_level").isin(*FLAGGED)


def _window_cols(df: DataFrame) -> DataFrame:
    return (df.withColumn("window_start", F.col("window.start"))
              .withColumn("window_end", F.col("window.end")).drop("window"))


def minute_summary(scored: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """A2: 1-minute tumbling cells by category x risk x country."""
    out = (scored.groupBy(F.window(ts, "1 minute"), "merchant_category", "risk_level", "country")
                 .agg(F.count(F.lit(1)).alias("tx_count"),
                      F.sum("amount").alias("total_amount"),
                      F.avg("anomaly_score").alias("avg_anomaly_score")))
    return _window_cols(out)


def risk_counts(gold: DataFrame) -> DataFrame:
    """A3: the ad-hoc count by risk level, largest first."""
    return gold.groupBy("risk_level").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col("cnt").desc())


def daily_summary(scored: DataFrame, top_k: int = 5) -> DataFrame:
    """A5: per day -- totals by level and the top flagged cards.

    The per-day card ranking is a ``row_number() <= k`` window, which Catalyst
    plans as a WindowGroupLimit: each map task keeps its k best per day before
    the shuffle, so a busy day does not gather all its cards in one task.
    """
    # one aggregate per (day, card) feeds both the day totals and the ranking
    per_card = scored.groupBy("tx_date", "card_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("risk_level") == "HIGH").alias("high"),
        F.count_if(F.col("risk_level") == "MEDIUM").alias("medium"),
        F.count_if(F.col("risk_level") == "LOW").alias("low"),
    ).withColumn("flagged", F.col("high") + F.col("medium"))
    totals = per_card.groupBy("tx_date").agg(
        F.sum("n").alias("total_transactions"),
        F.sum("high").alias("high_risk_count"),
        F.sum("medium").alias("medium_risk_count"),
        F.sum("low").alias("low_risk_count"),
    )
    per_card = per_card.filter(F.col("flagged") > 0)
    w = Window.partitionBy("tx_date").orderBy(F.col("flagged").desc(), F.col("card_id"))
    top = (per_card.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= top_k)
                   .groupBy("tx_date")
                   .agg(F.array_sort(F.collect_list(F.struct("rank", "card_id", "flagged"))).alias("_top")))
    top = top.select("tx_date", F.array_join(
        F.transform("_top", lambda x: F.concat(x["card_id"], F.lit(":"), x["flagged"].cast("string"))), ",")
        .alias("top_flagged_cards"))
    return (totals.join(top, on="tx_date", how="left")
                  .withColumn("top_flagged_cards", F.coalesce("top_flagged_cards", F.lit(""))))


SUMMARY_FIELDS = ("report_date", "pipeline_run", "total_transactions", "high_risk_count", "medium_risk_count",
                  "low_risk_count", "top_flagged_cards", "generated_at")   # the published record


def daily_summary_payload(summary: DataFrame, run_id: str, generated_at: Column) -> DataFrame:
    """A5 as the published record: one JSON value of ``SUMMARY_FIELDS`` per day;
    the cards by rank, an empty list on a day without flags."""
    cards = F.transform(F.filter(F.split("top_flagged_cards", ","), lambda x: x != ""),
                        lambda x: F.substring_index(x, ":", 1))
    record = {"report_date": F.col("tx_date").cast("string"), "pipeline_run": F.lit(run_id), "top_flagged_cards": cards,
              "generated_at": generated_at}
    return summary.select(F.col("tx_date").cast("string").alias("key"), F.to_json(F.struct(
        *[record.get(f, F.col(f)).alias(f) for f in SUMMARY_FIELDS])).alias("value"))


def anomaly_rate(scored: DataFrame, length: str = "5 minutes", slide: str = "1 minute",
                 ts: str = "event_timestamp") -> DataFrame:
    """Share of flagged rows over a sliding window; rows are combined into
    cells of one slide before the cells are copied to the windows that cover them."""
    cells = (scored.groupBy(F.window(ts, slide).alias("cell"))
                   .agg(F.count(F.lit(1)).alias("n"), F.count_if(is_flagged()).alias("f")))
    out = (cells.select("n", "f", covering_windows(F.col("cell.start"), length, slide).alias("window"))
                .groupBy("window").agg(F.sum("n").alias("tx_count"), F.sum("f").alias("flagged_count")))
    out = out.withColumn("anomaly_rate_pct", F.col("flagged_count") * 100.0 / F.col("tx_count"))
    return _window_cols(out)


def score_by_hour(scored: DataFrame) -> DataFrame:
    """Hour of day x score decile (100 falls in the top bin)."""
    bin_ = (F.least(F.floor(F.col("anomaly_score") / 10), F.lit(9)) * 10).cast("int")
    return scored.groupBy("tx_hour", bin_.alias("score_bin")).agg(F.count(F.lit(1)).alias("tx_count"))


def tx_rate_by_category(scored: DataFrame, ts: str = "event_timestamp") -> DataFrame:
    """Transactions per second by category, per minute."""
    out = (scored.groupBy(F.window(ts, "1 minute"), "merchant_category")
                 .agg(F.count(F.lit(1)).alias("tx_count")))
    return _window_cols(out).withColumn("tx_per_sec", F.col("tx_count") / 60.0)


def latest(scored: DataFrame, n: int = 100) -> DataFrame:
    """Live feed -- the n most recent transactions (ties by id)."""
    return scored.orderBy(F.col("event_timestamp").desc(), F.col("transaction_id").desc()).limit(n)


def card_counts(scored: DataFrame) -> DataFrame:
    """T3's mergeable part: per card its flagged and all transactions and its highest score."""
    return scored.groupBy("card_id").agg(
        F.count_if(is_flagged()).alias("flagged_count"),
        F.max("anomaly_score").alias("max_score"),
        F.count(F.lit(1)).alias("tx_count"))


def merged_card_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("card_id").agg(F.sum("flagged_count").alias("flagged_count"), F.max("max_score").alias("max_score"),
                                         F.sum("tx_count").alias("tx_count"))


def top_flagged_cards(scored: DataFrame, n: int = 10) -> DataFrame:
    """Cards with the most flagged transactions."""
    return top_cards(card_counts(scored), n)


def top_cards(per_card: DataFrame, n: int = 10) -> DataFrame:
    return per_card.orderBy(F.col("flagged_count").desc(), F.col("max_score").desc(), F.col("card_id")).limit(n)


def alert_timeline(scored: DataFrame) -> DataFrame:
    """T4: MEDIUM/HIGH events in time order."""
    return (scored.filter(is_flagged())
                  .select("event_timestamp", "transaction_id", "card_id", "risk_level", "anomaly_score",
                          "triggered_rules")
                  .orderBy("event_timestamp", "transaction_id"))


# Fixed: the alert record's fields.
ALERT_FIELDS = ("transaction_id", "card_id", "user_id", "amount", "anomaly_score", "risk_level",
                "triggered_rules", "merchant_category", "country", "scored_at")


def alert_payload(scored: DataFrame) -> DataFrame:
    """S15 + B10: HIGH rows as key (card) / value (JSON of 10 fields)."""
    fields = [F.date_format("scored_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("scored_at") if f == "scored_at"
              else F.col(f) for f in ALERT_FIELDS]
    return (scored.filter(F.col("risk_level") == "HIGH")
                  .select(F.col("card_id").alias("key"), F.to_json(F.struct(*fields)).alias("value")))


def label_quality(scored: DataFrame, rule_set: str) -> DataFrame:
    """Injected-anomaly labels against the flags (MEDIUM/HIGH) of one rule set:
    counts, precision and recall -- the check the labels were injected for.

    ``scored`` carries each row's ``label`` (``with_labels`` before the scoring);
    the result is one global aggregate (partial per task).
    """
    lbl, flg = F.coalesce(F.col("label"), F.lit(False)), is_flagged()
    agg = scored.agg(F.count(F.lit(1)).alias("tx_count"), F.count_if(lbl).alias("labelled_count"),
                F.count_if(flg).alias("flagged_count"), F.count_if(lbl & flg).alias("true_positives"))
    tp, fl, lb = F.col("true_positives"), F.col("flagged_count"), F.col("labelled_count")
    return agg.select(F.lit(rule_set).alias("rule_set"), "tx_count", "labelled_count", "flagged_count",
                      "true_positives", F.when(fl > 0, tp / fl).alias("flag_precision"),
                      F.when(lb > 0, tp / lb).alias("flag_recall"))


def labels_by_id(labels: DataFrame) -> DataFrame:
    """One label per transaction; redelivered copies carry the same one (map-side partial max)."""
    return labels.groupBy("transaction_id").agg(F.max("label").alias("label"))


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows with the ``label`` of their transaction, NULL without one; ``labels`` has one row per id (``labels_by_id``).
    Deduplicated rows lie by the id already, so the join moves only the labels."""
    return rows.join(labels, "transaction_id", "left")
