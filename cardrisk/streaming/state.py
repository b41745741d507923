"""ST8: the documented history rules online, with ``transformWithStateInPandas``.

* ``CardHistory`` (key: card) -- R2h count in the trailing 10 minutes and R4h
  "two countries within 60 minutes". State: the card's rows by minute (MapState),
  of the frame length plus the watermark behind its newest row, as a row that
  late may still come; a batch reads and writes only the minutes it touches
  or looks back on. An event-time timer clears an idle card.
* ``UserHistory`` (key: user) -- R5h first use of a high-risk category
  (categories seen: at most three per user, no expiry) and the 30-day amount
  statistics at day granularity (day -> count, sum, sum of squares in whole
  cents): the stats of days d-30 .. d-1, as ``user_stats`` computes them in
  batch (A4/J2). Days are kept as long as a late row can still refer to them.
  State: one small ValueState, read and written once per batch.

A query that starts over, or on a stream that began long ago, is given its state
(``card_state``, ``user_state``): daily partials and the last 70 minutes of silver.

A row is scored on the rows that arrived before it or with it: on in-order
input the outputs equal the batch plans, and a late row is scored as in batch
on all that has arrived by then.

Scale note: keyed state puts a hot key's micro-batch rows in one task. What a
batch brings is bounded by the source (``maxOffsetsPerTrigger`` /
``maxFilesPerTrigger``, ST6), so a key holding a third of the traffic brings
at most a third of one capped batch; its state is 70 minutes of the card's
(time, country) pairs or at most 32 day-partials and three categories of a
user.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..config import DEFAULT, HIGH_RISK_CATEGORIES, MICROS_PER_DAY, MICROS_PER_MINUTE, MICROS_PER_SECOND, ScoringConfig
from ..functions.columns import epoch_micros, flag_score, frequency_score, velocity_score, zscore
from ..functions.moments import CENTS
from ..operators.features import seconds
from ..operators.score import finish, history_triggers

CARD_OUT = "transaction_id string, tx_count_10min long, countries_60min_multi boolean"
USER_OUT = ("transaction_id string, user_30d_n long, user_30d_mean double, user_30d_std double, "
            "is_first_high_risk boolean, amount double, is_off_hours boolean")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _ms(us: int) -> int:
    return int(us // 1000)


def watermark_us(cfg: ScoringConfig) -> int:
    """The watermark delay in microseconds."""
    return seconds(cfg.watermark) * MICROS_PER_SECOND


class CardHistory(StatefulProcessor):
    """R2h and R4h facts of a card, from minute cells and the latest rows.

    A row up to ``late_us`` behind the newest may still come, and its frame
    reaches back another frame length, so that much is kept: times of the rows
    in the count frame (for the exact count at its edges), and per country the
    times that a 60-minute frame can start or end on.
    """

    def __init__(self, freq_us: int = 10 * MICROS_PER_MINUTE, border_us: int = 60 * MICROS_PER_MINUTE,
                 late_us: int = 10 * MICROS_PER_MINUTE):
        self.freq_us = freq_us
        self.border_us = border_us
        self.late_us = late_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # minute -> its rows as (time in the minute, country) packed in order
        self.minutes = handle.getMapState("minutes", "minute long", "t array<long>, country array<string>")

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Rows (t, country) of the card that the frames of the first batches may reach back to."""
        cells: dict[int, list] = {}
        for t, c in zip(initialState["t"].tolist(), initialState["country"].tolist()):
            cell = cells.setdefault(int(t) // MICROS_PER_MINUTE, [[], []])
            cell[0].append(int(t))
            cell[1].append(c if isinstance(c, str) else None)
        for m, (times, countries) in cells.items():
            if self.minutes.containsKey((m,)):          # a key's rows may come in several frames
                held = self.minutes.getValue((m,))
                times, countries = list(held[0]) + times, list(held[1]) + countries
            self.minutes.updateValue((m,), (times, countries))
        newest = max(int(initialState["t"].max()), max((int(k[0]) for k in self.minutes.keys()), default=0) * MICROS_PER_MINUTE)
        self._expire_after(newest)

    def _expire_after(self, newest: int) -> None:
        for ts in list(self.handle.listTimers()):
            self.handle.deleteTimer(ts)
        self.handle.registerTimer(_ms(newest + self.border_us + self.late_us) + 1)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows), ignore_index=True).sort_values(["t", "transaction_id"], kind="stable")
        t_new = new["t"].to_numpy(dtype=np.int64)
        lowest = (int(t_new.min()) - self.border_us) // MICROS_PER_MINUTE
        held: dict[int, list] = {}
        newest = int(t_new.max())
        stored = [int(k[0]) for k in self.minutes.keys()] if self.minutes.exists() else []
        for m in stored:
            newest = max(newest, m * MICROS_PER_MINUTE)
            if m >= lowest:
                v = self.minutes.getValue((m,))
                held[m] = [list(v[0]), list(v[1])]
        touched = set()
        for t, c in zip(t_new.tolist(), new["country"].tolist()):
            m = t // MICROS_PER_MINUTE
            cell = held.setdefault(m, [[], []])
            cell[0].append(t)
            cell[1].append(c if isinstance(c, str) else None)
            touched.add(m)
        t_all = np.array([t for cell in held.values() for t in cell[0]], np.int64)
        country = np.array([c for cell in held.values() for c in cell[1]], object)
        order = np.argsort(t_all, kind="stable")
        t_all, country = t_all[order], country[order]
        count = np.searchsorted(t_all, t_new, side="right") - np.searchsorted(t_all, t_new - self.freq_us, side="left")
        # two countries in [t - 60 min, t]: a change of country between the
        # first and last non-null country rows of the range
        known = np.array([c is not None for c in country], bool)
        t_nn, codes = t_all[known], pd.factorize(country[known])[0]
        changes = np.concatenate([[0], np.cumsum(codes[1:] != codes[:-1])]) if len(codes) else np.zeros(0, int)
        a = np.searchsorted(t_nn, t_new - self.border_us, side="left")
        b = np.searchsorted(t_nn, t_new, side="right") - 1
        multi = np.zeros(len(t_new), dtype=bool)
        ok = b > a
        if len(codes):
            multi[ok] = changes[b[ok]] - changes[a[ok]] > 0
        keep = (newest - self.border_us - self.late_us) // MICROS_PER_MINUTE
        for m in touched:                       # only minutes that changed and are still needed are written
            if m >= keep:
                self.minutes.updateValue((m,), (held[m][0], held[m][1]))
        for m in stored:
            if m < keep:
                self.minutes.removeKey((m,))
        self._expire_after(newest)
        yield pd.DataFrame({"transaction_id": new["transaction_id"].to_numpy(),
                            "tx_count_10min": count.astype("int64"),
                            "countries_60min_multi": multi})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.minutes.clear()
        return iter([])

    def close(self) -> None:
        pass


class UserHistory(StatefulProcessor):
    """R5h first use and the exact 30-day statistics of a user, at day granularity."""

    def __init__(self, days: int = 30, high_risk: tuple = HIGH_RISK_CATEGORIES,
                 late_us: int = 10 * MICROS_PER_MINUTE):
        self.days = days
        self.high_risk = set(high_risk)
        self.late_days = -(-late_us // MICROS_PER_DAY)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # one value, as every access is a call to the JVM. Whole cents: exact, whatever the order; squares as
        # decimal digits, as they outgrow a long
        self.held = handle.getValueState("held", "day array<int>, n array<long>, s array<long>, ss array<string>, "
                                                 "category array<string>, first_t array<long>, timer long")

    def _get(self) -> tuple[dict, dict, int]:
        """(partials by day, first use by category, time of the registered timer or 0)."""
        v = self.held.get()
        if v is None:
            return {}, {}, 0
        return {d: (n, s, int(ss)) for d, n, s, ss in zip(*v[:4])}, dict(zip(v[4], v[5])), v[6]

    def _put(self, parts: dict, seen: dict, timer: int) -> None:
        """A timer follows the newest day: one that is registered goes off first, and is then set anew."""
        if parts and not timer:
            timer = self._expiry(max(parts))
            self.handle.registerTimer(timer)
        n, s, ss = ([p[j] for p in parts.values()] for j in range(3))
        self.held.update((list(parts), n, s, [str(x) for x in ss], list(seen), list(seen.values()), timer))

    def _expiry(self, newest_day: int) -> int:
        return _ms((newest_day + self.days + self.late_days + 1) * MICROS_PER_DAY)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        """Rows (day, n, s, ss) of the user's stored partials, or (category, first_t) of high-risk use so far."""
        parts, seen, timer = self._get()               # a key's rows may come in several frames
        for day, n, total, squares, category, first in zip(*(initialState[c].tolist() for c in ("day", "n", "s", "ss", "category", "first_t"))):
            if isinstance(category, str):
                seen[category] = int(first)
            else:
                parts[int(day)] = (int(n), int(total), int(squares))
        self._put(parts, seen, timer)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        columns = ("t", "transaction_id", "merchant_category", "amount", "is_off_hours")
        data = sorted((r for f in rows for r in zip(*(f[c].tolist() for c in columns))), key=lambda r: r[:2])
        parts, seen, timer = self._get()
        first, days = [], {}
        for t, _, category, amount, _ in data:
            # R5h: first row per high-risk category, not seen in earlier batches
            new = category in self.high_risk and category not in seen
            if new:
                seen[category] = int(t)
            first.append(new)
            days.setdefault(t // MICROS_PER_DAY, []).append(amount)
        # 30-day stats at day granularity: partials of days d-30 .. d-1
        n_out, mean_out, std_out = [], [], []
        for d, amounts in days.items():             # in order of time
            hist = [p for k, p in parts.items() if d - self.days <= k <= d - 1]
            n, s, ss = (sum(p[j] for p in hist) for j in range(3))
            n_out += [n] * len(amounts)
            mean_out += [s / n / CENTS if n > 0 else np.nan] * len(amounts)
            std_out += [((n * ss - s * s) / (n * (n - 1))) ** 0.5 / CENTS if n >= 2 else np.nan] * len(amounts)
            xs = [round(a * CENTS) for a in amounts if a is not None and a == a]
            p = parts.get(d, (0, 0, 0))
            parts[d] = (p[0] + len(xs), p[1] + sum(xs), p[2] + sum(v * v for v in xs))
        keep = max(parts) - self.days - self.late_days
        self._put({k: p for k, p in parts.items() if k >= keep}, seen, timer)
        yield pd.DataFrame({"transaction_id": [r[1] for r in data], "user_30d_n": np.array(n_out, np.int64),
                            "user_30d_mean": mean_out, "user_30d_std": std_out, "is_first_high_risk": np.array(first, bool),
                            "amount": np.array([r[3] for r in data], float), "is_off_hours": np.array([r[4] for r in data], bool)})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # keep first-use memory (bounded); drop stale day partials
        parts, seen, timer = self._get()
        if parts and self._expiry(max(parts)) <= timer:
            parts = {}
        self._put(parts, seen, 0)
        return iter([])

    def close(self) -> None:
        pass


def ensure_rocksdb(spark: SparkSession) -> None:
    """transformWithState needs the RocksDB state store; set it for new queries."""
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass", "") != ROCKSDB:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def card_state(history: DataFrame, cut: Column, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    """What ``card_history`` starts from: the rows of silver before ``cut`` that a frame of a row from then on,
    or of one that is as late as the watermark allows, reaches back to (70 minutes, narrow)."""
    since = epoch_micros(cut) - F.lit(cfg.cross_border_window_minutes * MICROS_PER_MINUTE + watermark_us(cfg))
    t = epoch_micros("event_timestamp")
    return history.filter((t >= since) & (t < epoch_micros(cut))).select("card_id", t.alias("t"), "country")


def user_state(partials: DataFrame, history: DataFrame, cut: Column, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    """What ``user_history`` starts from: the stored daily partials (A4) of the days that rows from ``cut`` on
    look back on, and when each high-risk category was first used; one row per user and day or category."""
    first_day = F.date_sub(cut.cast("date"), cfg.history_days + -(-watermark_us(cfg) // MICROS_PER_DAY))
    days = partials.filter(F.col("tx_date") >= first_day).select(
        "user_id", F.unix_date("tx_date").alias("day"), "n", F.coalesce("s", F.lit(0)).cast("long").alias("s"),
        F.coalesce("ss", F.lit(0)).cast("string").alias("ss"))
    used = (history.filter((epoch_micros("event_timestamp") < epoch_micros(cut)) & F.col("merchant_category").isin(*cfg.high_risk_categories))
                   .groupBy("user_id", F.col("merchant_category").alias("category"))
                   .agg(F.min(epoch_micros("event_timestamp")).alias("first_t")))
    return days.unionByName(used, allowMissingColumns=True)


def card_history(silver: DataFrame, cfg: ScoringConfig = DEFAULT, start: DataFrame | None = None) -> DataFrame:
    """R2h and R4h facts online; ``start`` (see ``card_state``) makes a new query go on from stored history."""
    rows = silver.select("card_id", "transaction_id", "country", "event_time_ltz",
                         epoch_micros("event_timestamp").alias("t"))
    return rows.groupBy("card_id").transformWithStateInPandas(
        CardHistory(cfg.freq_window_minutes * MICROS_PER_MINUTE, cfg.cross_border_window_minutes * MICROS_PER_MINUTE,
                    watermark_us(cfg)),
        CARD_OUT, "append", "EventTime", initialState=None if start is None else start.groupBy("card_id"))


def user_history(silver: DataFrame, cfg: ScoringConfig = DEFAULT, start: DataFrame | None = None) -> DataFrame:
    """R5h facts and 30-day statistics online; ``start`` as for ``card_history`` (see ``user_state``)."""
    rows = silver.select("user_id", "transaction_id", "merchant_category", "amount", "is_off_hours", "event_time_ltz",
                         epoch_micros("event_timestamp").alias("t"))
    return rows.groupBy("user_id").transformWithStateInPandas(
        UserHistory(cfg.history_days, tuple(cfg.high_risk_categories), watermark_us(cfg)), USER_OUT, "append", "EventTime",
        initialState=None if start is None else start.groupBy("user_id"))


def history_scores(card: DataFrame, user: DataFrame, cfg: ScoringConfig = DEFAULT) -> DataFrame:
    """Join the two processors' outputs (read back) and score the documented
    rules to the end: five scores, composite, level and triggered rules."""
    j = card.join(user, "transaction_id")
    for c in ("user_30d_mean", "user_30d_std"):        # pandas NaN -> SQL NULL
        j = j.withColumn(c, F.when(~F.isnan(c), F.col(c)))
    enough = F.col("user_30d_n") >= cfg.min_history_rows
    j = j.withColumn("amount_zscore", F.when(enough, zscore("amount", "user_30d_mean", "user_30d_std")).otherwise(F.lit(0.0)))
    j = (j.withColumn("score_amount_velocity", velocity_score("amount_zscore", cfg))
          .withColumn("score_tx_frequency", frequency_score("tx_count_10min", cfg))
          .withColumn("score_off_hours", flag_score("is_off_hours"))
          .withColumn("score_cross_border", flag_score("countries_60min_multi"))
          .withColumn("score_high_risk_mcc", flag_score("is_first_high_risk")))
    return finish(j, cfg, triggers=history_triggers(cfg))
