"""DuckDB SQL for every catalogue key (same column names as the Spark plans)."""

from __future__ import annotations

from .oracle import BASE, CURS_IN, CUT_TS, HISTORY, RUN_ID, RUN_TS, SCORED, TX, BRONZE, w

ORACLE: dict[str, str] = {}


def sql(name: str, text: str) -> None:
    ORACLE[name] = text


S_ = w(*BASE)            # ... silver
SC = w(*BASE, SCORED)    # ... scored
HI = w(*BASE, HISTORY)   # ... hist

# -- bronze -----------------------------------------------------------------------

sql("bronze_typed", w(TX, BRONZE) + f"""
SELECT *, TIMESTAMP '{RUN_TS}' AS dbt_loaded_at, '{RUN_ID}' AS dbt_run_id FROM bronze""")

sql("bronze_incremental", w(TX, BRONZE) + f"""
SELECT transaction_id, ingested_at, kafka_offset, kafka_partition FROM bronze
WHERE ingested_at > (SELECT coalesce(max(ingested_at), TIMESTAMP '1970-01-01 00:00:00')
                     FROM bronze WHERE event_timestamp < TIMESTAMP '{CUT_TS}')""")

# -- silver -----------------------------------------------------------------------

sql("silver_valid", S_ + "SELECT transaction_id, kafka_offset, amount, currency FROM valid")
sql("silver_dedup", S_ + "SELECT transaction_id, ingested_at, kafka_offset, kafka_partition FROM deduped")
sql("silver_text", S_ + """SELECT transaction_id, merchant_name, merchant_category, amount, currency, country,
  city, device_type FROM silver""")
sql("silver_time", S_ + """SELECT transaction_id, event_timestamp, tx_hour, tx_day_of_week,
  CAST(tx_date AS VARCHAR) AS tx_date, tx_week, tx_month FROM silver""")
sql("silver_bucket", S_ + "SELECT transaction_id, amount, amount_bucket FROM silver")
sql("silver_flags", S_ + """SELECT transaction_id, is_high_risk_mcc, is_cnp, is_off_hours, is_foreign_country
  FROM silver""")
sql("silver_latency", S_ + """SELECT transaction_id, event_timestamp, kafka_ingest_time, kafka_latency_ms
  FROM silver""")
sql("silver_full", S_ + "SELECT * REPLACE (CAST(tx_date AS VARCHAR) AS tx_date) FROM silver")

# -- rules ------------------------------------------------------------------------

sql("rule_velocity_batch", SC + """SELECT transaction_id, user_id, amount,
  round(user_batch_std, 4) AS user_batch_std, round(amount_zscore, 4) AS amount_zscore,
  round(score_amount_velocity, 2) AS score_amount_velocity FROM scored""")
sql("rule_velocity_30d", HI + """SELECT transaction_id, user_id, amount, user_30d_n,
  round(user_30d_std, 4) AS user_30d_std,
  round(amount_zscore, 4) AS amount_zscore, round(score_amount_velocity, 2) AS score_amount_velocity FROM hist""")
sql("rule_frequency_batch", SC + """SELECT transaction_id, card_id, tx_count_batch,
  round(score_tx_frequency, 2) AS score_tx_frequency FROM scored""")
sql("rule_frequency_10m", HI + """SELECT transaction_id, card_id, tx_count_10min,
  round(score_tx_frequency, 2) AS score_tx_frequency FROM hist""")
sql("rule_off_hours", SC + "SELECT transaction_id, tx_hour, is_off_hours, score_off_hours FROM scored")
def _zone_case() -> str:
    from ..operators.rules import COUNTRY_ZONES
    whens = " ".join(f"WHEN '{c}' THEN '{z}'" for c, z in COUNTRY_ZONES.items())
    return f"CASE country {whens} ELSE 'UTC' END"


sql("rule_off_hours_local", S_ + f"""SELECT transaction_id, country, tx_hour, local_hour,
  coalesce(local_hour >= 0 AND local_hour < 5, false) AS is_off_hours_local,
  CASE WHEN coalesce(local_hour >= 0 AND local_hour < 5, false) THEN 100.0::DOUBLE ELSE 0.0::DOUBLE END
    AS score_off_hours
FROM (SELECT *, CAST(hour(timezone({_zone_case()}, event_timestamp AT TIME ZONE 'UTC')) AS INTEGER) AS local_hour
      FROM silver)""")
sql("rule_cross_border_flag", SC + "SELECT transaction_id, is_international, amount, score_cross_border FROM scored")
sql("rule_cross_border_60m", HI + """SELECT transaction_id, card_id, country, countries_60min_multi,
  score_cross_border FROM hist""")
sql("rule_high_risk_mcc", SC + """SELECT transaction_id, merchant_category, is_high_risk_mcc, score_high_risk_mcc
  FROM scored""")
sql("rule_first_mcc", HI + """SELECT transaction_id, user_id, merchant_category, is_first_high_risk,
  score_high_risk_mcc FROM hist""")

SCORE_COLS = "transaction_id, card_id, user_id, event_timestamp, amount"
sql("composite_score", SC + f"""SELECT {SCORE_COLS}, round(amount_zscore, 4) AS amount_zscore,
  round(score_amount_velocity, 2) AS score_amount_velocity, tx_count_batch,
  round(score_tx_frequency, 2) AS score_tx_frequency, score_off_hours, score_cross_border, score_high_risk_mcc,
  anomaly_score, risk_level FROM scored""")
sql("risk_levels", SC + "SELECT transaction_id, anomaly_score, risk_level FROM scored")
sql("triggered_rules", SC + "SELECT transaction_id, triggered_rules FROM scored")
sql("triggered_rule_counts", SC + """SELECT rule, count(*) AS fired
  FROM (SELECT unnest(string_split(triggered_rules, ',')) AS rule FROM scored WHERE triggered_rules <> '')
  GROUP BY rule""")
sql("composite_history", HI + f"""SELECT {SCORE_COLS}, user_30d_n, round(amount_zscore, 4) AS amount_zscore,
  round(score_amount_velocity, 2) AS score_amount_velocity, tx_count_10min,
  round(score_tx_frequency, 2) AS score_tx_frequency, score_off_hours, score_cross_border, score_high_risk_mcc,
  anomaly_score, risk_level, triggered_rules FROM hist""")

from .oracle import GOLD, WIRE  # noqa: E402

GO = w(*BASE, SCORED, GOLD)

# -- bronze parse / dead letter -----------------------------------------------------

sql("bronze_parse_json", w(TX, WIRE) + """
SELECT * EXCLUDE (raw_payload, reject_reason), '1.0.0' AS pipeline_version FROM parsed WHERE reject_reason IS NULL""")
sql("bronze_dead_letter", w(TX, WIRE) + """
SELECT reject_reason, kafka_offset, kafka_partition, kafka_ingest_time, ingested_at FROM parsed
WHERE reject_reason IS NOT NULL""")

# -- storage ------------------------------------------------------------------------

_SILVER_OF = """
{name}_valid AS (SELECT * FROM {src} WHERE transaction_id IS NOT NULL AND card_id IS NOT NULL
    AND amount IS NOT NULL AND amount > 0.0 AND amount <= 100000.0
    AND currency IN ('USD', 'EUR', 'GBP', 'CAD', 'JPY', 'AUD')),
{name} AS (
  SELECT transaction_id, ingested_at, kafka_offset, kafka_partition, round(amount, 2) AS amount FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id
                                 ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC) AS rn
    FROM {name}_valid) WHERE rn = 1
)"""
sql("silver_upsert", w(TX, BRONZE, f"bronze_old AS (SELECT * FROM bronze WHERE ingested_at < TIMESTAMP '{CUT_TS}')",
                       _SILVER_OF.format(name="target", src="bronze_old"),
                       _SILVER_OF.format(name="allnew", src="bronze"),
                       """incoming AS (SELECT * FROM allnew WHERE ingested_at >
                            (SELECT coalesce(max(ingested_at), TIMESTAMP '1970-01-01') FROM target))""") + """
SELECT * FROM target WHERE transaction_id NOT IN (SELECT transaction_id FROM incoming)
UNION ALL SELECT * FROM incoming""")

sql("schema_evolution", S_ + f"""
SELECT transaction_id, event_timestamp,
       CASE WHEN event_timestamp < TIMESTAMP '{CUT_TS}' THEN NULL ELSE tx_week END AS tx_week,
       CASE WHEN event_timestamp < TIMESTAMP '{CUT_TS}' THEN NULL ELSE tx_month END AS tx_month,
       CASE WHEN event_timestamp < TIMESTAMP '{CUT_TS}' THEN NULL ELSE kafka_latency_ms END AS kafka_latency_ms
FROM silver""")

# -- features -----------------------------------------------------------------------

sql("card_sliding_features", S_ + """
, win AS (
  SELECT card_id, country, amount,
         time_bucket(INTERVAL 1 MINUTE, event_timestamp) - to_minutes(k) AS window_start
  FROM silver, range(10) AS r(k)
),
per_country AS (
  SELECT card_id, window_start, country, count(*) AS n, sum(amount) AS s, max(amount) AS m
  FROM win GROUP BY ALL
)
SELECT card_id, window_start, window_start + INTERVAL 10 MINUTE AS window_end,
       sum(n)::BIGINT AS tx_count_window, round(sum(s), 2) AS amount_sum_window, max(m) AS amount_max_window,
       coalesce(string_agg(country || ':' || CAST(n AS VARCHAR), ',' ORDER BY country || ':' || CAST(n AS VARCHAR)), '')
         AS countries_in_window
FROM per_country GROUP BY card_id, window_start""")

sql("user_stats_30d", S_ + """
, days AS (SELECT DISTINCT user_id, tx_date FROM silver)
SELECT d.user_id, CAST(d.tx_date AS VARCHAR) AS stats_date, count(s.amount) AS user_30d_n,
       round(coalesce(sum(s.amount), 0.0), 2) AS user_30d_sum, round(stddev_samp(s.amount), 4) AS user_30d_std
FROM days d LEFT JOIN silver s
  ON s.user_id = d.user_id AND s.tx_date >= d.tx_date - INTERVAL 30 DAY AND s.tx_date <= d.tx_date - INTERVAL 1 DAY
GROUP BY d.user_id, d.tx_date""")

sql("score_with_user_stats", S_ + """
, days AS (SELECT DISTINCT user_id, tx_date FROM silver),
st AS (
  SELECT d.user_id, d.tx_date, count(s.amount) AS n, avg(s.amount) AS mean, stddev_samp(s.amount) AS std
  FROM days d LEFT JOIN silver s
    ON s.user_id = d.user_id AND s.tx_date >= d.tx_date - INTERVAL 30 DAY AND s.tx_date <= d.tx_date - INTERVAL 1 DAY
  GROUP BY d.user_id, d.tx_date
),
j AS (
  SELECT t.transaction_id, st.n AS user_30d_n, st.std AS user_30d_std,
         CASE WHEN st.n >= 2 AND st.std > 0 THEN (t.amount - st.mean) / st.std ELSE 0.0::DOUBLE END AS amount_zscore
  FROM silver t LEFT JOIN st ON t.user_id = st.user_id AND t.tx_date = st.tx_date
)
SELECT transaction_id, user_30d_n, round(user_30d_std, 4) AS user_30d_std, round(amount_zscore, 4) AS amount_zscore,
       round(least(100.0::DOUBLE, greatest(0.0::DOUBLE, amount_zscore / 6.0::DOUBLE * 100.0::DOUBLE)), 2)
         AS score_amount_velocity
FROM j""")

sql("cross_border_pairs", S_ + """
, c AS (SELECT card_id, transaction_id, event_timestamp, country FROM silver WHERE country IS NOT NULL),
pairs AS (
  SELECT a.card_id, a.transaction_id, a.event_timestamp, a.country,
         b.transaction_id AS partner_transaction_id, b.event_timestamp AS partner_timestamp,
         b.country AS partner_country,
         epoch_us(a.event_timestamp) - epoch_us(b.event_timestamp) AS gap_us,
         row_number() OVER (PARTITION BY a.transaction_id ORDER BY b.event_timestamp DESC, b.transaction_id DESC) AS rn
  FROM c a JOIN c b ON a.card_id = b.card_id AND b.country <> a.country
    AND b.event_timestamp >= a.event_timestamp - INTERVAL 60 MINUTE
    AND (b.event_timestamp < a.event_timestamp
         OR (b.event_timestamp = a.event_timestamp AND b.transaction_id < a.transaction_id))
)
SELECT * EXCLUDE (rn) FROM pairs WHERE rn = 1""")

# -- gold and reports -----------------------------------------------------------------

sql("gold_anomalies", GO + "SELECT * FROM gold")
sql("risk_counts", GO + "SELECT risk_level, count(*) AS cnt FROM gold GROUP BY risk_level")
sql("minute_summary", SC + """SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) AS window_start,
  time_bucket(INTERVAL 1 MINUTE, event_timestamp) + INTERVAL 1 MINUTE AS window_end,
  merchant_category, risk_level, country, count(*) AS tx_count, round(sum(amount), 2) AS total_amount,
  round(avg(anomaly_score), 6) AS avg_anomaly_score
FROM scored GROUP BY ALL""")
sql("daily_summary", SC + """
, totals AS (
  SELECT tx_date, count(*) AS total_transactions, CAST(count_if(risk_level = 'HIGH') AS BIGINT) AS high_risk_count,
         CAST(count_if(risk_level = 'MEDIUM') AS BIGINT) AS medium_risk_count, CAST(count_if(risk_level = 'LOW') AS BIGINT) AS low_risk_count
  FROM scored GROUP BY tx_date
),
pc AS (
  SELECT tx_date, card_id, count(*) AS flagged FROM scored WHERE risk_level IN ('MEDIUM', 'HIGH') GROUP BY ALL
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY tx_date ORDER BY flagged DESC, card_id) AS rk FROM pc
),
top AS (
  SELECT tx_date, string_agg(card_id || ':' || CAST(flagged AS VARCHAR), ',' ORDER BY rk) AS top_flagged_cards
  FROM ranked WHERE rk <= 5 GROUP BY tx_date
)
SELECT CAST(t.tx_date AS VARCHAR) AS tx_date, total_transactions, high_risk_count, medium_risk_count,
       low_risk_count, coalesce(top.top_flagged_cards, '') AS top_flagged_cards
FROM totals t LEFT JOIN top USING (tx_date)""")
sql("anomaly_rate_5m", SC + """
, win AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) - to_minutes(k) AS window_start, risk_level
  FROM scored, range(5) AS r(k)
)
SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, count(*) AS tx_count,
       CAST(count_if(risk_level IN ('MEDIUM', 'HIGH')) AS BIGINT) AS flagged_count,
       round(count_if(risk_level IN ('MEDIUM', 'HIGH')) * 100.0::DOUBLE / count(*), 4) AS anomaly_rate_pct
FROM win GROUP BY window_start""")
sql("score_by_hour", SC + """SELECT tx_hour, CAST(least(floor(anomaly_score / 10), 9) * 10 AS INTEGER) AS score_bin,
  count(*) AS tx_count FROM scored GROUP BY ALL""")
sql("tx_rate_by_category", SC + """SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) AS window_start,
  time_bucket(INTERVAL 1 MINUTE, event_timestamp) + INTERVAL 1 MINUTE AS window_end, merchant_category,
  count(*) AS tx_count, round(count(*) / 60.0::DOUBLE, 6) AS tx_per_sec FROM scored GROUP BY ALL""")
sql("latest_100", SC + """SELECT transaction_id, event_timestamp, card_id, amount, anomaly_score, risk_level
  FROM scored ORDER BY event_timestamp DESC, transaction_id DESC LIMIT 100""")
sql("top_flagged_cards", SC + """SELECT card_id, CAST(count_if(risk_level IN ('MEDIUM', 'HIGH')) AS BIGINT) AS flagged_count,
  max(anomaly_score) AS max_score, count(*) AS tx_count FROM scored GROUP BY card_id
  ORDER BY flagged_count DESC, max_score DESC, card_id LIMIT 10""")
sql("alert_timeline", SC + """SELECT event_timestamp, transaction_id, card_id, risk_level, anomaly_score,
  triggered_rules FROM scored WHERE risk_level IN ('MEDIUM', 'HIGH') ORDER BY event_timestamp, transaction_id""")
sql("alert_payload", SC + """SELECT card_id AS key, CAST(json_object('transaction_id', transaction_id,
  'card_id', card_id, 'user_id', user_id, 'amount', amount, 'anomaly_score', anomaly_score,
  'risk_level', risk_level, 'triggered_rules', triggered_rules, 'merchant_category', merchant_category,
  'country', country, 'scored_at', strftime(scored_at, '%Y-%m-%d %H:%M:%S.%f')) AS VARCHAR) AS value
  FROM scored WHERE risk_level = 'HIGH'""")

# declared column tests per layer: (layer, column, test, condition-or-None)
_CUR = CURS_IN
_CHECKS = [
    ("bronze", "transaction_id", "not_null", "transaction_id IS NULL"),
    ("bronze", "transaction_id", "unique", None),
    ("bronze", "card_id", "not_null", "card_id IS NULL"),
    ("bronze", "amount", "not_null", "amount IS NULL"),
    ("bronze", "amount", "accepted_range", "amount < 0.01 OR amount > 1000000"),
    ("bronze", "currency", "not_null", "currency IS NULL"),
    ("bronze", "currency", "accepted_values", f"currency NOT IN {_CUR}"),
    ("silver", "transaction_id", "not_null", "transaction_id IS NULL"),
    ("silver", "transaction_id", "unique", None),
    ("silver", "card_id", "not_null", "card_id IS NULL"),
    ("silver", "user_id", "not_null", "user_id IS NULL"),
    ("silver", "amount", "not_null", "amount IS NULL"),
    ("silver", "amount", "accepted_range", "amount < 0.01 OR amount > 100000"),
    ("silver", "currency", "not_null", "currency IS NULL"),
    ("silver", "currency", "accepted_values", f"currency NOT IN {_CUR}"),
    ("silver", "amount_bucket", "not_null", "amount_bucket IS NULL"),
    ("silver", "amount_bucket", "accepted_values",
     "amount_bucket NOT IN ('MICRO', 'SMALL', 'MEDIUM', 'LARGE', 'VERY_LARGE')"),
    ("silver", "tx_hour", "not_null", "tx_hour IS NULL"),
    ("silver", "tx_hour", "accepted_range", "tx_hour < 0 OR tx_hour > 23"),
    ("silver", "is_high_risk_mcc", "not_null", "is_high_risk_mcc IS NULL"),
    ("silver", "is_high_risk_mcc", "accepted_values", "is_high_risk_mcc NOT IN (true, false)"),
    ("silver", "event_timestamp", "not_null", "event_timestamp IS NULL"),
    ("gold", "transaction_id", "not_null", "transaction_id IS NULL"),
    ("gold", "transaction_id", "unique", None),
    ("gold", "anomaly_score", "not_null", "anomaly_score IS NULL"),
    ("gold", "anomaly_score", "accepted_range", "anomaly_score < 0 OR anomaly_score > 100"),
    ("gold", "risk_level", "not_null", "risk_level IS NULL"),
    ("gold", "risk_level", "accepted_values", "risk_level NOT IN ('LOW', 'MEDIUM', 'HIGH')"),
    ("gold", "risk_label", "not_null", "risk_label IS NULL"),
    ("gold", "risk_label", "accepted_values",
     "risk_label NOT IN ('🚨 ANOMALY', '⚠️  SUSPICIOUS', '✅ NORMAL')"),
    ("gold", "end_to_end_latency_ms", "accepted_range", "end_to_end_latency_ms < 0 OR end_to_end_latency_ms > 60000"),
]


def _check_sql(layer, column, test, cond):
    if cond is None:
        v = (f"(SELECT count(*) FROM (SELECT {column} FROM {layer} WHERE {column} IS NOT NULL "
             f"GROUP BY {column} HAVING count(*) > 1))")
        return f"SELECT '{layer}' AS layer, '{column}' AS column_name, '{test}' AS test, {v} AS violations"
    return (f"SELECT '{layer}' AS layer, '{column}' AS column_name, '{test}' AS test, "
            f"CAST(count_if({cond}) AS BIGINT) AS violations FROM {layer}")


sql("quality_report", GO + "SELECT layer, column_name, test, CAST(violations AS BIGINT) AS violations, "
    "violations = 0 AS passed FROM (\n" + "\nUNION ALL ".join(_check_sql(*c) for c in _CHECKS) + ")")

from .oracle import COMPOSITE, D, LEVEL, SCORED_BATCH, SILVER, STREAM_BRONZE, TRIGGERS, VEL  # noqa: E402

STREAM_S = w(TX, WIRE, STREAM_BRONZE, SILVER)
STREAM_SC = w(TX, WIRE, STREAM_BRONZE, SILVER, SCORED_BATCH)
_CONTENT = ("transaction_id, card_id, user_id, merchant_category, amount, currency, country, event_timestamp, "
            "amount_bucket, is_high_risk_mcc, is_off_hours")

sql("stream_dedup", STREAM_S + f"SELECT {_CONTENT} FROM silver")
sql("stream_restart", STREAM_S + f"SELECT {_CONTENT} FROM silver")
sql("stream_scored_fanout", STREAM_SC + """SELECT transaction_id, card_id, amount, anomaly_score, risk_level,
  triggered_rules FROM scored WHERE risk_level IN ('MEDIUM', 'HIGH')""")
sql("stream_minute_summary", STREAM_SC + """
SELECT * FROM (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_timestamp) AS window_start,
         time_bucket(INTERVAL 1 MINUTE, event_timestamp) + INTERVAL 1 MINUTE AS window_end,
         merchant_category, risk_level, country, count(*) AS tx_count, round(sum(amount), 2) AS total_amount,
         round(avg(anomaly_score), 6) AS avg_anomaly_score
  FROM scored GROUP BY ALL)
WHERE window_end <= (SELECT max(event_timestamp) FROM scored) - INTERVAL 10 MINUTE""")
sql("stream_sliding", STREAM_S + """
, win AS (
  SELECT card_id, country, amount,
         time_bucket(INTERVAL 1 MINUTE, event_timestamp) - to_minutes(k) AS window_start
  FROM silver, range(10) AS r(k)
),
per_country AS (
  SELECT card_id, window_start, country, count(*) AS n, sum(amount) AS s, max(amount) AS m
  FROM win GROUP BY ALL
)
SELECT card_id, window_start, window_start + INTERVAL 10 MINUTE AS window_end,
       sum(n)::BIGINT AS tx_count_window, round(sum(s), 2) AS amount_sum_window, max(m) AS amount_max_window,
       coalesce(string_agg(country || ':' || CAST(n AS VARCHAR), ',' ORDER BY country || ':' || CAST(n AS VARCHAR)), '')
         AS countries_in_window
FROM per_country GROUP BY card_id, window_start
HAVING window_start + INTERVAL 10 MINUTE <= (SELECT max(event_timestamp) FROM silver) - INTERVAL 10 MINUTE""")

DAILY_STATS = """
, days AS (SELECT DISTINCT user_id, tx_date FROM silver),
st AS (
  SELECT d.user_id, d.tx_date, count(s.amount) AS n, avg(s.amount) AS mean, stddev_samp(s.amount) AS std
  FROM days d LEFT JOIN silver s
    ON s.user_id = d.user_id AND s.tx_date >= d.tx_date - INTERVAL 30 DAY AND s.tx_date <= d.tx_date - INTERVAL 1 DAY
  GROUP BY d.user_id, d.tx_date
)"""
_Z = f"CASE WHEN st.n >= 2 AND st.std > 0 THEN (x.amount - st.mean) / st.std ELSE 0.0{D} END"

# the documented rules, with the velocity of the days before
_STATEFUL = (w(TX, WIRE, STREAM_BRONZE, SILVER, HISTORY) + DAILY_STATS + f"""
, z AS (
  SELECT x.* EXCLUDE (user_30d_n, user_30d_mean, user_30d_std, amount_zscore, score_amount_velocity, anomaly_score, risk_level,
                      triggered_rules),
         st.n AS user_30d_n, st.std AS user_30d_std, {_Z} AS amount_zscore
  FROM hist x JOIN st ON x.user_id = st.user_id AND x.tx_date = st.tx_date),
v AS (SELECT *, {VEL} AS score_amount_velocity FROM z),
c AS (SELECT *, {COMPOSITE} AS anomaly_score FROM v)
SELECT transaction_id, tx_count_10min, countries_60min_multi, user_30d_n, round(user_30d_std, 4) AS user_30d_std,
       round(amount_zscore, 4) AS amount_zscore, is_first_high_risk, round(score_amount_velocity, 2) AS score_amount_velocity,
       round(score_tx_frequency, 2) AS score_tx_frequency, score_off_hours, score_cross_border, score_high_risk_mcc,
       anomaly_score, {LEVEL} AS risk_level, {TRIGGERS.format(freq_fired='tx_count_10min > 5')} AS triggered_rules
FROM c""")
sql("stream_stateful_rules", _STATEFUL)
sql("stream_warm_start", _STATEFUL + f" WHERE event_timestamp >= TIMESTAMP '{CUT_TS}'")

sql("stream_user_stats", w(TX, WIRE, STREAM_BRONZE, SILVER) + DAILY_STATS + f"""
, z AS (
  SELECT x.transaction_id, st.n AS user_30d_n, st.std AS user_30d_std, {_Z} AS amount_zscore
  FROM silver x JOIN st ON x.user_id = st.user_id AND x.tx_date = st.tx_date)
SELECT transaction_id, user_30d_n, round(user_30d_std, 4) AS user_30d_std, round(amount_zscore, 4) AS amount_zscore,
       round({VEL}, 2) AS score_amount_velocity FROM z""")

sql("stream_alerts", STREAM_SC + """SELECT card_id AS key, transaction_id, amount, anomaly_score, risk_level,
  triggered_rules FROM scored WHERE risk_level = 'HIGH'""")

sql("gold_layer", GO + f"""
SELECT transaction_id, anomaly_score, risk_level, triggered_rules, event_timestamp, TIMESTAMP '{RUN_TS}' AS loaded_at FROM gold""")

sql("daily_summary_payload", SC + f"""
, pc AS (SELECT tx_date, card_id, count(*) AS flagged FROM scored WHERE risk_level IN ('MEDIUM', 'HIGH') GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY tx_date ORDER BY flagged DESC, card_id) AS rk FROM pc),
top AS (SELECT tx_date, list(card_id ORDER BY rk) AS cards FROM ranked WHERE rk <= 5 GROUP BY tx_date),
totals AS (
  SELECT tx_date, count(*) AS n, CAST(count_if(risk_level = 'HIGH') AS BIGINT) AS h,
         CAST(count_if(risk_level = 'MEDIUM') AS BIGINT) AS m, CAST(count_if(risk_level = 'LOW') AS BIGINT) AS l
  FROM scored GROUP BY tx_date)
SELECT CAST(tx_date AS VARCHAR) AS key, CAST(json_object('report_date', CAST(tx_date AS VARCHAR), 'pipeline_run', '{RUN_ID}',
  'total_transactions', n, 'high_risk_count', h, 'medium_risk_count', m, 'low_risk_count', l,
  'top_flagged_cards', coalesce(cards, []), 'generated_at', '{RUN_TS}') AS VARCHAR) AS value
FROM totals LEFT JOIN top USING (tx_date)""")

sql("label_quality", w(*BASE, SCORED, HISTORY) + """
, labels AS (SELECT transaction_id, max(_is_injected_anomaly) AS label FROM tx GROUP BY transaction_id),
lq AS (
  SELECT 'as_coded' AS rule_set, s.risk_level IN ('MEDIUM', 'HIGH') AS is_flag, coalesce(l.label, false) AS is_label
  FROM scored s LEFT JOIN labels l USING (transaction_id)
  UNION ALL
  SELECT 'history', h.risk_level IN ('MEDIUM', 'HIGH'), coalesce(l.label, false)
  FROM hist h LEFT JOIN labels l USING (transaction_id)
)
SELECT rule_set, count(*) AS tx_count, CAST(count_if(is_label) AS BIGINT) AS labelled_count, CAST(count_if(is_flag) AS BIGINT) AS flagged_count,
  CAST(count_if(is_label AND is_flag) AS BIGINT) AS true_positives,
  round(CASE WHEN count_if(is_flag) > 0 THEN count_if(is_label AND is_flag) / count_if(is_flag) END, 6)
    AS flag_precision,
  round(CASE WHEN count_if(is_label) > 0 THEN count_if(is_label AND is_flag) / count_if(is_label) END, 6)
    AS flag_recall
FROM lq GROUP BY rule_set""")

sql("gated_layers", ORACLE["quality_report"])

sql("stream_live_feed", STREAM_SC + """
, latest AS (
  SELECT * FROM scored ORDER BY event_timestamp DESC, transaction_id DESC LIMIT 100),
cards AS (
  SELECT card_id, CAST(count_if(risk_level IN ('MEDIUM', 'HIGH')) AS BIGINT) AS flagged_count, max(anomaly_score) AS max_score,
         count(*) AS tx_count FROM scored GROUP BY card_id ORDER BY flagged_count DESC, max_score DESC, card_id LIMIT 10)
SELECT 'latest' AS kind, card_id, transaction_id, event_timestamp, amount, anomaly_score, risk_level,
       NULL::BIGINT AS flagged_count, NULL::BIGINT AS tx_count FROM latest
UNION ALL
SELECT 'cards', card_id, NULL, NULL, NULL, max_score, NULL, flagged_count, tx_count FROM cards""")

sql("stream_history_batches", _STATEFUL)

sql("gold_bucketed", GO + """
, times AS (SELECT transaction_id, count(*) AS times_in_silver FROM silver GROUP BY transaction_id)
SELECT transaction_id, card_id, anomaly_score, risk_level, risk_label, triggered_rules, end_to_end_latency_ms, times_in_silver
FROM gold JOIN times USING (transaction_id)""")

sql("stream_late_rows", w(TX, WIRE, STREAM_BRONZE) + """
, d AS (
  SELECT *, epoch_us(CASE WHEN kafka_offset % 50 = 7 THEN kafka_ingest_time + INTERVAL 6 DAY ELSE kafka_ingest_time END)
            // 432000000000 AS slice FROM bronze),
m AS (SELECT slice, max(event_timestamp) AS newest FROM d GROUP BY slice),
k AS (SELECT slice, max(newest) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 10 MINUTE AS watermark FROM m),
v AS (
  SELECT d.*, watermark, coalesce(event_timestamp < watermark, false) AS late FROM d JOIN k USING (slice)
  WHERE transaction_id IS NOT NULL AND card_id IS NOT NULL AND amount IS NOT NULL AND amount > 0.0 AND amount <= 100000.0
    AND currency IN ('USD', 'EUR', 'GBP', 'CAD', 'JPY', 'AUD')),
s AS (SELECT DISTINCT transaction_id FROM v WHERE NOT late)
SELECT transaction_id, kafka_offset, kafka_partition, event_timestamp, watermark, s.transaction_id IS NOT NULL AS in_silver
FROM v LEFT JOIN s USING (transaction_id) WHERE late""")
