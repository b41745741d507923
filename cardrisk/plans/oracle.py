"""DuckDB twins of the catalogue queries (the correctness oracle).

Written independently of the Spark plans, as plain SQL over the
pre-registered views. Straightforward single-partition window frames and
joins are used here on purpose: the oracle states *what* is computed, the
Spark plans decide *how* it scales.
"""

from __future__ import annotations

from ..config import (
    ACCEPTED_CURRENCIES,
    HIGH_RISK_CATEGORIES,
)
from ..sources.fixture import FIXTURE_CATEGORIES

RUN_TS = "2024-02-01 00:00:00"
RUN_ID = "run-00000001"
CUT_TS = "2024-01-16 00:00:00"


def _list(xs) -> str:
    return "[" + ", ".join(f"'{x}'" for x in xs) + "]"


def _in(xs) -> str:
    return "(" + ", ".join(f"'{x}'" for x in xs) + ")"


CATS = _list(FIXTURE_CATEGORIES + HIGH_RISK_CATEGORIES)
CURS = _list(ACCEPTED_CURRENCIES)
HIGH = _in(HIGH_RISK_CATEGORIES)
CURS_IN = _in(ACCEPTED_CURRENCIES)

# events -> transactions (same mapping as cardrisk.sources.fixture)
TX = f"""
ev AS (
  SELECT event_id AS eid, ts, user_id AS uid, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events
),
tx1 AS (
  SELECT
    eid,
    'txn_' || lpad(CAST(eid AS VARCHAR), 12, '0') AS transaction_id,
    'card_' || lpad(CAST(uid % 5 AS VARCHAR), 5, '0') AS card_id,
    'user_' || lpad(CAST(uid AS VARCHAR), 5, '0') AS user_id,
    'merch_' || lpad(CAST(k AS VARCHAR), 5, '0') AS merchant_id,
    '  Merchant ' || CAST(k AS VARCHAR) || ' ' AS merchant_name,
    CASE WHEN eid % 7 = 0 THEN ' ' || lower({CATS}[k % 12 + 1]) || ' ' ELSE {CATS}[k % 12 + 1] END
      AS merchant_category,
    CASE WHEN k % 20 = 0 THEN round(value * 15, 2) ELSE round(value, 2) END AS amount,
    CASE WHEN eid % 50 = 0 THEN 'XXX' WHEN eid % 50 = 1 THEN 'usd ' ELSE {CURS}[eid % 6 + 1] END
      AS currency,
    CASE eid % 10 WHEN 7 THEN 'CA' WHEN 8 THEN 'GB' WHEN 9 THEN 'CN' ELSE 'US' END AS country,
    ' City ' || CAST(k % 7 AS VARCHAR) || ' ' AS city,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00' AS "timestamp",
    (CASE eid % 10 WHEN 7 THEN 'CA' WHEN 8 THEN 'GB' WHEN 9 THEN 'CN' ELSE 'US' END) <> 'US'
      AS is_international,
    event_type <> 'click' AS card_present,
    CASE event_type WHEN 'click' THEN ' Mobile' WHEN 'view' THEN 'desktop' ELSE 'POS ' END AS device_type,
    k % 20 = 0 AS _is_injected_anomaly,
    CAST(eid // 3 AS BIGINT) AS kafka_offset,
    CAST(eid % 3 AS BIGINT) AS kafka_partition,
    ts + to_milliseconds(k * 10) AS kafka_ingest_time,
    ts AS event_time,
    ts + INTERVAL 2 SECOND AS ingested_at,
    '1.0.0' AS pipeline_version
  FROM ev
),
tx AS (
  SELECT transaction_id, card_id, user_id, merchant_id, merchant_name, merchant_category, amount,
         currency, country, city, "timestamp", is_international, card_present, device_type,
         _is_injected_anomaly, kafka_offset, kafka_partition, kafka_ingest_time, event_time,
         ingested_at, pipeline_version FROM tx1
  UNION ALL
  SELECT transaction_id, card_id, user_id, merchant_id, merchant_name, merchant_category, amount,
         currency, country, city, "timestamp", is_international, card_present, device_type,
         _is_injected_anomaly, kafka_offset + 1000000 AS kafka_offset, kafka_partition,
         kafka_ingest_time, event_time, ingested_at + INTERVAL 60 SECOND AS ingested_at, pipeline_version
  FROM tx1 WHERE eid % 40 = 0
)"""

PARSE_TS = "CAST(try_cast({c} AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS TIMESTAMP)"

BRONZE = f"""
bronze AS (
  SELECT transaction_id, card_id, user_id, merchant_id, merchant_name, merchant_category,
         CAST(amount AS DOUBLE) AS amount, currency, country, city,
         {PARSE_TS.format(c='"timestamp"')} AS event_timestamp,
         is_international, card_present, device_type, ingested_at, kafka_ingest_time,
         kafka_offset, kafka_partition, pipeline_version
  FROM tx
)"""

VALID_WHERE = f"""transaction_id IS NOT NULL AND card_id IS NOT NULL AND amount IS NOT NULL
    AND amount > 0.0 AND amount <= 100000.0 AND currency IN {CURS_IN}"""

SILVER = f"""
valid AS (
  SELECT * FROM bronze WHERE {VALID_WHERE}
),
deduped AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id
                                 ORDER BY ingested_at DESC, kafka_partition DESC, kafka_offset DESC) AS rn
    FROM valid) WHERE rn = 1
),
silver AS (
  SELECT transaction_id, card_id, user_id, merchant_id,
         trim(merchant_name) AS merchant_name,
         upper(trim(merchant_category)) AS merchant_category,
         round(amount, 2) AS amount,
         upper(trim(currency)) AS currency,
         upper(trim(country)) AS country,
         trim(city) AS city,
         event_timestamp, is_international, card_present,
         lower(trim(device_type)) AS device_type,
         ingested_at, kafka_ingest_time, kafka_offset, kafka_partition, pipeline_version,
         CAST(hour(event_timestamp) AS INTEGER) AS tx_hour,
         CAST(dayofweek(event_timestamp) + 1 AS INTEGER) AS tx_day_of_week,
         CAST(event_timestamp AS DATE) AS tx_date,
         CAST(weekofyear(event_timestamp) AS INTEGER) AS tx_week,
         CAST(month(event_timestamp) AS INTEGER) AS tx_month,
         CASE WHEN amount < 25 THEN 'MICRO' WHEN amount < 100 THEN 'SMALL' WHEN amount < 500 THEN 'MEDIUM'
              WHEN amount < 2000 THEN 'LARGE' ELSE 'VERY_LARGE' END AS amount_bucket,
         coalesce(upper(trim(merchant_category)) IN {HIGH}, false) AS is_high_risk_mcc,
         NOT card_present AS is_cnp,
         coalesce(hour(event_timestamp) >= 0 AND hour(event_timestamp) < 5, false) AS is_off_hours,
         coalesce(upper(trim(country)) <> 'US', false) AS is_foreign_country,
         date_diff('millisecond', event_timestamp, kafka_ingest_time) AS kafka_latency_ms
  FROM deduped
)"""

D = "::DOUBLE"
VEL = f"least(100.0{D}, greatest(0.0{D}, amount_zscore / 6.0{D} * 100.0{D}))"
FREQ = "least(100.0{D}, CAST({c} AS DOUBLE) / 5.0{D} * 100.0{D})"
CB = (f"CASE WHEN is_international AND amount > 200.0{D} THEN 100.0{D} "
      f"WHEN is_international THEN 50.0{D} ELSE 0.0{D} END")
COMPOSITE = (f"least(100.0{D}, greatest(0.0{D}, round(score_amount_velocity * 0.35{D} + score_tx_frequency * 0.25{D}"
             f" + score_off_hours * 0.15{D} + score_cross_border * 0.15{D} + score_high_risk_mcc * 0.1{D}, 2)))")
LEVEL = "CASE WHEN anomaly_score >= 70.0 THEN 'HIGH' WHEN anomaly_score >= 40.0 THEN 'MEDIUM' ELSE 'LOW' END"
TRIGGERS = ("concat_ws(',', CASE WHEN score_amount_velocity >= 50 THEN 'amount_velocity' END, "
            "CASE WHEN {freq_fired} THEN 'tx_frequency' END, "
            "CASE WHEN score_off_hours > 0 THEN 'off_hours' END, "
            "CASE WHEN score_cross_border > 0 THEN 'cross_border' END, "
            "CASE WHEN score_high_risk_mcc > 0 THEN 'high_risk_mcc' END)")

# as-coded scoring: R1 over all of a user's rows, R2 per card and hour
SCORED_T = f"""
stats AS (
  SELECT *,
    avg(amount) OVER (PARTITION BY {{user_part}}) AS user_batch_mean,
    stddev_samp(amount) OVER (PARTITION BY {{user_part}}) AS user_batch_std,
    count(*) OVER (PARTITION BY {{card_part}}) AS tx_count_batch
  FROM silver
),
z AS (
  SELECT *, CASE WHEN user_batch_std > 0 THEN (amount - user_batch_mean) / user_batch_std ELSE 0.0{D} END
            AS amount_zscore
  FROM stats
),
rules AS (
  SELECT *,
    {VEL} AS score_amount_velocity,
    {FREQ.format(D=D, c='tx_count_batch')} AS score_tx_frequency,
    CASE WHEN is_off_hours THEN 100.0{D} ELSE 0.0{D} END AS score_off_hours,
    {CB} AS score_cross_border,
    CASE WHEN is_high_risk_mcc THEN 100.0{D} ELSE 0.0{D} END AS score_high_risk_mcc
  FROM z
),
comp AS (SELECT *, {COMPOSITE} AS anomaly_score FROM rules),
scored AS (
  SELECT *, {LEVEL} AS risk_level,
         {TRIGGERS.format(freq_fired='score_tx_frequency >= 50')} AS triggered_rules,
         event_timestamp + INTERVAL 5 SECOND AS scored_at
  FROM comp
)"""

SCORED = SCORED_T.replace("{card_part}", "card_id, date_trunc('hour', event_timestamp)").replace("{user_part}", "user_id")

# the streams' scope: a span of whole days, as one micro-batch brings
STREAM_SLICE_DAYS = 5
_SLICE = f"epoch_us(event_timestamp) // {STREAM_SLICE_DAYS * 86_400_000_000}"
SCORED_BATCH = SCORED_T.replace("{card_part}", f"card_id, {_SLICE}").replace("{user_part}", f"user_id, {_SLICE}")

US = "epoch_us(event_timestamp)"
HISTORY = f"""
h1 AS (
  SELECT *,
    count(amount) OVER w30 AS user_30d_n,
    avg(amount) OVER w30 AS user_30d_mean,
    stddev_samp(amount) OVER w30 AS user_30d_std,
    count(*) OVER w10 AS tx_count_10min,
    min(country) OVER w60 AS cmin, max(country) OVER w60 AS cmax
  FROM silver
  WINDOW w30 AS (PARTITION BY user_id ORDER BY {US} RANGE BETWEEN 2592000000000 PRECEDING AND 1 PRECEDING),
         w10 AS (PARTITION BY card_id ORDER BY {US} RANGE BETWEEN 600000000 PRECEDING AND CURRENT ROW),
         w60 AS (PARTITION BY card_id ORDER BY {US} RANGE BETWEEN 3600000000 PRECEDING AND CURRENT ROW)
),
firsts AS (
  SELECT user_id, merchant_category, min((event_timestamp, transaction_id)) AS f
  FROM silver WHERE is_high_risk_mcc GROUP BY ALL
),
h2 AS (
  SELECT h1.*,
    CASE WHEN user_30d_n >= 2 AND user_30d_std > 0 THEN (amount - user_30d_mean) / user_30d_std ELSE 0.0{D} END
      AS amount_zscore,
    coalesce(cmin <> cmax, false) AS countries_60min_multi,
    coalesce(h1.is_high_risk_mcc AND (h1.event_timestamp, h1.transaction_id) = firsts.f, false) AS is_first_high_risk
  FROM h1 LEFT JOIN firsts USING (user_id, merchant_category)
),
h3 AS (
  SELECT *,
    {VEL} AS score_amount_velocity,
    {FREQ.format(D=D, c='tx_count_10min')} AS score_tx_frequency,
    CASE WHEN is_off_hours THEN 100.0{D} ELSE 0.0{D} END AS score_off_hours,
    CASE WHEN countries_60min_multi THEN 100.0{D} ELSE 0.0{D} END AS score_cross_border,
    CASE WHEN is_first_high_risk THEN 100.0{D} ELSE 0.0{D} END AS score_high_risk_mcc
  FROM h2
),
h4 AS (SELECT *, {COMPOSITE} AS anomaly_score FROM h3),
hist AS (
  SELECT *, {LEVEL} AS risk_level,
         {TRIGGERS.format(freq_fired='tx_count_10min > 5')} AS triggered_rules
  FROM h4
)"""


def w(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes) + "\n"


BASE = (TX, BRONZE, SILVER)

GOLD = f"""
sc AS (
  SELECT transaction_id, round(anomaly_score, 2) AS anomaly_score, risk_level, triggered_rules,
         round(amount_zscore, 4) AS amount_zscore,
         round(score_amount_velocity, 2) AS score_amount_velocity,
         round(score_tx_frequency, 2) AS score_tx_frequency,
         round(score_off_hours, 2) AS score_off_hours,
         round(score_cross_border, 2) AS score_cross_border,
         round(score_high_risk_mcc, 2) AS score_high_risk_mcc,
         scored_at
  FROM scored
),
sc1 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY scored_at DESC, anomaly_score DESC) AS rn
    FROM sc) WHERE rn = 1 AND risk_level IN ('MEDIUM', 'HIGH')
),
gold AS (
  SELECT t.transaction_id, t.card_id, t.user_id, t.merchant_id, t.merchant_name, t.merchant_category,
         t.amount, t.currency, t.amount_bucket, t.country, t.city, t.is_international, t.is_foreign_country,
         t.card_present, t.is_cnp, t.device_type, t.event_timestamp, t.tx_hour, t.tx_day_of_week,
         CAST(t.tx_date AS VARCHAR) AS tx_date, t.is_off_hours, t.is_high_risk_mcc,
         s.anomaly_score, s.risk_level, s.triggered_rules, s.amount_zscore, s.score_amount_velocity,
         s.score_tx_frequency, s.score_off_hours, s.score_cross_border, s.score_high_risk_mcc,
         CASE WHEN s.anomaly_score >= 70 THEN '🚨 ANOMALY' WHEN s.anomaly_score >= 40 THEN '⚠️  SUSPICIOUS'
              ELSE '✅ NORMAL' END AS risk_label,
         s.scored_at,
         date_diff('millisecond', t.event_timestamp, s.scored_at) AS end_to_end_latency_ms
  FROM silver t JOIN sc1 s ON t.transaction_id = s.transaction_id
)"""

JSON_OK = "(json_valid({v}) AND json_type(CASE WHEN json_valid({v}) THEN {v} END) = 'OBJECT')"

WIRE = f"""
wire0 AS (
  SELECT *, CAST(substr(transaction_id, 5) AS BIGINT) AS eid FROM tx
),
wire1 AS (
  SELECT *, CASE WHEN eid % 101 = 1 THEN 'garbage' WHEN eid % 103 = 2 THEN 'truncated'
                 WHEN eid % 107 = 3 THEN 'amount_text' WHEN eid % 109 = 4 THEN 'missing_id'
                 WHEN eid % 113 = 5 THEN 'negative_amount' WHEN eid % 127 = 6 THEN 'bad_timestamp'
                 WHEN eid % 131 = 7 THEN 'extra_field' END AS kind
  FROM wire0
),
wire2 AS (
  SELECT *, CAST(json_object(
      'transaction_id', CASE WHEN kind = 'missing_id' THEN NULL ELSE transaction_id END,
      'card_id', card_id, 'user_id', user_id, 'merchant_id', merchant_id, 'merchant_name', merchant_name,
      'merchant_category', merchant_category,
      'amount', CASE WHEN kind = 'negative_amount' THEN -amount ELSE amount END,
      'currency', currency, 'country', country, 'city', city,
      'timestamp', CASE WHEN kind = 'bad_timestamp' THEN 'not-a-time' ELSE "timestamp" END,
      'is_international', is_international, 'card_present', card_present, 'device_type', device_type,
      '_is_injected_anomaly', _is_injected_anomaly) AS VARCHAR) AS js
  FROM wire1
),
raw AS (
  SELECT CASE kind
           WHEN 'amount_text' THEN regexp_replace(js, '"amount":[-0-9.Ee]+', '"amount":"abc"')
           WHEN 'extra_field' THEN regexp_replace(js, '^\\{{', '{{"promo_code":"X1",')
           WHEN 'truncated' THEN substr(js, 1, 40)
           WHEN 'garbage' THEN 'not json at all ' || transaction_id
           ELSE js END AS value,
         kafka_offset, kafka_partition, kafka_ingest_time, ingested_at
  FROM wire2
),
p1 AS (
  SELECT value AS raw_payload, kafka_offset, kafka_partition, kafka_ingest_time, ingested_at,
         {JSON_OK.format(v='value')} AS ok_json,
         CASE WHEN json_valid(value) THEN value END AS j
  FROM raw
),
parsed AS (
  SELECT raw_payload, kafka_offset, kafka_partition, kafka_ingest_time, ingested_at,
    json_extract_string(j, '$.transaction_id') AS transaction_id,
    json_extract_string(j, '$.card_id') AS card_id,
    json_extract_string(j, '$.user_id') AS user_id,
    json_extract_string(j, '$.merchant_id') AS merchant_id,
    json_extract_string(j, '$.merchant_name') AS merchant_name,
    json_extract_string(j, '$.merchant_category') AS merchant_category,
    CASE WHEN json_type(j, '$.amount') IN ('DOUBLE', 'UBIGINT', 'BIGINT')
         THEN CAST(json_extract(j, '$.amount') AS DOUBLE) END AS amount,
    json_extract_string(j, '$.currency') AS currency,
    json_extract_string(j, '$.country') AS country,
    json_extract_string(j, '$.city') AS city,
    json_extract_string(j, '$.timestamp') AS "timestamp",
    CASE WHEN json_type(j, '$.is_international') = 'BOOLEAN'
         THEN CAST(json_extract(j, '$.is_international') AS BOOLEAN) END AS is_international,
    CASE WHEN json_type(j, '$.card_present') = 'BOOLEAN'
         THEN CAST(json_extract(j, '$.card_present') AS BOOLEAN) END AS card_present,
    json_extract_string(j, '$.device_type') AS device_type,
    CASE WHEN json_type(j, '$._is_injected_anomaly') = 'BOOLEAN'
         THEN CAST(json_extract(j, '$._is_injected_anomaly') AS BOOLEAN) END AS _is_injected_anomaly,
    {PARSE_TS.format(c="json_extract_string(j, '$.timestamp')")} AS event_time,
    CASE WHEN raw_payload IS NULL THEN 'null_payload'
         WHEN NOT ok_json THEN 'malformed_json'
         WHEN json_extract_string(j, '$.transaction_id') IS NULL THEN 'missing_transaction_id'
         WHEN json_extract_string(j, '$.card_id') IS NULL THEN 'missing_card_id'
         WHEN json_type(j, '$.amount') NOT IN ('DOUBLE', 'UBIGINT', 'BIGINT') OR json_type(j, '$.amount') IS NULL
           THEN 'missing_or_bad_amount'
         WHEN isnan(CAST(json_extract(j, '$.amount') AS DOUBLE)) THEN 'nan_amount'
         WHEN CAST(json_extract(j, '$.amount') AS DOUBLE) <= 0 THEN 'non_positive_amount'
    END AS reject_reason
  FROM p1
)"""

# the stream's bronze: parsed deliveries that carry an event time
STREAM_BRONZE = f"""
bronze AS (
  SELECT transaction_id, card_id, user_id, merchant_id, merchant_name, merchant_category, amount, currency,
         country, city, event_time AS event_timestamp, is_international, card_present, device_type,
         ingested_at, kafka_ingest_time, kafka_offset, kafka_partition, '1.0.0' AS pipeline_version
  FROM parsed WHERE reject_reason IS NULL AND event_time IS NOT NULL
)"""
