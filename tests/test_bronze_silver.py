"""Parsing, dead letter, silver validity and dedup."""

from pyspark.sql import functions as F

from cardrisk.config import DEFAULT
from cardrisk.operators import bronze as B
from cardrisk.operators import silver as SV

GOOD = ('{"transaction_id":"t%d","card_id":"c1","user_id":"u1","merchant_id":"m1","amount":%s,'
        '"currency":"USD","country":"US","timestamp":"2024-01-01T03:00:00.000000+00:00",'
        '"is_international":false,"card_present":true,"merchant_category":"GROCERY"}')


def raw(spark, payloads):
    rows = [(p, i, 0, None, None) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, "value string, kafka_offset bigint, kafka_partition bigint, "
                                       "kafka_ingest_time timestamp_ntz, ingested_at timestamp_ntz")


def test_reject_reasons(spark):
    payloads = [
        GOOD % (1, "12.5"),
        "not json",
        (GOOD % (2, "12.5"))[:40],
        GOOD % (3, '"abc"'),
        GOOD % (4, '"4.5"'),
        GOOD.replace('"transaction_id":"t%d",', "") % ("1.0",),
        GOOD % (6, "-3"),
        GOOD % (7, '"NaN"'),
        None,
        (GOOD % (9, "5")).replace("{", '{"extra":1,', 1),
        (GOOD % (10, "5")).replace("2024-01-01T03:00:00.000000+00:00", "junk"),
    ]
    parsed = B.parse_records(raw(spark, payloads)).orderBy("kafka_offset").collect()
    reasons = [r.reject_reason for r in parsed]
    assert reasons == [None, "malformed_json", "malformed_json", "missing_or_bad_amount",
                       "missing_or_bad_amount", "missing_transaction_id", "non_positive_amount", "nan_amount",
                       "null_payload", None, None]
    # an unquoted NaN token is not strict JSON: rejected as malformed
    bare = B.parse_records(raw(spark, [GOOD % (8, "NaN")])).first()
    assert bare.reject_reason == "malformed_json"
    assert parsed[10].event_time is None            # junk time parses to NULL, not an error
    assert str(parsed[0].event_time) == "2024-01-01 03:00:00"


def test_bronze_and_dead_letter_partition_the_input(spark):
    payloads = [GOOD % (i, "1.5") for i in range(5)] + ["x", None]
    good, dead = B.parse_to_bronze(raw(spark, payloads))
    assert good.count() == 5 and dead.count() == 2
    assert set(good.columns) >= {"event_time", "ingested_at", "pipeline_version"}


def test_future_guard(spark):
    cfg = DEFAULT.with_(future_tolerance_seconds=60)
    r = raw(spark, [GOOD % (1, "2")]).withColumn("kafka_ingest_time", F.lit("2024-01-01 02:00:00").cast("timestamp_ntz"))
    assert B.parse_records(r, cfg).first().reject_reason == "future_event_time"


def _typed(spark, rows):
    return spark.createDataFrame(rows, "transaction_id string, card_id string, amount double, currency string, "
                                       "ingested_at timestamp_ntz, kafka_partition bigint, kafka_offset bigint")


def test_currency_checked_before_normalising(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    df = _typed(spark, [("a", "c", 10.0, "usd ", t, 0, 1), ("b", "c", 10.0, "USD", t, 0, 2),
                        ("c", "c", 100000.004, "USD", t, 0, 3), ("d", "c", 0.0, "USD", t, 0, 4)])
    assert {r.transaction_id for r in SV.valid(df).collect()} == {"b"}
    assert {r.transaction_id for r in SV.valid(df, DEFAULT.with_(normalize_first=True)).collect()} == {"a", "b", "c"}


def test_dedup_keeps_latest_delivery(spark):
    import datetime as dt
    t = dt.datetime(2024, 1, 1)
    df = _typed(spark, [("a", "c", 1.0, "USD", t, 0, 1), ("a", "c", 2.0, "USD", t + dt.timedelta(seconds=60), 0, 9),
                        ("b", "c", 3.0, "USD", t, 0, 1), ("b", "c", 4.0, "USD", t, 1, 1)])
    got = {r.transaction_id: r.amount for r in SV.dedup_latest(df).collect()}
    assert got == {"a": 2.0, "b": 4.0}


def test_upsert_is_idempotent(spark):
    tgt = spark.createDataFrame([("a", 1), ("b", 1)], "transaction_id string, v int")
    inc = spark.createDataFrame([("b", 2), ("c", 2)], "transaction_id string, v int")
    once = SV.upsert(tgt, inc)
    twice = SV.upsert(once, inc)
    assert sorted(once.collect()) == sorted(twice.collect())
    assert {r.transaction_id: r.v for r in once.collect()} == {"a": 1, "b": 2, "c": 2}


def test_gold_follows_the_latest_score(spark):
    """The latest score decides -- HIGH then LOW leaves gold, LOW then HIGH enters it."""
    from conftest import SF_SMALL
    from cardrisk.operators import gold as G
    from cardrisk.plans import catalogue as C
    silver = C.silver_table(spark, SF_SMALL)
    scored = C.scored_rows(spark, SF_SMALL, silver).withColumn("scored_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    ids = [r.transaction_id for r in silver.orderBy("transaction_id").limit(3).collect()]
    first = scored.filter(F.col("transaction_id").isin(ids))
    level = lambda mapping: F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[F.col("transaction_id")]
    def at(when, levels):
        high = level(levels) == "HIGH"
        return (first.withColumn("risk_level", level(levels)).withColumn("anomaly_score", F.when(high, 80.0).otherwise(10.0))
                     .withColumn("scored_at", F.lit(when).cast("timestamp_ntz")))
    falls, rises, stays = ids
    scores = at("2024-01-01 00:00:00", {falls: "HIGH", rises: "LOW", stays: "HIGH"}).unionByName(
        at("2024-01-02 00:00:00", {falls: "LOW", rises: "HIGH", stays: "HIGH"}))
    got = [(r.transaction_id, r.risk_level, r.scored_at.day) for r in G.gold_anomalies(silver, scores).collect()]
    assert sorted(got) == sorted([(rises, "HIGH", 2), (stays, "HIGH", 2)])
