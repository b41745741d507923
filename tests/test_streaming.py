"""Streaming behaviour: stream == batch on the same rows, late rows, restart,
idempotent fan-out."""

import datetime as dt
import json
from decimal import Decimal

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cardrisk.session import scratch_path
from cardrisk.streaming import pipeline as P

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def payload(i, t, card="c1", amount=10.0):
    return json.dumps({"transaction_id": f"t{i}", "card_id": card, "user_id": "u1", "merchant_id": "m",
                       "merchant_category": "GROCERY", "amount": amount, "currency": "USD", "country": "US",
                       "timestamp": t.strftime("%Y-%m-%dT%H:%M:%S.%f") + "+00:00", "is_international": False,
                       "card_present": True})


def write_batch(spark, path, rows):
    df = spark.createDataFrame(
        [(payload(i, t), i, 0, t, t) for i, t in rows],
        "value string, kafka_offset bigint, kafka_partition bigint, kafka_ingest_time timestamp_ntz, "
        "ingested_at timestamp_ntz")
    df.coalesce(1).write.mode("append").parquet(path)


@pytest.mark.parametrize("key", ["stream_dedup", "stream_restart", "stream_scored_fanout", "stream_sliding",
                                 "stream_minute_summary", "stream_stateful_rules", "stream_warm_start", "stream_user_stats", "stream_alerts", "stream_live_feed", "stream_history_batches",
                                 "stream_late_rows"])
def test_stream_keys_match_duckdb(spark, key):
    from __spark_entry__ import oracle_sql, queries
    df = queries()[key](spark, SF_SMALL)
    cols = sorted(df.columns)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF_SMALL}/events.parquet')")
    want = sorted(con.execute(f"SELECT {', '.join(cols)} FROM ({oracle_sql()[key]})").fetchall(), key=repr)
    got = sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
    assert got == want


def test_late_rows_dropped_only_by_stateful_step(spark):
    base = scratch_path(spark, "late")
    raw = f"{base}/raw"
    write_batch(spark, raw, [(1, T0), (2, T0 + dt.timedelta(minutes=1))])
    write_batch(spark, raw, [(3, T0 + dt.timedelta(minutes=60))])            # watermark -> T0+50min
    write_batch(spark, raw, [(4, T0 + dt.timedelta(minutes=61))])            # batch in which it is applied
    write_batch(spark, raw, [(5, T0 + dt.timedelta(minutes=5)), (6, T0 + dt.timedelta(minutes=62))])  # 5 is late
    bronze, _ = P.bronze_stream(P.read_raw_stream(spark, raw, 1))
    P.start_append(bronze, f"{base}/bronze", f"{base}/ck/bronze").awaitTermination()
    silver = P.silver_stream(P.bronze_stream(P.read_raw_stream(spark, raw, 1))[0]).drop(P.ET)
    P.start_append(silver, f"{base}/silver", f"{base}/ck/silver").awaitTermination()
    b = {r.transaction_id for r in spark.read.parquet(f"{base}/bronze").collect()}
    s = {r.transaction_id for r in spark.read.parquet(f"{base}/silver").collect()}
    assert b == {f"t{i}" for i in range(1, 7)}          # stateless layer keeps late rows
    assert s == b - {"t5"}                               # dedup (stateful) drops the late one


def test_restart_adds_nothing_and_redelivery_is_dropped(spark):
    base = scratch_path(spark, "restart")
    raw = f"{base}/raw"
    write_batch(spark, raw, [(1, T0), (2, T0 + dt.timedelta(minutes=1))])
    q = lambda: P.start_append(P.silver_stream(P.bronze_stream(P.read_raw_stream(spark, raw, 1))[0]).drop(P.ET),
                               f"{base}/out", f"{base}/ck")
    q().awaitTermination()
    q().awaitTermination()                               # nothing new: no new rows
    assert spark.read.parquet(f"{base}/out").count() == 2
    write_batch(spark, raw, [(2, T0 + dt.timedelta(minutes=1)), (3, T0 + dt.timedelta(minutes=2))])  # t2 again
    q().awaitTermination()
    assert sorted(r.transaction_id for r in spark.read.parquet(f"{base}/out").collect()) == ["t1", "t2", "t3"]


def test_fan_out_replay_is_idempotent(spark):
    base = scratch_path(spark, "fanout")
    sinks = P.Sinks(base)
    from cardrisk.plans import catalogue as C
    silver = C.silver_rows(spark, SF_SMALL)
    run = P.score_and_fan_out(sinks)
    run(silver, 7)
    first = sorted(spark.read.parquet(sinks.path("scored")).select("transaction_id", "anomaly_score").collect())
    run(silver, 7)                                       # the same batch delivered again
    again = sorted(spark.read.parquet(sinks.path("scored")).select("transaction_id", "anomaly_score").collect())
    assert first == again and len(first) == silver.count()
    assert spark.read.parquet(sinks.path("gold_anomalies")).filter(~F.col("risk_level").isin("MEDIUM", "HIGH")) \
        .count() == 0


def test_bronze_and_dead_letter_from_one_read(spark):
    base = scratch_path(spark, "bronze-dl")
    raw = f"{base}/raw"
    write_batch(spark, raw, [(1, T0), (2, T0 + dt.timedelta(minutes=1))])
    bad = spark.createDataFrame([("not json", 9, 0, T0, T0), (None, 10, 0, T0, T0)],
                                "value string, kafka_offset bigint, kafka_partition bigint, "
                                "kafka_ingest_time timestamp_ntz, ingested_at timestamp_ntz")
    bad.coalesce(1).write.mode("append").parquet(raw)
    sinks = P.Sinks(f"{base}/out")
    P.start_bronze(P.read_raw_stream(spark, raw, 1), sinks, f"{base}/ck").awaitTermination()
    assert spark.read.parquet(sinks.path("bronze")).count() == 2
    reasons = sorted(r.reject_reason for r in spark.read.parquet(sinks.path("dead_letter")).collect())
    assert reasons == ["malformed_json", "null_payload"]


def test_fan_out_runs_the_stream_plan_once_per_batch(spark):
    """The stateful dedup upstream of the fan-out executes once per
    micro-batch: its state holds exactly the rows written to silver (a
    scoring branch re-running the stream plan would multiply the count)."""
    from cardrisk.plans import catalogue as C
    from cardrisk.streaming import staging
    base, raw, ckpt, out = C._stream_dirs(spark, "fanout-once")
    staging.stage(C._raw(spark, SF_SMALL), raw, None)
    sinks = P.Sinks(out)
    q = P.start_scoring(C._silver_from(spark, raw), sinks, f"{ckpt}/score")
    q.awaitTermination()
    first = q.recentProgress[0]
    silver_rows = spark.read.parquet(sinks.path("silver")).count()
    assert first["stateOperators"][0]["numRowsTotal"] == silver_rows > 0
    # the closing batch has no rows and writes no partition
    assert spark.read.parquet(sinks.path("silver")).select("batch_id").distinct().count() == 1


def test_replayed_scoring_batch_counts_once(spark):
    """A batch that is written again after a failure reaches the summary as new
    files; its rows are counted once."""
    from cardrisk.plans import catalogue as C
    base = scratch_path(spark, "replay")
    sinks = P.Sinks(f"{base}/out")
    rows = C.silver_rows(spark, SF_SMALL).withColumn("event_timestamp", F.lit(T0).cast("timestamp_ntz")).limit(1)
    later = rows.withColumn("transaction_id", F.lit("late")).withColumn("event_timestamp", F.lit(T0 + dt.timedelta(hours=2)).cast("timestamp_ntz"))
    run = P.score_and_fan_out(sinks)
    rows = spark.createDataFrame(rows.collect(), rows.schema)
    later = spark.createDataFrame(later.collect(), later.schema)
    run(rows, 0)
    schema = spark.read.parquet(sinks.path("scored")).schema

    def summarise():
        scored = spark.readStream.schema(schema).parquet(sinks.path("scored"))
        P.start_append(P.minute_summary_stream(scored), f"{base}/summary", f"{base}/ck").awaitTermination()
    summarise()
    run(rows, 0)                                         # delivered and written again
    run(later, 1)                                        # moves the watermark on
    summarise()
    got = spark.read.parquet(f"{base}/summary").collect()
    assert [r.tx_count for r in got] == [1]


def _state_rows(spark, path, rows):
    """Silver-shaped rows (id, card, user, minutes after T0, country, category, amount) as one file."""
    data = [(i, c, u, T0 + dt.timedelta(minutes=m), k, g, a, False) for i, c, u, m, k, g, a in rows]
    spark.createDataFrame(data, "transaction_id string, card_id string, user_id string, event_timestamp timestamp_ntz, country string, "
                          "merchant_category string, amount double, is_off_hours boolean").coalesce(1).write.mode("append").parquet(path)


def test_late_rows_inside_the_watermark_are_scored_as_in_batch(spark):
    """A row that comes late still sees all rows its frames reach back to: the
    state outlives the frame by the watermark, for minutes and for days."""
    from cardrisk.operators import features as FT
    from cardrisk.operators import rules as R
    from cardrisk.streaming import state as ST
    ST.ensure_rocksdb(spark)
    base = scratch_path(spark, "late-state")
    raw, day = f"{base}/raw", 24 * 60
    midnight = 31 * day - 12 * 60                        # T0 is at noon
    for b in ([("a", "c", "u", 0, "US", "X", 10.0)], [("b", "c", "u", 61, "CA", "X", 20.0)], [("late", "c", "u", 55, "CA", "X", 30.0)]):
        _state_rows(spark, raw, b)
    users = f"{base}/users"
    for b in ([("d0", "z", "v", -60, "US", "X", 5.0)], [("d1", "z", "v", day, "US", "X", 7.0)], [("d31", "z", "v", midnight + 1, "US", "X", 9.0)],
              [("d30", "z", "v", midnight - 1, "US", "X", 11.0)]):
        _state_rows(spark, users, b)

    def stream(path):
        schema = spark.read.parquet(path).schema
        s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
        return s.withColumn(P.ET, F.col("event_timestamp").cast("timestamp")).withWatermark(P.ET, "10 minutes")
    P.start_append(ST.card_history(stream(raw)), f"{base}/card", f"{base}/ck1").awaitTermination()
    P.start_append(ST.user_history(stream(users)), f"{base}/user", f"{base}/ck2").awaitTermination()
    card = {r.transaction_id: r for r in spark.read.parquet(f"{base}/card").collect()}
    want = {r.transaction_id: r for r in R.card_history(spark.read.parquet(raw)).collect()}
    assert card["late"].countries_60min_multi is True and want["late"].countries_60min_multi is True
    assert card["late"].tx_count_10min == want["late"].tx_count_10min == 1
    user = {r.transaction_id: r for r in spark.read.parquet(f"{base}/user").collect()}
    silver = spark.read.parquet(users).withColumn("tx_date", F.to_date("event_timestamp"))
    stats = {r.transaction_id: r.user_30d_n for r in FT.score_with_user_stats(silver, FT.user_stats(silver)).collect()}
    assert user["d30"].user_30d_n == stats["d30"] == 2   # days 0 and 1


def test_a_replayed_batch_publishes_its_alerts_once(spark, monkeypatch):
    from cardrisk.sources import storage
    base = scratch_path(spark, "outbox")
    sinks = P.Sinks(f"{base}/out", "json", {"path": f"{base}/topic"})
    alerts = lambda at: spark.createDataFrame([("c1", f"{{\"transaction_id\": \"t1\", \"scored_at\": {at}}}"), ("c2", f"{{\"transaction_id\": \"t2\", \"scored_at\": {at}}}")], "key string, value string")
    topic = lambda: sorted(tuple(r) for r in spark.read.schema("key string, value string").json(f"{base}/topic").collect())
    P.publish(alerts(1), sinks, 0)
    P.publish(alerts(2), sinks, 0)                       # replayed after the mark: nothing goes out
    assert len(topic()) == 2 and storage.exists(spark, P.published(sinks, 0))
    # it dies after the outbox was written and before the sink took anything
    monkeypatch.setitem(sinks.alert_options, "compression", "no such codec")
    with pytest.raises(Exception):
        P.publish(alerts(3), sinks, 1)
    monkeypatch.delitem(sinks.alert_options, "compression")
    P.publish(alerts(4), sinks, 1)                       # scored again later: the outbox's records leave, once
    assert [v for _, v in topic() if "3}" in v] and not [v for _, v in topic() if "4}" in v] and len(topic()) == 4
    # it dies between publishing and the mark: the same records again, to the byte
    with monkeypatch.context() as m:
        m.setattr(P, "mark_published", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            P.publish(alerts(5), sinks, 2)
    P.publish(alerts(6), sinks, 2)
    P.publish(alerts(7), sinks, 2)
    assert len(topic()) == 8 and len(set(topic())) == 6
    outbox = spark.read.parquet(sinks.path("alerts"))
    assert {r.batch_id for r in outbox.collect()} == {0, 1, 2} and outbox.count() == 6


def test_a_replayed_scoring_batch_alerts_once(spark):
    """The whole fan-out called twice for one batch, as a restart does."""
    from cardrisk.plans import catalogue as C
    base = scratch_path(spark, "replay-alerts")
    sinks = P.Sinks(f"{base}/out", "json", {"path": f"{base}/topic"})
    silver = C.silver_table(spark, SF_SMALL)
    run = P.score_and_fan_out(sinks)
    run(silver, 3)
    ids = lambda: [r[0] for r in spark.read.schema("key string, value string").json(f"{base}/topic").select(
        F.get_json_object("value", "$.transaction_id")).collect()]
    first = ids()
    run(silver, 3)
    assert sorted(ids()) == sorted(first) and len(set(first)) == len(first) > 0


def test_user_partials_fold_into_days_and_a_late_batch_reads_no_more(spark, monkeypatch):
    """40 batches of like days: what a batch reads does not grow, every row counts once, replays and cut-short folds too."""
    from cardrisk.sources import storage
    sinks = P.Sinks(scratch_path(spark, "partials"))
    day0 = dt.date(2024, 1, 1)
    rows = lambda n: [(u, day0 + dt.timedelta(days=n // 2 - b), n + 1, 10 * n + b, n * n) for u in ("u", "v") for b in (0, 1)]
    schema = "user_id string, tx_date date, n long, s long, ss decimal(38,0)"
    read, want = {}, {}
    for n in range(40):
        if n == 16:            # a fold that died before its commit
            with monkeypatch.context() as m:
                m.setattr(storage, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
                with pytest.raises(RuntimeError):
                    P.fold_user_partials(spark, sinks, n, 4)
        for _ in range(2 if n % 13 == 5 else 1):                       # some batches are delivered twice
            P.fold_user_partials(spark, sinks, n, 4)
            P.write_batch(spark.createDataFrame([(u, d, a, b, Decimal(c)) for u, d, a, b, c in rows(n)], schema).coalesce(1), sinks.path("user_partials"), n)
        for u, d, a, b, c in rows(n):
            x = want.setdefault((u, d), [0, 0, 0])
            want[u, d] = [x[0] + a, x[1] + b, x[2] + c]
        if n in (11, 39):
            last = day0 + dt.timedelta(days=n // 2)
            got = P.user_partials(spark, sinks, n, last - dt.timedelta(days=4), last)
            read[n] = len(got.inputFiles())
            assert {(r.user_id, r.tx_date): [r.n, r.s, int(r.ss)] for r in got.collect()} == \
                {k: v for k, v in want.items() if last - dt.timedelta(days=4) <= k[1] <= last}
    assert read[39] <= read[11]
    whole = P.user_partials(spark, sinks, 39, day0 - dt.timedelta(days=9), day0 + dt.timedelta(days=99)).collect()
    assert {(r.user_id, r.tx_date): [r.n, r.s, int(r.ss)] for r in whole} == want
    assert storage.current_version(spark, sinks.path("user_days")) == 36


def test_live_feed_and_cards_after_replays_equal_the_batch_reports(spark):
    """Twelve batches, some delivered twice: the kept rows equal the reports over all rows, and old states go."""
    from cardrisk.operators import reports as RP
    import random
    rnd = random.Random(5)
    sinks = P.Sinks(scratch_path(spark, "feed"))
    schema = "transaction_id string, event_timestamp timestamp_ntz, card_id string, amount double, anomaly_score double, risk_level string"
    every = []
    for n in range(12):
        rows = [(f"t{n}-{i}", T0 + dt.timedelta(minutes=rnd.randrange(300)), f"c{rnd.randrange(9)}", 1.0, float(rnd.randrange(100)),
                 rnd.choice(["LOW", "MEDIUM", "HIGH"])) for i in range(rnd.randrange(1, 15))]
        every += rows
        for _ in range(2 if n % 4 == 1 else 1):
            P.keep_live_feed(spark.createDataFrame(rows, schema).coalesce(1), sinks, n, 20)
    whole = spark.createDataFrame(every, schema)
    assert P.live_feed(spark, sinks, 20).collect() == RP.latest(whole, 20).select(*P.FEED).collect()
    assert P.flagged_cards(spark, sinks, 4).collect() == RP.top_flagged_cards(whole, 4).collect()
    assert spark.read.parquet(sinks.path("live_feed")).select("batch_id").distinct().count() <= 3


def test_a_hot_card_in_every_batch_is_scored_by_minutes_as_in_one_batch(spark):
    """A card with a third of the rows, batches of twenty minutes, one delivered twice, one late row."""
    from cardrisk.operators import rules as R
    from cardrisk.streaming import history as H
    import random
    rnd = random.Random(8)
    sinks, recent, got = P.Sinks(scratch_path(spark, "hot")), None, {}
    schema = "transaction_id string, card_id string, event_timestamp timestamp_ntz, country string"
    every = []
    for n in range(6):
        rows = [(f"{n}-{i:04d}", "hot" if i % 3 == 0 else f"c{i % 40}", T0 + dt.timedelta(minutes=20 * n, seconds=1200 * rnd.random()),
                 rnd.choice(["US"] * 40 + ["CA", None])) for i in range(900)]
        if n == 5:
            rows.append(("late", "hot", T0 + dt.timedelta(minutes=20 * n - 8), "US"))
        every += rows
        df = spark.createDataFrame(rows, schema)
        for _ in range(2 if n == 3 else 1):
            recent = P._state_before(spark, sinks.path("recent"), n)
            got |= {r.transaction_id: (r.tx_count_10min, r.countries_60min_multi) for r in H.card_facts(df, recent).collect()}
            P.write_batch(H.keep_recent(df, recent), sinks.path("recent"), n)
    whole = spark.createDataFrame(every, schema)
    want = {r.transaction_id: (r.tx_count_10min, r.countries_60min_multi) for r in R.card_history(whole).collect()}
    t = {r[0]: r[2] for r in every}
    after_late = {i for i, when in t.items() if i != "late" and when >= t["late"] and int(i[0]) < 5}   # scored before it came
    assert {i: v for i, v in got.items() if i not in after_late} == {i: v for i, v in want.items() if i not in after_late}
    kept = spark.read.parquet(sinks.path("recent")).filter("batch_id = 5")
    assert kept.count() < 0.75 * len(every)
    text = H.card_facts(df, recent)._jdf.queryExecution().optimizedPlan().toString()
    keys = {x.split("]")[0] for x in text.split("windowspecdefinition(")[1:]}
    assert all("card_id" in x and "_bkt" in x for x in keys) and "Python" not in text


def test_late_rows_are_kept_in_a_table_of_their_own(spark):
    """Behind the watermark: in bronze and late_rows, not in silver; a replayed batch parts its rows the same way."""
    from cardrisk.streaming import late as L
    base = scratch_path(spark, "late-rows")
    raw, sinks = f"{base}/raw", P.Sinks(f"{base}/out")
    minutes = lambda m: T0 + dt.timedelta(minutes=m)
    batches = [[(1, minutes(0)), (2, minutes(1)), (2, minutes(1))], [(3, minutes(60)), (1, minutes(0))],
               [(4, minutes(5)), (5, minutes(51)), (3, minutes(60))], [(4, minutes(5)), (6, minutes(70))]]
    for b in batches:
        write_batch(spark, raw, b)
    L.start_late(P.read_raw_stream(spark, raw, 1), sinks, f"{base}/ck").awaitTermination()
    L.start_late(P.read_raw_stream(spark, raw, 1), sinks, f"{base}/ck").awaitTermination()
    read = lambda name: sorted((r.transaction_id, r.batch_id) for r in spark.read.parquet(sinks.path(name)).collect())
    late = [("t4", 2), ("t4", 3)]
    assert read("late_rows") == late
    assert read("silver") == [("t1", 0), ("t2", 0), ("t3", 1), ("t5", 2), ("t6", 3)]
    assert len(read("bronze")) == sum(map(len, batches))
    again = spark.read.parquet(raw).filter(F.get_json_object("value", "$.transaction_id").isin("t4", "t6") & (F.col("kafka_ingest_time") >= T0))
    L.late_fan_out(sinks)(again.dropDuplicates(["value"]), 3)                    # batch 3 delivered again
    assert read("late_rows") == late and read("silver")[-1] == ("t6", 3)
    marks = {r.watermark for r in spark.read.parquet(sinks.path("late_rows")).collect()}
    assert marks == {minutes(50)}


def test_no_alert_writes_nothing(spark):
    sinks = P.Sinks("unused", "json", {"path": scratch_path(spark, "no-alerts")})
    P.publish(spark.createDataFrame([], "key string, value string"), sinks, 0)
    from cardrisk.sources import storage
    assert not storage.exists(spark, sinks.alert_options["path"])


def test_staging_derives_every_record_once(spark, tmp_path):
    """One pass over the deliveries gives the bounds, the slices and the files, unaligned slices and a null time included."""
    from cardrisk.streaming import staging
    made = spark.sparkContext.accumulator(0)

    def payload(i):
        made.add(1)
        return f'{{"id": {i}}}'

    value = F.udf(payload, "string").asNondeterministic()
    at = F.when(F.col("id") < 50, F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600 * 12)).cast("timestamp_ntz")
    raw = spark.range(0, 51, 1, 2).select(value("id").alias("value"), F.col("id").alias("kafka_offset"), F.lit(0).cast("long").alias("kafka_partition"),
                                          at.alias("kafka_ingest_time"), at.alias("ingested_at"))
    order = F.when(F.length("value") > 0, F.col("kafka_ingest_time"))
    path = str(tmp_path / "raw")
    files = staging.stage(raw, path, 5, order=order, files_per_slice=2)
    assert made.value == 51
    rows = spark.read.parquet(path)
    assert files == 2 and staging.data_files(spark, path) == 2 * 5             # 24.5 days
    assert sorted(r.kafka_offset for r in rows.collect()) == list(range(50)) and rows.columns == raw.columns
    # oldest files first: the slices in order, none across a boundary
    import glob
    import os
    import pyarrow.parquet as pq
    by_age = sorted(glob.glob(f"{path}/part-*.parquet"), key=os.path.getmtime)
    held = [[i for f in by_age[k:k + 2] for i in pq.read_table(f)["kafka_offset"].to_pylist()] for k in range(0, 10, 2)]
    assert [sorted(h) for h in held] == [list(range(k, k + 10)) for k in range(0, 50, 10)]


def test_a_user_costs_one_read_and_one_write_of_state_per_batch():
    """However many days and categories a batch has; the timer is set once and follows the newest day."""
    import pandas as pd
    from cardrisk.config import MICROS_PER_DAY
    from cardrisk.streaming.state import UserHistory
    calls, timers = [], []

    class Value:
        held = None

        def get(self):
            calls.append("get")
            return self.held

        def update(self, v):
            calls.append("update")
            self.held = v

    class Handle:
        def getValueState(self, name, schema):
            return Value()

        def registerTimer(self, ms):
            timers.append(ms)

    def batch(*rows):
        return iter([pd.DataFrame([(int(d * MICROS_PER_DAY), i, c, a, False) for i, d, c, a in rows],
                                  columns=["t", "transaction_id", "merchant_category", "amount", "is_off_hours"])])

    user = UserHistory(days=30)
    user.init(Handle())
    (one,) = user.handleInputRows(("u",), batch(("c", 3.5, "GAMBLING", 4.0), ("a", 1.5, "GAMBLING", 1.0), ("b", 2.5, "X", 2.0)), None)
    assert calls == ["get", "update"] and len(timers) == 1
    assert one.transaction_id.tolist() == ["a", "b", "c"] and one.user_30d_n.tolist() == [0, 1, 2]
    assert one.is_first_high_risk.tolist() == [True, False, False] and one.user_30d_mean.tolist()[1:] == [1.0, 1.5]
    (two,) = user.handleInputRows(("u",), batch(("d", 40.5, "CRYPTOCURRENCY", 9.0), ("e", 41.5, "GAMBLING", 9.0), ("f", 33.25, "X", 9.0)), None)
    assert calls == ["get", "update"] * 2 and len(timers) == 1
    assert two.transaction_id.tolist() == ["f", "d", "e"] and two.user_30d_n.tolist() == [1, 1, 2]      # day 3; day 33; 33 and 40
    assert two.is_first_high_risk.tolist() == [False, True, False]
    assert list(user.handleExpiredTimer(("u",), None, None)) == [] and len(timers) == 2 and timers[1] > timers[0]
    assert user._get()[0].keys() == {33, 40, 41}
    assert list(user.handleExpiredTimer(("u",), None, None)) == [] and len(timers) == 2                 # nothing newer: days go
    assert user._get()[0] == {} and user._get()[1].keys() == {"GAMBLING", "CRYPTOCURRENCY"}
