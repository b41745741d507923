"""Plan shape: the properties the scale design relies on, read from explain()."""

import re

import pytest

from conftest import SF_SMALL


def plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def windows(text):
    """(partition keys, order keys) of every Window operator."""
    return re.findall(r"\(\d+\) Window\s*\nInput [^\n]*\nArguments: \[[^\n]*?\], \[([^\]]*)\], \[([^\]]*)\]",
                      text)


def q(spark, key):
    from __spark_entry__ import queries
    return plan(queries()[key](spark, SF_SMALL))


def test_card_windows_are_split_by_time_bucket(spark):
    text = q(spark, "composite_history")
    parts = windows(text)
    assert parts, text[:2000]
    for p, o in parts:
        cols = [c.strip().split("#")[0] for c in p.split(",")]
        order = [c.strip().split("#")[0] for c in o.split(",")]
        if "card_id" in cols or "user_id" in cols:
            # either split by time bucket, or a window over the per-bucket
            # partials themselves (ordered by bucket: one row per key and day)
            assert "_bkt" in cols or order == ["_bkt"], (cols, order)


def test_dedup_limits_rows_before_the_shuffle(spark):
    text = q(spark, "silver_full")
    head = text.split("\n\n(1)")[0]
    # a partial WindowGroupLimit sits below the Exchange
    assert re.search(r"Exchange[^\n]*\n[^\n]*WindowGroupLimit", head), head


def test_no_python_in_batch_plans(spark):
    for key in ("gold_anomalies", "composite_history", "quality_report", "bronze_parse_json"):
        text = q(spark, key)
        assert "Python" not in text and "ArrowEval" not in text, key


def test_scan_prunes_columns(spark):
    text = q(spark, "silver_valid")
    schemas = re.findall(r"ReadSchema: (struct<[^\n]*>)", text)
    assert schemas and all("event_type" not in s for s in schemas)


def test_payload_parsed_once(spark):
    text = q(spark, "bronze_parse_json")
    assert text.count("from_json(") <= 2       # one parse (named once in the plan tree and details)


def test_scoring_scans_written_silver_once_per_branch(spark):
    """Multi-branch plans (rows + per-key statistics joined back, gold join)
    scan the written silver table; the fixture explode and the dedup window
    run once, in the write, not once per branch."""
    for key in ("composite_score", "composite_history", "gold_anomalies"):
        text = q(spark, key)
        head = text.split("\n\n(1)")[0]
        assert "events.parquet" not in text, key          # the fixture is not re-read
        assert "WindowGroupLimit" not in head or key == "gold_anomalies", key  # no dedup; gold keeps D13 top-1
        assert "silver-" in text, key                     # scans the written table


def test_stage_writes_equal_files_per_slice(spark, tmp_path):
    from cardrisk.plans import catalogue as C
    from cardrisk.streaming import staging

    raw = C._raw(spark, SF_SMALL)
    path = str(tmp_path / "raw")
    f = staging.stage(raw, path, 10, files_per_slice=4)
    assert staging.slice_count(raw, 10) == 3 and staging.slice_count(raw, None) == 1
    assert f == 4 and staging.data_files(spark, path) == 12
    assert spark.read.parquet(path).count() == raw.count()
    # a slice with fewer rows than files is padded with empty files
    tiny = spark.createDataFrame(raw.orderBy("kafka_ingest_time", "kafka_offset").limit(2).collect(), raw.schema)
    path2 = str(tmp_path / "tiny")
    staging.stage(tiny, path2, None, files_per_slice=5)
    assert staging.data_files(spark, path2) == 5 and spark.read.parquet(path2).count() == 2


def test_a_hot_user_is_split_in_the_statistics_join(spark):
    """With broadcast off and 40 % of rows on one user, AQE splits the hot
    partition of the join of rows and statistics (R1), and of R5h."""
    from pyspark.sql import functions as F
    from cardrisk.operators import rules as R
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    hot = F.when(F.col("id") % 5 < 2, "hot").otherwise(F.concat(F.lit("u"), (F.col("id") % 997).cast("string")))
    rows = spark.range(0, 200_000, 1, 8).select(
        F.concat(F.lit("t"), F.col("id").cast("string"), F.lit("x" * 40)).alias("transaction_id"), hot.alias("user_id"),
        (F.col("id") % 1000 / 10).alias("amount"), F.lit("GAMBLING").alias("merchant_category"), F.lit(True).alias("is_high_risk_mcc"),
        F.timestamp_seconds(F.col("id") + 1_700_000_000).cast("timestamp_ntz").alias("event_timestamp"))
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for rule in (R.amount_velocity, R.first_high_risk_use):
            out = rule(rows)
            assert out.count() == 200_000
            df = out.drop("event_timestamp")
            df.toPandas()
            assert "skew=true" in df._jdf.queryExecution().executedPlan().toString(), rule
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_sliding_windows_are_expanded_above_the_first_aggregate(spark):
    for key in ("card_sliding_features", "anomaly_rate_5m"):
        head = q(spark, key).split("\n\n(1)")[0]
        top = head.index("Generate")
        assert "HashAggregate" in head[top:], key          # the plan's leaves come last


def test_bucketed_layers_join_deduplicate_and_count_without_a_shuffle(spark):
    from cardrisk.operators import quality as Q
    from cardrisk.operators import silver as SV
    from cardrisk.plans import catalogue as C
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        silver, scored, gold = C.bucketed_gold(spark, SF_SMALL)
        plans = [plan(gold), plan(SV.dedup_latest(silver)), plan(SV.upsert(silver, scored.select(silver.columns)))]
        assert all("Exchange" not in p for p in plans) and "SortMergeJoin" in plans[0] and "LeftAnti" in plans[2]
        # the uniqueness check exchanges its single total only
        unique = plan(Q.check_layer(silver, "silver", [Q.Check("transaction_id", "unique")]))
        assert unique.split("\n\n(1)")[0].count("Exchange") == 1 and "SinglePartition" in unique
        assert gold.count() == C.gold_rows(spark, SF_SMALL, order=False).count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def silver_of(spark, n=40):
    from pyspark.sql import functions as F
    return spark.range(n).select(
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("transaction_id"), F.lit("c").alias("card_id"),
        (F.col("id") % 3).cast("string").alias("user_id"), F.lit("GAMBLING").alias("merchant_category"),
        (F.col("id") * 1.0 + 1).alias("amount"), F.when(F.col("id") % 2 == 0, "US").otherwise("CA").alias("country"),
        F.timestamp_seconds(F.col("id") * 400 + 1_700_000_000).cast("timestamp_ntz").alias("event_timestamp"),
        (F.col("id") % 2 == 1).alias("is_international"), F.lit(False).alias("is_off_hours"), (F.col("id") % 4 == 0).alias("is_high_risk_mcc"))


def test_history_scores_run_their_windows_once(spark):
    """R5h takes its input in two parts; behind the windows each part ran them all again."""
    from cardrisk.operators import score as S
    text = S.score_history(silver_of(spark))._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Window [") == 5           # R1h: buckets, rows; R2h and R4h: buckets, rows up to, rows onward


def test_labels_are_joined_once_and_lose_no_row(spark):
    from cardrisk.operators import reports as RP
    from cardrisk.operators import score as S
    deliveries = spark.createDataFrame([("t0", False), ("t0", True), ("t1", True), ("t2", None), (None, True), ("x", True)],
                                       "transaction_id string, label boolean")
    rows = RP.with_labels(silver_of(spark), RP.labels_by_id(deliveries))
    assert rows.count() == 40
    assert {r.transaction_id for r in rows.filter("label").collect()} == {"t0", "t1"}
    flagged = S.score_history(rows)
    r = RP.label_quality(flagged, "history").collect()[0]
    assert (r.rule_set, r.tx_count, r.labelled_count) == ("history", 40, 2)


def test_the_fixture_parses_each_record_once(spark):
    from cardrisk.plans import catalogue as C
    text = C.silver_rows(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert all("get_json_object" not in line for line in text.splitlines() if "Filter" in line)
