"""The layered batch chain: two incremental runs equal one full run."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from cardrisk.plans import batch
from cardrisk.plans import catalogue as C
from cardrisk.session import scratch_path
from cardrisk.sources import storage


def test_two_incremental_runs_equal_full_silver(spark):
    rows = C.bronze_rows(spark, SF_SMALL)
    base = scratch_path(spark, "layers")
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    r1 = batch.run_layers(spark, rows.filter(F.col("ingested_at") < cut), base, scored_at=C.scored_at())
    r2 = batch.run_layers(spark, rows, base, scored_at=C.scored_at())
    assert (r1.silver_version, r2.silver_version) == (1, 2)
    from cardrisk.sources import storage
    got = storage.read_current(spark, f"{base}/silver").select("transaction_id", "ingested_at", "amount")
    want = C.silver_rows(spark, SF_SMALL).select("transaction_id", "ingested_at", "amount")
    assert sorted(got.collect()) == sorted(want.collect())
    # bronze holds every delivery exactly once
    assert spark.read.parquet(f"{base}/bronze").count() == rows.count()
    rep = {(r.layer, r.column_name, r.test): r.passed for r in r2.report.collect()}
    assert len(rep) == 31 and rep[("silver", "transaction_id", "unique")] and rep[("gold", "transaction_id", "unique")]
    gold = spark.read.parquet(f"{base}/gold")
    assert gold.filter(~F.col("risk_level").isin("MEDIUM", "HIGH")).count() == 0


def test_gate_stops_chain_on_live_latency_bound(spark):
    import pytest
    from cardrisk.operators.quality import QualityGateError
    rows = C.bronze_rows(spark, SF_SMALL)
    with pytest.raises(QualityGateError, match="end_to_end_latency_ms"):
        batch.run_layers(spark, rows, scratch_path(spark, "layers-live"))   # scored now: years of latency


def test_written_gold_equals_the_catalogue_and_keeps_its_order(spark):
    rows = C.bronze_rows(spark, SF_SMALL)
    base = scratch_path(spark, "layers-gold")
    batch.run_layers(spark, rows, base, scored_at=C.scored_at())
    gold = spark.read.parquet(f"{base}/gold")
    cols = [c for c in gold.columns if c not in ("dbt_loaded_at", "tx_date")]
    want = C.QUERIES["gold_anomalies"](spark, SF_SMALL)
    assert sorted(map(repr, gold.select(cols).collect())) == sorted(map(repr, want.select(cols).collect()))
    # files by name, rows within each: anomaly score, then time, descending
    import glob
    import pyarrow.parquet as pq
    files = sorted(glob.glob(f"{base}/gold/part-*.parquet"))
    placed = [r for f in files for r in pq.read_table(f, columns=["anomaly_score", "event_timestamp"]).to_pylist()]
    assert placed == sorted(placed, key=lambda r: (r["anomaly_score"], r["event_timestamp"]), reverse=True) and placed
    silver = storage.read_version(spark, f"{base}/silver", 1)
    assert "dbt_loaded_at" in silver.columns and "dbt_loaded_at" in gold.columns


def test_bronze_gate_stops_the_chain(spark):
    import pytest
    from cardrisk.operators.quality import QualityGateError
    rows = C.bronze_rows(spark, SF_SMALL).withColumn("card_id", F.when(F.col("kafka_offset") != 1, F.col("card_id")))
    rows = rows.withColumn("amount", F.when(F.col("kafka_offset") == 2, F.lit(5e6)).otherwise(F.col("amount")))
    with pytest.raises(QualityGateError, match="bronze"):
        batch.run_layers(spark, rows, scratch_path(spark, "layers-bad"), scored_at=C.scored_at())


def test_amounts_of_nothing_are_reported_and_do_not_stop_the_chain(spark):
    rows = C.bronze_rows(spark, SF_SMALL)
    none = (F.col("kafka_offset") % 100 == 2) & (F.col("kafka_partition") == 0)
    rows = rows.withColumn("amount", F.when(none, F.lit(0.0)).otherwise(F.col("amount")))
    run = batch.run_layers(spark, rows, scratch_path(spark, "layers-zero"), scored_at=C.scored_at())
    rep = {(r.layer, r.column_name, r.test): r.violations for r in run.report.collect()}
    assert rep[("bronze", "amount", "accepted_range")] == rows.filter(none).count() > 0
    assert rep[("silver", "amount", "accepted_range")] == 0
    assert spark.read.parquet(f"{run.base}/gold").filter("amount <= 0").count() == 0


def test_amounts_above_the_bound_stop_the_chain(spark):
    import pytest
    from cardrisk.operators.quality import QualityGateError
    rows = C.bronze_rows(spark, SF_SMALL)
    rows = rows.withColumn("amount", F.when(F.col("kafka_offset") == 2, F.lit(5e6)).otherwise(F.col("amount")))
    with pytest.raises(QualityGateError, match="bronze.amount accepted_range"):
        batch.run_layers(spark, rows, scratch_path(spark, "layers-high"), scored_at=C.scored_at())
