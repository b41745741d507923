import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from cardrisk.operators import quality as Q
from cardrisk.sources import storage


def test_report_has_31_checks_and_gate(spark):
    from cardrisk.plans import catalogue as C
    rep = C.QUERIES["quality_report"](spark, SF_SMALL)
    rows = rep.collect()
    assert len(rows) == 31
    failed = {(r.layer, r.column_name, r.test) for r in rows if not r.passed}
    # the bronze layer holds redeliveries and unnormalised currencies
    assert ("bronze", "transaction_id", "unique") in failed
    assert ("bronze", "currency", "accepted_values") in failed
    assert not any(layer != "bronze" for layer, _, _ in failed)
    with pytest.raises(Q.QualityGateError):
        Q.gate(rep, "bronze")
    Q.gate(rep, "silver")
    Q.gate(rep, "gold")


def test_versioned_merge_and_incremental_append(spark, tmp_path):
    from cardrisk.sources import storage
    base = str(tmp_path / "silver")
    a = spark.createDataFrame([("a", 1), ("b", 1)], "transaction_id string, v int")
    b = spark.createDataFrame([("b", 2), ("c", 2)], "transaction_id string, v int")
    assert storage.merge_version(spark, a, base) == 1
    assert storage.merge_version(spark, b, base) == 2
    assert storage.merge_version(spark, b, base) == 3      # replay: same content
    cur = {r.transaction_id: r.v for r in storage.read_current(spark, base).collect()}
    assert cur == {"a": 1, "b": 2, "c": 2}

    tgt = str(tmp_path / "bronze")
    src = spark.createDataFrame([("x", 1), ("y", 2), ("z", 3)], "id string, ingested_at int") \
        .withColumn("ingested_at", F.timestamp_seconds("ingested_at").cast("timestamp_ntz"))
    storage.append_new(spark, src.filter("id != 'z'"), tgt, exists=False)
    new = storage.append_new(spark, src, tgt, exists=True)
    assert [r.id for r in new.collect()] == ["z"]
    assert spark.read.parquet(tgt).count() == 3


def test_a_damaged_version_log_raises_and_destroys_nothing(spark, tmp_path):
    from cardrisk.sources import storage
    base = str(tmp_path / "silver")
    a = spark.createDataFrame([("a", 1), ("b", 1)], "transaction_id string, v int")
    storage.merge_version(spark, a, base)
    storage.merge_version(spark, a, base)
    for f in (tmp_path / "silver" / storage.LOG).glob("*.parquet"):
        f.write_bytes(b"damaged")
        (f.parent / f".{f.name}.crc").unlink(missing_ok=True)
    with pytest.raises(Exception):
        storage.merge_version(spark, a.limit(1), base)
    assert spark.read.parquet(f"{base}/v000001").count() == spark.read.parquet(f"{base}/v000002").count() == 2
    assert not storage.exists(spark, f"{base}/v000003")


def test_a_left_over_version_is_not_overwritten(spark, tmp_path):
    from cardrisk.sources import storage
    base = str(tmp_path / "silver")
    a = spark.createDataFrame([("a", 1)], "transaction_id string, v int")
    a.write.parquet(f"{base}/v000001")                   # a job died before it committed
    assert storage.merge_version(spark, a.selectExpr("'b' AS transaction_id", "v"), base) == 2
    assert [r.transaction_id for r in storage.read_current(spark, base).collect()] == ["b"]
    assert [r.transaction_id for r in spark.read.parquet(f"{base}/v000001").collect()] == ["a"]


def test_shared_folder_is_required_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace
    from cardrisk import session
    conf = SimpleNamespace(get=lambda k, d=None: None)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(SimpleNamespace(conf=conf, sparkContext=context))


def _files(base):
    import os
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, names in os.walk(f"{base}/data") for f in names if f.endswith(".parquet")}


def _dated(spark, *rows):
    return spark.createDataFrame(rows, "transaction_id string, v int, d string").withColumn("tx_date", F.to_date("d")).drop("d")


def test_a_merge_rewrites_only_the_dates_it_touches(spark, tmp_path):
    base = str(tmp_path / "silver")
    days = [f"2024-01-{d:02d}" for d in range(1, 11)]
    storage.merge_version(spark, _dated(spark, *[(f"{d}-{i}", 1, d) for d in days for i in range(20)]), base)
    before = _files(base)
    # one date: a new key and a replaced one
    assert storage.merge_version(spark, _dated(spark, ("2024-01-03-5", 2, "2024-01-03"), ("new", 2, "2024-01-03")), base) == 2
    after = _files(base)
    assert {k: after[k] for k in before} == before                       # nothing is rewritten in place
    assert {k.split("tx_date=")[1][:10] for k in set(after) - set(before)} == {"2024-01-03"}
    # a key moves to another date: both dates are written, the others listed as they are
    storage.merge_version(spark, _dated(spark, ("2024-01-07-1", 3, "2024-01-09")), base)
    last = _files(base)
    assert {k.split("tx_date=")[1][:10] for k in set(last) - set(after)} == {"2024-01-07", "2024-01-09"}
    rows = {(r.transaction_id, r.v, str(r.tx_date)) for r in storage.read_current(spark, base).collect()}
    want = {(f"{d}-{i}", 1, d) for d in days for i in range(20)} - {("2024-01-03-5", 1, "2024-01-03"), ("2024-01-07-1", 1, "2024-01-07")}
    assert rows == want | {("2024-01-03-5", 2, "2024-01-03"), ("new", 2, "2024-01-03"), ("2024-01-07-1", 3, "2024-01-09")}
    assert storage.read_version(spark, base, 1).filter("v = 1").count() == 200
    # the scan is one, and a date filter reaches its folders
    plan = storage.read_current(spark, base).filter("tx_date = date'2024-01-03'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "PartitionFilters: [isnotnull(tx_date" in plan
    gone = storage.expire_versions(spark, base, keep=1)
    assert len(gone) == 3 and {(r.transaction_id, r.v, str(r.tx_date)) for r in storage.read_current(spark, base).collect()} == \
        want | {("2024-01-03-5", 2, "2024-01-03"), ("new", 2, "2024-01-03"), ("2024-01-07-1", 3, "2024-01-09")}


def test_merges_of_null_dates_emptied_dates_new_columns_and_nothing(spark, tmp_path):
    base = str(tmp_path / "silver")
    storage.merge_version(spark, _dated(spark, ("a", 1, None), ("b", 1, "2024-01-01")), base)
    storage.merge_version(spark, _dated(spark, ("b", 2, "2024-01-02")).withColumn("extra", F.lit("x")), base)   # its old date is empty now
    storage.merge_version(spark, _dated(spark, ("z", 9, None)).limit(0), base)
    assert [d for d, _ in storage.manifest(spark, base, 3)] == ["2024-01-02", storage.NO_DATE]
    got = {(r.transaction_id, r.v, r.tx_date and str(r.tx_date), r.extra) for r in storage.read_current(spark, base).collect()}
    assert got == {("a", 1, None, None), ("b", 2, "2024-01-02", "x")}
    storage.merge_version(spark, _dated(spark, ("a", 3, "2024-01-02")), base)
    assert {(r.transaction_id, r.v) for r in storage.read_current(spark, base).collect()} == {("a", 3), ("b", 2)}


def test_a_merge_that_dies_leaves_the_version_before_current(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "silver")
    storage.merge_version(spark, _dated(spark, ("a", 1, "2024-01-01")), base)
    with monkeypatch.context() as m:
        m.setattr(storage, "_write_manifest", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            storage.merge_version(spark, _dated(spark, ("a", 2, "2024-01-01")), base)
    assert [r.v for r in storage.read_current(spark, base).collect()] == [1]
    assert storage.merge_version(spark, _dated(spark, ("a", 3, "2024-01-01")), base) == 2
    assert [r.v for r in storage.read_current(spark, base).collect()] == [3]


def test_a_written_layer_is_checked_by_its_write(spark, tmp_path):
    """The counts of the write equal those of a scan; the report scans for uniqueness only; a second run of the
    chain, which appends and merges, scans."""
    import contextlib
    import io
    rows = [("a", "c", 1.0, "USD"), ("a", None, 2e6, "USD"), ("b", "c", 0.001, "XXX"), (None, "c", None, None)]
    df = spark.createDataFrame(rows, "transaction_id string, card_id string, amount double, currency string")
    checks = Q.layer_checks()["bronze"]
    seen = Q.Observed("bronze", checks)
    storage.write_layer(df, str(tmp_path / "bronze"), observed=seen.attach)
    written = storage.read_layer(spark, str(tmp_path / "bronze"))
    report = seen.report(written)
    assert sorted(report.collect()) == sorted(Q.check_layer(written, "bronze", checks).collect())
    assert {(r.column_name, r.test): r.violations for r in report.collect()}["amount", "accepted_range"] == 2
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        seen.report(written).explain()
        Q.check_layer(written, "bronze", checks).explain()
    first, second = buf.getvalue().split("== Physical Plan ==")[1:]
    assert first.count("FileScan") == 1 and second.count("FileScan") == 2
    empty = Q.Observed("bronze", checks)
    storage.write_layer(df.limit(0), str(tmp_path / "empty"), observed=empty.attach)
    assert empty.report(storage.read_layer(spark, str(tmp_path / "empty"))).filter("violations > 0 or not passed").count() == 0
