"""Rule-level cases of the reference's unit tests, run through the production
functions (the reference re-typed the expressions inside its tests)."""

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from cardrisk.config import DEFAULT, HIGH_RISK_CATEGORIES
from cardrisk.functions.columns import composite_score, is_off_hours, risk_level
from cardrisk.operators import rules as R
from cardrisk.operators import score as S


def velocity(spark, amounts):
    df = spark.createDataFrame([Row(user_id="u1", amount=float(a), i=i) for i, a in enumerate(amounts)])
    return [r.score_amount_velocity for r in R.amount_velocity(df, DEFAULT).orderBy("i").collect()]


def test_normal_amounts_masking_bound(spark):
    # 45..55 with the row inside its own sample: the top score is 21.88, not < 20
    scores = velocity(spark, [45, 55, 50, 48, 52])
    assert round(max(scores), 2) == 21.88
    assert min(scores) == 0.0


def test_one_large_amount_among_three_is_masked(spark):
    # z <= (n-1)/sqrt(n): with n = 4 the 5000 scores 25.0
    assert round(velocity(spark, [50, 48, 52, 5000])[-1], 2) == 25.0


@pytest.mark.parametrize("n,expected", [(24, 80.0), (37, 100.0)])
def test_large_amount_with_enough_history(spark, n, expected):
    assert round(velocity(spark, [50] * n + [5000])[-1], 2) == expected


def test_equal_amounts_score_zero(spark):
    assert velocity(spark, [50] * 5) == [0.0] * 5


def test_single_row_std_null_scores_zero(spark):
    assert velocity(spark, [123.0]) == [0.0]


@pytest.mark.parametrize("hour,flag", [(0, True), (1, True), (3, True), (4, True), (5, False), (6, False),
                                       (14, False), (23, False), (None, False)])
def test_off_hours_flag(spark, hour, flag):
    df = spark.createDataFrame([(hour,)], "tx_hour int")
    assert df.select(is_off_hours("tx_hour").alias("f")).first().f is flag


@pytest.mark.parametrize("flag,score", [(True, 100.0), (False, 0.0)])
def test_off_hours_score(spark, flag, score):
    df = spark.createDataFrame([(flag,)], "is_off_hours boolean")
    assert R.off_hours(df).first().score_off_hours == score


@pytest.mark.parametrize("mcc,score", [(c, 100.0) for c in HIGH_RISK_CATEGORIES]
                         + [(c, 0.0) for c in ("GROCERY", "RESTAURANT", "PHARMACY", "GAS_STATION")])
def test_category_score(spark, mcc, score):
    from cardrisk.functions.columns import is_high_risk_category
    df = spark.createDataFrame([(mcc,)], "merchant_category string")
    df = df.withColumn("is_high_risk_mcc", is_high_risk_category("merchant_category"))
    assert R.high_risk_mcc(df).first().score_high_risk_mcc == score


def _composite(spark, v, f, o, c, m):
    df = spark.createDataFrame([(float(v), float(f), float(o), float(c), float(m))],
                               "score_amount_velocity double, score_tx_frequency double, score_off_hours double, "
                               "score_cross_border double, score_high_risk_mcc double")
    return df.select(composite_score(DEFAULT).alias("s")).first().s


def test_composite_all_and_none(spark):
    assert _composite(spark, 100, 100, 100, 100, 100) == 100.0
    assert _composite(spark, 0, 0, 0, 0, 0) == 0.0


def test_composite_is_clamped(spark):
    assert _composite(spark, 200, 200, 200, 200, 200) == 100.0
    assert _composite(spark, -50, -10, 0, -100, 0) == 0.0


def test_without_velocity_no_row_is_high(spark):
    # 25 + 15 + 15 + 10 = 65 < 70
    assert _composite(spark, 0, 100, 100, 100, 100) == 65.0


@pytest.mark.parametrize("score,level", [(15.0, "LOW"), (39.9, "LOW"), (40.0, "MEDIUM"), (69.9, "MEDIUM"),
                                         (70.0, "HIGH"), (100.0, "HIGH")])
def test_risk_level_thresholds(spark, score, level):
    df = spark.createDataFrame([(score,)], "anomaly_score double")
    assert df.select(risk_level("anomaly_score").alias("l")).first().l == level


def test_cross_border_as_coded(spark):
    df = spark.createDataFrame([(True, 250.0), (True, 200.0), (False, 900.0), (None, 900.0)],
                               "is_international boolean, amount double")
    assert [r.score_cross_border for r in R.cross_border(df).collect()] == [100.0, 50.0, 0.0, 0.0]


def test_frequency_as_coded_counts_scope(spark):
    df = spark.createDataFrame([("c1", i) for i in range(3)] + [("c2", 0)], "card_id string, i int")
    got = {(r.card_id, r.score_tx_frequency) for r in R.tx_frequency(df, DEFAULT).collect()}
    assert got == {("c1", 60.0), ("c2", 20.0)}


def test_triggered_rules_and_counts(spark):
    df = spark.createDataFrame(
        [(60.0, 60.0, 100.0, 50.0, 100.0), (0.0, 20.0, 0.0, 0.0, 0.0)],
        "score_amount_velocity double, score_tx_frequency double, score_off_hours double, "
        "score_cross_border double, score_high_risk_mcc double")
    out = S.finish(df, DEFAULT, scored_at=F.lit(None).cast("timestamp_ntz"))
    rows = out.select("triggered_rules").collect()
    assert rows[0].triggered_rules == "amount_velocity,tx_frequency,off_hours,cross_border,high_risk_mcc"
    assert rows[1].triggered_rules == ""
    counts = {r.rule: r.fired for r in S.rule_counts(out).collect()}
    assert counts == {t: 1 for t in ("amount_velocity", "tx_frequency", "off_hours", "cross_border",
                                     "high_risk_mcc")}


def test_off_hours_by_local_clock(spark):
    import datetime as dt
    df = spark.createDataFrame([("US", dt.datetime(2024, 1, 1, 3, 0)), ("GB", dt.datetime(2024, 1, 1, 3, 0)),
                                ("ZZ", dt.datetime(2024, 1, 1, 4, 59))], "country string, event_timestamp timestamp_ntz")
    got = {r.country: (r.local_hour, r.score_off_hours) for r in R.off_hours_local(df).collect()}
    assert got == {"US": (22, 0.0), "GB": (3, 100.0), "ZZ": (4, 100.0)}
