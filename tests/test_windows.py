"""The time-bucketed window plans equal the single-partition RANGE frames,
including a hot key holding most rows and rows on bucket edges."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cardrisk.functions.columns import epoch_micros
from cardrisk.operators.windows import bucketed_frames, prior_moments

T0 = dt.datetime(2024, 1, 1)
MIN = 60_000_000


def frame(spark, seed, n=600, span_min=600):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if rnd.random() < 0.6 else f"k{rnd.randrange(4)}"
        # some timestamps sit exactly on bucket / frame edges, some repeat
        m = rnd.choice([rnd.randrange(span_min), 10 * rnd.randrange(span_min // 10), 60])
        ts = T0 + dt.timedelta(minutes=m, microseconds=rnd.choice([0, 0, rnd.randrange(60_000_000)]))
        rows.append((f"id{i:05d}", key, ts, round(rnd.uniform(1, 500), 2), rnd.choice(["US", "CA", None])))
    return spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz, x double, c string")


@pytest.mark.parametrize("seed", [3, 4])
def test_prior_moments_equals_range_frame(spark, seed):
    df = frame(spark, seed, n=500, span_min=3000)
    window = 300 * MIN
    got = prior_moments(df, "k", "ts", "x", window, 60 * MIN, prefix="h")
    w = Window.partitionBy("k").orderBy(epoch_micros("ts")).rangeBetween(-window, -1)
    want = df.select("id", F.count("x").over(w).alias("n"), F.avg("x").over(w).alias("m"),
                     F.stddev("x").over(w).alias("s"))
    g = {r.id: r for r in got.select("id", "h_n", "h_mean", "h_std").collect()}
    for r in want.collect():
        o = g[r.id]
        assert o.h_n == r.n
        if r.n:
            assert o.h_mean == pytest.approx(r.m, rel=1e-9)
        if r.s is None:
            assert o.h_std is None
        else:
            assert o.h_std == pytest.approx(r.s, rel=1e-7, abs=1e-9)


def test_prior_moments_equal_history_is_zero_spread(spark):
    rows = [("a", T0 + dt.timedelta(hours=i), 0.1) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    out = prior_moments(df, "k", "ts", "x", 30 * 24 * 60 * MIN, 24 * 60 * MIN, prefix="h").collect()
    assert all(r.h_std in (None, 0.0) for r in out)


@pytest.mark.parametrize("seed", [1, 2, 5])
@pytest.mark.parametrize("bucket_min", [1, 5, 10])
def test_bucketed_frames_equal_range_frames(spark, seed, bucket_min):
    """Count over 10 minutes and min/max over 60 minutes, with buckets down to
    a tenth of the shorter frame: equal to single-partition RANGE frames."""
    df = frame(spark, seed)
    got = bucketed_frames(df, "k", "ts", bucket_min * MIN, count_frame_us=10 * MIN, count_name="n",
                          minmax_col="c", minmax_frame_us=60 * MIN, min_name="mn", max_name="mx")
    t = epoch_micros("ts")
    w10 = Window.partitionBy("k").orderBy(t).rangeBetween(-10 * MIN, 0)
    w60 = Window.partitionBy("k").orderBy(t).rangeBetween(-60 * MIN, 0)
    want = df.select("id", F.count(F.lit(1)).over(w10).alias("n"), F.min("c").over(w60).alias("mn"),
                     F.max("c").over(w60).alias("mx"))
    assert sorted(got.select("id", "n", "mn", "mx").collect()) == sorted(want.collect())
    assert got.columns[:5] == df.columns                  # input columns kept, in order


def test_bucketed_frames_spread_a_hot_key(spark):
    """The row windows run in (key, bucket) partitions: a hot key is split
    into as many partitions as it has buckets."""
    import contextlib
    import io
    import re
    df = frame(spark, 7)
    out = bucketed_frames(df, "k", "ts", MIN, count_frame_us=10 * MIN, count_name="n")
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain("formatted")
    specs = re.findall(r"Arguments: \[[^\n]*?\], \[([^\]]*)\], \[([^\]]*)\]", buf.getvalue())
    parts = [[c.strip().split("#")[0] for c in p.split(",")] for p, _ in specs]
    assert ["k", "_bkt"] in parts


@pytest.mark.parametrize("bucket_min", [60, 120, 360])
def test_cross_border_partner_equals_brute_force(spark, bucket_min):
    """J3 (latest earlier row of another country within 60 minutes) at any
    bucket size equals a brute-force self-join on the small fixture."""
    from cardrisk.operators.features import cross_border_pairs
    df = frame(spark, 11).select(F.col("k").alias("card_id"), F.col("id").alias("transaction_id"),
                                 F.col("ts").alias("event_timestamp"), F.col("c").alias("country"))
    got = {r.transaction_id: r.partner_transaction_id
           for r in cross_border_pairs(df, bucket_minutes=bucket_min).collect()}
    a = df.toDF("card_a", "id_a", "ts_a", "c_a")
    b = df.toDF("card_b", "id_b", "ts_b", "c_b")
    earlier = (F.col("ts_b") < F.col("ts_a")) | ((F.col("ts_b") == F.col("ts_a")) & (F.col("id_b") < F.col("id_a")))
    cond = ((F.col("card_a") == F.col("card_b")) & (F.col("c_a") != F.col("c_b")) & earlier
            & (F.col("ts_b") >= F.col("ts_a") - F.expr("INTERVAL 60 MINUTES")))
    brute = (a.join(b, cond).groupBy("id_a").agg(F.max(F.struct("ts_b", "id_b")).alias("p"))
              .select("id_a", F.col("p.id_b").alias("partner")))
    want = {r.id_a: r.partner for r in brute.collect()}
    assert got == want and len(want) > 10


def _pairs_by_hand(rows):
    """id -> (partner id, gap) by looking back over the card's earlier rows."""
    out = {}
    for card, i, t, c in rows:
        earlier = [(t2, i2) for card2, i2, t2, c2 in rows if card2 == card and c2 not in (None, c) and (t2, i2) < (t, i) and t2 >= t - dt.timedelta(hours=1)]
        if c is not None and earlier:
            t2, i2 = max(earlier)
            out[i] = (i2, (t - t2) // dt.timedelta(microseconds=1))
    return out


def test_pairs_of_cells_merge_in_every_order_of_countries(spark):
    """Short cells, few countries, long same-country runs and gaps: the pair kept per cell has every partner."""
    import random
    from cardrisk.operators.features import cross_border_pairs, latest_two
    rnd = random.Random(3)
    rows = []
    for card in ("a", "b", "c"):
        t, c = T0, "US"
        for k in range(220):
            t += dt.timedelta(seconds=rnd.choice([0, 0, 1, 20, 60, 119, 600, 3600 if k % 50 == 49 else 5]))
            if rnd.random() < {"a": 0.5, "b": 0.05, "c": 0.01}[card]:
                c = rnd.choice(["US", "CA", "MX", None])
            rows.append((card, f"{card}{rnd.randrange(10 ** 6):06d}-{k}", t, c))
    df = spark.createDataFrame(rows, "card_id string, transaction_id string, event_timestamp timestamp_ntz, country string")
    want = _pairs_by_hand(rows)
    for minutes in (1, 7, 60, 240):
        got = {r.transaction_id: (r.partner_transaction_id, r.gap_us) for r in cross_border_pairs(df, bucket_minutes=minutes).collect()}
        assert got == want and len(want) > 200
    keyed = df.filter("country is not null").withColumn("_t", epoch_micros("event_timestamp"))
    for r in latest_two(keyed, "card_id").collect():
        mine = sorted((x for x in rows if x[0] == r.card_id and x[3]), key=lambda x: (x[2], x[1]))
        assert r._c1.transaction_id == mine[-1][1]
        assert r._c2.transaction_id == next(x[1] for x in reversed(mine) if x[3] != mine[-1][3])


def test_a_hot_hour_of_one_card_is_spread_over_its_minutes(spark):
    """50,000 rows in one (card, hour): the rows' windows are per minute, and no task holds the hour."""
    import contextlib
    import io
    import time
    from cardrisk.operators.features import cross_border_pairs
    n = 50_000
    df = spark.range(n).select(
        F.concat(F.lit("hot"), F.col("id") % 1).alias("card_id"), F.format_string("t%06d", F.col("id")).alias("transaction_id"),
        F.timestamp_micros((F.col("id") * (3_600_000_000 // n) + 1_700_002_800_000_000).cast("long")).cast("timestamp_ntz").alias("event_timestamp"),
        F.when(F.col("id") % 9000 == 0, "CA").otherwise("US").alias("country"))
    out = cross_border_pairs(df)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain("formatted")
    import re
    parts = re.findall(r"\(\d+\) Window\s*\nInput [^\n]*\nArguments: \[[^\n]*?\], \[([^\]]*)\], \[[^\]]*\]", buf.getvalue())
    by = {tuple(c.strip().split("#")[0] for c in p.split(",")) for p in parts}
    assert by == {("card_id", "_cell"), ("card_id", "_span")}
    minute = df.groupBy(F.date_trunc("minute", "event_timestamp")).count().agg(F.max("count")).first()[0]
    assert minute <= n // 60 + 1
    t = time.time()
    rows = out.select("transaction_id", "partner_transaction_id").collect()
    assert time.time() - t < 60
    got = {int(a[1:]): int(b[1:]) for a, b in rows}
    assert got == {i: (i - 1 if i % 9000 == 0 else i // 9000 * 9000) for i in range(1, n)}


def test_small_spread_around_a_large_mean_is_kept(spark):
    """40 amounts alternating by five cents, then a jump: the spread is real,
    so the jump scores 100; equal amounts have a spread of exactly 0."""
    from cardrisk.operators.features import score_with_user_stats, user_stats
    from cardrisk.operators.rules import amount_velocity_history
    rows = [("u", f"t{i:02d}", T0 + dt.timedelta(hours=i), 50_000.0 + 0.05 * (i % 2)) for i in range(40)]
    rows.append(("u", "t99", T0 + dt.timedelta(days=5), 60_000.0))
    rows += [("v", f"v{i}", T0 + dt.timedelta(hours=i), 33.33) for i in range(5)]
    df = spark.createDataFrame(rows, "user_id string, transaction_id string, event_timestamp timestamp_ntz, amount double")
    got = {r.transaction_id: r for r in amount_velocity_history(df).collect()}
    assert got["t99"].user_30d_std == pytest.approx(0.025318, rel=1e-4) and got["t99"].score_amount_velocity == 100.0
    assert got["v4"].user_30d_std == 0.0 and got["v4"].score_amount_velocity == 0.0
    df = df.withColumn("tx_date", F.to_date("event_timestamp"))
    daily = {r.transaction_id: r for r in score_with_user_stats(df, user_stats(df)).collect()}
    assert daily["t99"].score_amount_velocity == 100.0


def test_a_dense_minute_of_one_card_is_linear_and_exact(spark):
    """50,000 rows of one card in one minute (and neighbours that enter and
    leave the frames) equal the plain RANGE frames, in seconds."""
    import time
    n = 50_000
    at = lambda minute, k: F.expr(f"timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, {minute}, 0)") + \
        F.expr(f"make_dt_interval(0, 0, 0, cast((id % {k}) / {k}.0 * 60 as decimal(18,6)))")
    parts = [spark.range(m).select(F.concat(F.lit(f"{minute}-"), F.col("id").cast("string")).alias("id"),
                                   F.lit("hot").alias("k"), at(minute, m).alias("ts"),
                                   F.when(F.col("id") % 7 == 0, "CA").otherwise("US").alias("c"))
             for minute, m in ((0, 300), (10, n), (11, 50), (70, 300))]
    df = parts[0]
    for p in parts[1:]:
        df = df.unionByName(p)
    t = time.time()
    got = {r.id: tuple(r) for r in bucketed_frames(
        df, "k", "ts", MIN, count_frame_us=10 * MIN, count_name="n", minmax_col="c", minmax_frame_us=60 * MIN,
        min_name="mn", max_name="mx").select("id", "n", "mn", "mx").collect()}
    assert time.time() - t < 60
    us = epoch_micros("ts")
    w10 = Window.partitionBy("k").orderBy(us).rangeBetween(-10 * MIN, 0)
    rows = df.select("id", us.alias("t"), "c", F.count(F.lit(1)).over(w10).alias("n")).collect()
    assert len(got) == len(rows) and all(got[r.id][1] == r.n for r in rows)
    assert all(got[r.id][2:] == ("CA", "US") for r in rows if r.id.startswith(("10-", "11-")))


def test_no_frame_runs_to_the_end_of_a_partition(spark):
    import contextlib
    import io
    out = bucketed_frames(frame(spark, 9), "k", "ts", MIN, count_frame_us=10 * MIN, minmax_col="c", minmax_frame_us=60 * MIN)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain("extended")
    assert "unboundedfollowing" not in buf.getvalue().lower()


def plan_text(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("extended")
    return buf.getvalue()


def test_long_frames_cost_no_time_per_bucket_of_the_frame(spark):
    """The sums over the buckets of a 30-day frame are running ones: a sliding frame adds
    up its 720 buckets again for each of a key's buckets."""
    text = plan_text(prior_moments(frame(spark, 9), "k", "ts", "x", 30 * 24 * 60 * MIN, 60 * MIN, prefix="h"))
    assert "unboundedpreceding" in text and "specifiedwindowframe(RangeFrame, -" not in text


@pytest.mark.parametrize("days", [29, 31, 95])
def test_prior_moments_of_tables_shorter_and_longer_than_the_frame(spark, days):
    rnd, window = random.Random(days), 30 * 24 * 60 * MIN
    rows = [(f"id{i}", rnd.choice(["a", "a", "b", None]), T0 + dt.timedelta(hours=rnd.randrange(24 * days), seconds=rnd.choice([0, 0, 7])),
             rnd.choice([None, 1.25, 30.0, 99.99])) for i in range(600)]
    df = spark.createDataFrame(rows, "id string, k string, ts timestamp_ntz, x double")
    got = {r.id: r for r in prior_moments(df, "k", "ts", "x", window, 60 * MIN, prefix="h").collect()}
    w = Window.partitionBy("k").orderBy(epoch_micros("ts")).rangeBetween(-window, -1)
    for r in df.select("id", "k", F.count("x").over(w).alias("n"), F.stddev("x").over(w).alias("s")).collect():
        if r.k is not None:
            assert got[r.id].h_n == r.n
            assert got[r.id].h_std == (None if r.s is None else pytest.approx(r.s, rel=1e-7, abs=1e-9))
    assert len(got) == 600


def test_rows_without_a_time_have_no_history(spark):
    rows = [("a", "k", T0, 1.0), ("b", "k", T0 + dt.timedelta(hours=1), 2.0), ("c", "k", None, 3.0), ("d", "k", None, 4.0)]
    for some in (rows, rows[2:]):
        df = spark.createDataFrame(some, "id string, k string, ts timestamp_ntz, x double")
        out = prior_moments(df, "k", "ts", "x", 30 * 24 * 60 * MIN, 60 * MIN, prefix="h").collect()
        assert {r.id: r.h_n for r in out} == {r[0]: 1 if r[0] == "b" else 0 for r in some}
