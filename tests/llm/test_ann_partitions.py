import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from cardrisk.llm import ann_partitions as A
from conftest import SF_SMALL


def brute(ids, x, queries, k):
    out = {}
    for q in queries:
        at = ids != ids[q]
        d = np.sqrt(((x[at] - x[q]) ** 2).sum(1))
        order = np.lexsort((ids[at], d))[:k]
        out[int(ids[q])] = list(zip(ids[at][order].tolist(), d[order].tolist()))
    return out


def test_recall_with_several_parts(spark, monkeypatch):
    monkeypatch.setattr(A, "PART_ROWS", 250)
    monkeypatch.setattr(A, "BLOCK", 100)
    monkeypatch.setattr(A, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = (centres[rng.integers(0, 12, 2000)] + 0.4 * rng.normal(size=(2000, 16))).astype(np.float32)
    ids = np.arange(2000)
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    got = A.search(spark, df, F.col("vec_id") % 50 == 0).collect()
    want = brute(ids, x.astype(float), range(0, 2000, 50), 10)
    found = {(r.query_id, r.vec_id): r.score for r in got}
    assert sum((q, v) in found for q, w in want.items() for v, _ in w) >= 0.95 * 400
    for r in got:
        assert r.score == pytest.approx(float(np.sqrt(((x[r.vec_id].astype(float) - x[r.query_id].astype(float)) ** 2).sum())), rel=1e-12)
    ranks = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        ranks.setdefault(r.query_id, []).append((r.rank, r.score))
    assert all([p[0] for p in v] == list(range(1, 11)) and [p[1] for p in v] == sorted(p[1] for p in v) for v in ranks.values())


def test_parts_are_balanced_and_keep_neighbours():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(900, 8))
    graph = A.neighbour_graph(x, 8)
    label = A.balanced_parts(x, graph, 6)
    size = np.bincount(label, minlength=6)
    assert size.min() >= 120 and size.max() <= 165
    shuffled = rng.permutation(label)
    kept = lambda y: (y[graph] == y[:, None]).mean()
    assert kept(label) > 2 * kept(shuffled)


def test_unusable_vectors_ties_and_few_candidates(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [1.0, 0.0]), (3, [0.0, 1.0]), (2, [0.0, 1.0]), (2, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0]), (None, [1.0, 1.0]), (200, [0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("x"))
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in A.search(spark, df, F.col("vec_id") % 100 == 0).collect())
    r2 = 2 ** 0.5
    assert got == [(0, 1, 100, 0.0), (0, 2, 2, r2), (0, 3, 3, r2), (100, 1, 0, 0.0), (100, 2, 2, r2), (100, 3, 3, r2)]
    assert A.search(spark, df.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert A.search(spark, df.filter("vec_id = 4"), F.col("vec_id") % 100 == 0).count() == 0


def test_query_on_the_table(spark):
    from cardrisk.llm.queries import QUERIES
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF_SMALL}/embeddings.parquet' ORDER BY vec_id").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], np.float32).astype(float)
    want = brute(ids, x, np.flatnonzero(ids % 100 == 0), 10)
    got = QUERIES["op7_learned_partition_ann"](spark, SF_SMALL).collect()
    hits = sum((r.query_id, r.vec_id) in {(q, v) for q, w in want.items() for v, _ in w} for r in got)
    assert hits >= 0.9 * sum(map(len, want.values())) and len(got) == sum(map(len, want.values()))


def test_repeated_rows_leave_room_for_k_ids():
    """Copies of an id, equal or not, count once before the cut to k."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(60, 8))
    for copies, jitter in ((2, 0), (10, 0), (25, 0), (10, 1e-3)):
        ids = np.repeat(np.arange(60), copies)
        rows = np.repeat(x, copies, 0) + jitter * rng.normal(size=(60 * copies, 8))
        at = rng.permutation(len(ids))
        q, r, d = A.nearest(x[:5], np.arange(5), rows[at], ids[at], 10)
        for i in range(5):
            every = np.sqrt(((rows - x[i]) ** 2).sum(1)).reshape(60, copies).min(1)
            every[i] = np.inf
            order = np.lexsort((np.arange(60), every))[:10]
            assert r[q == i].tolist() == order.tolist() and np.allclose(d[q == i], every[order])


def test_query_on_repeated_rows_returns_k(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(40, 4)).astype(np.float32)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(40) for _ in range(12)], "vec_id long, embedding array<float>")
    got = A.search(spark, df, F.col("vec_id") % 20 == 0).collect()
    want = brute(np.arange(40), x.astype(float), [0, 20], 10)
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == {(q, n, v) for q, w in want.items() for n, (v, _) in enumerate(w, 1)}


def test_scores_of_double_vectors_are_exact(spark):
    import math
    rows = [(0, [0.1, 0.2, 1 / 3]), (1, [0.3, 2 / 3, 0.7]), (100, [1e-9, 1.0, 1 / 7])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in A.search(spark, df, F.col("vec_id") == 0, k=2).collect()}
    assert got == {(0, i): math.sqrt(sum((a - b) ** 2 for a, b in zip(rows[0][1], v))) for i, v in rows[1:]}
