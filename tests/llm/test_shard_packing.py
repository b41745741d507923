import re
import zlib

import duckdb
import numpy as np

from cardrisk.llm import shard_packing as P
from conftest import SF_ORACLE


def test_place_takes_the_highest_dot_product():
    v = np.array([[0.5, 0.1, 0.1], [0.3, 0.2, 0.2], [0.1, 0.4, 0.4], [0.1, 0.3, 0.3]])
    out = P.place(v, 2, level=0)
    load = np.zeros((2, 3))
    for i in np.argsort(-v.max(1), kind="stable"):
        assert ((0.5 - load) @ v[i]).argmax() == out[i]
        load[out[i]] += v[i]


def check(rows, got, n_shards=8):
    size = lambda t: len((t or "").encode()) + 1
    want = sorted(((d, size(t), zlib.crc32((t or "").encode())) for d, t in rows), key=repr)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in got), key=repr) == want
    for s in range(n_shards):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert all(r.law == "bytes" and r.grown_shard is None for r in got)


def test_table_is_balanced_and_groups_stay_together(spark):
    from cardrisk.llm.queries import QUERIES
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_ORACLE}/documents.parquet'").fetchall()
    got = QUERIES["op10_vector_shards"](spark, SF_ORACLE).collect()
    check(rows, got)
    load = np.array([[sum(r["size"] for r in got if r.shard == s), sum(r.shard == s for r in got)] for s in range(8)], float)
    assert load[:, 0].max() <= 1.01 * load[:, 0].min()
    assert load[:, 1].max() <= 1.25 * load[:, 1].min()
    text = dict(rows)
    shards = {}
    for r in got:
        shards.setdefault(text[r.doc_id], set()).add(r.shard)
    split = [t for t, s in shards.items() if len(s) > 1]
    words = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = [sum(f(t) for t in text.values()) for f in (lambda t: len((t or "").encode()) + 1, words, lambda t: 1)]
    for t in split:         # only groups above a quarter of a shard in some measure
        n = sum(t == u for u in text.values())
        share = max(n * x / y for x, y in zip((len((t or "").encode()) + 1, words(t), 1), total))
        assert share > 0.9 * P.TOGETHER / P.PIECES / 8


def test_hot_group_is_cut_and_nulls_are_placed(spark):
    rows = [(i, "same text for a third of all rows") for i in range(300)] + [(1000 + i, f"other {i} " * (i % 7 + 1)) for i in range(500)]
    rows += [(5, None), (None, None), (None, ""), (7, ""), (0, "x"), (0, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("text", "'x' AS shard", "doc_id", "1 AS item")
    got = P.pack_documents(spark, df).collect()
    check(rows, got)
    load = [sum(r["size"] for r in got if r.shard == s) for s in range(8)]
    assert max(load) <= 1.05 * min(load)
    assert P.pack_documents(spark, df.limit(0)).count() == 0


def brute_place(items, n_shards, level):
    """The rule in plain steps: largest first, to the shard with the highest dot product with what it has room for;
    the smallest ``level`` of the items to the shard with the most room for bytes."""
    left = [[1 / n_shards] * 3 for _ in range(n_shards)]
    out = {}
    order = sorted(range(len(items)), key=lambda i: -max(items[i]))
    for rank, i in enumerate(order):
        if rank < (1 - level) * len(order):
            best = [sum(r * x for r, x in zip(left[s], items[i])) for s in range(n_shards)]
        else:
            best = [left[s][0] for s in range(n_shards)]
        s = max(range(n_shards), key=lambda k: (best[k], -k))
        out[i] = s
        left[s] = [r - x for r, x in zip(left[s], items[i])]
    return [out[i] for i in range(len(items))]


def test_place_equals_the_rule_step_by_step_at_the_level_that_the_query_uses():
    rng = np.random.default_rng(12)
    for n, shards in ((1, 8), (40, 3), (500, 8), (1500, 16)):
        v = rng.pareto(1.5, (n, 3)) + 0.01
        v[: n // 5] = v[0]                       # ties
        v /= v.sum(0)
        for level in (0.125, 0.0, 1.0):
            assert P.place(v, shards, level).tolist() == brute_place(v.tolist(), shards, level)
    assert P.place(v, 16).tolist() == brute_place(v.tolist(), 16, 0.125)
