import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from cardrisk.llm import mixture as M
from conftest import SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(budget, children):
    """Water-filling by rounds: {name: (capacity, weight)} -> shares."""
    share, open_ = {}, dict(children)
    while open_:
        w = sum(v[1] for v in open_.values())
        full = {k: v for k, v in open_.items() if v[0] <= budget * v[1] / w + 1e-9}
        if not full:
            share.update({k: budget * v[1] / w for k, v in open_.items()})
            break
        for k, v in full.items():
            share[k] = v[0]
            budget -= v[0]
            del open_[k]
        budget = max(budget, 0)
    return share


def brute(rows, budget, weights, epochs, seed="mix"):
    """(doc_id, epoch) of all taken rows; rows are (doc_id, domain, lang, source, tokens)."""
    leaf = {}
    for r in rows:
        leaf[r[1:4]] = leaf.get(r[1:4], 0) + r[4]
    weight = lambda path: weights.get(path, weights.get(("*",) * (len(path) - 1) + path[-1:] if len(path) > 1 else path, 1.0))

    def down(prefix, budget):
        names = sorted({k[len(prefix)] for k in leaf if k[:len(prefix)] == prefix})
        cap = {n: sum(v for k, v in leaf.items() if k[:len(prefix) + 1] == prefix + (n,)) * epochs for n in names}
        share = fill(budget, {n: (cap[n], weight(prefix + (n,))) for n in names})
        for n in names:
            if len(prefix) == 2:
                yield prefix + (n,), int(share[n] + 1e-6)
            else:
                yield from down(prefix + (n,), share[n])
    out = []
    for path, b in down((), float(int(budget))):
        mine = [r for r in rows if r[1:4] == path]
        full, rest = divmod(b, leaf[path]) if leaf[path] else (0, 0)
        out += [(r[0], e) for r in mine for e in range(full)]
        key = lambda r: hashlib.md5(f"{seed}:{full}:{'' if r[0] is None else r[0]}".encode()).hexdigest()
        used = 0
        for r in sorted(mine, key=key):
            used += r[4]
            if used > rest:
                break
            out.append((r[0], full))
    return sorted(out, key=repr)


def taken(spark, rows, share, weights, epochs):
    df = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, text string, bucket string, rest long")
    total = sum(len(WORD.findall(r[4] or "")) for r in rows)
    got = M.mix(spark, df, F.col("domain"), F.col("all_tokens") * share, weights, epochs)
    assert got.columns[:7] == df.columns
    clean = [(r[0], r[1] or "", r[2] or "", r[3] or "", len(WORD.findall(r[4] or ""))) for r in rows]
    return sorted(((r.doc_id, r["__epoch"]) for r in got.collect()), key=repr), brute(clean, total * share, weights, epochs)


WEIGHTS = {("web",): 0.5, ("books",): 0.5, ("*", "en"): 0.7, ("*", "de"): 0.3, ("books", "en", "rare"): 5.0}


@pytest.mark.parametrize("share,epochs", [(0.4, 1), (0.9, 2), (1.7, 3), (9.0, 2), (0.0, 1)])
def test_equals_rounds_of_water_filling(spark, share, epochs):
    rows, i = [], 0
    for domain, lang, source, docs, words in (("web", "en", "a", 60, 30), ("web", "en", "b", 10, 5), ("web", "de", "a", 9, 11),
                                              ("books", "en", "rare", 2, 9), ("books", "en", "common", 25, 40), ("books", "fr", "x", 5, 8)):
        for k in range(docs):
            rows.append((i, domain, lang, source, "w " * (words + k % 3), "b", 7))
            i += 1
    got, want = taken(spark, rows, share, WEIGHTS, epochs)
    assert got == want


def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [(i, "web", "en", s, "w " * 10, "", 0) for i, s in enumerate(["a"] * 1 + ["b"] * 99)]
    rows += [(1000 + i, "books", "en", "c", "w " * 10, "", 0) for i in range(100)]
    got, want = taken(spark, rows, 0.5, {}, 1)
    assert got == want
    # source a holds far less than its share: b takes it up, the domains stay even
    assert sum(d < 1000 for d, _ in got) == sum(d >= 1000 for d, _ in got) == 50


def test_nulls_empties_and_repeats(spark):
    rows = [(1, None, None, None, None, "", 0), (2, "web", "en", "a", "", "", 0), (3, "web", "en", "a", "x y", "", 0),
            (4, "web", "en", "a", "x y z", "", 0), (None, "web", "en", "b", "one", "", 0), (5, "web", "en", "b", "one two", "", 0)]
    got, want = taken(spark, rows, 0.6, {}, 2)
    assert got == want
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert M.mix(spark, df, F.lit("d"), F.lit(10), {}, 1).count() == 0


def test_query_equals_its_sql(spark):
    from cardrisk.llm.queries import ORACLE, QUERIES
    got = QUERIES["op8_hierarchical_mixture"](spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE['op8_hierarchical_mixture']})").fetchall()
    assert sorted(tuple(r) for r in got.select(cols).collect()) == sorted(want)


@pytest.mark.parametrize("weights", [{("web",): 0.0}, {("*", "en"): 0.0}, {("*", "*", "a"): 0.0, ("web", "en", "b"): 0.0}])
def test_weight_zero_leaves_a_node_out_and_its_share_to_its_siblings(spark, weights):
    rows, i = [], 0
    for domain in ("web", "books"):
        for lang in ("en", "de"):
            for source in ("a", "b"):
                for k in range(12):
                    rows.append((i, domain, lang, source, "w " * (10 + k), "", 0))
                    i += 1
    df = spark.createDataFrame(rows, "doc_id long, domain string, lang string, source string, text string, bucket string, rest long")
    gone = {(d, x, s) for d in ("web", "books") for x in ("en", "de") for s in ("a", "b")
            if 0.0 in (weights.get((d,)), weights.get(("*", x)), weights.get(("*", "*", s)), weights.get((d, x, s)))}
    left = [r for r in rows if r[1:4] not in gone]
    got = sorted((r.doc_id, r["__epoch"]) for r in M.mix(spark, df, F.col("domain"), F.lit(300), weights, 1).collect())
    clean = [(r[0], r[1], r[2], r[3], len(WORD.findall(r[4]))) for r in left]
    assert got == brute(clean, 300, {k: v for k, v in weights.items() if v}, 1) and got
    assert M.mix(spark, df, F.col("domain"), F.lit(300), {("web",): 0.0, ("books",): 0.0}, 1).count() == 0
