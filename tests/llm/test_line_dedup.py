import hashlib
import random

import duckdb
import pytest

from cardrisk.llm import line_dedup as L
from conftest import SF_SMALL

WS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows, min_chars=L.MIN_CHARS, min_docs=L.MIN_DOCS):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= min_chars:
                holders.setdefault(key_of(line), set()).add(doc)
    top = {k: max((d for d in v if d is not None), default=None) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key_of(x) not in top or top[key_of(x)] == doc]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=120):
    rnd = random.Random(seed)
    common = ["Line %d that many documents share, long enough to count é" % i for i in range(12)]
    rows = []
    for i in range(n):
        lines = []
        for _ in range(rnd.randrange(0, 14)):
            x = rnd.random()
            line = rnd.choice(common[:1 + int(11 * rnd.random() ** 2)]) if x < 0.6 else "own line %d of the document %d %s" % (rnd.random() * 1e6, i, "x" * 20)
            lines.append(rnd.choice(["", " ", "\t", "\r"]) + (line.upper() if rnd.random() < 0.2 else line) + rnd.choice(["", "  ", "\x0b"]))
        rows.append((i, "\n".join(lines)))
    return rows


@pytest.mark.parametrize("seed,rows_per_range", [(1, 1_000_000), (2, 100), (3, 40)])
def test_equals_brute_force_at_any_range_size(spark, monkeypatch, seed, rows_per_range):
    monkeypatch.setattr(L.keep_bitmaps, "__defaults__", (L.MIN_CHARS, L.MIN_DOCS, rows_per_range))
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in L.line_digests(spark, df).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("rows_per_range", [1_000_000, 9_000])
def test_nulls_ties_repeats_clashing_columns_and_long_texts(spark, rows_per_range):
    hot = "x" * 40
    rows = [(i, hot + "\nend") for i in range(6)] + [(5, hot + "\nend")] * 2 + [(5, "other\n" + hot)]
    rows += [(None, hot), (None, None), (7, None), (8, ""), (9, "y" * 40), (10, "y" * 40), (11, " " + "y" * 40), (12, "Y" * 40)]
    rows += [(13, "\n".join([hot, "z" * 39, "é" * 40] * 30_000))] + [(20 + i, "é" * 40) for i in range(4)]
    df = spark.createDataFrame([(*r, "b", 3, 4) for r in rows], "doc_id long, text string, h string, pos int, th int")
    bitmaps = L.keep_bitmaps(spark, df, rows_per_range=rows_per_range)
    got = L.apply_bitmaps(df, bitmaps)
    assert got.columns == df.columns
    want = brute(rows)
    texts = sorted(((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in got.collect()), key=repr)
    assert texts == sorted(((w[0], w[3]) for w in want), key=repr)
    assert {(r.doc_id, r.n_lines, r.n_dropped) for r in bitmaps.collect()} == {w[:3] for w in want if w[2]}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert L.line_digests(spark, empty).count() == 0


def test_a_hot_line_is_streamed_by_many_tasks(spark):
    rows = spark.range(20_000).selectExpr("id AS doc_id", "repeat('hot ', 20) || '\n' || repeat(id, 12) AS text")
    lines = L.line_rows(rows)
    order = ["h", L.F.col("doc_id").desc_nulls_last(), "pos"]
    ranged = lines.repartitionByRange(8, *order).withColumn("task", L.F.spark_partition_id())
    hot = ranged.groupBy("h", "task").count().groupBy("h").agg(L.F.sum("count").alias("n"), L.F.max("count").alias("most"))
    n, most = hot.orderBy(L.F.desc("n")).select("n", "most").first()
    assert n == 20_000 and most < 9_000
    got = L.keep_bitmaps(spark, rows, rows_per_range=5_000)
    assert got.count() == 19_999 and got.filter("doc_id = 19999").count() == 0


def test_query_equals_its_sql(spark):
    from cardrisk.llm.queries import ORACLE, QUERIES
    got = QUERIES["op12_line_dedup"](spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE['op12_line_dedup']})").fetchall()
    assert sorted(tuple(r) for r in got.select(cols).collect()) == sorted(want)
