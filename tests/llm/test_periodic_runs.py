import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from cardrisk.llm import periodic_runs as P
from conftest import SF_SMALL


def brute_runs(words, min_words=24, min_times=3):
    """Every maximal stretch per period, looked at word by word; only smallest periods count."""
    n, out, seen = len(words), [], set()
    for p in range(1, n // min_times + 1):
        x = 0
        while x < n - p:
            if words[x] != words[x + p]:
                x += 1
                continue
            start = x
            while x < n - p and words[x] == words[x + p]:
                x += 1
            size = x + p - start
            if size >= max(min_words, min_times * p) and (start, size) not in seen:
                seen.add((start, size))
                out.append((start, size, p))
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    runs = brute_runs(words)
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
            sha("".join("%d,%d,%d\n" % r for r in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


def periodic_text(rnd):
    words = []
    for _ in range(rnd.randrange(1, 6)):
        base = [rnd.choice("ab") if rnd.random() < 0.5 else rnd.choice(["c", "é", "word"]) for _ in range(rnd.randrange(1, 14))]
        if rnd.random() < 0.3:
            base = base * 3 + ["x"]                       # runs inside runs
        words += (base * rnd.randrange(1, 30))[:rnd.randrange(1, 200)]
        words += [rnd.choice("abc") for _ in range(rnd.randrange(0, 4))]
    return words


def test_runs_equal_brute_force():
    rnd = random.Random(5)
    texts = [" ".join(periodic_text(rnd)) for _ in range(250)]
    texts += [" ".join(rnd.choice("ab") for _ in range(rnd.randrange(20, 120))) for _ in range(60)]
    for found, text in zip(P.analyse(texts), texts, strict=True):
        assert [tuple(r) for r in found.runs.tolist()] == brute_runs(text.split())


@pytest.mark.parametrize("letters", [1, 2, 4, 1000])
def test_grammar_answers_common_extensions_exactly(letters):
    rng = np.random.default_rng(letters)
    text = rng.integers(1, letters + 1, 700)
    text[300:600] = text[200:500]
    text[500:560] = 1
    sequence = np.r_[0, text, 0, text[:200], 0]
    grammar = P.Grammar(sequence)
    assert len(grammar.top) == 5
    i = rng.integers(1, 700, 3000)
    j = rng.integers(1, 701, 3000)
    i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]
    for step in (1, -1):
        got = grammar.common(i, j, step)
        for x, y, n in zip(i.tolist(), j.tolist(), got.tolist()):
            want = 0
            while sequence[x + step * want] == sequence[y + step * want] and sequence[y + step * want] and sequence[x + step * want]:
                want += 1
            assert n == want


def test_levels_are_logarithmic_and_linear_in_all():
    rng = np.random.default_rng(3)
    n = 200_000
    grammar = P.Grammar(np.r_[0, rng.integers(1, 5000, n), 0])
    assert len(grammar.levels) < 120
    assert sum(len(x.symbols) for x in grammar.levels) < 9 * n


def test_grid_meets_every_long_enough_stretch():
    for n in (24, 25, 77, 300):
        points = [p for piece in P.grid(n) for p in zip(*(x.tolist() for x in piece))]
        assert len(points) == len(set(points))
        for p in range(1, n // 3 + 1):
            places = sorted(g for q, g in points if q == p)
            need = max(24, 3 * p) - p
            assert all(any(s <= g < s + need for g in places) for s in range(0, n - p - need + 1))


def test_null_empty_long_tied_and_repeated_rows(spark):
    rnd = random.Random(9)
    long = " ".join(("lorem ipsum dolor " * 100_000).split() + [str(i) for i in range(200_000)] + ["z"] * 50_000)
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a " * 23), (5, "a " * 24), (None, "a " * 24), (5, "a " * 24), (6, "a b " * 12),
            (7, " ".join(["a"] * 24 + ["b"] * 24)), (8, "x y z " * 8 + "q " * 30)] + [(100 + i, " ".join(periodic_text(rnd))) for i in range(40)]
    df = spark.createDataFrame([(*r, "s", 1) for r in rows + [(9, long)]], "doc_id long, text string, runs string, start int")
    got = sorted((tuple(r) for r in P.run_digests(df).filter("doc_id <> 9 or doc_id is null").collect()), key=repr)
    assert got == sorted((brute_row(*r) for r in rows), key=repr)
    assert P.find_runs(df.filter("doc_id = 9")).first().runs == [(0, 300_000, 3), (500_000, 50_000, 1)]
    out = P.collapse_runs(df)
    assert out.columns == [*df.columns, "__runs"]
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[1] is None and texts[3] == " \t\n" and texts[4] == "a " * 23 and texts[5] == "a" and texts[6] == "a b"
    assert texts[8] == "x y z q" and texts[9].count(" ") == 3 + 200_000
    assert P.run_digests(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def planted(doc_id, text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return text
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))


def test_query_equals_brute_force(spark):
    from cardrisk.llm.queries import QUERIES
    from cardrisk.llm.common import table
    docs = table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    short = {r.doc_id: r for r in docs if len(r.text or "") < 12_000}
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF_SMALL).collect()}
    assert len(got) == len(docs) and len(short) > 150
    assert {k: got[k] for k in short} == {k: brute_row(k, planted(*r)) for k, r in short.items()}
    assert sum(v[1] > 0 for v in got.values()) > 5
