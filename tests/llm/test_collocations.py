import random
import re
from collections import Counter

import duckdb
import pytest

from cardrisk.llm import collocations as C
from conftest import SF_SMALL


def brute(rows, min_count=30, top=2000):
    counts, total = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, 5):
                counts.setdefault(lang, Counter()).update(tuple(w[i:i + m]) for i in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        cand = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = {p[s:s + m] for p, a in cand.items() for m in range(2, len(p)) for s in range(len(p) - m + 1)
                if 100 * a >= 80 * f[p[s:s + m]]}
        found = []
        for p, a in cand.items():
            if p not in gone:
                score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def corpus(seed, n=150):
    rnd = random.Random(seed)
    words = ["w%d" % i for i in range(40)] + ["é", "naïve", "\x01", "日本"]
    pick = lambda: words[int(len(words) * rnd.random() ** 2)]
    fixed = ["new york city hall", "machine learning model", "of the", "to be or not"]
    rows = []
    for _ in range(n):
        parts = []
        for _ in range(rnd.randrange(0, 40)):
            parts.append(rnd.choice(fixed) if rnd.random() < 0.3 else pick())
            if rnd.random() < 0.2:
                parts.append(rnd.choice([",", ".", "\n", " \t ", ";", "!?", "\x0b"]))
        text = " ".join(parts)
        rows.append((rnd.choice(["en", "en", "de", None]), text.upper() if rnd.random() < 0.1 else text))
        if rnd.random() < 0.3:
            rows += [rows[-1]] * rnd.randrange(1, 4)
    return rows


def mined(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, text string, phrase string, c int")
    return sorted(tuple(r) for r in C.mine(spark, df, **options).collect())


@pytest.mark.parametrize("seed,trigger,bits", [(1, 32, 1 << 26), (2, 2, 1 << 15), (3, 1, 1 << 20)])
def test_equals_brute_force_with_any_trigger_and_bitmap(spark, seed, trigger, bits):
    rows = corpus(seed)
    got = mined(spark, rows, trigger=trigger, bits=bits)
    assert len(got) >= 10 and got == brute(rows)
    if seed == 1:
        assert mined(spark, rows, min_count=5, top=7) == brute(rows, 5, 7)


def test_chunks_cover_every_phrase_once():
    for trigger in (1, 2, 8):
        texts = [C.tokens_of(t) for _, t in corpus(4, 30) if t] + [C.tokens_of(" ")]
        chunks, owned = C.chunks_of(texts, trigger)
        words = lambda t: t.split(b" ")[:-1]
        assert int(owned.sum()) == sum(w != b"\n" for t in texts for w in words(t))
        starts, want = Counter(), Counter()
        for c in chunks:
            w = words(c)
            assert len(w) >= C.OVERLAP and c.endswith(b" ")
            starts.update(tuple(w[i:i + 4]) for i in range(len(w) - C.OVERLAP))
        for t in texts:
            w = words(t)
            want.update(tuple(w[i:i + 4]) for i in range(len(w) - C.OVERLAP))
        assert starts == want
    assert len(set(chunks)) < len(chunks)


def test_nulls_empties_ties_and_long_texts(spark):
    rows = [("en", None), ("en", ""), (None, " \t"), ("en", ".,;\n")] + [("en", "a b")] * 30 + [("en", "b a")] * 30 + [(None, "c d e f g")] * 40
    rows += [("de", "x " * 100_000 + ". " + "p q " * 50_000), ("fr", "one two three")]
    assert mined(spark, rows) == brute(rows)
    empty = spark.createDataFrame([], "doc_id long, lang string, text string")
    assert C.mine(spark, empty).count() == 0


def test_scores_beyond_64_bits_and_hot_parts(spark):
    big = 4 * 10 ** 15
    rows = [("en", "the", big)] + [("en", w, big - 7) for w in ("a", "b")] + [("en", "the a", big - 9), ("en", "the b", 31)]
    rows += [("en", "w%d" % i, 40) for i in range(3000)] + [("en", "the w%d" % i, 35) for i in range(3000)]
    got = {r.phrase: r for r in C.scored(spark, spark.createDataFrame(rows, "lang string, phrase string, f long")).collect()}
    assert len(got) == 3002
    assert got["the a"].score == 2_000_000 * (big - 9) // (2 * big - 7)
    assert got["the w17"].score == 2_000_000 * 35 // (big + 40) and got["the w17"].l == big


def test_query_equals_its_sql(spark):
    from cardrisk.llm.queries import ORACLE, QUERIES
    got = QUERIES["op13_collocations"](spark, SF_SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF_SMALL}/documents.parquet'")
    cols = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({ORACLE['op13_collocations']})").fetchall()
    assert sorted(tuple(r) for r in got.select(cols).collect()) == sorted(want) and want
