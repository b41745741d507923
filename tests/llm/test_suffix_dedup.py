import hashlib
import random

import numpy as np
import pytest

from cardrisk.llm import suffix_dedup as S


def brute(rows):
    """Per row the result when 100-byte strings are looked up in a set, ids in order."""
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, i))
    for i in order:
        b = (rows[i][1] or "").encode()
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            if w in seen:
                gone[s:s + 100] = True
            seen.add(w)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((rows[i][0], len(b), int(gone.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~gone])).hexdigest()))
    return sorted(out, key=repr)


def corpus(seed, n=60):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(rnd.randrange(10, 60))) for _ in range(6)]
    texts = []
    for i in range(n):
        parts = [" ".join(word() for _ in range(rnd.randrange(0, 60))) for _ in range(3)]
        if rnd.random() < 0.6:
            parts.insert(rnd.randrange(3), rnd.choice(passages))
        if rnd.random() < 0.2:
            parts.append(rnd.choice(passages)[:rnd.randrange(95, 110)])
        texts.append(" ".join(parts))
        if rnd.random() < 0.3:
            t = list(rnd.choice(texts))
            for _ in range(rnd.randrange(3)):
                if t:
                    t[rnd.randrange(len(t))] = "z"
            texts.append("".join(t))
    return texts


def result(spark, rows, chunk_bytes):
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("'k' AS key", "text", "doc_id", "1 AS n_bytes")
    return sorted((tuple(r) for r in S.remove_repeats(spark, df, chunk_bytes).collect()), key=repr)


@pytest.mark.parametrize("seed,chunk_bytes", [(1, 1 << 20), (2, 4000), (3, 1)])
def test_equals_brute_force(spark, seed, chunk_bytes):
    rows = list(enumerate(corpus(seed)))
    assert result(spark, rows, chunk_bytes) == brute(rows)


def test_periodic_texts_nulls_ties_and_repeats(spark):
    p = "0123456789abcdef" * 20
    rows = [(1, "a" * 250), (2, "a" * 101), (3, "ab" * 80), (4, None), (5, ""), (6, "x" * 99), (7, "x" * 99), (8, p), (8, p), (9, p[5:140]),
            (10, "é" * 50), (11, "é" * 51), (None, p), (12, "b" * 100), (13, "b" * 100)]
    for chunk_bytes in (1 << 20, 1):
        assert result(spark, rows, chunk_bytes) == brute(rows)
    assert result(spark, [(1, None)], 100)[0][:4] == (1, 0, 0, 0)
    assert S.remove_repeats(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_difference_cover_names_order_the_suffixes():
    rng = np.random.default_rng(1)
    text = rng.choice(np.frombuffer(b"ab", np.uint8), 700)
    text[300:500] = text[50:250]
    names = S.sampled_names(text)
    at = [p for p in range(len(text) - 98) if p % 3]
    b = text.tobytes()
    by_bytes = sorted(at, key=lambda p: b[p:p + 98])
    assert all((names[p] == names[q]) == (b[p:p + 98] == b[q:q + 98]) and names[p] <= names[q] for p, q in zip(by_bytes, by_bytes[1:]))


def test_local_repeats_on_random_texts():
    rng = np.random.default_rng(7)
    for n in (99, 100, 350, 2000):
        text = rng.choice(np.frombuffer(b"ab", np.uint8), n)
        if n > 300:
            text[-150:] = text[:150]
            text[120:240] = 97
        sizes = np.array([n // 3, n - n // 3])
        flags = S.local_repeats(text, sizes, S.anchors(text))
        seen, want, b = set(), [], text.tobytes()
        for a, e in ((0, n // 3), (n // 3, n)):
            for s in range(a, e - 99):
                if b[s:s + 100] in seen:
                    want.append(s)
                seen.add(b[s:s + 100])
        assert np.flatnonzero(flags).tolist() == want
