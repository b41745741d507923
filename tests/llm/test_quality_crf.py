import itertools
import re

import duckdb
import numpy as np
import pytest

from cardrisk.llm import quality_crf as Q
from conftest import SF_ORACLE, SF_SMALL

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_counts(text):
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


def test_base_counts_equal_brute_force():
    texts = ["", " \n\t", "a b c a b c", "x x x x", "l1\nl1\n\n \nl1 \n", "é| ##\x0b<>\x1c a\x85b", "a b c d " * 5, "one\r\none\r\n"]
    texts += [t[:3000] for (t,) in duckdb.sql(f"SELECT text FROM '{SF_SMALL}/documents.parquet' ORDER BY doc_id LIMIT 40").fetchall()]
    for t in texts:
        assert Q.base_counts(t) == brute_counts(t), t[:80]


def test_viterbi_equals_enumeration():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 8):
        chain = Q.Chain(rng.normal(size=(Q.N_FEATURES, 2)), rng.normal(size=(2, 2)))
        f = rng.random((n, Q.N_FEATURES)).astype(np.float32)
        s = f @ chain.emit
        score = lambda y: sum(s[i, k] for i, k in enumerate(y)) + sum(chain.move[a, b] for a, b in zip(y, y[1:]))
        best = max(itertools.product((0, 1), repeat=n), key=score)
        assert tuple(chain.viterbi(f).astype(int)) == best
    assert len(chain.viterbi(np.zeros((0, Q.N_FEATURES)))) == 0


def test_held_out_accuracy():
    """Trained on every other labelled document, right on nearly all of the others."""
    rows = duckdb.sql(f"SELECT text, quality FROM '{SF_ORACLE}/documents.parquet' JOIN '{SF_ORACLE}/labels.parquet' USING (doc_id) "
                      "ORDER BY doc_id").fetchall()
    train = [(Q.content_lines(t), q) for t, q in rows[::2] if len(t) <= Q.TRAIN_CHARS]
    chain = Q.calibrate(Q.fit_chain([(Q.line_features(x), q) for x, q in train]), [x for x, q in train if q == 1])
    judged = [(Q.content_share(chain, Q.content_lines(t)) >= Q.MIN_CONTENT_SHARE, q) for t, q in rows[1::2]]
    clean = [k for k, q in judged if q == 1]
    assert sum(clean) >= 0.99 * len(clean)
    assert sum(k == bool(q) for k, q in judged) >= 0.9 * len(judged)


def test_without_labels_the_base_rules_decide(spark):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60))), (2, "a b c " * 40), (3, None), (None, "")],
                                 "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    chain = Q.train_chain(spark, docs, none)
    got = {r.doc_id: r for r in Q.judge_documents(spark, docs, chain).collect()}
    assert [got[k].kept for k in (1, 2, 3, None)] == [True, False, False, False]
    assert got[2].base_failed and got[2].n_repeat_words == 120 and got[3].n_words == 0
    assert Q.judge_documents(spark, docs.limit(0), chain).count() == 0
    wide = docs.selectExpr("text", "'z' AS kept", "doc_id", "1 AS n_words")
    kept = Q.keep_documents(spark, wide, chain).collect()
    assert [(r.doc_id, r.kept, r.n_words) for r in kept] == [(1, "z", 1)]


def test_query_keeps_clean_documents(spark):
    from cardrisk.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op1_line_crf_quality"](spark, SF_SMALL).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text, quality FROM '{SF_SMALL}/documents.parquet' LEFT JOIN '{SF_SMALL}/labels.parquet' USING (doc_id)").fetchall()
    assert len(got) == len(rows)
    for i, t, _ in rows:
        c = Q.base_counts(t or "")
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c
        assert r.base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0]) and not (r.base_failed and r.kept)
    clean = [got[i] for i, _, q in rows if q == 1 and not got[i].base_failed]
    assert sum(r.kept for r in clean) >= 0.98 * len(clean)


def labelled(half):
    """(lines, quality) of every other labelled document that passes the base rules."""
    rows = duckdb.sql(f"SELECT text, quality FROM '{SF_ORACLE}/documents.parquet' JOIN '{SF_ORACLE}/labels.parquet' USING (doc_id) "
                      "ORDER BY doc_id").fetchall()[half::2]
    return [(Q.content_lines(t), q) for t, q in rows if len(t) <= Q.TRAIN_CHARS and not Q.base_failed(Q.base_counts(t))]


def trained(train):
    chain = Q.fit_chain([(Q.line_features(x), q) for x, q in train])
    return Q.calibrate(chain, [x for x, q in train if q == 1], [x for x, q in train if q == 0])


def test_poor_documents_stay_rejected_whatever_a_few_labels_say():
    """Held-out poor documents that pass the base rules; then with three of them labelled clean in the sample."""
    train, held = labelled(0), labelled(1)
    poor = [x for x, q in held if q == 0]
    clean = [x for x, q in held if q == 1]
    wrong = [i for i, (_, q) in enumerate(train) if q == 0][:3]
    for sample in (train, [(x, 1 if i in wrong else q) for i, (x, q) in enumerate(train)]):
        chain = trained(sample)
        keeps = lambda x: Q.content_share(chain, x) >= Q.MIN_CONTENT_SHARE
        assert len(poor) > 8 and sum(not keeps(x) for x in poor) >= 0.8 * len(poor)
        assert sum(map(keeps, clean)) >= 0.98 * len(clean)


def test_labels_that_mean_nothing_are_an_error(spark):
    text = "\n".join(" ".join(f"word{i}x{j}" for j in range(10)) for i in range(20))
    docs = spark.createDataFrame([(i, text) for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    with pytest.raises(ValueError, match="told apart"):
        Q.train_chain(spark, docs, labels)
    one = Q.train_chain(spark, docs, labels.filter("quality = 0"))
    assert Q.judge(text, one)[-1]


def test_the_chain_marks_boilerplate_lines_inside_mixed_texts():
    """Held-out poor lines between held-out clean ones: both labels in one text, in runs."""
    train, held = labelled(0), labelled(1)
    chain = trained(train)
    clean, poor = [x for x, q in held if q == 1], [x for x, q in held if q == 0]
    marked = {True: [0, 0], False: [0, 0]}
    for i, p in enumerate(poor):
        a, b = clean[2 * i], clean[2 * i + 1]
        labels = chain.viterbi(Q.line_features(a + p + b)).tolist()
        for is_content, part in ((True, labels[:len(a)] + labels[len(a) + len(p):]), (False, labels[len(a):len(a) + len(p)])):
            marked[is_content][0] += len(part)
            marked[is_content][1] += sum(not x for x in part)
    assert marked[False][1] >= 0.75 * marked[False][0] and marked[True][1] <= 0.1 * marked[True][0]
