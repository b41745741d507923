import duckdb
import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline as CP
from cardrisk.llm import bpe, quality_crf, secret_scan
from cardrisk.sources.storage import materialize
from conftest import SF_SMALL
from test_lsh_forest import brute as all_pairs
from test_mixture import WORD, brute as water_filling

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's input and output, as tables."""
    docs, out = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), []
    for name, stage in CP.STAGES:
        new = materialize(spark, stage(spark, docs, SF_SMALL), "pipeline-test")
        out.append((docs, new))
        docs = new
    return out


def rows(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def test_stages_keep_the_columns_of_documents(stages):
    assert all(new.columns == COLUMNS for _, new in stages[:-1])


def test_quality_stage(spark, stages):
    docs, new = stages[0]
    chain = quality_crf.train_chain(spark, docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    want = [r for r in rows(docs) if quality_crf.judge(r[1] or "", chain)[-1]]
    assert rows(new) == want and 0 < len(want) < docs.count()
    clean = {i for (i,) in duckdb.sql(f"SELECT doc_id FROM '{SF_SMALL}/labels.parquet' WHERE quality = 1").fetchall()}
    long_enough = {r[0] for r in rows(docs) if not quality_crf.judge(r[1] or "", chain)[5]} & clean
    assert len(long_enough - {r[0] for r in want}) <= 0.02 * len(long_enough)


def test_near_duplicate_stage(stages):
    docs, new = stages[1]
    kept = {d for d, _, c in all_pairs([(r[0], r[1]) for r in rows(docs)], 5) if d == c}
    assert rows(new) == [r for r in rows(docs) if r[0] in kept]


def test_secret_stage(stages):
    docs, new = stages[2]
    encode = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(CP.vocabulary_path()),
                               special_tokens={}).encode_ordinary
    want = []
    for i, t, lang, source, _ in rows(docs):
        t = secret_scan.redact(t, secret_scan.all_spans(t, encode)[1])
        want.append((i, t, lang, source, len(t)))
    assert rows(new) == sorted(want, key=repr)
    assert all(not secret_scan.base_spans(r[1]) for r in rows(new))


def test_mixing_stage(stages):
    docs, new = stages[3]
    flat = [(r[0], "bulk" if r[3] == "src0" else "collected", r[2], r[3], len(WORD.findall(r[1]))) for r in rows(docs)]
    want = {d for d, _ in water_filling(flat, sum(r[4] for r in flat) * CP.MIX_SHARE, CP.MIX_WEIGHTS, 1)}
    assert rows(new) == [r for r in rows(docs) if r[0] in want] and len(want) < len(flat)


def test_encoding_stage(stages):
    docs, new = stages[4]
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(CP.vocabulary_path()), special_tokens={})
    want = {r[0]: library.encode_ordinary(r[1]) for r in rows(docs)}
    got = new.collect()
    assert {r.doc_id: r.ids for r in got} == want and all(r.decodes_back and r.n_tokens == len(r.ids) for r in got)


def test_run_equals_the_stages(spark, stages):
    got = CP.run(spark, SF_SMALL).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, stages[-1][1].select("doc_id", "n_tokens").collect()))


def test_empty_input(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in CP.STAGES:
        docs = stage(spark, docs, SF_SMALL)
    assert docs.count() == 0
