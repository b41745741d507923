import hashlib

import duckdb
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from cardrisk.llm import bpe
from conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = bpe.read_ranks(PATH)
CODEC = bpe.Codec(RANKS, public_tokenizers.PATTERN)
REFERENCE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
HARD = ["", " ", "\n\n  x", "a" * 3000, "naïve café 東京 🙂🙂", "don't I'll 12345 <|endoftext|>", "\x00\x01\t\r\n", "    x",
        "ab" * 700 + "!" * 99, "ſſK"]


def test_perfect_hash_is_minimal_and_rejects_strangers():
    keys = list(RANKS)
    h = bpe.PerfectHash(keys)
    assert sorted(h.slot_key.tolist()) == list(range(len(keys)))          # every slot taken once
    assert h.find(keys).tolist() == list(range(len(keys)))
    assert (h.find([b"no such entry at all", b"", keys[5] + b"\x00zz"]) == -1).all()
    assert bpe.PerfectHash([]).find([b"x"]).tolist() == [-1]


@pytest.mark.parametrize("text", HARD)
def test_same_ids_as_the_library(text):
    ids = CODEC.encode(text)
    assert ids == REFERENCE.encode_ordinary(text)
    assert CODEC.decode(ids) == text.encode()


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_round_trip_of_any_text(text):
    ids = CODEC.encode(text)
    assert ids == REFERENCE.encode_ordinary(text) and CODEC.decode(ids) == text.encode()


def test_memo_is_bounded():
    c = bpe.Codec(RANKS, public_tokenizers.PATTERN, memo_entries=3)
    for t in HARD:
        assert c.encode(t) == REFERENCE.encode_ordinary(t)


def test_nulls_repeats_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, None, "x"), (1, "ab ab", "y"), (1, "ab ab", "y"), (None, "", None)],
                                 "doc_id long, text string, n_tokens string")
    got = sorted((tuple(r) for r in bpe.tokenize_digests(spark, docs, PATH, public_tokenizers.PATTERN).collect()), key=repr)
    empty = hashlib.sha256(b"").hexdigest()
    assert len(got) == 4 and (1, 0, empty, empty) in got and (None, 0, empty, empty) in got
    assert sum(r[1] == 2 for r in got) == 2
    assert bpe.tokenize_digests(spark, docs.limit(0), PATH, public_tokenizers.PATTERN).count() == 0


def test_query_equals_the_library(spark):
    from cardrisk.llm.queries import QUERIES
    want = {}
    for i, t in duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall():
        ids = REFERENCE.encode_ordinary(t or "")
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in QUERIES["op5_two_tier_bpe"](spark, SF_SMALL).collect()}
    assert got == want
