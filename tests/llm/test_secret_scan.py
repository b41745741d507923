import hashlib
import random
import re
import string

import duckdb
import public_tokenizers
import tiktoken

from cardrisk.llm import bpe, secret_scan as S
from conftest import SF_SMALL

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
ENCODE = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(PATH),
                           special_tokens={}).encode_ordinary


def brute(text):
    """The fixed patterns, spelled out letter by letter and without flags."""
    either = lambda w: "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in w)
    names = "|".join([either(w) for w in ("password", "passwd", "secret", "token")] + [either("api") + "_?" + either("key")])
    out = []
    for m in re.finditer("(" + names + r""")["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m.group(2)) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(out)


def test_fixed_patterns():
    text = 'API_KEY = "abc123" password:short toKen=tok.en_1 ſecret=abcdefgh AKIA' + "Z" * 16 + " é" + "0a" * 12 + " " + "f" * 23
    assert S.base_spans(text) == brute(text)
    kinds = [k for _, k, _ in S.base_spans(text)]
    assert kinds.count(0) == 2 and kinds.count(1) == 1 and kinds.count(2) == 1   # 'short' has five characters


def test_random_strings_found_and_known_shapes_left():
    random_ = ["xK9vQ2mZr7TbN4wLpD8sYfGh", "Zm9vQmFyX3JhbmRvbVN0cmluZzEyMw==", "ghp_16C7e42F292c6912E7710c838347Ae178B4a"]
    known = ["d41d8cd98f00b204e9800998ecf8427e".upper(), "123e4567-e89b-12d3-a456-426614174000", "my_long_function_name_for_parsing",
             "internationalization", "SomeVeryLongClassNameFactory", "path/to/some/deep/folder/name"]
    for s in random_:
        base, every = S.all_spans(f"see {s} there", ENCODE)
        assert [k for _, k, _ in every] == [3] and not base, s
    for s in known:
        assert not S.is_random(s, ENCODE), s


def test_added_spans_keep_base_spans():
    text = "password=hunter22 and xK9vQ2mZr7TbN4wLpD8sYfGh " + "ab" * 20
    base, every = S.all_spans(text, ENCODE)
    assert set(base) <= set(every) and len(every) == len(base) + 1
    assert S.joined(every).startswith("assign:0:17,token:22:46,hex:")
    assert S.redact(text, every) == "[secret] and [secret] [secret]"


def test_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (2, ""), (None, "token=abcdefg")], "doc_id long, text string")
    got = S.scan_secrets(spark, docs, PATH, public_tokenizers.PATTERN).collect()
    none = hashlib.sha256(b"").hexdigest()
    assert sum(r.base_sha256 == none and r.spans == "" for r in got) == 3
    assert [r.n_assign for r in got if r.doc_id is None] == [1]
    out = S.redact_secrets(spark, docs.selectExpr("text", "doc_id", "'x' AS spans", "1 AS n_chars"), PATH, public_tokenizers.PATTERN)
    assert out.columns == ["text", "doc_id", "spans", "n_chars"]
    assert {(r.doc_id, r.text, r.n_chars) for r in out.collect()} == {(1, None, None), (2, "", 0), (None, "[secret]", 8)}


def test_query_equals_brute_force(spark):
    from cardrisk.llm.queries import QUERIES
    got = {r.doc_id: r for r in QUERIES["op4_token_efficiency_secrets"](spark, SF_SMALL).collect()}
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, t in rows:
        b = brute(t or "")
        assert [got[i].n_assign, got[i].n_access, got[i].n_hex] == [sum(k == j for _, k, _ in b) for j in range(3)]
        assert got[i].base_sha256 == hashlib.sha256(S.joined(b).encode()).hexdigest()
        assert set(S.joined(b).split(",")) <= set(got[i].spans.split(",")) or not b


def test_random_strings_behind_paths_and_names():
    """Words joined to a random string do not hide it; its span leaves them out."""
    rnd = random.Random(7)
    letters = string.ascii_letters + string.digits
    for prefix in ("api/v1/projects/production/settings/", "my_production_database_connection_string_", "some-long-service-name-"):
        for alphabet, least in ((letters, 97), (letters + "+/", 90), (letters + "-_", 88)):
            found = 0
            for i in range(100):
                secret = "".join(rnd.choice(alphabet) for _ in range((24, 32, 40)[i % 3]))
                text = f"see {prefix}{secret} there"
                spans = [(a, b) for a, k, b in S.all_spans(text, ENCODE)[1] if k == 3]
                found += bool(spans)
                if alphabet == letters and len(prefix) > 30 and spans:
                    assert secret not in S.redact(text, [(a, 3, b) for a, b in spans])
            assert found >= least, (prefix, alphabet, found)
    name = "my_production_database_connection_string_for_the_customer_service_"
    text = name + "xK9vQ2mZr7TbN4wLpD8sYfGh"
    assert S.all_spans(text, ENCODE)[1] == [(len(name), 3, len(text))]
    for s in ("api/v2/users/123e4567-e89b-12d3-a456-426614174000/profile", "usr/lib/x86_64-linux-gnu/some/library",
              "my_long_function_name_for_parsing/and/a_second_long_name", "backup-of-production-2024-01-02-final"):
        assert S.all_spans(s, ENCODE)[1] == [], s


def test_random_strings_of_one_class_and_rests_beside_fixed_patterns_are_found():
    rnd = random.Random(8)
    encode = ENCODE
    for letters, least in ((string.ascii_lowercase, 0.5), (string.ascii_uppercase, 0.8)):
        texts = ["see " + "".join(rnd.choice(letters) for _ in range(32)) + " there" for _ in range(200)]
        assert sum(bool(S.all_spans(t, encode)[1]) for t in texts) >= least * len(texts)
    key = "AKIA" + "ABCD1234EFGH5678"
    found = 0
    for _ in range(50):
        rest = "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(40))
        base, spans = S.all_spans(f"x {key}-{rest} y", encode)
        assert (2, 1, 22) in base and (2, 1, 22) in spans
        found += any(a >= 22 and b >= 60 for a, k, b in spans if k == 3)
    assert found >= 48
