import hashlib
import struct

import duckdb
import pytest
import zstandard

from cardrisk.llm import warc_zstd as W
from conftest import SF_SMALL


def records(n=400):
    out = []
    for i in range(n):
        p = f"<html><title>page {i}</title><p>{'some shared text of every page ' * 5}{i * i}</p></html>".encode()
        out.append(W.build_record(i, f"http://example.com/{i}", p, hashlib.sha256(p).hexdigest(), None, False))
    return out


def test_dictionary_leads_and_every_record_is_a_frame():
    recs = records()
    data = W.build_archive(recs)
    magic, size = struct.unpack_from("<II", data)
    assert magic == W.DICTIONARY_MAGIC
    raw = zstandard.ZstdDecompressor().decompress(data[8:8 + size])
    plain = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
    at, seen = 8 + size, []
    while at < len(data):
        end = W.frame_end(memoryview(data), at)
        seen.append(plain.decompress(data[at:end]))
        at = end
    assert seen == recs
    got = list(W.read_archive(data + W.EMPTY_FRAME))
    assert [r["page_id"] for r in got] == list(range(400)) and all(r["problem"] is None for r in got)
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["payload_digest"] for r in got)


def test_small_archives_have_no_dictionary():
    data = W.build_archive(records(2))
    assert int.from_bytes(data[:4], "little") == W.FRAME_MAGIC
    assert [r["problem"] for r in W.read_archive(data)] == [None, None]


@pytest.mark.parametrize("spoil", [
    lambda r: r.replace(b"WARC/1.1", b"WARC/9.9", 1), lambda r: r.replace(b"Content-Length: ", b"Content-Length: 9", 2),
    lambda r: r[:-2], lambda r: r.replace(b"page 1", b"page 7"), lambda r: r.replace(b"WARC-Date: ", b"WARC-Date "),
    lambda r: r.replace(b"X-Payload-Length: ", b"X-Payload-Length: 1"), lambda r: r.replace(b"WARC-Type: response", b"WARC-Type: other")])
def test_inconsistent_records_are_reported(spoil):
    recs = records(3)
    got = list(W.read_archive(W.build_archive([recs[0], spoil(recs[1]), recs[2]])))
    assert [r["problem"] is None for r in got] == [True, False, True]


def test_damaged_frames_are_reported():
    data = W.build_archive(records(3))
    assert list(W.read_archive(data[:-5]))[-1]["problem"]
    assert list(W.read_archive(data + b"rest of something"))[-1]["problem"]
    bad = bytearray(data)
    bad[len(data) - 6] ^= 255          # inside the last frame
    assert list(W.read_archive(bytes(bad)))[-1]["problem"]
    assert list(W.read_archive(b"")) == []


def test_nulls_ties_repeats_and_short_payloads(spark):
    long_ = "x" * 100
    rows = [(5, "u", long_), (3, None, long_), (3, "u\r\nX-Evil: 1", long_), (9, "ü", long_), (None, "n", long_),
            (1, "s", "y" * 99), (2, "s", "y" * 99), (7, "e", None), (8, "e", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("html", "page_id", "url", "'z' AS digest")
    got = sorted(((r.page_id, r.record_type, r.refers_to, r.payload_bytes, r.valid) for r in
                  W.archive_round_trip(spark, pages).collect()), key=repr)
    want = [(5, "revisit", 3, 100, True), (3, "response", None, 100, True), (3, "response", None, 100, True),
            (9, "revisit", 3, 100, True), (None, "revisit", 3, 100, True), (1, "response", None, 99, True),
            (2, "response", None, 99, True), (7, "response", None, 0, True), (8, "response", None, 0, True)]
    assert got == sorted(want, key=repr)
    assert W.archive_round_trip(spark, pages.limit(0)).count() == 0


def test_archives_are_cut_by_size_and_read_whole(spark, tmp_path):
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    W.write_archives(spark, pages, str(tmp_path / "a"), archive_bytes=20_000)
    files = list((tmp_path / "a").glob("part-*"))
    assert len(files) > 3
    got = {r.page_id: (r.url, r.payload) for r in W.read_archives(spark, str(tmp_path / "a")).collect()}
    want = {i: h.encode() for i, h in duckdb.sql(f"SELECT page_id, html FROM '{SF_SMALL}/pages.parquet'").fetchall()}
    assert {k: bytes(v[1]) for k, v in got.items()} == want


def foreign(kind, block, *fields, version=b"WARC/1.0"):
    head = [b"WARC-Type: " + kind, b"WARC-Record-ID: <urn:uuid:1>", b"WARC-Date: 2020-02-02T00:00:00Z", *fields, b"Content-Length: %d" % len(block)]
    return version + b"\r\n" + b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"


def streamed(records):
    """Frames as streaming writers make them: without a content size, and here without checksums."""
    out = b""
    for r in records:
        c = zstandard.ZstdCompressor(write_content_size=False).compressobj()
        out += c.compress(r) + c.flush()
    return out


def test_archives_of_other_writers_are_read(spark, tmp_path):
    import base64
    page = b"<html>hello</html>"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n" + page
    kind = b"Content-Type: application/http; msgtype=response"
    sha1 = base64.b32encode(hashlib.sha1(page).digest())
    block1 = base64.b32encode(hashlib.sha1(http).digest())
    records_ = [
        foreign(b"warcinfo", b"software: other\r\nformat: WARC", b"Content-Type: application/warc-fields"),
        foreign(b"request", b"GET / HTTP/1.1\r\nHost: x\r\n\r\n", b"Content-Type: application/http; msgtype=request"),
        foreign(b"response", http, kind, b"WARC-Payload-Digest: sha1:" + sha1, b"WARC-Block-Digest: sha1:" + block1, b"WARC-Target-URI: http://x/",
                b"WARC-Concurrent-To: <urn:a>", b"WARC-Concurrent-To: <urn:b>", b"X-Long: one", b" two"),
        foreign(b"response", http, kind, b"WARC-Payload-Digest: md5:" + hashlib.md5(page).hexdigest().encode(), version=b"WARC/1.1"),
        foreign(b"response", http, kind, b"WARC-Payload-Digest: blake9:xyz"),
        foreign(b"response", http, kind),
        foreign(b"resource", page, b"Content-Type: text/html"),
        foreign(b"metadata", b"fetchTimeMs: 12", b"Content-Type: application/warc-fields"),
        foreign(b"conversion", b"hello", b"Content-Type: text/plain"),
        foreign(b"revisit", http[:-len(page)], kind, b"WARC-Payload-Digest: sha1:" + sha1, b"WARC-Refers-To-Target-URI: http://x/"),
        foreign(b"response", http[:-5], kind, b"WARC-Payload-Digest: sha1:" + sha1, b"WARC-Truncated: length"),
        # and what does not hold
        foreign(b"response", http, kind, b"WARC-Payload-Digest: sha1:" + sha1[::-1]),
        foreign(b"response", http, kind, b"WARC-Block-Digest: sha256:00"),
        foreign(b"response", page, kind),
        foreign(b"revisit", http, kind, b"WARC-Payload-Digest: sha1:" + sha1, b"WARC-Refers-To: <urn:a>"),
        foreign(b"revisit", b"", kind, b"WARC-Payload-Digest: sha1:" + sha1),
        foreign(b"response", http, kind, b"WARC-Target-URI: a", b"WARC-Target-URI: b"),
    ]
    for data in (streamed(records_), W.build_archive(records_)):
        got = list(W.read_archive(data))
        assert [r["problem"] is None for r in got] == [True] * 11 + [False] * 6
        assert [r["record_type"] for r in got[:11]] == ["warcinfo", "request"] + ["response"] * 4 + ["resource", "metadata", "conversion", "revisit", "response"]
        assert {r["payload_digest"] for r in got[2:7]} == {hashlib.sha256(page).hexdigest()} and {r["payload"] for r in got[2:7]} == {page}
        assert got[9]["payload"] is None and got[9]["payload_digest"] == "sha1:" + sha1.decode() and got[9]["payload_bytes"] is None
        assert got[0]["page_id"] is None and got[2]["url"] == "http://x/" and got[1]["payload"] == b""
    (tmp_path / "a.warc.zst").write_bytes(streamed(records_))
    rows = W.read_archives(spark, str(tmp_path)).collect()
    assert len(rows) == 17 and sum(r.problem is None for r in rows) == 11


def test_a_record_beyond_the_bound_is_reported():
    import zstandard as z
    frame = streamed([b"x" * 3_000_000])
    with pytest.raises(ValueError):
        W.decoded(z.ZstdDecompressor(), memoryview(frame), 1_000_000)
    assert len(W.decoded(z.ZstdDecompressor(), memoryview(frame), 3_000_000)) == 3_000_000
