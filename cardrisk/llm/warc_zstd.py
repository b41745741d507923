"""Zstandard WARC archives: one frame per record, dictionary in a leading skippable frame.

Writing. Each task packs its rows into archives of about ``archive_bytes`` of
records and hands every archive over as one binary row; Spark's own file
writer stores one row per file, so archives are committed like any other Spark
output, on any file system, and a lost task is simply run again. The writer
wants a separator after each row: it is an empty skippable frame, which every
zstd reader passes over.

Rows whose payload of at least ``min_revisit`` bytes also occurs on a smaller
page id become revisit records that name the first one. The first page of each
repeated payload comes from an aggregate over digests; payloads that make up
1/HOT_SHARE of all rows or more, of which there can be at most HOT_SHARE, are
looked up from a broadcast, the others by a join on the digest, so no key
gathers an unbounded part of the rows in a task.

Reading. Files of any writer are read as bytes by Spark and walked frame by
frame: block headers give each frame's exact end, the frame, with or without a
content size, is decoded with the archive's dictionary, and the record's version
line, header fields, Content-Length, terminator and its block and payload digests, by
the algorithms that they name, are checked, as is the payload length where it is
given. All eight record types are returned. What fails is reported in ``problem``
for that record (or for the rest of the archive, where the next frame cannot be
found). A payload's digest is returned as hexadecimal SHA-256; a revisit's, which
has no payload to take it from, as its field has it unless that is SHA-256.

Defined results: a null html is an empty payload; a null url leaves out the
field; a null page id likewise, and reads back as null; among equal payloads
all rows with the smallest page id are responses (all rows, if all ids are
null); repeated rows give one record each; an empty table gives no archives
and an empty result; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import urllib.parse
from typing import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import pieces, sha256_hex

DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE_FIRST, SKIPPABLE_LAST = 0x184D2A50, 0x184D2A5F
FRAME_MAGIC = 0xFD2FB528
EMPTY_FRAME = struct.pack("<II", SKIPPABLE_FIRST, 0)

ARCHIVE_BYTES = 32 << 20
DICTIONARY_BYTES = 32 << 10
DICTIONARY_SAMPLES = 256      # records at the head of an archive that its dictionary is made from
HOT_SHARE = 1024
DATE = "2024-01-01T00:00:00Z"
# Fixed: the record types of WARC 1.1, the field it lets repeat, the fields by which a revisit refers.
RECORD_TYPES = ("warcinfo", "response", "resource", "request", "metadata", "revisit", "conversion", "continuation")
REPEATABLE = ("warc-concurrent-to",)
REFERENCES = ("warc-refers-to", "warc-refers-to-target-uri", "x-refers-to-page-id")
DIGESTS = ("md5", "sha1", "sha256", "sha384", "sha512")
MAX_RECORD = 1 << 30
RECORD_FIELDS = ("page_id", "record_type", "payload_bytes", "payload_digest", "refers_to", "payload", "url", "record_id", "date")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- records --------------------------------------------------------------


def record_id(page_id, digest: str) -> str:
    h = hashlib.sha256(f"{page_id}:{digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:32]}>"


def build_record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    fields = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", record_id(page_id, digest)),
              ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", urllib.parse.quote(url, safe="%/:=&?~#+!$,;'@()*[]")))
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    fields += [("X-Payload-Length", str(len(payload))), ("WARC-Payload-Digest", f"sha256:{digest}"),
               ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    if is_revisit:
        fields += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Truncated", "length"),
                   ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page-ID", str(refers_to))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    """Named fields of a record's header, names in lower case; lines that begin with a blank go on with the one before."""
    fields: dict[str, str] = {}
    last = None
    for line in head.split(b"\r\n")[1:]:
        if line[:1] in (b" ", b"\t") and last:
            fields[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        last = name.strip().lower().decode("ascii", "replace")
        if not colon or not last:
            raise ValueError(f"bad header line {line[:80]!r}")
        if last in fields and last not in REPEATABLE:
            raise ValueError(f"repeated header field {name[:80]!r}")
        text = value.strip().decode("utf-8", "replace")
        fields[last] = f"{fields[last]} {text}" if last in fields else text
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ValueError(f"header field {name} is missing")
    return fields


def check_digest(named: str | None, data: bytes, what: str) -> None:
    """Hold ``algorithm:value`` (hexadecimal or base 32) against the bytes; an unknown algorithm cannot be held against."""
    if not named:
        return
    algorithm, colon, value = named.partition(":")
    algorithm = algorithm.strip().lower().replace("-", "")
    if not colon or not value.strip():
        raise ValueError(f"the {what} digest names no algorithm")
    if algorithm in DIGESTS:
        raw = hashlib.new(algorithm, data, usedforsecurity=False).digest()
        if value.strip().lower() not in (raw.hex(), base64.b32encode(raw).decode().lower(), base64.b32encode(raw).decode().lower().rstrip("=")):
            raise ValueError(f"{what} digest differs from its field")


def number(fields: dict[str, str], name: str) -> int | None:
    if name not in fields:
        return None
    if not re.fullmatch(r"-?[0-9]{1,18}", fields[name]):
        raise ValueError(f"{name} is not a number")
    return int(fields[name])


def parse_record(raw: bytes) -> dict:
    """Fields and payload of one decoded record of any writer; raises ValueError on any inconsistency.

    The payload is what follows the HTTP header of an ``application/http`` block, else the block; of a revisit it
    is not there. Digests are checked by the algorithm they name. The fields that only this module writes
    (page id, payload length, referred page) are optional, and checked where they are.
    """
    end = raw.find(b"\r\n\r\n")
    if not raw.startswith((b"WARC/1.0\r\n", b"WARC/1.1\r\n")) or end < 0:
        raise ValueError("no WARC version line or header end")
    fields = header_fields(raw[:end])
    if not fields["content-length"].isdigit():
        raise ValueError("Content-Length is not a number")
    length = int(fields["content-length"])
    body = raw[end + 4:]
    if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length is {length}, the block has {len(body) - 4} bytes")
    kind, block = fields["warc-type"].lower(), body[:length]
    if kind not in RECORD_TYPES:
        raise ValueError(f"unexpected record type {kind}")
    payload = block
    if fields.get("content-type", "").lower().startswith("application/http"):
        _, gap, payload = block.partition(b"\r\n\r\n")
        if not gap and kind in ("response", "request"):
            raise ValueError("the block has no HTTP header end")
    whole = "warc-truncated" not in fields
    if whole:
        check_digest(fields.get("warc-block-digest"), block, "block")
    size, declared = number(fields, "x-payload-length"), fields.get("warc-payload-digest")
    if kind == "revisit":
        if payload or not any(f in fields for f in REFERENCES):
            raise ValueError("a revisit record has a payload or refers to nothing")
        if not declared:
            raise ValueError("a revisit record has no payload digest")
        algorithm, _, value = declared.partition(":")
        digest, payload = value.lower() if algorithm.lower() in ("sha256", "sha-256") else declared, None
    else:
        if whole:
            check_digest(declared, payload, "payload")
            if size is not None and size != len(payload):
                raise ValueError("payload length differs from its field")
        digest, size = sha256_hex(payload), len(payload)
    return {"page_id": number(fields, "x-page-id"), "record_type": kind, "payload_bytes": size, "payload_digest": digest,
            "refers_to": number(fields, "x-refers-to-page-id") if kind == "revisit" else None, "payload": payload,
            "url": fields.get("warc-target-uri"), "record_id": fields["warc-record-id"], "date": fields["warc-date"]}


# ---- archives -------------------------------------------------------------


def build_archive(records: list[bytes], level: int = 3) -> bytes:
    """Dictionary frame (where the samples allow one) and a frame per record."""
    out, dictionary = [], None
    try:
        dictionary = zstandard.train_dictionary(DICTIONARY_BYTES, [r[:DICTIONARY_BYTES] for r in records[:DICTIONARY_SAMPLES]])
        data = zstandard.ZstdCompressor(level=level).compress(dictionary.as_bytes())
        out.append(struct.pack("<II", DICTIONARY_MAGIC, len(data)) + data)
    except zstandard.ZstdError:
        pass        # too few or too short samples: an archive without a dictionary is as valid
    c = zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True,
                                 **({"dict_data": dictionary} if out else {}))
    return b"".join(out + [c.compress(r) for r in records])


def frame_end(data: memoryview, at: int) -> int:
    """Where the zstd frame at ``at`` ends, from its block headers."""
    head = bytes(data[at:at + 18])
    params = zstandard.get_frame_parameters(head)
    pos = at + zstandard.frame_header_size(head)
    while True:
        if pos + 3 > len(data):
            raise ValueError("a frame is cut short")
        block = int.from_bytes(data[pos:pos + 3], "little")
        pos += 3 + (1 if (block >> 1) & 3 == 1 else block >> 3)
        if block & 1:
            break
    pos += 4 * params.has_checksum
    if pos > len(data):
        raise ValueError("a frame is cut short")
    return pos


def decoded(decoder: zstandard.ZstdDecompressor, frame: memoryview, most: int = MAX_RECORD) -> bytes:
    """A frame's content, whether or not its header tells the size (streaming writers leave it out)."""
    out, size = [], 0
    for part in decoder.read_to_iter(bytes(frame)):
        size += len(part)
        if size > most:
            raise ValueError(f"a record of more than {most} bytes")
        out.append(part)
    return b"".join(out)


def read_archive(content: bytes) -> Iterator[dict]:
    """Records of one archive; ``problem`` is set for what does not hold."""
    data = memoryview(content)
    decoder, at, first = zstandard.ZstdDecompressor(), 0, True
    none = dict.fromkeys(RECORD_FIELDS)
    while at < len(data):
        try:
            if at + 8 > len(data):
                raise ValueError("bytes after the last frame")
            magic, size = struct.unpack_from("<II", data, at)
            if SKIPPABLE_FIRST <= magic <= SKIPPABLE_LAST:
                if at + 8 + size > len(data):
                    raise ValueError("a skippable frame is cut short")
                if first and magic == DICTIONARY_MAGIC:
                    raw = bytes(data[at + 8:at + 8 + size])
                    if int.from_bytes(raw[:4], "little") == FRAME_MAGIC:
                        raw = zstandard.ZstdDecompressor().decompress(raw)
                    decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(raw))
                at, first = at + 8 + size, False
                continue
            if magic != FRAME_MAGIC:
                raise ValueError(f"no frame at byte {at}")
            end = frame_end(data, at)
        except (ValueError, struct.error, zstandard.ZstdError) as e:
            yield none | {"problem": str(e)}
            return
        try:
            record = parse_record(decoded(decoder, data[at:end])) | {"problem": None}
        except (ValueError, zstandard.ZstdError) as e:
            record = none | {"problem": str(e)}
        at, first = end, False
        yield record


# ---- tables ---------------------------------------------------------------


def plan_records(spark: SparkSession, pages: DataFrame, min_revisit: int = 100) -> DataFrame:
    """page_id, url, html, digest and ``first_page`` (set on rows whose payload repeats)."""
    body = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select("page_id", "url", "html", F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("size"))
    groups = rows.filter(F.col("size") >= min_revisit).groupBy("digest").agg(
        F.min("page_id").alias("first_page"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    path = scratch_path(spark, "warc-groups")
    groups.write.parquet(path)
    groups = spark.read.parquet(path)
    hot_rows = max(2, -(-pages.count() // HOT_SHARE))
    # no more than HOT_SHARE groups can be this large, hence the broadcast
    hot = groups.filter(F.col("n") >= hot_rows).select("digest", F.col("first_page").alias("hot_first"))
    rows = rows.join(F.broadcast(hot), "digest", "left")
    own = F.concat(F.lit("-"), F.xxhash64("page_id", "url", "digest").cast("string"))   # matches nothing
    rows = rows.withColumn("key", F.when((F.col("size") >= min_revisit) & F.col("hot_first").isNull(), F.col("digest")).otherwise(own))
    cold = groups.filter(F.col("n") < hot_rows).select(F.col("digest").alias("key"), "first_page")
    return rows.join(cold, "key", "left").select(
        "page_id", "url", "html", "digest", F.coalesce("first_page", "hot_first").alias("first_page"))


def write_archives(spark: SparkSession, pages: DataFrame, path: str, min_revisit: int = 100,
                   archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write one record per row of ``pages`` into ``.warc.zst`` content under ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, size = [], 0
        for b in pieces(batches):
            for page_id, url, html, digest, first in zip(*(c.to_pylist() for c in b.columns)):
                revisit = first is not None and page_id != first
                records.append(build_record(page_id, url, (html or "").encode(), digest, first, revisit))
                size += len(records[-1])
                if size >= archive_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array([build_archive(records)], pa.binary())], ["archive"])
                    records, size = [], 0
        if records:
            yield pa.RecordBatch.from_arrays([pa.array([build_archive(records)], pa.binary())], ["archive"])

    archives = plan_records(spark, pages, min_revisit).mapInArrow(run, "archive binary")
    (archives.select(F.col("archive").cast("string").alias("value"))   # a cast keeps the bytes as they are
             .write.option("lineSep", EMPTY_FRAME.decode("ascii")).option("maxRecordsPerFile", 1).text(path))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records of the archives under ``path``: fields, payload and ``problem``."""

    names = [*RECORD_FIELDS, "problem"]
    types = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary(), *[pa.string()] * 4]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 1):        # one archive at a time
            for content in b.column(0):
                chunk = []
                for record in read_archive(content.as_py()):
                    chunk.append(record)
                    if len(chunk) == 256:
                        yield batch(chunk)
                        chunk = []
                if chunk:
                    yield batch(chunk)

    def batch(records: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in records], t) for n, t in zip(names, types)], names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, "page_id long, record_type string, payload_bytes long, payload_digest string, "
                                 "refers_to long, payload binary, url string, record_id string, date string, problem string")


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the archives to the shared folder, read them back, one row per record."""
    path = scratch_path(spark, "warc")
    write_archives(spark, pages, path)
    return read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", F.col("problem").isNull().alias("valid"))
