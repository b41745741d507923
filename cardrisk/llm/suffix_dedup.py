"""Removal of repeated byte strings by suffix sorting with a difference cover.

A byte goes if a string of ``WINDOW`` bytes that covers it also starts earlier
(a smaller id, or earlier in the same text); texts are bytes in UTF-8, strings
are judged on the input, and none crosses from one text into another.

Sorting a corpus's suffixes outright would write some hundred bytes per byte of
text, so the work is dealt out in four steps, each exact:

1. Texts that resemble each other (equal smallest two-word shingle) are brought
   together by an adaptive rebalance and packed into chunks of bounded size.
2. In a chunk, anchors (see ``anchors``) that occur twice mark where strings
   can repeat. There the difference-cover construction sorts the suffixes up to
   ``WINDOW`` bytes: triples at the sampled positions (those not divisible by
   three) are sorted and named, the construction recurses on triples of names
   until a name stands for 98 bytes, the remaining suffixes are merged in by
   their first bytes and the name that follows, and adjacent equal prefixes
   tell which strings repeat an earlier one.
3. Anchors of all chunks are counted across chunks. Strings that are the first
   of their chunk and whose anchor also occurs in another chunk are the only
   ones that can still repeat elsewhere; their 96-bit names are dealt out by
   name, and the earliest place of each is found.
4. Verdicts return to their texts.

A repeated passage, however common, reaches step 3 at most once per chunk, and
names are dealt evenly, so no task holds more than its share of a hot text.

Defined results: a null text is empty; a null id counts as larger than every
id; rows with equal ids count as following each other in a fixed order, so of
rows that repeat id and text one keeps its bytes; texts shorter than
``WINDOW`` lose nothing; an empty table gives an empty result; further columns
are ignored. A single text is handled whole, so a task's memory is bounded by
the chunk size or the longest text, whichever is larger.
"""

from __future__ import annotations

from typing import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .common import arrow_rows, discard, free_shuffles, mix64, pieces, sha256_hex, texts_of
from .shingles import word_hashes

WINDOW = 100
ANCHOR = 48               # bytes of an anchor; every window contains one
CHUNK_BYTES = 3 << 20
CHUNK_TEXTS = 20_000      # so that a chunk of empty texts is bounded too
BUCKET_BYTES = 4 << 20    # of anchors in a task, about (raise it with CHUNK_BYTES: a chunk writes a row per bucket)
ANCHOR_SHARE = 0.25       # bytes of packed anchors per byte of text, at most about
LAST = np.int64(2 ** 63 - 1)

PLACE = np.uint64(2 ** 24 - 1)

# ---- rolling names --------------------------------------------------------

_TABLE = np.random.default_rng(31).integers(1, 1 << 63, (2, 256), dtype=np.uint64)


def _joined(a: np.ndarray, b: np.ndarray, shift: int, odd: int) -> np.ndarray:
    n = max(0, min(len(a), len(b) - shift))
    with np.errstate(over="ignore"):
        x = a[:n] * np.uint64(odd) + b[shift:shift + n]
        return x ^ (x >> np.uint64(29))


def rolling_names(data: np.ndarray, length: int, seed: int = 0) -> np.ndarray:
    """A 64-bit name of every ``length``-byte string of ``data``, by doubling."""
    out, covered = None, 0
    power, span = _TABLE[seed][data], 1
    step = 0
    while True:
        if length & span:
            out = power if out is None else _joined(out, power, covered, 0xD6E8FEB86659FD93 + 2 * step)
            covered += span
        if covered == length:
            return out
        power = _joined(power, power, span, 0x9E3779B97F4A7C15 + 4 * step + 2 * seed)
        span *= 2
        step += 1


STRIP = 1 << 15           # window starts worked on at a time, so that intermediates stay in a core's cache


def anchors(data: np.ndarray) -> np.ndarray:
    """For every window start the smallest name of an ANCHOR-byte string in the
    window (upper 40 bits) and where it stands, modulo 2^24 (lower 24).

    Equal windows have equal names; of equal names in a window the first counts,
    so the anchor also stands at the same place in equal windows. Neighbouring
    windows mostly share an anchor.
    """
    width = WINDOW - ANCHOR + 1
    out = np.empty(max(0, len(data) - WINDOW + 1), np.uint64)
    for begin in range(0, len(out), STRIP):
        n = min(STRIP, len(out) - begin)
        names = mix64(rolling_names(data[begin:begin + n + WINDOW - 1], ANCHOR))
        names = (names & ~PLACE) | (np.arange(begin, begin + len(names), dtype=np.uint64) & PLACE)
        low, span = names, 1
        while 2 * span <= width:
            low = np.minimum(low[:-span], low[span:])
            span *= 2
        np.minimum(low[:n], low[width - span:width - span + n], out=out[begin:begin + n])
    return out


# ---- difference cover -----------------------------------------------------


def ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks from 1 of integer keys."""
    order = np.argsort(keys)
    s = keys[order]
    new = np.empty(len(s), np.int64)
    if len(s):
        new[0] = 1
        new[1:] = s[1:] != s[:-1]
    out = np.empty(len(s), np.int64)
    out[order] = np.cumsum(new)
    return out


def name_triples(names: np.ndarray, at: np.ndarray, offsets: tuple[int, int]) -> np.ndarray:
    """Names of the triples (p, p + offsets[0], p + offsets[1]) for the sampled
    positions ``at``; offsets are multiples of three, so all members are sampled.
    ``names`` is indexed by position and 0 where nothing is."""
    a, b, c = names[at], names[at + offsets[0]], names[at + offsets[1]]
    if len(at) and int(a.max()) < 1 << 21:
        triple = (a << 42) | (b << 21) | c
    else:
        triple = (ranks((a << 32) | b) << 32) | c
    out = np.zeros(len(names), np.int64)
    out[at] = ranks(triple)
    return out


def sampled_names(text: np.ndarray) -> np.ndarray:
    """Names (order-preserving) of the 98-byte strings at the positions not divisible by three."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(64, np.uint8)])
    at = np.arange(n)
    at = at[at % 3 != 0]
    words = np.zeros(len(at), np.uint64)
    for k in range(8):
        words = (words << np.uint64(8)) | padded[at + k]
    names = np.zeros(n + 64, np.int64)
    names[at] = ranks(words)                       # 8 bytes
    names = name_triples(names, at, (6, 12))       # 12 + 8 = 20 bytes
    names = name_triples(names, at, (18, 36))      # 36 + 20 = 56
    return name_triples(names, at, (21, 42))[:n]   # 42 + 56 = 98


def repeats_earlier(text: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Of the windows at ``starts`` (ascending), those whose bytes equal a window at an earlier one.

    Two starts have a shift of 0, 1 or 2 in common that makes both sampled; for
    each shift windows are sorted by the bytes before the sampled position, its
    98-byte name and the bytes behind, and neighbours compared.
    """
    names = sampled_names(text)
    out = np.zeros(len(starts), bool)
    bits = max(1, int(len(starts)).bit_length())
    for shift in range(3):
        mine = np.flatnonzero((starts + shift) % 3 != 0)
        i = starts[mine]
        rest = [i + j for j in range(shift)] + [i + shift + 98 + j for j in range(2 - shift)]
        key = (names[i + shift] << 16) | (text[rest[0]].astype(np.int64) << 8) | text[rest[1]]
        if len(key) and int(key.max()).bit_length() + bits < 63:
            # key and place in one number: sorted as a whole, equal keys by place
            placed = np.sort((key << bits) | mine)
            out[placed[1:][(placed[1:] >> bits) == (placed[:-1] >> bits)] & ((1 << bits) - 1)] = True
        else:
            order = np.argsort(key, kind="stable")
            k = key[order]
            out[mine[order[1:][k[1:] == k[:-1]]]] = True
    return out


def gathered(valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, index of each window start among them) of the bytes that the windows at ``valid`` cover."""
    cut = np.flatnonzero(np.diff(valid) > WINDOW) + 1
    begin = valid[np.concatenate([[0], cut])]
    end = valid[np.concatenate([cut - 1, [len(valid) - 1]])] + WINDOW
    size = end - begin
    shift = begin - np.concatenate([[0], np.cumsum(size)[:-1]])
    per_run = np.diff(np.concatenate([[0], cut, [len(valid)]]))
    return np.arange(int(size.sum())) + np.repeat(shift, size), valid - np.repeat(shift, per_run)


def runs_of(flags: np.ndarray) -> np.ndarray:
    """(begin, end) rows of the maximal runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
    return edge.reshape(-1, 2).astype(np.int32)


def flags_of(runs: np.ndarray, n: int) -> np.ndarray:
    mark = np.zeros(n + 1, np.int8)
    mark[runs[:, 0]] += 1
    mark[runs[:, 1]] -= 1
    return np.cumsum(mark[:n], dtype=np.int8).view(bool)


def chunk_starts(lengths: np.ndarray) -> np.ndarray:
    """Flags of the window starts that stay inside their text, texts standing one after another."""
    n = int(lengths.sum())
    kind = np.int32 if n < 1 << 31 else np.int64
    left = np.repeat(np.cumsum(lengths).astype(kind), lengths)
    left -= np.arange(n, dtype=kind)
    return left >= WINDOW


def local_repeats(data: np.ndarray, lengths: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Flags of the window starts that repeat an earlier window of the chunk."""
    out = np.zeros(len(data), bool)
    valid = np.flatnonzero(chunk_starts(lengths))
    if len(valid) < 2:
        return out
    # a window can only repeat where its anchor's name stands in two places
    a = anchor[valid]
    run = np.empty(len(a), bool)
    run[0] = True
    run[1:] = (a[1:] != a[:-1]) | (valid[1:] != valid[:-1] + 1)
    index = np.flatnonzero(run)
    again = np.zeros(len(index), bool)
    if len(index) < 1 << 24:
        # name and run in one number (the name has 40 bits)
        placed = np.sort((a[index] & ~PLACE) | np.arange(len(index), dtype=np.uint64))
        same = (placed[1:] >> np.uint64(24)) == (placed[:-1] >> np.uint64(24))
        placed = (placed & PLACE).astype(np.int64)
        again[placed[1:][same]] = True
        again[placed[:-1][same]] = True
    else:
        again[:] = True
    wraps = (valid & int(PLACE)) >= int(PLACE) - WINDOW       # where places start anew, the first may not count
    valid = valid[np.repeat(again, np.diff(np.append(index, len(a)))) | wraps]
    if len(valid) < 2:
        return out
    positions, starts = gathered(valid)
    out[valid[repeats_earlier(data[positions], starts)]] = True
    return out


# ---- results of one text --------------------------------------------------


def result_of(raw: bytes, starts: np.ndarray) -> tuple[int, int, int, str]:
    """n_bytes, n_removed, n_spans, kept_sha256, given the starts of windows that repeat an earlier one."""
    n = len(raw)
    if not len(starts):
        return n, 0, 0, sha256_hex(raw)
    mark = np.zeros(n + 1, np.int32)
    mark[starts] += 1            # starts are distinct
    mark[starts + WINDOW] -= 1
    gone = np.cumsum(mark[:n]) > 0
    return n, int(gone.sum()), len(runs_of(gone)), sha256_hex(np.frombuffer(raw, np.uint8)[~gone].tobytes())


# ---- steps ----------------------------------------------------------------


def _pack(z: zstandard.ZstdCompressor, ids: list, raws: list[bytes]) -> dict:
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
    return {"ids": [ids[i] for i in order], "lengths": [len(raws[i]) for i in order],
            "body": z.compress(b"".join(raws[i] for i in order))}


CHUNK = "ids array<long>, lengths array<int>, body binary"
CHUNK_ARROW = pa.schema([("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("body", pa.binary())])


def make_chunks(spark: SparkSession, docs: DataFrame, chunk_bytes: int) -> DataFrame:
    """Texts that resemble each other, packed into rows of about ``chunk_bytes`` (written, with stable numbers)."""

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=1)
        for b in pieces(batches):
            keys, bodies = [], []
            for t in texts_of(b.column(1)):
                w = word_hashes(t)
                with np.errstate(over="ignore"):
                    s = mix64(mix64(w[:-1]) + w[1:]) if len(w) > 1 else w
                keys.append(int(s.min().astype(np.int64)) if len(s) else 0)
                bodies.append(z.compress(t.encode("utf-8", "surrogatepass")))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.int64()), pa.array(bodies, pa.binary())],
                                             ["doc_id", "key", "body"])

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        un, z = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
        ids, raws, size = [], [], 0
        for b in pieces(batches):
            for i, body in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                raw = un.decompress(body)
                if ids and (size + len(raw) > chunk_bytes or len(ids) == CHUNK_TEXTS):
                    yield pa.RecordBatch.from_pylist([_pack(z, ids, raws)], schema=CHUNK_ARROW)
                    ids, raws, size = [], [], 0
                ids.append(i)
                raws.append(raw)
                size += len(raw)
        if ids:
            yield pa.RecordBatch.from_pylist([_pack(z, ids, raws)], schema=CHUNK_ARROW)

    rows = docs.select("doc_id", "text").mapInArrow(keyed, "doc_id long, key long, body binary")
    rows = rows.hint("rebalance", "key").sortWithinPartitions("key", F.col("doc_id"))
    chunks = rows.mapInArrow(packed, CHUNK).withColumn("chunk", F.monotonically_increasing_id())
    return materialize(spark, chunks, "text-chunks")


def _unpacked(body: bytes, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint8), np.array(lengths, np.int64)


def _dealt(names: np.ndarray, n_buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, indices of the names that belong to it)."""
    bucket = (mix64(names) % np.uint64(n_buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    ends = np.cumsum(np.bincount(bucket, minlength=n_buckets))
    for k in range(n_buckets):
        part = order[ends[k - 1] if k else 0:ends[k]]
        if len(part):
            yield k, part


def local_pass(chunks: DataFrame, n_buckets: int) -> DataFrame:
    """Per chunk the runs of repeating starts (bucket -1) and, by bucket, its distinct anchors (40 bits each)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for chunk, lengths, body in zip(*(c.to_pylist() for c in b.columns)):
                data, sizes = _unpacked(body, lengths)
                anchor = anchors(data) if len(data) >= WINDOW else np.zeros(0, np.uint64)
                repeats = local_repeats(data, sizes, anchor)
                rows = [(chunk, -1, runs_of(repeats).tobytes())]
                first = np.flatnonzero(chunk_starts(sizes) & ~repeats)
                names = anchor[first] >> np.uint64(24)
                names = np.unique(names[np.flatnonzero(np.diff(names, prepend=~names[:1]))])
                for k, part in _dealt(names, n_buckets):
                    rows.append((chunk, k, names[part].view(np.uint8).reshape(-1, 8)[:, :5].tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()),
                                                  pa.array([r[2] for r in rows], pa.binary())], ["chunk", "bucket", "payload"])

    return chunks.select("chunk", "lengths", "body").mapInArrow(run, "chunk long, bucket int, payload binary")


def _by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[int], list[bytes]]]:
    """Rows (bucket, chunk, payload) sorted by bucket, one bucket at a time."""
    now, chunks, payloads = None, [], []
    for b in batches:
        for bucket, chunk, payload in zip(*(c.to_pylist() for c in b.columns)):
            if bucket != now and chunks:
                yield now, chunks, payloads
                chunks, payloads = [], []
            now = bucket
            chunks.append(chunk)
            payloads.append(payload)
    if chunks:
        yield now, chunks, payloads


def shared_anchors(anchored: DataFrame, n_buckets: int) -> DataFrame:
    """Per chunk and bucket the anchors that also occur in another chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, chunks, payloads in _by_bucket(batches):
            parts = [np.frombuffer(p, np.uint8).reshape(-1, 5) for p in payloads]
            name = np.zeros((sum(map(len, parts)), 8), np.uint8)
            name[:, :5] = np.concatenate(parts)
            name = name.view(np.uint64).ravel()
            order = np.argsort(name, kind="stable")
            s = name[order]
            same = np.zeros(len(s), bool)
            same[1:] = s[1:] == s[:-1]
            same[:-1] |= same[1:]
            hit = np.zeros(len(s), bool)
            hit[order] = same
            at, out = 0, []
            for chunk, part in zip(chunks, parts):
                found = part[hit[at:at + len(part)]]
                at += len(part)
                if len(found):
                    out.append((chunk, found.tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.binary())],
                                             ["chunk", "payload"])

    rows = anchored.select("bucket", "chunk", "payload").repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "chunk long, payload binary")


OPEN = "kind string, chunk long, doc int, doc_id long, bucket int, payload binary, runs binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
OPEN_ARROW = pa.schema([("kind", pa.string()), ("chunk", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64()), ("bucket", pa.int32()),
                        ("payload", pa.binary()), ("runs", pa.binary()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                        ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
NAMED = np.dtype([("high", "<u8"), ("low", "<u4"), ("doc", "<i4"), ("start", "<i4")])


def pack_names(z: zstandard.ZstdCompressor, table: np.ndarray, docs: np.ndarray, mine: np.ndarray) -> bytes:
    """Names as they are, texts and places column by column and compressed (they ascend)."""
    steps = np.diff(mine["start"], prepend=mine["start"][:1] * 0).astype(np.int32)
    side = z.compress(table.tobytes() + docs.astype(np.int32).tobytes() + np.bincount(mine["doc"], minlength=len(docs)).astype(np.int32).tobytes()
                      + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 4).T).tobytes())
    return (np.array([len(docs), len(mine), len(side)], np.int32).tobytes() + side
            + np.ascontiguousarray(mine["high"]).tobytes() + np.ascontiguousarray(mine["low"]).tobytes())


def unpack_names(un: zstandard.ZstdDecompressor, p: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(table of ids, numbers of the texts, names) of a packed payload."""
    n_docs, n, size = np.frombuffer(p, np.int32, 3)
    side = un.decompress(p[12:12 + size])
    table, docs = np.frombuffer(side, np.int64, n_docs), np.frombuffer(side, np.int32, n_docs, 8 * n_docs)
    counts = np.frombuffer(side, np.int32, n_docs, 12 * n_docs)
    steps = np.frombuffer(side, np.uint8, 4 * n, 16 * n_docs).reshape(4, n).T
    out = np.empty(n, NAMED)
    out["doc"] = np.repeat(np.arange(n_docs), counts)
    out["start"] = np.cumsum(np.ascontiguousarray(steps).view(np.int32).ravel())
    out["high"] = np.frombuffer(p, np.uint64, n, 12 + size)
    out["low"] = np.frombuffer(p, np.uint32, n, 12 + size + 8 * n)
    return table, docs, out


def open_windows(chunks: DataFrame, n_buckets: int) -> DataFrame:
    """Results of texts that no other chunk can change (kind done); the others'
    bodies and runs (kind text), and the names of their open windows by bucket (kind name)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        z = zstandard.ZstdCompressor(level=3)
        for b in batches:
            for chunk, ids, lengths, body, runs, shared in zip(*(c.to_pylist() for c in b.columns)):
                data, sizes = _unpacked(body, lengths)
                begin = np.concatenate([[0], np.cumsum(sizes)])
                repeats = flags_of(np.frombuffer(runs, np.int32).reshape(-1, 2), len(data))
                shared = np.frombuffer(b"".join(shared or []), np.uint8).reshape(-1, 5)
                wide = np.zeros((len(shared), 8), np.uint8)
                wide[:, :5] = shared
                shared = wide.view(np.uint64).ravel()
                starts = np.zeros(0, np.int64)
                if len(shared):
                    first = np.flatnonzero(chunk_starts(sizes) & ~repeats)
                    anchor = anchors(data)[first] >> np.uint64(24)
                    head = np.flatnonzero(np.diff(anchor, prepend=~anchor[:1]))
                    starts = first[np.repeat(np.isin(anchor[head], shared), np.diff(np.append(head, len(anchor))))]
                rows = []
                doc_of = np.searchsorted(begin, starts, side="right") - 1
                if len(starts):
                    positions, at = gathered(starts)
                    text = data[positions]
                    named = np.zeros(len(starts), NAMED)
                    high = mix64(rolling_names(text, WINDOW, 0)[at])
                    named["high"], named["doc"], named["start"] = high, doc_of, starts - begin[doc_of]
                    named["low"] = mix64(rolling_names(text, WINDOW, 1)[at]) & np.uint64(2 ** 32 - 1)
                    for k, part in _dealt(high, n_buckets):
                        mine = named[part]
                        docs, where = np.unique(mine["doc"], return_inverse=True)
                        mine["doc"] = where
                        table = np.array([LAST if ids[d] is None else ids[d] for d in docs], np.int64)
                        rows.append({"kind": "name", "chunk": chunk, "bucket": k,
                                     "payload": pack_names(z, table, docs, mine)})
                pending = set(doc_of.tolist())
                for d, (i, size) in enumerate(zip(ids, lengths)):
                    raw = data[begin[d]:begin[d + 1]].tobytes()
                    mine = repeats[begin[d]:begin[d + 1]]
                    if d in pending:
                        rows.append({"kind": "text", "chunk": chunk, "doc": d, "doc_id": i, "payload": z.compress(raw),
                                     "runs": runs_of(mine).tobytes()})
                    else:
                        n, gone, spans, digest = result_of(raw, np.flatnonzero(mine))
                        rows.append({"kind": "done", "doc_id": i, "n_bytes": n, "n_removed": gone, "n_spans": spans, "kept_sha256": digest})
                for at in range(0, len(rows), 512):
                    yield pa.RecordBatch.from_pylist(rows[at:at + 512], schema=OPEN_ARROW)

    return chunks.select("chunk", "ids", "lengths", "body", "runs", "shared").mapInArrow(run, OPEN)


def later_windows(names: DataFrame, n_buckets: int) -> DataFrame:
    """Per text (chunk, doc) the starts of open windows that repeat an earlier one of another chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        un = zstandard.ZstdDecompressor()
        for _, chunks, payloads in _by_bucket(batches):
            parts, ids, numbers, chunk_of = [], [], [], []
            for chunk, p in zip(chunks, payloads):
                table, docs, part = unpack_names(un, p)
                parts.append(part)
                ids.append(table[part["doc"]])
                numbers.append(docs[part["doc"]])
                chunk_of.append(np.full(len(part), chunk, np.int64))
            all_, ids, numbers, chunk_of = (np.concatenate(x) for x in (parts, ids, numbers, chunk_of))
            # equal names stand together, the earliest place first
            order = np.lexsort((all_["start"], numbers, chunk_of, ids, all_["low"], all_["high"]))
            s = all_[order]
            later = order[1:][(s["high"][1:] == s["high"][:-1]) & (s["low"][1:] == s["low"][:-1])]
            if not len(later):
                continue
            later = later[np.lexsort((numbers[later], chunk_of[later]))]
            c, d, start = chunk_of[later], numbers[later], all_["start"][later].astype(np.int32)
            cut = np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (d[1:] != d[:-1])]))
            ends = np.append(cut[1:], len(c))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[cut]), pa.array(d[cut]), pa.array([start[i:j].tobytes() for i, j in zip(cut, ends)], pa.binary())],
                ["chunk", "doc", "starts"])

    rows = names.select("bucket", "chunk", "payload").repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    return rows.mapInArrow(run, "chunk long, doc int, starts binary").groupBy("chunk", "doc").agg(
        F.collect_list("starts").alias("starts"))


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    un = zstandard.ZstdDecompressor()
    for b in pieces(batches):
        out = []
        for body, runs, starts in zip(*(c.to_pylist() for c in b.columns[1:])):
            raw = un.decompress(body)
            mine = flags_of(np.frombuffer(runs, np.int32).reshape(-1, 2), len(raw))
            mine[np.frombuffer(b"".join(starts or []), np.int32)] = True
            out.append(result_of(raw, np.flatnonzero(mine)))
        columns = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(c), t) for c, t in zip(
            columns, (pa.int64(), pa.int64(), pa.int64(), pa.string())))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(spark: SparkSession, docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    chunks = make_chunks(spark, docs, chunk_bytes)
    total = chunks.select(F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    n_buckets = 1 + int(total * ANCHOR_SHARE) // BUCKET_BYTES

    free_shuffles(spark)
    with arrow_rows(spark, 2):      # chunks, not texts
        local = materialize(spark, local_pass(chunks, n_buckets), "local-repeats")
        shared = materialize(spark, shared_anchors(local.filter("bucket >= 0"), n_buckets), "shared-anchors")
        joined = (chunks.join(local.filter("bucket < 0").select("chunk", F.col("payload").alias("runs")), "chunk")
                        .join(shared.groupBy("chunk").agg(F.collect_list("payload").alias("shared")), "chunk", "left"))
        free_shuffles(spark)
        opened = materialize(spark, open_windows(joined, n_buckets), "open-windows")
        for used in (chunks, local, shared):
            discard(used)
        free_shuffles(spark)
        later = materialize(spark, later_windows(opened.filter("kind = 'name'"), n_buckets), "later-windows")
    texts = opened.filter("kind = 'text'").select("chunk", "doc", "doc_id", "payload", "runs").join(later, ["chunk", "doc"], "left")
    finished = texts.select("doc_id", "payload", "runs", "starts").mapInArrow(_finish, RESULT)
    done = opened.filter("kind = 'done'").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return done.unionByName(finished)
