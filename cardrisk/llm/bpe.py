"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one is a minimal perfect hash over the vocabulary: a pre-token that is a
vocabulary entry is answered by one probe, for all distinct pre-tokens of a
batch at once. Tier two merges the bytes of the remaining pre-tokens: parts
are a doubly linked list, candidate merges a heap ordered by (rank, position),
and stale heap entries are skipped, so a pre-token of n bytes costs
O(n log n) however long it is.

The vocabulary file is a parameter. The driver reads it once and broadcasts
its bytes; its size is checked against ``MAX_VOCAB_BYTES`` first. Encoding is
a narrow map over the documents: no shuffle, one document at a time.

Defined results: a null text encodes as the empty text (no ids); rows with a
null ``doc_id`` and repeated rows are encoded like any other, one output row
each; an empty table gives an empty result; further input columns are ignored.
"""

from __future__ import annotations

import base64
import heapq
from typing import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import Shared, mix64, pieces, sha256_hex, texts_of

MAX_VOCAB_BYTES = 64 << 20
MEMO_ENTRIES = 1_000_000  # resolved pre-tokens kept per Python worker


def read_ranks(path: str) -> dict[bytes, int]:
    """Vocabulary entries of a rank file (base64 token, rank), checked for size."""
    with open(path, "rb") as f:
        raw = f.read(MAX_VOCAB_BYTES + 1)
    if len(raw) > MAX_VOCAB_BYTES:
        raise ValueError(f"vocabulary file is larger than {MAX_VOCAB_BYTES} bytes: {path}")
    return {base64.b64decode(t): int(r) for t, r in (line.split() for line in raw.splitlines() if line)}


def hash_bytes(items: list[bytes]) -> np.ndarray:
    """64-bit hashes of byte strings: eight-byte little-endian words, one vector step per word."""
    n = len(items)
    if not n:
        return np.zeros(0, np.uint64)
    lengths = np.fromiter(map(len, items), np.int64, n)
    h = mix64(lengths.astype(np.uint64) + np.uint64(0x51ED270B))
    order = np.argsort(lengths, kind="stable")
    sorted_len = lengths[order]
    words = (lengths + 7) // 8
    starts = np.concatenate([[0], np.cumsum(words)])
    data = np.frombuffer(b"".join([x.ljust(int(w) * 8, b"\0") for x, w in zip(items, words)]), "<u8")
    for k in range(int(words.max(initial=0))):
        live = order[np.searchsorted(sorted_len, 8 * k, side="right"):]
        h[live] = mix64(h[live] ^ data[starts[live] + k])
    return h


class PerfectHash:
    """A minimal perfect hash of distinct byte strings by compress-hash-displace.

    Keys are dealt to buckets; the largest buckets first choose a displacement
    that sends all their keys to free slots. ``find`` returns the key's index
    in the given list, or -1: the slot's key is compared byte for byte, so a
    string outside the set is never mistaken for a member.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.keys = np.array(keys + [None], dtype=object)
        self.n_buckets = max(1, n // 3)
        self.displace = np.zeros(self.n_buckets, np.uint64)
        self.slot_key = np.full(max(1, n), -1, np.int64)
        h = hash_bytes(keys)
        if len(np.unique(h)) != n:
            raise ValueError("keys must be distinct")
        bucket = (h % np.uint64(self.n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        counts = np.bincount(bucket, minlength=self.n_buckets)
        first = np.concatenate([[0], np.cumsum(counts)])
        taken = bytearray(max(1, n))
        for b in np.argsort(-counts, kind="stable"):
            members = order[first[b]:first[b + 1]]
            if not len(members):
                break
            d = 0
            while True:
                tries = np.arange(d, d + (64 if len(members) > 1 else 1024), dtype=np.uint64)
                slots = self._slots(h[members][:, None], tries[None, :])
                done = False
                for j in range(slots.shape[1]):
                    s = slots[:, j].tolist()
                    if not any(taken[x] for x in s) and len(set(s)) == len(s):
                        for x, m in zip(s, members.tolist()):
                            taken[x] = 1
                            self.slot_key[x] = m
                        self.displace[b] = tries[j]
                        done = True
                        break
                if done:
                    break
                d += len(tries)

    def _slots(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (mix64(h + d * np.uint64(0xA24BAED4963EE407)) % np.uint64(max(1, self.n))).astype(np.int64)

    def find(self, items: list[bytes]) -> np.ndarray:
        if not self.n or not items:
            return np.full(len(items), -1, np.int64)
        h = hash_bytes(items)
        d = self.displace[(h % np.uint64(self.n_buckets)).astype(np.int64)]
        at = self.slot_key[self._slots(h, d)]
        same = self.keys[at] == np.array(items + [None], dtype=object)[:-1]
        return np.where(same.astype(bool), at, -1)


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: lowest rank first, leftmost among equals."""
    n = len(piece)
    get = ranks.get
    parts = [piece[i:i + 1] for i in range(n)]
    heap = [(r, i, 2) for i in range(n - 1) if (r := get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    after = list(range(1, n + 1))   # start of the next part
    before = list(range(-1, n - 1))
    pop, push = heapq.heappop, heapq.heappush
    while heap:
        _, i, size = pop(heap)
        left = parts[i]
        if left is None:
            continue
        j = after[i]
        if j >= n or len(left) + len(parts[j]) != size:
            continue   # one of the two parts has grown since
        left = parts[i] = left + parts[j]
        parts[j] = None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            joined = left + parts[k]
            if (r := get(joined)) is not None:
                push(heap, (r, i, len(joined)))
        p = before[i]
        if p >= 0:
            joined = parts[p] + left
            if (r := get(joined)) is not None:
                push(heap, (r, p, len(joined)))
    return [ranks[x] for x in parts if x is not None]


class Codec:
    """Encoder and decoder of one vocabulary; resolved pre-tokens are kept in a bounded memo."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo_entries: int = MEMO_ENTRIES):
        self.ranks = ranks
        keys = list(ranks)
        self.perfect = PerfectHash(keys)
        self.rank_of = np.array([ranks[k] for k in keys] + [-1], np.int64)
        self.split = regex.compile(pattern).findall
        self.token_bytes = {str(r): t for t, r in ranks.items()}
        self.memo: dict[str, str] = {}
        self.memo_entries = memo_entries

    def _resolve(self, pretokens: Iterable[str]) -> None:
        """Put the decimal ids of new pre-tokens into the memo."""
        new = [t for t in pretokens if t not in self.memo]
        if not new:
            return
        raw = [t.encode("utf-8", "surrogatepass") for t in new]
        found = self.rank_of[self.perfect.find(raw)].tolist()
        for t, b, r in zip(new, raw, found):
            self.memo[t] = str(r) if r >= 0 else " ".join(map(str, merge_bytes(b, self.ranks)))

    def encode_texts(self, texts: list[str]) -> list[str]:
        """Ids of each text as decimals joined by one space ('' for no ids)."""
        pieces = [self.split(t) for t in texts]
        if len(self.memo) > self.memo_entries:
            self.memo.clear()
        self._resolve(set().union(*map(set, pieces)) if pieces else ())
        get = self.memo.__getitem__
        return [" ".join(map(get, p)) for p in pieces]

    def encode(self, text: str) -> list[int]:
        ids = self.encode_texts([text])[0]
        return [int(x) for x in ids.split(" ")] if ids else []

    def decode_joined(self, ids: str) -> bytes:
        return b"".join(map(self.token_bytes.__getitem__, ids.split(" "))) if ids else b""

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(self.token_bytes[str(i)] for i in ids)


_CODECS: dict[tuple, Codec] = {}


def codec_of(shared: Shared, pattern: str) -> Codec:
    """The worker's codec for a broadcast vocabulary, built on first use and kept, with its bounded memo, across tasks."""
    key = (shared.key, pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value, pattern)
    return _CODECS[key]


def tokenize_documents(spark: SparkSession, docs: DataFrame, vocab_path: str, pattern: str) -> DataFrame:
    """Per document the encoded ids (array of int), their number, and whether they decode to the text again."""
    shared = Shared(spark, read_ranks(vocab_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared, pattern)
        for b in pieces(batches):
            texts = texts_of(b.column(1))
            joined = codec.encode_texts(texts)
            ids = [np.fromstring(s, np.int32, sep=" ") for s in joined]
            ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
            same = [codec.decode_joined(s) == t.encode("utf-8", "surrogatepass") for s, t in zip(joined, texts)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(ends), pa.int64()),
                 pa.ListArray.from_arrays(ends, np.concatenate(ids) if ids else np.zeros(0, np.int32)),
                 pa.array(same, pa.bool_())], ["doc_id", "n_tokens", "ids", "decodes_back"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids array<int>, decodes_back boolean")


def tokenize_digests(spark: SparkSession, docs: DataFrame, vocab_path: str, pattern: str) -> DataFrame:
    """Per document the number of ids, the digest of the ids and of the bytes they decode to.

    The same encoder and decoder as ``tokenize_documents``; ids leave the
    worker as digests so that the result stays a few bytes per document.
    """
    shared = Shared(spark, read_ranks(vocab_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(shared, pattern)
        for b in pieces(batches):
            ids = codec.encode_texts(texts_of(b.column(1)))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([s.count(" ") + 1 if s else 0 for s in ids], pa.int64()),
                 pa.array([sha256_hex(s.encode()) for s in ids]),
                 pa.array([sha256_hex(codec.decode_joined(s)) for s in ids])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
