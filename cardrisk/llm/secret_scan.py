"""Secret scan: fixed patterns, plus a token-efficiency test for random strings.

Patterns find assignments, access keys and long hexadecimal runs. The added
test looks at the remaining long unbroken strings: text a BPE vocabulary was
made for needs few tokens, so a string whose characters-per-token ratio is low
is likely random. Strings of known harmless shape (digests, UUIDs, names made
of word parts) are excluded before the test. Words joined to a random string by
/ _ + or - would hide it in the ratio of the whole; where the whole passes, the
runs of its parts with the lowest ratio take the same test by themselves.

A narrow map over the documents. The vocabulary is broadcast after a check of
its size (see ``bpe.read_ranks``) and applied with the tiktoken library.

Defined results: a null text has no spans; empty texts likewise; null ids and
repeated rows give one output row each; an empty table an empty result.
Offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re
from typing import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import read_ranks
from .common import Shared, pieces, sha256_hex, texts_of

KINDS = ("assign", "access", "hex", "token")  # order among spans with equal starts
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # maximal runs, so the same as [0-9a-f]+ of 24 or more
CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{20,}={0,2}")
DIGEST = re.compile(r"(?:sha\d+[-_])?(?:[0-9a-f]+|[0-9A-F]+)")
DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}  # hexadecimal characters of the usual digests
UUID = re.compile(r"[0-9A-Fa-f]{8}(?:-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}")
WORD_PART = re.compile(r"[A-Z]?[a-z]{2,}|[A-Z]{2,}(?![a-z])|\d{1,4}(?!\d)")

PART = re.compile(r"[A-Za-z0-9]+={0,2}")
UUID_INSIDE = re.compile(rf"(?<![A-Za-z0-9]){UUID.pattern}(?![A-Za-z0-9])")

MIN_CHARS = 20         # of a run of parts, as of a candidate
DROP = 8               # characters too many for its tokens that end a run of parts
MAX_CHARS_PER_TOKEN = 2.0
ONE_KIND = 0.9         # stricter by this factor for strings of only lower case, upper case or digits
MIN_WORD_SHARE = 0.8   # of an identifier's letters and digits inside word parts


def is_known_shape(s: str) -> bool:
    """Digests, UUIDs and identifiers made of word parts joined by - _ / or capitals."""
    if UUID.fullmatch(s):
        return True
    if DIGEST.fullmatch(s) and len(s.split("-")[-1].split("_")[-1]) in DIGEST_LENGTHS:
        return True
    solid = sum(c.isalnum() for c in s)
    parts = WORD_PART.findall(s)
    joined = re.search(r"[-_/]", s) or not re.search(r"\d", s)
    return bool(joined) and sum(map(len, parts)) >= MIN_WORD_SHARE * solid and \
        sum(len(p) >= 3 for p in parts) * 6 >= len(s) / 3


def is_random(s: str, encode, max_ratio: float = MAX_CHARS_PER_TOKEN) -> bool:
    kinds = (any("a" <= c <= "z" for c in s)) + (any("A" <= c <= "Z" for c in s)) + (any("0" <= c <= "9" for c in s))
    if is_known_shape(s):
        return False
    return len(s) < (max_ratio if kinds > 1 else max_ratio * ONE_KIND) * len(encode(s))


def random_spans(s: str, encode, max_ratio: float = MAX_CHARS_PER_TOKEN) -> list[tuple[int, int]]:
    """Where a candidate is random: as a whole, or else in runs of the parts between its separators."""
    known = [m.span() for m in UUID_INSIDE.finditer(s)]
    if not known and is_random(s, encode, max_ratio):
        return [(0, len(s))]
    parts = [m.span() for m in PART.finditer(s)]
    if parts == [(0, len(s))]:
        return []
    weight, at = [], 0
    for a, b in parts:
        while at < len(known) and known[at][1] <= a:
            at += 1
        harmless = at < len(known) and known[at][0] <= a or DIGEST.fullmatch(s[a:b]) and b - a in DIGEST_LENGTHS
        weight.append(float("-inf") if harmless else max_ratio * len(encode(s[a:b])) - (b - a))
    out, i = [], 0
    while i < len(parts):
        total = best = 0.0
        end = i
        for j in range(i, len(parts)):
            total += weight[j]
            if total > best:
                best, end = total, j + 1
            if total <= 0 or total < best - DROP:
                break
        if end == i:
            i += 1
            continue
        a, b = parts[i][0], parts[end - 1][1]
        spans = [(a, b)] if is_random(s[a:b], encode, max_ratio) else [p for p in parts[i:end] if is_random(s[p[0]:p[1]], encode, max_ratio)]
        out += [(a, b) for a, b in spans if b - a >= MIN_CHARS]
        i = end
    return out


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind index, end) of the fixed patterns."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def outside(base: list[tuple[int, int, int]], a: int, b: int) -> list[tuple[int, int]]:
    """The parts of [a, b) that no base span covers (base spans by start)."""
    out = []
    for s, _, e in base:
        if s < b and a < e:
            if s > a:
                out.append((a, s))
            a = max(a, e)
    return out + [(a, b)] if a < b else out


def all_spans(text: str, encode, max_ratio: float = MAX_CHARS_PER_TOKEN) -> tuple[list, list]:
    """Base spans, and these with the token-efficiency spans of what lies outside them."""
    base = base_spans(text)
    extra = []
    for m in CANDIDATE.finditer(text):
        for a, b in outside(base, *m.span()):
            if b - a >= MIN_CHARS:
                extra += [(a + x, 3, a + y) for x, y in random_spans(text[a:b], encode, max_ratio)]
    return base, sorted(base + extra)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def redact(text: str, spans: list[tuple[int, int, int]], mark: str = "[secret]") -> str:
    """The text with every maximal run of covered characters replaced by ``mark``."""
    out, at = [], 0
    end = -1
    for a, _, b in spans:
        if a > end:            # a new run
            if end >= 0:
                at = end
            out += [text[at:a], mark]
            end = b
        else:
            end = max(end, b)
    if end >= 0:
        at = end
    return "".join(out) + text[at:]


_ENCODERS: dict[tuple, tiktoken.Encoding] = {}


def _encoder(shared: Shared, pattern: str):
    """The worker's encoder for a broadcast vocabulary, built on first use."""
    key = (shared.key, pattern)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=shared.value, special_tokens={})
    return _ENCODERS[key].encode_ordinary


def scan_secrets(spark: SparkSession, docs: DataFrame, vocab_path: str, pattern: str,
                 max_ratio: float = MAX_CHARS_PER_TOKEN) -> DataFrame:
    """One row per document: counts of the fixed patterns, digest of their spans, all spans."""
    shared = Shared(spark, read_ranks(vocab_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared, pattern)
        for b in pieces(batches):
            found = [all_spans(t, encode, max_ratio) for t in texts_of(b.column(1))]
            counts = [[sum(s[1] == k for s in base) for base, _ in found] for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in counts),
                 pa.array([sha256_hex(joined(base).encode()) for base, _ in found], pa.string()),
                 pa.array([joined(every) for _, every in found], pa.string()),
                 pa.array([len(every) - len(base) for base, every in found], pa.int64())],
                ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_token"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_token long")


def redact_secrets(spark: SparkSession, docs: DataFrame, vocab_path: str, pattern: str,
                   max_ratio: float = MAX_CHARS_PER_TOKEN, mark: str = "[secret]") -> DataFrame:
    """The documents, all columns kept, with every found span replaced by ``mark``.

    A null text stays null; ``n_chars``, where present, counts the new text.
    """
    shared = Shared(spark, read_ranks(vocab_path))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(shared, pattern)
        for b in pieces(batches):
            new = [t if t is None else redact(t, all_spans(t, encode, max_ratio)[1], mark)
                   for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if i == at else c for i, c in enumerate(b.columns)],
                                             b.schema.names)

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in out.columns:
        kind = out.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.char_length("text").cast(kind))
    return out
