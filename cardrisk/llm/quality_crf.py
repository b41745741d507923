"""Quality rules by line sequence labelling.

Every line of a document is labelled content or boilerplate by a linear-chain
conditional random field (Viterbi decoding over the whole document, blank
lines skipped); the share of a document's words on content lines decides
whether it is kept.

Training. Line labels come from the document labels: the lines of documents of
quality 1 count as content, those of quality 0 as boilerplate, and the chain's
transition weights smooth over the exceptions. The field is fitted on at most
``TRAIN_DOCS`` labelled documents of each quality with at most ``TRAIN_CHARS``
characters each (smallest hashes of the id first), so the driver sees at most
2 * TRAIN_DOCS * TRAIN_CHARS characters; the fitted weights are a few dozen
numbers. A shift towards content, the least that keeps ``KEEP_CLEAN`` of the
sample's clean documents, guards ordinary text; it never goes so far that less
than ``REJECT_POOR`` of the sample's poor documents stay rejected. Only documents
that pass the base rules count for it. Everything else is a narrow map over whole texts.

Defined results: words are runs of characters other than space and U+0009 to
U+000D; a null or empty text has none and fails the base rules; null ids and
repeated rows give one output row each; without usable labels of both
qualities every line counts as content, so the base rules alone decide; labels of
both that no shift can tell apart (``MIN_CLEAN``) are an error.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import pieces, texts_of

TRAIN_DOCS = 600
TRAIN_CHARS = 10_000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_CONTENT_SHARE = 0.5
KEEP_CLEAN = 0.998       # of the clean documents in the sample
REJECT_POOR = 0.8        # of the poor ones, at least
MIN_CLEAN = 0.9          # of the clean ones, where wrong labels put KEEP_CLEAN out of reach

SYMBOLS = b"#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

# ---- features -------------------------------------------------------------


def _byte_classes() -> np.ndarray:
    """One row per byte: membership in the classes that the features count."""
    t = np.zeros((256, 8), np.float32)
    t[[*SYMBOLS], 0] = 1
    t[[*b"!?"], 1] = 1
    t[ord("|"), 2] = 1
    t[ord("A"):ord("Z") + 1, 3] = 1
    t[ord("0"):ord("9") + 1, 4] = 1
    t[[*b".,;:"], 5] = 1
    t[[*SPACES.encode()], 6] = 1
    t[:, 7] = 1
    t[0x80:0xC0, 7] = 0          # continuation bytes: not another character
    return t


_CLASSES = _byte_classes()
N_FEATURES = 13


def line_features(lines: list[bytes]) -> np.ndarray:
    """(lines, N_FEATURES) of non-blank lines, each bounded to [0, 1] or nearly."""
    n = len(lines)
    if not n:
        return np.zeros((0, N_FEATURES), np.float32)
    lengths = np.fromiter(map(len, lines), np.int64, n)
    buf = np.frombuffer(b"".join(lines), np.uint8)
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    counts = np.stack([np.add.reduceat(_CLASSES[:, k][buf], starts) for k in range(8)], 1)
    chars = np.maximum(counts[:, 7], 1)
    words = np.fromiter((len(x.split()) for x in lines), np.int64, n)
    seen: set[bytes] = set()
    repeat = np.zeros(n, np.float32)
    for i, x in enumerate(lines):
        repeat[i] = x in seen
        seen.add(x)
    solid = np.maximum(chars - counts[:, 6], 1)
    f = np.empty((n, N_FEATURES), np.float32)
    f[:, 0] = 1
    for k in range(6):
        f[:, 1 + k] = counts[:, k] / solid
    f[:, 7] = (counts[:, 0] > 0.05 * solid)
    f[:, 8] = (counts[:, 3] > 0.5 * solid)
    f[:, 9] = np.minimum(words, 50) / 50
    f[:, 10] = words <= 3
    f[:, 11] = np.minimum(solid / np.maximum(words, 1), 30) / 30
    f[:, 12] = repeat
    return f


# ---- the chain ------------------------------------------------------------


@dataclass
class Chain:
    """Weights of a two-state chain: state 0 boilerplate, state 1 content."""

    emit: np.ndarray    # (N_FEATURES, 2)
    move: np.ndarray    # (2, 2), from, to

    def viterbi(self, features: np.ndarray) -> np.ndarray:
        """The most probable labels; equal scores go to content."""
        score = (features @ self.emit).astype(np.float64).tolist()
        if not score:
            return np.zeros(0, bool)
        (m00, m01), (m10, m11) = self.move.tolist()
        a, b = score[0]
        back0, back1 = [], []
        for e0, e1 in score[1:]:
            s0, t0, s1, t1 = a + m00, b + m10, a + m01, b + m11
            back0.append(t0 >= s0)
            back1.append(t1 >= s1)
            a, b = (t0 if t0 >= s0 else s0) + e0, (t1 if t1 >= s1 else s1) + e1
        label = b >= a
        out = [label]
        for p0, p1 in zip(reversed(back0), reversed(back1)):
            label = p1 if label else p0
            out.append(label)
        return np.array(out[::-1], bool)


ALL_CONTENT = Chain(np.stack([np.zeros(N_FEATURES), np.eye(N_FEATURES)[0]], 1), np.zeros((2, 2)))


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def fit_chain(sequences: list[tuple[np.ndarray, int]], steps: int = 80, rate: float = 0.15,
              decay: float = 1e-3) -> Chain:
    """Maximum conditional likelihood by Adam; the gradient comes from forward-backward
    sums over all sequences at once (padded to the longest)."""
    sequences = [(f, y) for f, y in sequences if len(f)]
    if len({y for _, y in sequences}) < 2:
        return ALL_CONTENT
    n, length = len(sequences), max(len(f) for f, _ in sequences)
    x = np.zeros((n, length, N_FEATURES))
    mask = np.zeros((n, length))
    for i, (f, _) in enumerate(sequences):
        x[i, :len(f)] = f
        mask[i, :len(f)] = 1
    y = np.array([y for _, y in sequences])
    target = np.zeros((n, length, 2))
    target[np.arange(n), :, y] = 1
    weight = mask / mask.sum(1, keepdims=True)      # a long document counts as much as a short one
    pair = mask[:, 1:] * weight[:, 1:]
    want_move = np.zeros((2, 2))
    for k in (0, 1):
        want_move[k, k] = pair[y == k].sum()
    theta = np.zeros(N_FEATURES * 2 + 4)
    m = np.zeros_like(theta)
    v = np.zeros_like(theta)
    for step in range(1, steps + 1):
        emit, move = theta[:-4].reshape(N_FEATURES, 2), theta[-4:].reshape(2, 2)
        s = x @ emit
        alpha, beta = np.empty((n, length, 2)), np.zeros((n, length, 2))
        alpha[:, 0] = s[:, 0]
        for t in range(1, length):
            nxt = _logsumexp(alpha[:, t - 1, :, None] + move, 1) + s[:, t]
            alpha[:, t] = np.where(mask[:, t, None] > 0, nxt, alpha[:, t - 1])
        for t in range(length - 2, -1, -1):
            prev = _logsumexp(move + (s[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
            beta[:, t] = np.where(mask[:, t + 1, None] > 0, prev, 0.0)
        z = _logsumexp(alpha[:, -1], 1)
        marginal = np.exp(alpha + beta - z[:, None, None])
        g_emit = np.einsum("ntf,nt,ntk->fk", x, weight, target - marginal)
        joint = np.exp(alpha[:, :-1, :, None] + move + (s[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
        g_move = want_move - (joint * pair[:, :, None, None]).sum((0, 1))
        g = np.concatenate([g_emit.ravel(), g_move.ravel()]) / n - decay * theta
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta = theta + rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Chain(theta[:-4].reshape(N_FEATURES, 2), theta[-4:].reshape(2, 2))


def calibrate(chain: Chain, clean: list[list[bytes]], poor: list[list[bytes]] = (), min_share: float = MIN_CONTENT_SHARE,
              kept: float = KEEP_CLEAN, rejected: float = REJECT_POOR, least: float = MIN_CLEAN) -> Chain:
    """Raise the chain's inclination to content until the share ``kept`` of clean documents passes.

    Ordinary lines also stand in poor documents, whose labels cover all their
    lines; where they are all a text has, the fitted weights alone would turn
    against them. The least sufficient shift is taken, of those that leave the
    share ``rejected`` of poor documents out (a negative one where the weights
    alone do not). Some labels may be wrong: where no such shift suffices, the
    one that keeps most is taken, if that is ``least``.
    """
    clean, poor = [x for x in clean if x], [x for x in poor if x]

    def shifted(shift: float) -> Chain:
        emit = chain.emit.copy()
        emit[0, 1] += shift                     # feature 0 is constant
        return Chain(emit, chain.move)

    def share(moved: Chain, sample: list[list[bytes]]) -> float:
        return sum(content_share(moved, x) >= min_share for x in sample) / len(sample) if sample else 1.0

    def rejects(moved: Chain) -> bool:
        return not poor or 1 - share(moved, poor) >= rejected

    start = next((x for x in np.arange(0.0, -8.0, -0.25) if rejects(shifted(x))), None)
    best, best_kept = None, -1.0
    for shift in [] if start is None else np.arange(start, 8.0, 0.25):
        moved = shifted(shift)
        if not rejects(moved):                  # and a larger shift leaves no more out
            break
        passed = share(moved, clean)
        if passed > best_kept:
            best, best_kept = moved, passed
        if passed >= kept:
            break
    if best is None or best_kept < least:
        raise ValueError(f"the labels cannot be told apart by lines: with {rejected} of {len(poor)} poor documents rejected "
                         f"at most {max(best_kept, 0):.3f} of {len(clean)} clean ones are kept ({least} asked)")
    return best


def train_chain(spark: SparkSession, docs: DataFrame, labels: DataFrame,
                train_docs: int = TRAIN_DOCS, train_chars: int = TRAIN_CHARS) -> Chain:
    """Fit the chain on a bounded sample of labelled documents (see the module's text)."""
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).filter(
        F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    order = F.xxhash64("doc_id")
    chosen = None
    for q in (0, 1):
        part = known.filter(F.col("quality") == q).orderBy(order, "doc_id").limit(train_docs)
        chosen = part if chosen is None else chosen.unionByName(part)
    # at most 2 * train_docs ids, so safe to broadcast
    texts = docs.select("doc_id", "text").filter(F.length("text") <= train_chars).join(F.broadcast(chosen), "doc_id")
    rows = texts.orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(2 * train_docs).collect()
    lines = [(content_lines(r.text), r.quality) for r in rows]
    chain = fit_chain([(line_features(x), q) for x, q in lines])
    if chain is ALL_CONTENT:
        return chain
    passed = [(x, q) for (x, q), r in zip(lines, rows) if not base_failed(base_counts(r.text))]
    return calibrate(chain, [x for x, q in passed if q == 1], [x for x, q in passed if q == 0])


# ---- documents ------------------------------------------------------------


def content_lines(text: str) -> list[bytes]:
    return [x for x in text.encode("utf-8", "surrogatepass").split(b"\n") if x.strip(SPACES.encode())]


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more."""
    n = len(words)
    if n < 4:
        return 0
    ids: dict[bytes, int] = {}
    w = np.fromiter((ids.setdefault(x, len(ids)) for x in words), np.int64, n)
    if len(ids) < 1 << 21:
        key = (w[:-2] << 42) | (w[1:-1] << 21) | w[2:]
    else:
        pair = np.unique(w[:-1] * len(ids) + w[1:], return_inverse=True)[1]
        key = pair[:-1] * len(ids) + w[2:]
    order = np.argsort(key, kind="stable")
    k = key[order]
    same = k[1:] == k[:-1]
    if not same.any():
        return 0
    again = np.zeros(len(k), bool)
    again[1:] |= same
    again[:-1] |= same
    hit = np.zeros(n, bool)
    at = order[again]
    hit[at] = hit[at + 1] = hit[at + 2] = True
    return int(hit.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(raw.count(bytes([c])) for c in SYMBOLS)
    lines = content_lines(text)
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def base_failed(counts: tuple[int, int, int, int, int]) -> bool:
    return counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]


def content_share(chain: Chain, lines: list[bytes]) -> float:
    """Share of the words that stand on lines labelled content (0 without words)."""
    if not lines:
        return 0.0
    words = np.fromiter((len(x.split()) for x in lines), np.int64, len(lines))
    return float(words[chain.viterbi(line_features(lines))].sum() / words.sum())


def judge(text: str, chain: Chain, min_share: float = MIN_CONTENT_SHARE) -> tuple:
    """(the five base counts, base_failed, content share, kept)."""
    counts = base_counts(text)
    failed = base_failed(counts)
    share = content_share(chain, content_lines(text))
    return (*counts, failed, share, not failed and share >= min_share)


def judge_documents(spark: SparkSession, docs: DataFrame, chain: Chain,
                    min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """One row per document: base counts, verdict of the base rules, content share, kept."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "content_share", "kept"]
    types = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            rows = [judge(t, chain, min_share) for t in texts_of(b.column(1))]
            columns = zip(*rows) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(list(c), t) for c, t in zip(columns, types))], ["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
             "base_failed boolean, content_share double, kept boolean")


def keep_documents(spark: SparkSession, docs: DataFrame, chain: Chain,
                   min_share: float = MIN_CONTENT_SHARE) -> DataFrame:
    """The documents that the rules keep, all columns as they were."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            yield b.filter(pa.array([judge(t, chain, min_share)[-1] for t in texts_of(b.column(at))], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
