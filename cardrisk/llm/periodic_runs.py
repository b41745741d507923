"""Periodic runs of words by recompression.

A run is a stretch of consecutive words (``[^\\x20\\x09-\\x0D]+``) with smallest
period q -- words q apart are identical -- of at least ``max(MIN_WORDS,
MIN_TIMES * q)`` words that no neighbouring word extends keeping the period.
Collapsing drops every word that some run contains after its first q words.

Grammar. The words of many texts, a barrier between texts, are compressed in
rounds: first every block of equal symbols becomes one symbol (symbol, length);
then symbols are dealt to two sides by a hash and every pair (left, right)
becomes one symbol. A round shortens a text by about a quarter, so there are
logarithmically many, and all levels together hold a few times the words. Equal
stretches are parsed alike but for their ends, so a longest common extension
climbs the levels while both places stand at the edge of a symbol, one step per
level, and comes down again where the symbols part: exact, a logarithmic number
of steps, and all queries of a group of texts take each step together.

Candidates. A run of period p has words[x] == words[x + p] on a stretch of
``max(MIN_WORDS, MIN_TIMES * p) - p`` places or more, so on at least one point
of the grid of that step: about n log n points over all periods of n words.
Points whose two words differ are no candidates; from the others the grammar
answers both extensions. A multiple of a run's smallest period finds the same
stretch, of which the smallest period is kept.

A text is handled by one task and texts never meet, so there is no shuffle. A
task holds one batch of texts and the grammar of ``GROUP_WORDS`` words or of the
longest text.

Defined results: null, empty and wordless texts have no run and no words;
``find_runs`` returns every row's id as it is, null and repeated ids too;
``collapse_runs`` leaves texts without a run as they are (null stays null), joins
the kept words of the others by one space, and keeps all other columns; an empty
table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from typing import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import mix64, pieces, sha256_hex, texts_of

MIN_WORDS = 24
MIN_TIMES = 3
GROUP_WORDS = 400_000      # words of texts that are compressed together, about
GRID_POINTS = 2_000_000    # grid points looked at together
BARRIER = 0
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN_TYPE = ArrayType(StructType([StructField(c, LongType()) for c in ("start", "length", "period")]))

# ---- grammar --------------------------------------------------------------


class Level:
    """One compression step: ``symbols`` in order and how they join into the next level's."""

    def __init__(self, symbols: np.ndarray, begins: np.ndarray, is_block: bool):
        self.symbols, self.is_block = symbols, is_block
        self.parent = np.cumsum(begins) - 1
        self.first = np.flatnonzero(begins)
        self.last = np.append(self.first[1:], len(symbols)) - 1


class Grammar:
    """Run-length grammar of a barrier-separated sequence of word numbers from 1."""

    def __init__(self, words: np.ndarray):
        self.levels: list[Level] = []
        self.top = words
        self.next_symbol = int(words.max(initial=0)) + 1
        smallest = 2 * int((words == BARRIER).sum()) - 1      # a symbol between every two barriers
        salt = 0
        while len(self.top) > smallest:
            self._join_blocks()
            self._join_pairs(salt)
            salt += 1

    def _push(self, begins: np.ndarray, is_block: bool, names: np.ndarray) -> None:
        """Add a level; ``names`` are keys of the joined symbols, one per parent that joins several."""
        level = Level(self.top, begins, is_block)
        above = self.top[level.first]
        joined = level.last > level.first
        distinct, number = np.unique(names, return_inverse=True)
        above[joined] = self.next_symbol + number
        self.next_symbol += len(distinct)
        self.levels.append(level)
        self.top = above

    def _join_blocks(self) -> None:
        s = self.top
        begins = np.r_[True, s[1:] != s[:-1]]
        if begins.all():
            return
        first = np.flatnonzero(begins)
        size = np.diff(np.append(first, len(s)))
        self._push(begins, True, ((s[first] << 32) | size)[size > 1])

    def _join_pairs(self, salt: int) -> None:
        s = self.top
        side = (mix64(s.astype(np.uint64) + np.uint64(salt << 32)) & np.uint64(1)).astype(bool)
        real = s != BARRIER
        inner = real[1:] & real[:-1] & (side[1:] != side[:-1])
        forth, back = inner & ~side[:-1], inner & side[:-1]
        pairs = np.flatnonzero(forth if forth.sum() >= back.sum() else back)
        if len(pairs):
            begins = np.ones(len(s), bool)
            begins[pairs + 1] = False
            self._push(begins, False, (s[pairs] << 32) | s[pairs + 1])

    def common(self, i: np.ndarray, j: np.ndarray, step: int) -> np.ndarray:
        """Number of equal words from places ``i`` and ``j`` of the sequence on (step 1) or backwards (step -1),
        ``i`` < ``j`` in the same text or at the barrier before it."""
        a, b = i.copy(), j.copy()
        height = np.full(len(i), len(self.levels))
        climbing = np.arange(len(i))
        for k, level in enumerate(self.levels):
            if not len(climbing):
                break
            x, y = a[climbing], b[climbing]
            edge = level.first if step > 0 else level.last
            far = level.last if step > 0 else level.first
            px, py = level.parent[x], level.parent[y]
            at_edge = (edge[px] == x) & (edge[py] == y)
            move = ~at_edge & (level.symbols[x] == level.symbols[y])
            if move.any():
                n = 1
                if level.is_block:
                    n = np.minimum(np.abs(far[px] - x), np.abs(far[py] - y))[move] + 1
                x[move] += step * n
                y[move] += step * n
                px, py = level.parent[x], level.parent[y]
                at_edge = (edge[px] == x) & (edge[py] == y)
            a[climbing], b[climbing] = np.where(at_edge, px, x), np.where(at_edge, py, y)
            height[climbing[~at_edge]] = k
            climbing = climbing[at_edge]
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            down = np.flatnonzero(height > k)
            if not len(down):
                continue
            edge = level.first if step > 0 else level.last
            x, y = edge[a[down]], edge[b[down]]
            same = level.symbols[x] == level.symbols[y]
            if same.any():
                n = 1
                if level.is_block:      # blocks of a symbol part after the shorter one
                    far = level.last if step > 0 else level.first
                    n = np.minimum(np.abs(far[level.parent[x]] - x), np.abs(far[level.parent[y]] - y))[same] + 1
                x[same] += step * n
                y[same] += step * n
            a[down], b[down] = x, y
        return step * (a - i)


# ---- runs -----------------------------------------------------------------


def grid(n: int, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(period, place) of every grid point of a text of ``n`` words, in bounded pieces."""
    periods = np.arange(1, n // min_times + 1)
    step = np.maximum(min_words, min_times * periods) - periods
    points = (n - 1 - periods) // step + 1
    ends = np.cumsum(points)
    at = 0
    while at < len(periods):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GRID_POINTS, "right")))
        of = np.repeat(np.arange(at, to), points[at:to])
        place = np.arange(len(of)) - np.repeat(ends[at:to] - points[at:to] - (ends[at - 1] if at else 0), points[at:to])
        yield periods[of], place * step[of]
        at = to


def runs_in(words: np.ndarray, starts: np.ndarray, sizes: np.ndarray, min_words: int = MIN_WORDS,
            min_times: int = MIN_TIMES) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, in this order, of texts that lie at ``starts`` of a
    barrier-separated sequence."""
    found = [np.zeros((0, 4), np.int64)]
    grammar = Grammar(words)

    def extend(text, i, period):
        after = grammar.common(i, i + period, 1)
        before = grammar.common(i - 1, i + period - 1, -1)
        size = before + after + period
        ok = size >= np.maximum(min_words, min_times * period)
        found.append(np.stack([text, i - before - starts[text], size, period], 1)[ok])

    held, n_held = [], 0
    for text, (start, size) in enumerate(zip(starts.tolist(), sizes.tolist())):
        for period, place in grid(size, min_words, min_times):
            i = start + place
            hit = np.flatnonzero(words[i] == words[i + period])
            if len(hit):
                held.append((np.full(len(hit), text), i[hit], period[hit]))
                n_held += len(hit)
            if n_held >= GRID_POINTS:
                extend(*map(np.concatenate, zip(*held)))
                held, n_held = [], 0
    if held:
        extend(*map(np.concatenate, zip(*held)))
    runs = np.concatenate(found)
    # of the periods that find a stretch the smallest; a run's other finds are repeats
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :3] != runs[:-1, :3]).any(1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


class Found:
    """The words of a text, its runs (start, length, period) and the words that stay."""

    def __init__(self, words: list[str], runs: np.ndarray):
        self.words, self.runs = words, runs

    def kept(self) -> list[str]:
        if not len(self.runs):
            return self.words
        change = np.zeros(len(self.words) + 1, np.int64)
        np.add.at(change, self.runs[:, 0] + self.runs[:, 2], 1)
        np.add.at(change, self.runs[:, 0] + self.runs[:, 1], -1)
        return [w for w, inside in zip(self.words, (np.cumsum(change) > 0).tolist()) if not inside]

    def strongest(self) -> tuple | None:
        """The run of the greatest exact length / period; of equals the first start, then the shortest period."""
        best = None
        for start, length, period in self.runs.tolist():
            if best is None or length * best[2] > best[1] * period:
                best = start, length, period
        return best


def analyse(texts: list[str], min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> Iterator[Found]:
    """Runs of every text, in order."""
    group, n_words = [], 0

    def finish() -> Iterator[Found]:
        numbers: dict[str, int] = defaultdict()
        numbers.default_factory = lambda: len(numbers) + 1
        long = [k for k, words in enumerate(group) if len(words) >= min_words]
        sizes = np.array([len(group[k]) for k in long], np.int64)
        runs = {}
        if long:
            sequence = np.zeros(int(sizes.sum()) + len(long) + 1, np.int64)
            starts = np.cumsum(sizes + 1) - sizes
            for k, s, n in zip(long, starts.tolist(), sizes.tolist()):
                sequence[s:s + n] = np.fromiter(map(numbers.__getitem__, group[k]), np.int64, n)
            rows = runs_in(sequence, starts, sizes, min_words, min_times)
            cuts = np.searchsorted(rows[:, 0], np.arange(len(long) + 1))
            runs = {k: rows[cuts[x]:cuts[x + 1], 1:] for x, k in enumerate(long)}
        none = np.zeros((0, 3), np.int64)
        for k, words in enumerate(group):
            yield Found(words, runs.get(k, none))

    for text in texts:
        group.append(WORD.findall(text))
        n_words += len(group[-1])
        if n_words >= GROUP_WORDS:
            yield from finish()
            group, n_words = [], 0
    yield from finish()


# ---- Spark ----------------------------------------------------------------


def runs_array(found: list[Found]) -> pa.Array:
    ends = np.cumsum([0] + [len(f.runs) for f in found]).astype(np.int32)
    rows = np.concatenate([np.zeros((0, 3), np.int64)] + [f.runs for f in found])
    columns = [pa.array(np.ascontiguousarray(rows[:, k])) for k in range(3)]
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(columns, ["start", "length", "period"]))


def find_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> DataFrame:
    """doc_id, n_words and all runs of each row, by start, then period."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            found = list(analyse(texts_of(b.column(1)), min_words, min_times))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(f.words) for f in found], pa.int64()), runs_array(found)],
                ["doc_id", "n_words", "runs"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>")


def collapse_runs(docs: DataFrame, min_words: int = MIN_WORDS, min_times: int = MIN_TIMES) -> DataFrame:
    """The documents, all columns as they were, without the repeated words, and their runs as ``__runs``."""
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches):
            found = list(analyse(texts_of(b.column(at)), min_words, min_times))
            texts = [" ".join(f.kept()) if len(f.runs) else t for f, t in zip(found, b.column(at).to_pylist())]
            columns = b.columns
            columns[at] = pa.array(texts, b.column(at).type)
            yield pa.RecordBatch.from_arrays([*columns, runs_array(found)], [*b.schema.names, "__runs"])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("__runs", RUN_TYPE)]))


def run_digests(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` its number of runs, the strongest run, and digests of all runs and of the kept words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for f in analyse(texts_of(b.column(1))):
                start, length, period = f.strongest() or (None, None, None)
                listed = "".join("%d,%d,%d\n" % tuple(r) for r in f.runs.tolist())
                rows.append((len(f.runs), start, length, period, None if start is None else 1000 * length // period,
                             sha256_hex(listed.encode()), sha256_hex(" ".join(f.kept()).encode("utf-8", "surrogatepass"))))
            columns = list(zip(*rows)) or [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in columns[:5]), *(pa.array(c, pa.string()) for c in columns[5:])],
                ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
             "runs_sha256 string, collapsed_sha256 string")
