"""Collocations counted over a prefix-free parse.

A text is lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those
into words ``[^\\x20\\x09]+``. Its tokens are the words and, between pieces, a break;
``OVERLAP`` breaks close it.

Parse. A chunk begins at the first token and wherever the hash of the next
``OVERLAP`` tokens is divisible by ``TRIGGER``, and runs on through the tokens that
begin the next one. So chunks overlap by ``OVERLAP`` tokens, equal passages give
equal chunks wherever they stand, and a phrase of up to ``OVERLAP + 1`` words that
starts before a chunk's last ``OVERLAP`` tokens lies in it whole: that chunk owns
it, and no other. The dictionary is the table of distinct chunks of each language
with their parse frequencies; all counting reads it instead of the texts.

Counts. A phrase that occurs ``MIN_COUNT`` times has only parts that do. Phrases of
one word, then two, then three and four are counted by hashes, each only
where the shorter parts counted before may be frequent. What may be frequent is
a bitmap of ``BITMAP_BITS`` hashed places, a fixed size at any corpus size: two
phrases in one place, or with one hash, only let a rare one through. A last pass counts the
phrases that came through, exactly, as strings.

Scores. Cutting a phrase after its first k words gives l and r, the counts of the
two parts, and ``floor(2000000 * a / (l + r))`` in decimals; the lowest-scoring cut
counts. A phrase inside a longer candidate with 100 * f(longer) >= 80 * a is dropped.
The counts of parts are looked up by joins in which parts that many phrases share
are kept apart from the others, and the first ``TOP`` of a language are found
over many tasks before they meet in one.

Defined results: a null text has no words; a null language is ``und``; repeated
rows and null ids count as documents of their own; an empty table gives an empty
result; further columns are ignored. A task works on
GROUP_BYTES of texts or chunks at a time; a chunk is at most one text long.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import materialize
from .common import Shared, free_shuffles, join_sized, mix64

OVERLAP = 3
LONGEST = OVERLAP + 1
TRIGGER = 32
MIN_COUNT = 30
COVERED_PERCENT = 80
TOP = 2000
SCALE = 2_000_000
BITMAP_BITS = 1 << 26
PASSES = ((1,), (2,), (3, 4))      # lengths that are counted together by hashes
GROUP_BYTES = 2 << 20      # of texts or chunks that are worked on together in a task, about
NO_LANG = "und"
BREAK = b"\n"

# to lower case A-Z; every piece end becomes a break and every tab a space
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")
_FIRST = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)      # masks of the first k of eight bytes

# ---- tokens ---------------------------------------------------------------


def tokens_of(text: str) -> bytes:
    """The text's tokens, with the closing breaks, a space after each."""
    folded = text.encode("utf-8", "surrogatepass").translate(_FOLD).replace(BREAK, b" \n ")
    return b" ".join([*filter(None, folded.split(b" ")), *[BREAK] * OVERLAP, b""])


class Tokens:
    """Places and hashes of the tokens of texts, which follow each other in ``data`` and end at ``ends``."""

    def __init__(self, data: bytes, ends: np.ndarray):
        self.data = data
        raw = np.frombuffer(data, np.uint8)
        self.ends = np.flatnonzero(raw == 32)
        self.starts = np.r_[0, self.ends[:-1] + 1]
        self.is_break = raw[self.starts] == BREAK[0]
        self._eight = np.ndarray(len(raw), np.uint64, data + bytes(8), strides=(1,))   # the 8 bytes from each place on
        self.last = np.searchsorted(self.starts, ends) - 1                             # the last token of each text
        self.hashes = self.hashed(1)

    def hashed(self, seed: int) -> np.ndarray:
        """A 64-bit hash of every token, taken in pieces of eight bytes."""
        size = self.ends - self.starts
        h = mix64(size.astype(np.uint64) + np.uint64(seed << 32))
        rest, done = np.arange(len(size)), 0
        while len(rest):
            piece = self._eight[self.starts[rest] + done] & _FIRST[np.minimum(size[rest] - done, 8)]
            h[rest] = mix64(h[rest] ^ piece)
            done += 8
            rest = rest[size[rest] > done]
        return h


def following(hashes: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Hash of a phrase and a token after it."""
    with np.errstate(over="ignore"):
        return mix64(hashes * np.uint64(0xC2B2AE3D27D4EB4F) + more)


def chunks_of(texts: list[bytes], every: int = TRIGGER) -> tuple[list[bytes], np.ndarray]:
    """The chunks of every text (tokens, a space after each), and the number of words that each owns."""
    tokens = Tokens(b"".join(texts), np.cumsum([len(t) for t in texts]))
    h = tokens.hashes
    n = len(h) - OVERLAP + 1
    trigger = h[:n]
    for k in range(1, OVERLAP):
        trigger = following(trigger, h[k:n + k])
    begins = np.zeros(len(h), bool)
    begins[:n] = trigger % np.uint64(every) == 0
    first = np.r_[0, tokens.last[:-1] + 1]
    for k in range(OVERLAP):               # the closing breaks begin no chunk, nor does what crosses texts
        begins[tokens.last - k] = False
    begins[first] = True
    at = np.flatnonzero(begins)
    ends = np.r_[at[1:] + OVERLAP - 1, tokens.last[-1]]
    ends = np.minimum(ends, tokens.last[np.searchsorted(tokens.last, at)])
    words = np.r_[0, np.cumsum(~tokens.is_break)]
    return ([tokens.data[s:e + 1] for s, e in zip(tokens.starts[at].tolist(), tokens.ends[ends].tolist())],
            words[ends + 1 - OVERLAP] - words[at])


def parse(spark: SparkSession, docs: DataFrame, trigger: int = TRIGGER) -> DataFrame:
    """The dictionary: lang, chunk, the number of words ``w`` that it owns, and its parse frequency ``c``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[bytes]] = {}
        size: dict[str, int] = {}

        def finish(lang: str) -> pa.RecordBatch:
            chunks, words = chunks_of(held.pop(lang), trigger)
            return pa.RecordBatch.from_arrays([pa.array([lang] * len(chunks)), pa.array(chunks, pa.binary()),
                                               pa.array(words, pa.int64())], ["lang", "chunk", "w"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if text:
                    if lang not in held:
                        held[lang], size[lang] = [], 0
                    held[lang].append(tokens_of(text))
                    size[lang] += len(text)
                    if size[lang] >= GROUP_BYTES:
                        yield finish(lang)
            for lang in list(held):            # languages are unbounded: none waits for another batch
                yield finish(lang)

    rows = docs.select(F.coalesce("lang", F.lit(NO_LANG)).alias("lang"), "text").mapInArrow(run, "lang string, chunk binary, w long")
    return rows.groupBy("lang", "chunk", "w").agg(F.count(F.lit(1)).alias("c"))


# ---- counting -------------------------------------------------------------


@lru_cache(maxsize=4096)
def lang_seed(lang: str) -> int:
    """What tells the hashes of one language's phrases from another's."""
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


class Chunks:
    """A group of dictionary rows (lang, chunk, c), and the phrases in them that may be frequent."""

    def __init__(self, rows: pa.Table, bitmaps: list[np.ndarray]):
        self.bitmaps = bitmaps
        chunks, langs = rows["chunk"].combine_chunks(), rows["lang"].combine_chunks().dictionary_encode()
        at = np.frombuffer(chunks.buffers()[1], np.int32)[chunks.offset:chunks.offset + len(chunks) + 1]
        self.tokens = Tokens(chunks.buffers()[2][int(at[0]):int(at[-1])].to_pybytes(), at[1:] - at[0])
        last = self.tokens.last
        self.chunk = np.repeat(np.arange(len(chunks)), np.diff(np.r_[-1, last]))
        self.weight = rows["c"].to_numpy()[self.chunk]
        self.owned = ~self.tokens.is_break      # words that start phrases of this chunk
        for k in range(OVERLAP):
            self.owned[last - k] = False
        self.langs, self.lang = langs.dictionary.to_pylist(), langs.indices.to_numpy()
        self.seed = np.array([lang_seed(x) for x in self.langs], np.uint64)[self.lang][self.chunk]

    def phrases(self, *lengths: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """By length the starts and hashes of the owned phrases whose parts pass the bitmaps there are, and
        which pass the bitmap of their own length if there is one."""
        ok, h = ~self.tokens.is_break, following(self.seed, self.tokens.hashes)
        for k in range(1, max(lengths) + 1):
            if k > 1:
                n = len(h) - 1
                ok = ok[:n] & ok[1:] & (self.chunk[:n] == self.chunk[k - 1:])
                h = following(h[:n], self.tokens.hashes[k - 1:])
            if k <= len(self.bitmaps):
                at = np.flatnonzero(ok)
                ok[at] = in_bitmap(self.bitmaps[k - 1], h[at])
            if k in lengths:
                at = np.flatnonzero(ok & self.owned[:len(ok)])
                yield k, at, h[at]

    def hashed_counts(self, lengths: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes (of so many bits) of the phrases, with their weighted counts."""
        found = [(at, h) for _, at, h in self.phrases(*lengths)]
        at, h = (np.concatenate(x) for x in zip(*found))
        h &= np.uint64((1 << bits) - 1)
        order = np.argsort(h)
        h = h[order]
        new = np.flatnonzero(np.r_[True, h[1:] != h[:-1]][:len(h)])
        return h[new].view(np.int64), np.add.reduceat(self.weight[at[order]], new) if len(new) else np.zeros(0, np.int64)

    def exact_counts(self) -> Iterator[pa.RecordBatch]:
        """lang, phrase and weighted count of the phrases. Equal phrases of the group are found by two 64-bit hashes."""
        t, second, names = self.tokens, self.tokens.hashed(2), pa.array(self.langs, pa.string())
        for words, at, h in self.phrases(*range(1, LONGEST + 1)):
            g = self.seed[at]
            for k in range(words):
                g = following(g, second[at + k])
            order = np.argsort(h)
            if ((h[order[1:]] == h[order[:-1]]) & (g[order[1:]] != g[order[:-1]])).any():
                order = np.lexsort((g, h))
            at, h, g = at[order], h[order], g[order]
            new = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (g[1:] != g[:-1])][:len(h)])
            if not len(new):
                continue
            first = at[new]
            spans = zip(t.starts[first].tolist(), t.ends[first + words - 1].tolist())
            yield pa.RecordBatch.from_arrays(
                [names.take(pa.array(self.lang[self.chunk[first]])), pa.array([t.data[s:e].decode("utf-8", "surrogatepass") for s, e in spans]),
                 pa.array(np.add.reduceat(self.weight[at], new))], ["lang", "phrase", "c"])


def in_bitmap(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = (h & np.uint64(8 * len(bitmap) - 1)).view(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def groups(batches: Iterator[pa.RecordBatch], bitmaps: list[bytes]) -> Iterator[Chunks]:
    """The dictionary rows of a task, grouped up to a bounded size (or one chunk)."""
    maps = [np.frombuffer(b, np.uint8) for b in bitmaps]
    held, size = [], 0
    for b in batches:
        ends = np.cumsum(pc.binary_length(b.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
        at = 0
        while at < b.num_rows:
            done = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + GROUP_BYTES - size, "right")))
            held.append(b.slice(at, to - at))
            size += int(ends[to - 1]) - done
            at = to
            if size >= GROUP_BYTES or at < b.num_rows:
                yield Chunks(pa.Table.from_batches(held), maps)
                held, size = [], 0
    if held:
        yield Chunks(pa.Table.from_batches(held), maps)


def bitmap_of(hashes: DataFrame, bits: int) -> bytes:
    """The bitmap of a table of hashes ``h``, built over many tasks; so many places at any table size."""
    place = F.col("h").bitwiseAND(F.lit(bits - 1)) + 1        # the bitmap functions count from 1
    parts = hashes.select(F.bitmap_bucket_number(place).alias("part"), F.bitmap_bit_position(place).alias("bit"))
    parts = parts.groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bits"))
    out = bytearray(bits // 8)
    for part, some in parts.collect():
        out[(part - 1) * len(some):part * len(some)] = some
    return bytes(out)


def frequent_phrases(spark: SparkSession, dictionary: DataFrame, min_count: int = MIN_COUNT,
                     bits: int = BITMAP_BITS) -> DataFrame:
    """lang, phrase and count ``f`` of all phrases of 1 to LONGEST words with ``min_count`` occurrences."""
    total = dictionary.agg(F.sum(F.col("c") * F.col("w"))).first()[0] or 0
    # sixteen values per word occurrence: rare phrases seldom share one, and rows of the shuffle stay short
    hash_bits = min(63, max(bits.bit_length() - 1, total.bit_length() + 4))
    dictionary = dictionary.select("lang", "chunk", "c")
    bitmaps: list[bytes] = []
    for lengths in PASSES:
        known = Shared(spark, list(bitmaps))

        def count(batches: Iterator[pa.RecordBatch], known=known, lengths=lengths) -> Iterator[pa.RecordBatch]:
            for chunks in groups(batches, known.value):
                h, c = chunks.hashed_counts(lengths, hash_bits)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(c)], ["h", "c"])

        hashed = dictionary.mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
        bitmaps += [bitmap_of(hashed.filter(F.col("c") >= min_count), bits)] * len(lengths)      # one for all lengths of a pass
        free_shuffles(spark)
    known = Shared(spark, bitmaps)

    def count_exactly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunks in groups(batches, known.value):
            yield from chunks.exact_counts()

    exact = dictionary.mapInArrow(count_exactly, "lang string, phrase string, c long")
    return exact.groupBy("lang", "phrase").agg(F.sum("c").alias("f")).filter(F.col("f") >= min_count)


# ---- scores ---------------------------------------------------------------


def scored(spark: SparkSession, frequent: DataFrame) -> DataFrame:
    """lang, phrase, a and the lowest-scoring cut (score, k, l, r) of every candidate."""
    candidates = frequent.withColumn("words", F.size(F.split("phrase", " "))).filter("words > 1")
    cuts = candidates.select("lang", "phrase", F.col("f").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    sides = F.array(F.struct(F.lit("l").alias("side"), F.expr("substring_index(phrase, ' ', k)").alias("part")),
                    F.struct(F.lit("r").alias("side"), F.expr("substring_index(phrase, ' ', k - words)").alias("part")))
    parts = cuts.select("*", F.inline(sides)).withColumn("key", F.struct("lang", "part")).drop("part")
    parts = materialize(spark, parts, "phrase-parts")
    uses = parts.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    counts = frequent.select(F.struct("lang", F.col("phrase").alias("part")).alias("key"), "f").join(uses, "key")
    counts = materialize(spark, counts, "part-counts")
    found = join_sized(parts, counts, "key", parts.count())
    of = lambda side, k: F.max(F.when((F.col("side") == side) & (F.col("k") == k), F.col("f"))).alias(f"{side}{k}")
    found = found.groupBy("lang", "phrase", "a").agg(*(of(side, k) for k in range(1, LONGEST) for side in "lr"))

    def cut(k):
        score = F.expr(f"cast(({SCALE} * cast(a as decimal(20,0))) div (cast(l{k} as decimal(20,0)) + cast(r{k} as decimal(20,0))) as long)")
        return F.when(F.col(f"l{k}").isNotNull(), F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"),
                                                           F.col(f"r{k}").alias("r")))

    best = F.array_min(F.array(*map(cut, range(1, LONGEST))))
    return found.select("lang", "phrase", "a", best.alias("cut")).select("lang", "phrase", "a", "cut.*")


def covered(frequent: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """lang and phrase of the candidates inside a longer one that is nearly as frequent."""
    longer = frequent.withColumn("w", F.split("phrase", " ")).withColumn("n", F.size("w")).filter("n > 2")
    spans = F.array(*(F.struct(F.lit(s).alias("s"), F.lit(m).alias("m")) for m in range(2, LONGEST) for s in range(1, LONGEST - m + 2)))
    inner = longer.select("lang", "w", "n", "f", F.inline(spans)).filter("m < n and s + m - 1 <= n")
    inner = inner.groupBy("lang", F.expr("array_join(slice(w, s, m), ' ')").alias("phrase")).agg(F.max("f").alias("longest"))
    return inner.join(frequent, ["lang", "phrase"]).filter(
        F.col("longest").cast("decimal(20,0)") * 100 >= F.col("f").cast("decimal(20,0)") * percent).select("lang", "phrase")


def mine(spark: SparkSession, docs: DataFrame, min_count: int = MIN_COUNT, top: int = TOP, trigger: int = TRIGGER,
         bits: int = BITMAP_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the first ``top`` phrases of each language."""
    dictionary = materialize(spark, parse(spark, docs, trigger), "phrase-dictionary")
    free_shuffles(spark)
    frequent = materialize(spark, frequent_phrases(spark, dictionary, min_count, bits), "frequent-phrases")
    total = dictionary.groupBy("lang").agg(F.sum(F.col("c") * F.col("w")).alias("n"))
    left = scored(spark, frequent).join(covered(frequent), ["lang", "phrase"], "left_anti")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(16))).orderBy(*order)
    first = left.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    first = first.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    return first.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
