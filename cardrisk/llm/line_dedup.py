"""Removal of lines that many documents share, by a streamed range sort of line hashes.

A line's key is the line without space and U+0009 to U+000D at both ends, A-Z
lower-cased. Keys of at least ``MIN_CHARS`` code points found in at least
``MIN_DOCS`` documents lose all their lines except in the largest id holding it.

1. Every long enough line becomes a narrow row: the key's 128-bit hash, the
   document, the line's place. Text is not carried on.
2. The rows are range-partitioned by (hash, id descending, place) and sorted so
   in each partition. As the whole order is the range key, a hash that a third
   of all lines share runs over many partitions instead of one.
3. A task streams its partition. The first document of a hash keeps its lines;
   those of the others are dropped from the fifth document on, and so are the
   few held back until then. What a partition cannot decide alone -- its first
   hash, which may have begun in the partition before, and its last, if that
   has not reached five documents -- leaves it undecided.
4. Each partition also tells, for its first and last hash, up to five documents
   that hold it. These notes, at most two per partition, are merged by hash and
   decide the undecided rows.
5. The dropped places of a document become one compressed bitmap of its lines
   (bit set: the line stays). Documents that lose nothing have no bitmap.

``keep_bitmaps`` returns the bitmaps, ``apply_bitmaps`` the documents without
the dropped lines, ``line_digests`` the digest columns of the registered query.

Defined results: a null or empty text is one empty line; rows that repeat an id
count as one document, and each loses its own lines; a null id is smaller than
every id and all null ids are one document; an empty table gives an empty
result; further columns are ignored by ``keep_bitmaps`` and kept by
``apply_bitmaps``. A task holds one batch of rows, and of a hash the rows of its
first four documents.
"""

from __future__ import annotations

import zlib
from typing import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..sources.storage import materialize
from .common import sha256_hex

MIN_CHARS = 40
MIN_DOCS = 5
ROWS_PER_RANGE = 250_000
SPACES = "".join(map(chr, [0x20, *range(0x09, 0x0E)]))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

DROP, OPEN, NOTE = 1, 2, 3
STREAMED = pa.schema([("kind", pa.int32()), ("h", pa.binary()), ("doc_id", pa.int64()), ("th", pa.int64()),
                      ("pos", pa.int32()), ("n_lines", pa.int32()), ("docs", pa.list_(pa.int64()))])
STREAMED_SQL = "kind int, h binary, doc_id long, th long, pos int, n_lines int, docs array<long>"


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """h, doc_id, th (hash of the text), pos and n_lines of every line whose key is long enough."""
    lines = F.split(F.coalesce("text", F.lit("")), "\n", -1)
    rows = docs.select("doc_id", F.xxhash64("text").alias("th"), lines.alias("lines")).select(
        "doc_id", "th", F.size("lines").alias("n_lines"), F.posexplode("lines").alias("pos", "line"))
    key = F.translate(F.btrim("line", F.lit(SPACES)), UPPER, LOWER)
    return rows.filter(F.length("line") >= min_chars).withColumn("key", key).filter(
        F.length("key") >= min_chars).select(F.unhex(F.md5("key")).alias("h"), "doc_id", "th", "pos", "n_lines")


class Run:
    """The rows of one hash in one partition, which come by descending id."""

    def __init__(self, h: bytes, first: bool):
        self.h, self.first = h, first
        self.docs: list = []               # its distinct documents, the largest first, as many as decide
        self.held: list[pa.Table] = []     # rows seen before there were enough documents

    def feed(self, rows: pa.Table, min_docs: int) -> tuple[int, pa.Table] | None:
        """Take further rows; what is decided by them, or must be left open."""
        if len(self.docs) < min_docs:
            for d in rows["doc_id"].unique().to_pylist()[:min_docs]:
                if d not in self.docs and len(self.docs) < min_docs:
                    self.docs.append(d)
        if self.first:
            return OPEN, rows
        self.held.append(rows)
        if len(self.docs) < min_docs:
            return None
        rows, self.held = pa.concat_tables(self.held), []
        return DROP, rows.filter(pc.fill_null(pc.not_equal(rows["doc_id"], self.docs[0]), True))


def marked(kind: int, rows: pa.Table) -> list[pa.RecordBatch]:
    n = rows.num_rows
    columns = {"kind": pa.array(np.full(n, kind, np.int32)), "docs": pa.nulls(n, pa.list_(pa.int64()))}
    return pa.table([columns.get(f.name, rows[f.name] if f.name in rows.column_names else None) for f in STREAMED],
                    schema=STREAMED).combine_chunks().to_batches() if n else []


def note(run: Run) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"kind": NOTE, "h": run.h, "docs": run.docs}], schema=STREAMED)


def stream_range(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """One sorted partition: dropped rows, undecided rows, and notes on its first and last hash."""
    run = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        rows = pa.Table.from_batches([batch])
        h = rows["h"].combine_chunks().cast(pa.binary(16))
        halves = np.frombuffer(h.buffers()[1], np.uint64, 2 * n, 16 * h.offset).reshape(n, 2)
        starts = np.flatnonzero(np.r_[True, (halves[1:] != halves[:-1]).any(1)])
        ends = np.r_[starts[1:], n]
        seen = ends - starts >= min_docs     # a shorter run inside the batch keeps its lines
        seen[0] = seen[-1] = True
        decided = {DROP: [], OPEN: []}
        for s, e in zip(starts[seen].tolist(), ends[seen].tolist()):
            key = h[s].as_py()
            if run is None or run.h != key:
                if run is not None and run.first:
                    yield note(run)
                run = Run(key, first=run is None)
            found = run.feed(rows.slice(s, e - s), min_docs)
            if found:
                decided[found[0]].append(found[1])
        for kind, parts in decided.items():
            if parts:
                yield from marked(kind, pa.concat_tables(parts))
    if run is not None:
        if run.held:
            yield from marked(OPEN, pa.concat_tables(run.held))
        yield note(run)


def dropped_lines(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                  rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, th, pos and n_lines of every line that goes."""
    lines = materialize(spark, line_rows(docs, min_chars), "line-hashes")
    order = [F.col("h"), F.col("doc_id").desc_nulls_last(), F.col("pos")]
    ranges = max(1, -(-lines.count() // rows_per_range))
    ordered = lines.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    streamed = ordered.mapInArrow(lambda batches: stream_range(batches, min_docs), STREAMED_SQL)
    streamed = materialize(spark, streamed, "line-verdicts")
    place = ["doc_id", "th", "pos", "n_lines"]
    merged = streamed.filter(F.col("kind") == NOTE).groupBy("h").agg(
        F.array_distinct(F.flatten(F.collect_list("docs"))).alias("docs"))
    # at most two notes per range, so this side is bounded by the number of ranges
    merged = F.broadcast(merged.filter(F.size("docs") >= min_docs).select("h", F.array_max("docs").alias("top")))
    late = streamed.filter(F.col("kind") == OPEN).join(merged, "h").filter(~F.col("doc_id").eqNullSafe(F.col("top")))
    return streamed.filter(F.col("kind") == DROP).select(*place).unionByName(late.select(*place))


def keep_bitmaps(spark: SparkSession, docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS,
                 rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    """doc_id, th (hash of the text), n_lines, n_dropped and ``keep``, a compressed bitmap of the lines that
    stay, of every document that loses lines."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            maps = []
            for n, gone in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                keep = np.ones(n, bool)
                keep[gone] = False
                maps.append(zlib.compress(np.packbits(keep).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pc.list_value_length(b.column(3)), pa.array(maps, pa.binary())],
                ["doc_id", "th", "n_lines", "n_dropped", "keep"])

    gone = dropped_lines(spark, docs, min_chars, min_docs, rows_per_range)
    gone = gone.groupBy("doc_id", "th", "n_lines").agg(F.collect_set("pos").alias("gone"))   # repeated rows: once
    return gone.mapInArrow(run, "doc_id long, th long, n_lines int, n_dropped int, keep binary")


def kept_text(text: str, keep: bytes) -> str:
    lines = text.split("\n")
    stay = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines)).tolist()
    return "\n".join([line for line, s in zip(lines, stay) if s])


@F.pandas_udf(StringType())
def _kept_text(text: pd.Series, keep: pd.Series) -> pd.Series:
    return pd.Series([None if k is None else kept_text(t, k) for t, k in zip(text, keep)], dtype=object)


@F.pandas_udf(StringType())
def _kept_digest(text: pd.Series, keep: pd.Series) -> pd.Series:
    return pd.Series([None if k is None else sha256_hex(kept_text(t, k).encode()) for t, k in zip(text, keep)], dtype=object)


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The documents with ``__lines``, ``__dropped`` and ``__keep`` (null where nothing goes).

    Bitmaps are hashed in each partition; the texts, shuffled once, are not sorted.
    """
    b = bitmaps.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("n_lines").alias("__lines"),
                       F.col("n_dropped").alias("__dropped"), F.col("keep").alias("__keep")).hint("shuffle_hash")
    own = docs.withColumn("__h", F.xxhash64("text"))
    return own.join(b, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__th")), "left").drop(
        "__id", "__th", "__h")


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The documents, all columns as they were, without the lines that their bitmaps drop."""
    j = with_bitmaps(docs, bitmaps)
    changed = _kept_text(F.when(F.col("__keep").isNotNull(), F.col("text")), "__keep")
    return j.withColumn("text", F.when(F.col("__keep").isNotNull(), changed).otherwise(F.col("text"))).select(*docs.columns)


def line_digests(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the digest of the text that stays."""
    docs = docs.select("doc_id", "text")
    j = with_bitmaps(docs, keep_bitmaps(spark, docs))
    text = F.coalesce("text", F.lit(""))
    digest = _kept_digest(F.when(F.col("__keep").isNotNull(), F.col("text")), "__keep")
    return j.select(
        "doc_id",
        F.coalesce("__lines", F.size(F.split(text, "\n", -1))).cast("long").alias("n_lines"),
        F.coalesce("__dropped", F.lit(0)).cast("long").alias("n_dropped"),
        F.coalesce(digest, F.sha2(text, 256)).alias("kept_sha256"))
