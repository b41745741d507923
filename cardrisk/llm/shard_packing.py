"""Sharding by vector bin packing.

Rows with equal texts form a group. Groups are placed, largest first, in the
shard where the dot product of the group's vector (bytes, tokens, rows; each
as a share of the total) with the shard's residual capacity is highest.

What is placed is bounded, whatever the input: groups holding less than
1 / (shards * PIECES) of every measure are combined by hash into at most
2 * ``bundles`` bundles that are placed as one; larger groups, of which there
can be at most 3 * shards * PIECES, are placed by themselves, whole up to a quarter of a shard; those above are cut into
parts of about that size, as no shard could hold a group of a third of all
rows and stay balanced. A sixteenth of the bundles is
dealt into sixteen times finer ones, which are placed last and level the rest.
So the driver sees sums of at most a few thousand items and sends back one
shard and one first slot for each; rows are numbered inside their item.

The law kept is ``bytes``: shards are nearly equal in bytes, and by the joint
placing nearly so in tokens and rows.

Defined results: a null text has size 1 and the checksum 0, and null texts
form one group; null ids and repeated rows are rows like any other; an empty
table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import materialize

PIECES = 64      # rows are numbered in pieces of no more than about 1/64 of a shard
TOGETHER = 16    # pieces of a group that are placed as one: up to a quarter of a shard
FINE = 16


def place(vectors: np.ndarray, n_shards: int, level: float = 0.125) -> np.ndarray:
    """Shard of each item; ``vectors`` holds shares of the total of each measure.

    The smallest ``level`` of the items, a far smaller share of the total, fill
    the shard with the most room in the first measure, whose law is kept.
    """
    load = np.zeros((n_shards, vectors.shape[1]))
    out = np.zeros(len(vectors), np.int64)
    order = np.argsort(-vectors.max(1, initial=0), kind="stable")
    for rank, i in enumerate(order):
        room = 1.0 / n_shards - load
        s = int(np.argmax(room @ vectors[i] if rank < (1 - level) * len(order) else room[:, 0]))
        out[i] = s
        load[s] += vectors[i]
    return out


def pack_documents(spark: SparkSession, docs: DataFrame, n_shards: int = 8, bundles: int = 2048) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        "doc_id", (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("tokens"),
        F.xxhash64("text", F.lit(1)).alias("g"), F.xxhash64(F.lit(2), "text").alias("g2"))
    # Written once: the salt below must stay the same when a lost task is run again.
    rows = materialize(spark, rows.withColumn("salt", F.monotonically_increasing_id()), "shard-rows")

    total = rows.agg(F.sum("size"), F.sum("tokens"), F.count(F.lit(1))).first()
    total = [max(1, x or 0) for x in total]
    least = [-(-t // (n_shards * PIECES)) for t in total]
    sums = [F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")]
    # at most 3 * n_shards * PIECES groups reach this share of a measure
    share = F.greatest(*(F.col(c) / F.lit(x) for c, x in zip(("b", "t", "n"), least)))
    large = (rows.groupBy("g", "g2").agg(*sums).filter(share >= 1)
                 .select("g", "g2", F.ceil(share).cast("int").alias("cuts"),
                         F.row_number().over(Window.orderBy("g", "g2")).alias("large")))
    deal = F.pmod("g", F.lit(bundles * FINE))
    coarse = F.floor(deal / FINE)
    bundle = F.when(coarse < bundles - bundles // FINE, coarse).otherwise(F.lit(bundles) + deal)
    item = F.when(F.col("large").isNull(), F.struct(F.lit(-1).alias("large"), bundle.cast("long").alias("part"))) \
            .otherwise(F.struct(F.col("large"), F.pmod(F.xxhash64("salt"), F.col("cuts")).cast("long").alias("part")))
    # ``large`` is bounded as said above, hence the broadcast
    rows = rows.join(F.broadcast(large), ["g", "g2"], "left").withColumn("item", item).drop("large", "cuts")

    items = rows.groupBy("item").agg(*sums).orderBy("item").collect()
    vectors = np.array([[r.b, r.t, r.n] for r in items], float).reshape(-1, 3) / np.array(total, float)
    units: dict[tuple, int] = {}
    unit = np.array([units.setdefault((r.item.large, r.item.part // TOGETHER if r.item.large > 0 else r.item.part), len(units))
                     for r in items], np.int64)
    together = np.zeros((len(units), 3))
    np.add.at(together, unit, vectors)
    shard = place(together, n_shards)[unit]
    first = np.zeros(len(items), np.int64)
    for s in range(n_shards):
        at = np.flatnonzero(shard == s)
        first[at] = np.cumsum([0, *(items[i].n for i in at)])[:-1]
    placed = spark.createDataFrame(
        [((r.item.large, r.item.part), int(s), int(f)) for r, s, f in zip(items, shard, first)],
        "item struct<large:int,part:bigint>, shard int, first long")
    slot = F.col("first") + F.row_number().over(Window.partitionBy("item").orderBy("doc_id", "salt")) - 1
    return rows.join(F.broadcast(placed), "item").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
