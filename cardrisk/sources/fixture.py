"""Deterministic view of the provided ``events`` table as card transactions.

The reference ships no data; its producer is a simulator. Instead the given
``events`` table is mapped, row for row, onto the transaction record with
pure column expressions (no UDF, no driver round-trip), so the work grows
with the table. The same mapping is written in DuckDB SQL in
``cardrisk.plans.oracle`` for the correctness check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ACCEPTED_CURRENCIES, HIGH_RISK_CATEGORIES, PIPELINE_VERSION

# Fixed mapping parameters (see FIXTURES.md section 5).
FIXTURE_CATEGORIES = tuple(f"CATEGORY_{i}" for i in range(1, 10))   # without a rule of their own
CARDS_PER_USER_MOD = 5          # card = user_id mod 5: shared cards
DUPLICATE_EVERY = 40            # event_id mod 40 = 0 is delivered twice
DUPLICATE_DELAY_S = 60
DUPLICATE_OFFSET = 1_000_000
INJECT_EVERY = 20               # k mod 20 = 0 is a labelled anomaly (amount x 15)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a table as its files are split."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _categories() -> Column:
    return F.array(*[F.lit(c) for c in FIXTURE_CATEGORIES + HIGH_RISK_CATEGORIES])


def transactions(events: DataFrame, with_duplicates: bool = True) -> DataFrame:
    """Bronze-layer rows (wire fields + source metadata + ingest columns)."""
    k = F.get_json_object("props", "$.k").cast("int")
    eid = F.col("event_id")
    # Producer retries: every DUPLICATE_EVERY-th record is delivered twice
    # (later ingest, later offset). One scan; the copy comes from inline, which
    # brings k along: as a plain column it would be parsed again by every filter
    # and column that reads it.
    first, again = (F.struct(k.alias("_k"), F.lit(i).alias("_copy")) for i in (0, 1))
    copies = (F.when(eid % DUPLICATE_EVERY == 0, F.array(first, again)).otherwise(F.array(first))
              if with_duplicates else F.array(first))
    base = events.select(
        eid.alias("_eid"),
        F.col("ts").alias("event_time"),
        F.col("user_id").alias("_uid"),
        "event_type",
        "value",
        F.inline(copies),
    )
    k = F.col("_k")
    eid = F.col("_eid")
    cat = F.element_at(_categories(), (k % 12 + 1).cast("int"))
    country = (F.when(eid % 10 == 7, "CA").when(eid % 10 == 8, "GB")
               .when(eid % 10 == 9, "CN").otherwise("US"))
    currencies = F.array(*[F.lit(c) for c in ACCEPTED_CURRENCIES])
    out = base.select(
        F.concat(F.lit("txn_"), _pad(eid, 12)).alias("transaction_id"),
        F.concat(F.lit("card_"), _pad(F.col("_uid") % CARDS_PER_USER_MOD, 5)).alias("card_id"),
        F.concat(F.lit("user_"), _pad(F.col("_uid"), 5)).alias("user_id"),
        F.concat(F.lit("merch_"), _pad(k, 5)).alias("merchant_id"),
        F.concat(F.lit("  Merchant "), k.cast("string"), F.lit(" ")).alias("merchant_name"),
        F.when(eid % 7 == 0, F.concat(F.lit(" "), F.lower(cat), F.lit(" "))).otherwise(cat)
         .alias("merchant_category"),
        F.when(k % INJECT_EVERY == 0, F.round(F.col("value") * 15, 2))
         .otherwise(F.round(F.col("value"), 2)).alias("amount"),
        F.when(eid % 50 == 0, F.lit("XXX")).when(eid % 50 == 1, F.lit("usd "))
         .otherwise(F.element_at(currencies, (eid % 6 + 1).cast("int"))).alias("currency"),
        country.alias("country"),
        F.concat(F.lit(" City "), (k % 7).cast("string"), F.lit(" ")).alias("city"),
        F.concat(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00"))
         .alias("timestamp"),
        (country != "US").alias("is_international"),
        (F.col("event_type") != "click").alias("card_present"),
        F.when(F.col("event_type") == "click", " Mobile")
         .when(F.col("event_type") == "view", "desktop").otherwise("POS ").alias("device_type"),
        (k % INJECT_EVERY == 0).alias("_is_injected_anomaly"),
        (F.floor(eid / 3) + F.col("_copy") * DUPLICATE_OFFSET).cast("bigint").alias("kafka_offset"),
        (eid % 3).cast("bigint").alias("kafka_partition"),
        F.timestamp_add("MILLISECOND", k * 10, "event_time").alias("kafka_ingest_time"),
        "event_time",
        F.timestamp_add("SECOND", 2 + F.col("_copy") * DUPLICATE_DELAY_S, "event_time").alias("ingested_at"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
    )
    return out


def load_transactions(spark: SparkSession, sf_dir: str, with_duplicates: bool = True) -> DataFrame:
    return transactions(read_table(spark, sf_dir, "events"), with_duplicates)


# Kinds of malformed delivery, chosen by event_id so both engines agree.
# (modulus, remainder, kind) -- first match wins.
CORRUPTIONS = (
    (101, 1, "garbage"),
    (103, 2, "truncated"),
    (107, 3, "amount_text"),
    (109, 4, "missing_id"),
    (113, 5, "negative_amount"),
    (127, 6, "bad_timestamp"),
    (131, 7, "extra_field"),
)


def wire_records(events: DataFrame, with_duplicates: bool = True) -> DataFrame:
    """Raw deliveries: JSON payload + source metadata, some of them malformed."""
    tx = transactions(events, with_duplicates)
    eid = F.substring("transaction_id", 5, 12).cast("bigint")
    kind = F.lit(None).cast("string")
    for mod, rem, name in reversed(CORRUPTIONS):
        kind = F.when(eid % mod == rem, F.lit(name)).otherwise(kind)
    tx = tx.withColumn("_kind", kind)
    fields = []
    for f in ("transaction_id", "card_id", "user_id", "merchant_id", "merchant_name",
              "merchant_category", "amount", "currency", "country", "city", "timestamp",
              "is_international", "card_present", "device_type", "_is_injected_anomaly"):
        c = F.col(f)
        if f == "transaction_id":
            c = F.when(F.col("_kind") == "missing_id", F.lit(None).cast("string")).otherwise(c)
        elif f == "amount":
            c = F.when(F.col("_kind") == "negative_amount", -c).otherwise(c)
        elif f == "timestamp":
            c = F.when(F.col("_kind") == "bad_timestamp", F.lit("not-a-time")).otherwise(c)
        fields.append(c.alias(f))
    js = F.to_json(F.struct(*fields))
    js = (F.when(F.col("_kind") == "amount_text",
                 F.regexp_replace(js, '"amount":[-0-9.Ee]+', '"amount":"abc"'))
           .when(F.col("_kind") == "extra_field", F.regexp_replace(js, "^\\{", '{"promo_code":"X1",'))
           .when(F.col("_kind") == "truncated", F.substring(js, 1, 40))
           .when(F.col("_kind") == "garbage", F.concat(F.lit("not json at all "), F.col("transaction_id")))
           .otherwise(js))
    return tx.select(js.alias("value"), "kafka_offset", "kafka_partition", "kafka_ingest_time",
                     "ingested_at")
