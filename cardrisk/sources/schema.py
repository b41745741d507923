"""Wire and layer schemas."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

# The JSON record on the wire. Six fields are required by the producer
# contract, but from_json yields nullable columns, so every field is nullable
# here and the critical-field predicate (bronze) does the enforcing.
TRANSACTION_SCHEMA = StructType([
    StructField("transaction_id", StringType()),
    StructField("card_id", StringType()),
    StructField("user_id", StringType()),
    StructField("merchant_id", StringType()),
    StructField("merchant_name", StringType()),
    StructField("merchant_category", StringType()),
    StructField("amount", DoubleType()),
    StructField("currency", StringType()),
    StructField("country", StringType()),
    StructField("city", StringType()),
    StructField("timestamp", StringType()),
    StructField("is_international", BooleanType()),
    StructField("card_present", BooleanType()),
    StructField("device_type", StringType()),
    StructField("_is_injected_anomaly", BooleanType()),
])

WIRE_FIELDS = [f.name for f in TRANSACTION_SCHEMA.fields]

# A raw record as delivered by the transport: payload plus source metadata.
RAW_SCHEMA = StructType([
    StructField("value", StringType()),
    StructField("kafka_offset", LongType()),
    StructField("kafka_partition", LongType()),
    StructField("kafka_ingest_time", TimestampNTZType()),
    StructField("ingested_at", TimestampNTZType()),
])

SOURCE_META = ["kafka_offset", "kafka_partition", "kafka_ingest_time"]
