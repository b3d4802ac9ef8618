"""Schemas of every table the job reads or writes."""

from pyspark.sql import types as T

# Row shape of a message log, as Spark's Kafka source delivers it.
MESSAGE_LOG = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# JSON object carried by a message value. The field names.
ENVELOPE = T.StructType(
    [
        T.StructField("@metadata", T.StringType()),
        T.StructField("@timestamp", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("well_id", T.StringType()),
    ]
)

# Messages that give no envelope field, as they came, and why.
REJECTS = T.StructType([*MESSAGE_LOG.fields, T.StructField("reason", T.StringType())])

# JSON object carried by the payload text: a contract, never inferred from data.
PAYLOAD = T.StructType([T.StructField("value", T.DoubleType())])

RAW = ENVELOPE
RAW_NESTED = T.StructType([T.StructField("value", ENVELOPE)])

CURATED = T.StructType(
    [
        *RAW.fields,
        T.StructField("partition_id", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

# Per group: what is needed to merge averages across batches. A batch stores its own
# version of each date that it touched.
PARTIALS = T.StructType(
    [
        T.StructField("well_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("event_hour", T.TimestampType()),
        T.StructField("value_sum", T.DoubleType()),
        T.StructField("value_count", T.LongType()),
        T.StructField("event_date", T.StringType()),
        T.StructField("batches", T.StringType()),
    ]
)
PARTIALS_PARTITIONS = ["event_date", "batches"]

# Hours that a batch touched and that the hourly table has yet to take over.
TOUCHED = T.StructType(
    [
        T.StructField("event_date", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("event_hour", T.TimestampType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

# Metrics whose averages changed and that a database has yet to take over.
CHANGES = T.StructType([T.StructField("name", T.StringType())])

# What a batch of a stage wrote, counted while it wrote: a row per physical partition
# (``name`` is NULL and ``partition_id`` is not) and one per name of a message
# (``partition_id`` is NULL).
COUNTS = T.StructType(
    [
        T.StructField("partition_id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("messages", T.LongType()),
        T.StructField("rejected", T.LongType()),
        T.StructField("counted_at", T.StringType()),
        T.StructField("stage", T.StringType()),
        T.StructField("batch_id", T.LongType()),
    ]
)
COUNTS_PARTITIONS = ["stage", "batch_id"]

# Averages of open hours as batches saw them; the newest of a group counts.
LIVE = T.StructType(
    [
        T.StructField("well_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("event_hour", T.TimestampType()),
        T.StructField("hourly_avg_value", T.DoubleType()),
        T.StructField("readings", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

HOURLY = T.StructType(
    [
        T.StructField("well_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField("hour", T.IntegerType()),
        T.StructField("hourly_avg_value", T.DoubleType()),
    ]
)
HOURLY_PARTITIONS = ["name", "year", "month", "day", "hour"]
