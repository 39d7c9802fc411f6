"""Column sets shared by every module: log records, envelopes and the relational tables."""

from __future__ import annotations

from pyspark.sql import types as T

HEADERS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)

# The columns of Spark's Kafka source after the key and the value are cast to text.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("headers", HEADERS),
    ]
)

# Envelope fields in wire order; every one may be absent on read. The payload stays JSON text.
ENVELOPE_FIELDS = [
    ("eventId", "string"),
    ("eventType", "string"),
    ("eventVersion", "string"),
    ("occurredAt", "string"),
    ("producer", "string"),
    ("correlationId", "string"),
    ("aggregateId", "string"),
    ("payload", "string"),
]

# Position of a record in the total order used across partitions.
LOG_ORDER = ("timestamp", "partition", "offset")

# The tables and their columns.
TABLES = {
    "orders": "id string, status string, amount int, updated_at timestamp",
    "outbox": "id string, aggregate_id string, event_type string, payload string, "
    "published boolean, created_at timestamp",
    "inbox": "event_id string, processed_at timestamp",
    "billing_payments": "order_id string, amount int, created_at timestamp",
    "order_projection": "order_id string, status string, amount int, last_event_id string, "
    "updated_at timestamp",
}

# Fixed value: partitions of every topic.
PARTITIONS = 3
