"""Building and reading event envelopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import ENVELOPE_FIELDS
from .columns import as_col
from .json_fields import int_or, is_object, text_or

DECODED = (
    "event_id",
    "event_type",
    "event_version",
    "occurred_at",
    "producer",
    "correlation_id",
    "aggregate_id",
    "payload",
)


def stable_id(*parts: Column | str) -> Column:
    """Id derived from content, so that a job run again gives its events the same ids.

    Every part is told apart by its length, and NULL from any text, so that other parts never give the same id.
    """
    texts = [as_col(p).cast("string") for p in parts]
    told = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*told), 256)


def iso_instant(ts: Column | str) -> Column:
    return F.date_format(as_col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def build_envelope(
    event_id: Column,
    event_type: Column,
    aggregate_id: Column,
    payload: Column,
    occurred_at: Column,
    correlation_id: Column | None = None,
    version: int = 1,
    producer: str = "logweir",
) -> Column:
    """Envelope as JSON text. ``payload`` is a struct or map; its null fields are left out."""
    correlation = stable_id(event_id, F.lit("correlation")) if correlation_id is None else correlation_id
    return F.to_json(
        F.struct(
            event_id.alias("eventId"),
            event_type.alias("eventType"),
            F.lit(version).alias("eventVersion"),
            iso_instant(occurred_at).alias("occurredAt"),
            F.lit(producer).alias("producer"),
            correlation.alias("correlationId"),
            aggregate_id.alias("aggregateId"),
            payload.alias("payload"),
        )
    )


def _envelope_fields(payload_fields: list[str] | None) -> str:
    payload = "string"
    if payload_fields:
        payload = "struct<" + ", ".join(f"`{name}`: string" for name in payload_fields) + ">"
    return ", ".join(f"{n} {payload if n == 'payload' else t}" for n, t in ENVELOPE_FIELDS)


def parse_envelope(value: Column | str, payload_fields: list[str] | None = None) -> Column:
    """Envelope struct read in one pass over the text.

    Without ``payload_fields`` the payload stays JSON text. With them it becomes a struct of
    text fields, which saves a second parse when the wanted fields are known.
    """
    return F.from_json(as_col(value), _envelope_fields(payload_fields))


def parse_checked(value: Column | str, payload_fields: list[str] | None = None) -> Column:
    """As ``parse_envelope``, with a last field ``_bad`` that holds the text of doubtful records."""
    fields = f"{_envelope_fields(payload_fields)}, _bad string"
    return F.from_json(as_col(value), fields, {"columnNameOfCorruptRecord": "_bad"})


def readable(envelope: Column | str, value: Column | str) -> Column:
    """Whether the text behind a ``parse_checked`` struct is a JSON object.

    A record that parsed cleanly and has an event id is one. Only the others, which may be
    malformed or merely have a field of another type, are read a second time to find out.
    """
    parsed = as_col(envelope)
    clean = parsed["_bad"].isNull() & parsed["eventId"].isNotNull()
    return F.coalesce(clean, F.lit(False)) | is_object(value)


def decode_log(log: DataFrame, payload_fields: list[str] | None = None) -> DataFrame:
    """Log with the envelope promoted to columns, the form every operator takes.

    Stored this way, later filters on type or aggregate reach the parquet scan and parse nothing.
    Rows whose value is not a JSON object are left out here; ``split_valid`` keeps them.

    ``inline`` makes the parsed struct a row of its own. Catalyst does not move later filters
    below it, where it would parse the text a second time just to evaluate them.
    """
    kept = [c for c in log.columns if c != "value" and c not in DECODED]
    parsed = log.select(*kept, "value", parse_checked("value", payload_fields).alias("_e"))
    rows = parsed.select(*kept, F.inline(F.when(readable("_e", "value"), F.array("_e"))))
    return rows.select(
        *kept,
        text_or("eventId").alias("event_id"),
        text_or("eventType").alias("event_type"),
        int_or("eventVersion").alias("event_version"),
        F.try_to_timestamp(F.col("occurredAt")).alias("occurred_at"),
        "producer",
        F.col("correlationId").alias("correlation_id"),
        text_or("aggregateId").alias("aggregate_id"),
        "payload",
    )
