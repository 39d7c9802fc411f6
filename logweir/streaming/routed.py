"""Routing a topic of mixed event types as a stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..functions.json_fields import is_object, missing_fields
from ..operators.routing import route
from .queries import write_append


def routed(
    log: DataFrame, targets: Mapping[str, str], required: Mapping[str, Sequence[str]], default: str | None = None
) -> DataFrame:
    """``log`` with its ``topic`` replaced by that of the record's type, and the ``reason`` why a record is refused.

    ``required`` names the payload fields that a type's readers need. A record whose payload is no object or lacks one of
    them goes to ``<topic>.quarantine``. A field that is there and null is there.
    """
    lacks = F.array().cast("array<string>")
    for kind, fields in required.items():
        lacks = F.when(F.col("event_type") == kind, missing_fields("payload", fields)).otherwise(lacks)
    reason = F.when(~is_object("payload"), F.lit("payload is no object")).when(
        F.size(lacks) > 0, F.concat(F.lit("missing "), F.array_join(lacks, ", "))
    )
    rows = route(log, targets, default).withColumn("reason", reason)
    topic = F.when(F.col("reason").isNull(), F.col("target")).otherwise(F.concat("target", F.lit(".quarantine")))
    return rows.withColumn("topic", topic).drop("target")


def write_routed(
    log: DataFrame,
    root: str,
    checkpoint: str,
    targets: Mapping[str, str],
    required: Mapping[str, Sequence[str]],
    default: str | None = None,
) -> DataStreamWriter:
    """One query over one source and one folder per topic below ``root``.

    Spark's file sink lists the files of a micro-batch when it is complete: a batch that is tried again after a stop adds
    nothing twice, and readers never see half of one. Rows are not shuffled: each task writes what it has of each topic.
    """
    return write_append(routed(log, targets, required, default), root, checkpoint, partition_by=["topic"])


def read_routed(spark: SparkSession, root: str, topic: str | None = None) -> DataFrame:
    """What has been routed; of one topic only that folder is read."""
    rows = spark.read.parquet(root)
    return rows if topic is None else rows.where(F.col("topic") == topic)
