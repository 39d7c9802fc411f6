"""Topics of mixed event types: what is in them, and where each type should go."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.codes import switch


def type_mix(log: DataFrame) -> DataFrame:
    """Records per topic and event type."""
    return log.groupBy("topic", "event_type").agg(F.count("*").alias("records"))


def topic_summary(log: DataFrame) -> DataFrame:
    """Distinct event types per topic, from the counts rather than from the log."""
    return (
        type_mix(log)
        .groupBy("topic")
        .agg(
            F.count("*").alias("event_types"),
            F.array_join(F.array_sort(F.collect_list("event_type")), ",").alias("types"),
            F.sum("records").alias("records"),
        )
    )


def route(log: DataFrame, targets: Mapping[str, str], default: str | None = None) -> DataFrame:
    """Adds ``target``: the topic of the record's type, else ``default``, else its own topic."""
    rest = F.col("topic") if default is None else F.lit(default)
    return log.withColumn("target", switch(F.col("event_type"), targets, rest))
