"""Can a reader that is already deployed still read these events?"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.json_fields import missing_fields

# What the deployed reader of customer events looks up.
CUSTOMER_READER = ("customerId", "name")


def check_contract(
    events: DataFrame, required: Iterable[str] = CUSTOMER_READER, payload: str = "payload"
) -> DataFrame:
    """Adds the ``missing`` field names and ``compatible``. A field set to null is present."""
    return events.withColumn("missing", missing_fields(payload, required)).withColumn(
        "compatible", F.size("missing") == 0
    )


def contract_summary(checked: DataFrame) -> DataFrame:
    """Compatible and breaking events per type and version."""
    return checked.groupBy("event_type", "event_version").agg(
        F.count("*").alias("events"),
        F.count_if("compatible").alias("compatible_events"),
        F.count_if(~F.col("compatible")).alias("breaking_events"),
    )
