"""Read models: folding a log into one row per aggregate, merging deltas, rebuilding by replay."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import order_status
from ..functions.columns import position
from ..functions.json_fields import json_int
from ..schema import LOG_ORDER
from ..sources.tables import upsert, write_version

MERGE_RULES = {"status": "last", "amount": "max", "last_event_id": "last"}


def order_facts(events: DataFrame, amount: Column | None = None) -> DataFrame:
    """Order events as read-model values, one row per event."""
    return events.where(F.col("event_type").startswith("Order")).withColumns(
        {
            "order_id": F.col("aggregate_id"),
            "status": order_status("event_type"),
            "amount": json_int("payload", "amount") if amount is None else amount,
        }
    )


def fold_orders(facts: DataFrame, order: Iterable[str] = LOG_ORDER) -> DataFrame:
    """Last status, greatest amount and last event id per order.

    All three are combined inside each task before the shuffle, so an order that holds a third
    of the log still sends one row per task.
    """
    last = F.max_by(F.struct("status", "event_id"), position(order))
    return (
        facts.groupBy("order_id")
        .agg(last.alias("_last"), F.max("amount").alias("amount"))
        .select(
            "order_id",
            F.col("_last.status").alias("status"),
            "amount",
            F.col("_last.event_id").alias("last_event_id"),
        )
    )


def project_orders(
    events: DataFrame, order: Iterable[str] = LOG_ORDER, amount: Column | None = None
) -> DataFrame:
    return fold_orders(order_facts(events, amount), order)


def merge_orders(projection: DataFrame, delta: DataFrame) -> DataFrame:
    """Projection after a folded delta: new status and event id, the greater amount."""
    return upsert(projection, delta, "order_id", MERGE_RULES)


def rebuild(
    events: DataFrame,
    root: str,
    version: int,
    order: Iterable[str] = LOG_ORDER,
    amount: Column | None = None,
) -> None:
    """Projects the whole log into a new version. Readers keep the old one until it is complete."""
    write_version(project_orders(events, order, amount), root, version)


def diff(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Keys on which two versions differ, and how."""
    rest = [c for c in old.columns if c != key]
    a = old.select(key, F.struct(*rest).alias("before"))
    b = new.select(key, F.struct(*rest).alias("after"))
    change = (
        F.when(F.col("before").isNull(), "added")
        .when(F.col("after").isNull(), "removed")
        .otherwise("changed")
    )
    return (
        a.join(b, key, "full_outer")
        .where(~F.col("before").eqNullSafe(F.col("after")))
        .select(key, change.alias("change"), "before", "after")
    )
