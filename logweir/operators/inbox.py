"""Applying events once: seen event ids are skipped, the first payment of an order stands."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.json_fields import json_int
from ..schema import LOG_ORDER
from ..sources.tables import insert_if_absent


def fresh_events(
    events: DataFrame,
    inbox: DataFrame,
    order: Iterable[str] = LOG_ORDER,
    event_type: str = "OrderPaid",
    amount: Column | None = None,
) -> DataFrame:
    """Events of a type that the inbox has not seen, each id once with its first delivery."""
    order = list(order)
    wanted = events.where(F.col("event_type") == event_type).select(
        "event_id",
        F.col("aggregate_id").alias("order_id"),
        (json_int("payload", "amount") if amount is None else amount).alias("amount"),
        *order,
    )
    return insert_if_absent(inbox, wanted, ["event_id"], order)


def first_payments(
    fresh: DataFrame, payments: DataFrame, order: Iterable[str] = LOG_ORDER
) -> DataFrame:
    """Payments to append: the first per order that has none yet."""
    order = list(order)
    offered = fresh.select("order_id", "amount", *order)
    return insert_if_absent(payments, offered, ["order_id"], order).select("order_id", "amount")


def apply_inbox(
    events: DataFrame,
    inbox: DataFrame,
    payments: DataFrame,
    order: Iterable[str] = LOG_ORDER,
    event_type: str = "OrderPaid",
    amount: Column | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Rows to append to the inbox and to the payments.

    An event that is new but whose order is already paid still enters the inbox. A job that
    stores both should store ``fresh_events`` first and derive the payments from what it stored,
    as the stream form does, so that the log is reduced once.
    """
    order = list(order)
    fresh = fresh_events(events, inbox, order, event_type, amount)
    return fresh.select("event_id"), first_payments(fresh, payments, order)
