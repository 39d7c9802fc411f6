"""Keyed publishing: order numbers become placed-order records keyed by user."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import PRODUCTS, cyclic, user_of_order
from ..functions.envelope import build_envelope, stable_id


def placed_orders(numbers: DataFrame, number: str, topic: str = "orders.events") -> DataFrame:
    """One record per order number, keyed by user; ``placed_value`` is its text."""
    rows = numbers.withColumns(
        {
            "topic": F.lit(topic),
            "order_id": F.col(number),
            "user_id": user_of_order(number),
            "product": cyclic(PRODUCTS, number),
        }
    )
    return rows.withColumn("key", F.col("user_id").cast("string"))


def placed_value(occurred_at: Column) -> Column:
    """Envelope of a placed order, over the columns of ``placed_orders``."""
    kind = F.lit("OrderPlaced")
    aggregate = F.concat(F.lit("order-"), F.col("order_id").cast("string"))
    payload = F.struct(
        F.col("order_id").alias("orderId"), F.col("user_id").alias("userId"), F.col("product")
    )
    return build_envelope(stable_id(kind, aggregate), kind, aggregate, payload, occurred_at)
