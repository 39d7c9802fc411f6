"""Code tables of the order domain as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_col

# Read-model status of an event type; any other type is its own status.
STATUS_OF = {"OrderCreated": "CREATED", "OrderPaid": "PAID", "OrderConfirmed": "CONFIRMED"}

# User of an order by order number modulo 3.
USER_OF = {0: 30, 1: 10}
OTHER_USER = 20

# Products handed out in turn.
PRODUCTS = [
    "Keyboard",
    "Mouse",
    "Monitor",
    "Laptop",
    "Headphones",
    "Tablet",
    "Printer",
    "Scanner",
    "Speaker",
    "Camera",
    "Drone",
    "Smartwatch",
]

ERROR_HEADER = "x-error"


def switch(value: Column, cases: Mapping, default: Column) -> Column:
    """First matching case, or ``default``."""
    chosen = None
    for match, result in cases.items():
        hit = value == F.lit(match)
        chosen = F.when(hit, F.lit(result)) if chosen is None else chosen.when(hit, F.lit(result))
    return default if chosen is None else chosen.otherwise(default)


def order_status(event_type: Column | str) -> Column:
    kind = as_col(event_type)
    return switch(kind, STATUS_OF, kind)


def user_of_order(order_id: Column | str) -> Column:
    return switch(F.pmod(as_col(order_id), F.lit(3)), USER_OF, F.lit(OTHER_USER))


def cyclic(items: Sequence[str], number: Column | str) -> Column:
    """Item for a number counted from 1, starting over after the last."""
    slot = F.pmod(as_col(number) - 1, F.lit(len(items))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(item) for item in items]), slot)


def error_text(case: Column, attempt: Column | int) -> Column:
    tried = F.lit(attempt) if isinstance(attempt, int) else attempt
    return F.concat(F.lit("case="), case, F.lit("; attempt="), tried.cast("string"))


def error_headers(text: Column) -> Column:
    """The one header a forwarded record carries; each hop replaces it."""
    header = F.struct(F.lit(ERROR_HEADER).alias("key"), F.encode(text, "UTF-8").alias("value"))
    return F.array(header)


def header_text(headers: Column | str, name: str = ERROR_HEADER) -> Column:
    """Value of the last header called ``name``, or NULL."""
    hits = F.filter(as_col(headers), lambda h: h["key"] == F.lit(name))
    return F.decode(F.try_element_at(hits, F.lit(-1))["value"], "UTF-8")
