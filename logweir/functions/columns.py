"""Small helpers over Column."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def position(order: Iterable[str]) -> Column:
    """One comparable value for a sequence of order columns."""
    names = list(order)
    return F.col(names[0]) if len(names) == 1 else F.struct(*names)
