"""Reading fields of dynamic JSON with defaults, and telling presence from null."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_col


def text_or(value: Column | str, default: str = "") -> Column:
    """Text, or ``default`` where the field is missing or null."""
    return F.coalesce(as_col(value).cast("string"), F.lit(default))


def int_or(value: Column | str, default: int = 0) -> Column:
    """Whole number from number text: fractions are cut off, anything else gives ``default``.

    Going through double keeps ``12.9`` readable as 12; both casts are tolerant because an
    ANSI cast would stop the job on overflow.
    """
    return F.coalesce(as_col(value).try_cast("double").try_cast("int"), F.lit(default))


def long_or(value: Column | str, default: int = 0) -> Column:
    """As ``int_or`` for identifiers, 64 bits wide and exact; numbers beyond that are NULL.

    A number beyond 64 bits must not turn into the default, which is an id like any other.
    """
    text = as_col(value)
    whole = text.try_cast("decimal(38,9)").try_cast("bigint")
    return F.when(text.try_cast("double").isNull(), F.lit(default).cast("bigint")).otherwise(whole)


def json_text(doc: Column | str, path: str, default: str = "") -> Column:
    return text_or(F.get_json_object(as_col(doc), f"$.{path}"), default)


def json_int(doc: Column | str, path: str, default: int = 0) -> Column:
    return int_or(F.get_json_object(as_col(doc), f"$.{path}"), default)


def json_fields(doc: Column | str, names: Iterable[str]) -> Column:
    """Struct of several text fields, read in one pass over the text; NULL where absent."""
    return F.from_json(as_col(doc), ", ".join(f"`{name}` string" for name in names))


def field_names(doc: Column | str) -> Column:
    """Names present in a JSON object, explicit nulls included; NULL for anything but an object."""
    return F.json_object_keys(as_col(doc))


def is_object(doc: Column | str) -> Column:
    return field_names(doc).isNotNull()


def missing_fields(doc: Column | str, required: Iterable[str]) -> Column:
    """Required names that are absent; all of them where ``doc`` is not an object."""
    wanted = F.array(*[F.lit(name) for name in required])
    return F.array_except(wanted, F.coalesce(field_names(doc), F.array().cast("array<string>")))


def has_fields(doc: Column | str, required: Iterable[str]) -> Column:
    return F.size(missing_fields(doc, required)) == 0
