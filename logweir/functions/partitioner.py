"""Placement of keys on partitions, by the public rule of the Kafka client's default partitioner."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_col

# Fixed values of 32-bit murmur2 as published: multiplier, shift and seed.
MULTIPLIER = 0x5BD1E995
SHIFT = 24
SEED = 0x9747B28C
WORD = 0xFFFFFFFF


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once however often ``body`` names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _times(value: Column) -> Column:
    # Two factors below 2^32 and 2^31 stay below 2^63, so bigint never overflows under ANSI.
    return (value * F.lit(MULTIPLIER)).bitwiseAND(F.lit(WORD))


def _fold(value: Column, bits: int) -> Column:
    return value.bitwiseXOR(F.shiftright(value, bits))


def _number(digits: Column, word: Column) -> Column:
    """Big-endian number of the four bytes at ``word``; bytes past the end count as zero."""
    piece = F.rpad(F.substring(digits, word * 8 + 1, F.lit(8)), 8, "0")
    return F.conv(piece, 16, 10).cast("bigint")


def _swapped(big: Column) -> Column:
    return (
        F.shiftright(big, 24)
        .bitwiseOR(F.shiftright(big, 8).bitwiseAND(F.lit(0xFF00)))
        .bitwiseOR(F.shiftleft(big, 8).bitwiseAND(F.lit(0xFF0000)))
        .bitwiseOR(F.shiftleft(big.bitwiseAND(F.lit(0xFF)), 24))
    )


def _mix(state: Column, scaled: Column) -> Column:
    return _times(state).bitwiseXOR(_times(_fold(scaled, SHIFT)))


def _hash(digits: Column) -> Column:
    size = F.shiftright(F.octet_length(digits), 1)
    words = F.shiftright(size, 2)
    start = F.lit(SEED).bitwiseXOR(size.cast("bigint"))
    numbers = F.transform(F.sequence(F.lit(0), words - 1), lambda i: _number(digits, i))
    scaled = F.transform(numbers, lambda big: _times(_swapped(big)))
    body = F.when(words > 0, F.aggregate(scaled, start, _mix)).otherwise(start)

    # One to three bytes may be left; they read as one more word.
    tail = _let(_number(digits, words), lambda big: _times(body.bitwiseXOR(_swapped(big))))
    mixed = F.when(size.bitwiseAND(F.lit(3)) == 0, body).otherwise(tail)
    return _let(_let(mixed, lambda h: _times(_fold(h, 13))), lambda h: _fold(h, 15))


def murmur2(key: Column | str) -> Column:
    """Unsigned murmur2 of the key's UTF-8 bytes, as bigint; NULL for a NULL key."""
    return _let(F.hex(F.encode(as_col(key), "UTF-8")), _hash)


def key_partition(
    key: Column | str, partitions: int, spread: Column | str | None = None
) -> Column:
    """Partition of a key. Rows without a key are spread by ``spread`` (an event id), if given."""
    placed = murmur2(key).bitwiseAND(F.lit(0x7FFFFFFF)) % F.lit(partitions)
    if spread is not None:
        # The last value is never reached; with it Catalyst knows that the result is not null.
        spread_out = F.pmod(F.xxhash64(as_col(spread)), F.lit(partitions))
        placed = F.coalesce(placed, spread_out, F.lit(0))
    return placed.cast("int")
