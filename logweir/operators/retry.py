"""Bounded retries: each tier processes a record, forwards it to the next, or buries it."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import error_headers, error_text
from ..functions.json_fields import is_object, json_text


@dataclass(frozen=True)
class Tier:
    """One pass over ``topic``; failures go on to ``next_topic``."""

    topic: str
    next_topic: str
    attempt: int


DEAD_LETTERS = "orders.dlt"
TIERS = (
    Tier("orders.events", "orders.retry.1", 1),
    Tier("orders.retry.1", "orders.retry.2", 2),
    Tier("orders.retry.2", DEAD_LETTERS, 3),
)

# The attempt from which a case goes through, and the case that never does.
SUCCEEDS_FROM = {"ok": 1, "temporary": 2, "temporary-long": 3}
FATAL = "poison"
QUARANTINED = "quarantined"


def case_of(payload: Column | str = "payload") -> Column:
    return json_text(payload, "case", "ok")


def succeeds(case: Column, attempt: int) -> Column:
    return case.isin(*[name for name, first in SUCCEEDS_FROM.items() if attempt >= first])


def _with_case(records: DataFrame, case: Column | None) -> tuple[Column, DataFrame]:
    """The case as a column of its own, so that the text is searched once however often it is named.

    NULL stands for a payload that is no JSON object: no tier can process it and none would later,
    so it is quarantined at the first.
    """
    read = F.when(is_object("payload"), case_of()) if case is None else case
    return F.col("_case"), records.withColumn("_case", read)


def retry_stage(
    records: DataFrame, tier: Tier, dead_letters: str = DEAD_LETTERS, case: Column | None = None
) -> DataFrame:
    """One tier: adds ``outcome``, and for failures the ``target`` topic and new ``headers``."""
    kind, rows = _with_case(records, case)
    good = succeeds(kind, tier.attempt)
    target = F.when(kind == FATAL, F.lit(dead_letters)).otherwise(F.lit(tier.next_topic))
    return rows.withColumns(
        {
            "outcome": F.when(kind.isNull(), F.lit(QUARANTINED))
            .when(good, F.lit("processed"))
            .otherwise(F.lit("forwarded")),
            "target": F.when(~good, target),
            "headers": F.when(~good, error_headers(error_text(kind, tier.attempt))),
        }
    ).drop("_case")


def _final(case: Column, tiers: Sequence[Tier], dead_letters: str) -> Column:
    """Struct (outcome, attempt, x_error) a record ends with, read off the last tier backwards.

    ``x_error`` is the header of the last record written for the event, so a record that went
    through on a later attempt carries the one of the attempt before.
    """

    def result(outcome: str, attempt: int, error_of: int | None) -> Column:
        error = F.lit(None).cast("string") if error_of is None else error_text(case, error_of)
        return F.struct(
            F.lit(outcome).alias("outcome"), F.lit(attempt).alias("attempt"), error.alias("x_error")
        )

    chain = None
    unread = F.when(case.isNull(), result(QUARANTINED, tiers[0].attempt, None))
    for i in reversed(range(len(tiers))):
        tier, previous = tiers[i], tiers[i - 1].attempt if i else None
        dead = result("dlt", tier.attempt, tier.attempt)
        step = F.when(succeeds(case, tier.attempt), result("processed", tier.attempt, previous))
        if tier.next_topic == dead_letters:
            chain = step.otherwise(dead)
            continue
        if chain is None:
            raise ValueError("the last tier must send its failures to the dead letters")
        chain = step.when(case == FATAL, dead).otherwise(chain)
    return unread.otherwise(chain)


def retry_chain(
    records: DataFrame,
    tiers: Sequence[Tier] = TIERS,
    dead_letters: str = DEAD_LETTERS,
    case: Column | None = None,
) -> DataFrame:
    """All tiers at once: every record with its final ``outcome``, ``attempt`` and ``x_error``.

    The outcome depends on the record alone, so the tiers are one expression over one scan
    rather than a chain of topics read again.
    """
    kind, rows = _with_case(records, case)
    return rows.withColumn("_end", _final(kind, tiers, dead_letters)).select(
        *records.columns, "_end.outcome", "_end.attempt", "_end.x_error"
    )


def retry_hops(
    records: DataFrame,
    tiers: Sequence[Tier] = TIERS,
    dead_letters: str = DEAD_LETTERS,
    case: Column | None = None,
) -> DataFrame:
    """Every record the tiers write: ``target`` topic, ``attempt`` and ``x_error`` per hop."""
    kind, rows = _with_case(records, case)
    hops = []
    reached = F.lit(True)
    for tier in tiers:
        fails = reached & ~succeeds(kind, tier.attempt)
        target = F.when(kind == FATAL, F.lit(dead_letters)).otherwise(F.lit(tier.next_topic))
        hop = F.struct(
            target.alias("target"),
            F.lit(tier.attempt).alias("attempt"),
            error_text(kind, tier.attempt).alias("x_error"),
        )
        hops.append(F.when(fails, hop))
        reached = fails & (target != dead_letters)
    written = F.filter(F.array(*hops), lambda hop: hop.isNotNull())
    return rows.withColumn("_hop", F.explode(written)).select(*records.columns, "_hop.*")


def dead_letter_report(finals: DataFrame) -> DataFrame:
    """Dead letters counted by reason.

    Counting with a condition, rather than filtering first, keeps Catalyst from evaluating the
    outcome of every record twice, once in the filter and once above it.
    """
    dead = F.count_if(F.col("outcome") == "dlt")
    return finals.groupBy("x_error", "attempt").agg(dead.alias("records")).where("records > 0")
