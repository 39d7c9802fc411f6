"""Enrichment of streams: facts that wait for the state they speak of, or look it up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.facts import enrich_facts


def facts_with_table(facts: DataFrame, state: DataFrame, on: str) -> DataFrame:
    """A stream of facts beside a table of state, one row per key, read anew in every micro-batch.

    Facts whose key the table lacks are given at once without state. Nothing is kept in a state store.
    """
    return enrich_facts(facts, state, on)


def facts_with_stream(
    facts: DataFrame,
    states: DataFrame,
    on: str,
    within: str,
    facts_delay: str,
    states_delay: str,
    fact_time: str = "timestamp",
    state_time: str = "state_at",
    fact_id: str = "event_id",
    state_id: str = "state_id",
) -> DataFrame:
    """Facts with the states of their key at most ``within`` before or after them, both streams.

    A fact waits for its state; once the watermark says that none can come any more it is given without one. Both sides
    may be late by their own delay and delivered again: repeats are dropped while their first delivery can still be remembered,
    and later than that they are late and dropped as such. The bound on the time between the two is what lets state rows go.
    After a restart a side that brings nothing new holds the common watermark where it was, so facts may wait longer.
    """
    left = facts.withWatermark(fact_time, facts_delay).dropDuplicatesWithinWatermark([fact_id])
    right = states.withWatermark(state_time, states_delay).dropDuplicatesWithinWatermark([state_id])
    right = right.withColumnRenamed(on, "_state_key")
    span = F.expr(f"interval {within}")
    near = (F.col(state_time) >= F.col(fact_time) - span) & (F.col(state_time) <= F.col(fact_time) + span)
    return left.join(right, (F.col(on) == F.col("_state_key")) & near, "left_outer").drop("_state_key")
