"""Events that carry a fact only, and events that carry the whole state."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from ..sources.tables import last_per_key


def enrich_facts(facts: DataFrame, state: DataFrame, on: str) -> DataFrame:
    """Facts with the state they refer to; facts without one are kept.

    ``state`` has one row per key. It is broadcast only if Catalyst's own size check allows it;
    beyond that the join is sort-merge, and a hot key of the facts is split by adaptive
    execution, which copies that key's single state row to each part.
    """
    return facts.join(state, on, "left")


def latest_state(states: DataFrame, keys: Iterable[str], version: str = "version") -> DataFrame:
    """The state with the highest version per key: no lookup is needed."""
    return last_per_key(states, keys, [version])
