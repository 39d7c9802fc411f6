"""Sagas as streams: how far each has come, and which came to rest unfinished."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.saga import ORDER_STEPS, described, step_folds, step_rows


def saga_steps_stream(events: DataFrame, steps: Sequence[str] = ORDER_STEPS) -> DataFrame:
    """Steps seen per saga, for update mode: the aggregate of ``saga_progress`` without its clock.

    State is one row per saga. What stuck means depends on when it is asked, so it is left to
    ``described`` on what a reader finds.
    """
    return step_rows(events, steps).groupBy("aggregate_id").agg(*step_folds(steps))


def saga_sessions(
    events: DataFrame, quiet: str, delay: str, steps: Sequence[str] = ORDER_STEPS
) -> DataFrame:
    """Sagas that came to rest, for append mode: one row once ``quiet`` has passed since the last step.

    A saga's events form a session that each further step prolongs. Events may come ``delay`` late and
    any number of times; when the watermark passes the session's end its row is given and its
    state dropped, so state holds the sagas under way and no others. ``stuck`` marks those that rest unfinished. A saga
    that goes on after a longer pause is given again, with the steps since then.
    """
    rows = step_rows(events, steps).withWatermark("timestamp", delay)
    session = F.session_window("timestamp", quiet).alias("session")
    folded = rows.groupBy("aggregate_id", session).agg(*step_folds(steps))
    return described(folded, F.lit(True), steps)
