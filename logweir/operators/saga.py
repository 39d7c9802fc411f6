"""Choreographed sagas: which event answers which, and how far each saga has come."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.envelope import stable_id
from ..session import lookup_table
from ..sources.tables import first_per_key


@dataclass(frozen=True)
class Rule:
    """``trigger`` read from ``topic`` is answered by ``reply`` on ``reply_topic``."""

    topic: str
    trigger: str
    reply_topic: str
    reply: str


ORDER_SAGA = (
    Rule("orders.events", "OrderCreated", "payments.events", "PaymentReserved"),
    Rule("payments.events", "PaymentReserved", "warehouse.events", "StockReserved"),
    Rule("warehouse.events", "StockReserved", "orders.events", "OrderConfirmed"),
)
ORDER_STEPS = ("OrderCreated", "PaymentReserved", "StockReserved", "OrderConfirmed")


def _reachable(rules: Sequence[Rule]) -> list[tuple[str, str, str, str, list[str]]]:
    """Every reply a trigger leads to, directly or through other replies, with the reply types on the way.

    A path stops where it would answer the same event twice, so circular rules end.
    """
    found = []
    for start in {(r.topic, r.trigger) for r in rules}:
        open_ends, seen = [(start, [])], {start}
        while open_ends:
            further = []
            for at, path in open_ends:
                for r in rules:
                    end = (r.reply_topic, r.reply)
                    if (r.topic, r.trigger) == at and end not in seen:
                        seen.add(end)
                        further.append((end, [*path, r.reply]))
            open_ends = further
            found += [(*start, *end, path) for end, path in open_ends]
    return sorted(found)


def _id_after(path: Column) -> Column:
    """Id of the event at the end of a path: each reply's id is derived from the one it answers."""
    return F.aggregate(path, F.col("event_id"), lambda done, reply: stable_id(done, reply))


def saga_replies(
    events: DataFrame, rules: Sequence[Rule] = ORDER_SAGA, payload: Column | None = None
) -> DataFrame:
    """The events the rules still have to emit for a log, hop by hop, keyed like their trigger.

    The rules are followed to the end on the driver, where they are a handful, so the log is
    joined with them once however many hops a saga has. The payload is carried along. A reply's id
    comes from the id of the event it answers (``caused_by``), so it is the same whether that event
    is in the log already or emitted with it. Replies whose id the log has are left out, and one that
    several events of a saga lead to counts from the nearest (``hop``): a log together with all its
    replies gives none.
    """
    table = lookup_table(
        events.sparkSession,
        _reachable(rules),
        "topic string, event_type string, reply_topic string, reply_type string, path array<string>",
    )
    replies = events.join(table, ["topic", "event_type"]).select(
        F.col("reply_topic").alias("topic"),
        F.col("aggregate_id").alias("key"),
        "aggregate_id",
        F.col("reply_type").alias("event_type"),
        F.size("path").alias("hop"),
        _id_after(F.slice("path", 1, F.size("path") - 1)).alias("caused_by"),
        _id_after(F.col("path")).alias("event_id"),
        (F.col("payload") if payload is None else payload).alias("payload"),
    )
    # Reduced inside each task first, and the anti-join finds the rows where the reduction has put them.
    first = first_per_key(replies, ["event_id"], ["hop"])
    emitted = events.where(F.col("event_type").isin(*sorted({r.reply for r in rules}))).select("event_id")
    return first.join(emitted, "event_id", "left_anti").select(*replies.columns)


def step_rows(events: DataFrame, steps: Sequence[str] = ORDER_STEPS) -> DataFrame:
    """The events that are steps of a saga, with the number of the step."""
    number = F.lit(0)
    for i, step in enumerate(steps, start=1):
        number = F.when(F.col("event_type") == step, F.lit(i)).otherwise(number)
    rows = events.where(F.col("event_type").isin(*steps))
    return rows.select("aggregate_id", "timestamp", number.alias("_step"))


def step_folds(steps: Sequence[str] = ORDER_STEPS) -> list[Column]:
    """What a saga's steps amount to. Maxima of fixed width: repeated and late events change nothing, and a hot saga
    sends one row per task."""
    seen = [F.max(F.col("_step") == i).alias(f"step_{i}") for i in range(1, len(steps) + 1)]
    return [F.max("_step").alias("furthest"), F.max("timestamp").alias("_last_at"), *seen]


def described(folded: DataFrame, late: Column, steps: Sequence[str] = ORDER_STEPS) -> DataFrame:
    """Folded steps by name; an unfinished saga for which ``late`` holds is stuck."""
    names = F.array(*[F.lit(step) for step in steps])
    done = F.col("furthest") == len(steps)
    return folded.select(
        "aggregate_id",
        *(f"step_{i}" for i in range(1, len(steps) + 1)),
        F.element_at(names, F.col("furthest")).alias("furthest_step"),
        F.try_element_at(names, F.col("furthest") + 1).alias("next_step"),
        (~done & late).alias("stuck"),
    )


def saga_progress(
    events: DataFrame, as_of: Column, stuck_after: str, steps: Sequence[str] = ORDER_STEPS
) -> DataFrame:
    """One row per saga: steps seen, furthest step, the step expected next, and whether it is stuck.

    Stuck means unfinished with the last step more than ``stuck_after`` (an interval) before ``as_of``.
    """
    folded = step_rows(events, steps).groupBy("aggregate_id").agg(*step_folds(steps))
    return described(folded, F.col("_last_at") < as_of - F.expr(f"interval {stuck_after}"), steps)
