"""More registered queries: stream forms that wait, route, merge and prune, and reports on logs and versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.partitioner import key_partition
from ..operators import difference, lag, outbox, projection, saga, trace
from ..schema import PARTITIONS
from ..session import run_dir
from ..sources import reported, zones
from ..streaming import changelog, facts, inbox, routed, sagas as saga_streams
from ..streaming import queries as streams
from . import further_oracle as sql
from .catalog import SEQ, TARGETS, query
from .tables import (
    as_log,
    caused_events,
    event_parts,
    late_parts,
    order_log,
    order_outbox,
    placed_log,
    raw_log,
    sagas,
    table,
    with_payload,
)

QUIET, DELAY = "1 day", "12 days"
WITHIN = "6 hours"
REQUIRED = {"OrderPaid": ("amount", "case"), "OrderPlaced": ("amount",), "CustomerBlocked": ("case",)}


# ---------------------------------------------------------------- sagas


@query(sql.SAGA_SESSIONS)
def saga_sessions_stream(spark, sf_dir):
    """Sagas of a user and day that came to rest, over several micro-batches with late and repeated events."""
    root = run_dir(spark, "saga-sessions")
    for events in late_parts(spark, sf_dir, f"{root}/in"):
        rested = saga_streams.saga_sessions(sagas(as_log(events)), QUIET, DELAY)
        streams.run_available(streams.write_append(rested, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(rested.schema).parquet(f"{root}/out")


@query(sql.SAGA_PROGRESS)
def saga_steps_stream(spark, sf_dir):
    """The progress of sagas as an update-mode stream, described when it is asked for."""
    root, keys = run_dir(spark, "saga-steps"), ["aggregate_id"]
    for events in late_parts(spark, sf_dir, f"{root}/in"):
        steps = saga_streams.saga_steps_stream(sagas(as_log(events)))
        streams.run_available(changelog.write_levels(steps, f"{root}/out", f"{root}/checkpoint", keys, every=2))
    folded = changelog.read_levels(spark, f"{root}/out", steps.schema, keys)
    late = F.col("_last_at") < F.lit("2024-01-31 00:00:00").cast("timestamp") - F.expr("interval 10 days")
    return saga.described(folded, late)


# ---------------------------------------------------------------- facts


@query(sql.FACTS_AND_STATES)
def facts_wait_stream(spark, sf_dir):
    """Payments with the orders created by their user within hours before or after them, both sides late and repeated."""
    root = run_dir(spark, "facts")
    for events in late_parts(spark, sf_dir, f"{root}/in"):
        log = as_log(events)
        paid = log.where("event_type = 'OrderPaid'").select("event_id", "user_id", "timestamp")
        created = log.where("event_type = 'OrderCreated'").select(
            "user_id", F.col("event_id").alias("state_id"), F.col("timestamp").alias("state_at"), F.col("amount").alias("ordered")
        )
        rows = facts.facts_with_stream(paid, created, "user_id", WITHIN, DELAY, DELAY)
        rows = rows.select("event_id", "user_id", "state_id", "ordered")
        streams.run_available(streams.write_append(rows, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


@query(sql.FACTS_AND_TABLE)
def facts_lookup_stream(spark, sf_dir):
    """Payments streamed beside the customer table; those of unknown customers stay."""
    root = run_dir(spark, "lookup")
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"))
    for events in event_parts(spark, sf_dir, f"{root}/in"):
        paid = as_log(events).where("event_type = 'OrderPaid' and delivery = 0").select("event_id", "user_id")
        rows = facts.facts_with_table(paid, customers, "user_id")
        streams.run_available(streams.write_append(rows, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


# ---------------------------------------------------------------- routing


@query(sql.ROUTED)
def type_route_stream(spark, sf_dir):
    """A mixed topic split by type as it grows, what its readers could not read set apart, and run once more on nothing new."""
    root = run_dir(spark, "routed")
    for events in event_parts(spark, sf_dir, f"{root}/in"):
        log = with_payload(as_log(events)).where("delivery = 0")
        payload = F.when(F.col("seq") % 11 == 0, F.lit("[1]")).when(F.col("seq") % 13 == 0, F.lit('{"note": null}'))
        log = log.withColumn("payload", F.coalesce(payload, F.col("payload")))
        log = log.select("topic", "event_id", "event_type", "payload")
        for _ in range(2):
            streams.run_available(routed.write_routed(log, f"{root}/out", f"{root}/checkpoint", TARGETS, REQUIRED))
    return routed.read_routed(spark, f"{root}/out").select("event_id", "event_type", F.col("topic").cast("string").alias("topic"), "reason")


# ---------------------------------------------------------------- merged and pruned tables


@query(sql.PROJECTION)
def projection_levels_stream(spark, sf_dir):
    """The projection through a changelog that merges older micro-batches into snapshots."""
    root, keys = run_dir(spark, "levels"), ["order_id"]
    for events in event_parts(spark, sf_dir, f"{root}/in"):
        folded = streams.projection_stream(as_log(events), SEQ, F.col("amount"))
        streams.run_available(changelog.write_levels(folded, f"{root}/out", f"{root}/checkpoint", keys, every=2))
    return changelog.read_levels(spark, f"{root}/out", folded.schema, keys)


@query(sql.PAYMENTS)
def inbox_days_stream(spark, sf_dir):
    """Streamed inbox apply that reads only the days and buckets a micro-batch touches."""
    root = run_dir(spark, "inbox-days")
    for events in event_parts(spark, sf_dir, f"{root}/in"):
        writer = inbox.write_days(
            as_log(events), f"{root}/out", f"{root}/checkpoint", ["delivery", "seq"], amount=F.col("amount")
        )
        streams.run_available(writer)
    return spark.read.schema("order_id string, amount int").parquet(f"{root}/out/payments").select(
        "order_id", "amount"
    )


@query(sql.DIFFERENCE)
def replay_difference(spark, sf_dir):
    """Where a read model differs from one built of a log that lacks some events and some orders."""
    versions = []
    for lost, skipped in ((F.lit(False), 7), (F.col("seq") % 97 == 0, 9)):
        log = order_log(spark, sf_dir, prefix="Order").where(~lost & (F.col("user_id") % 50 != skipped))
        versions.append(projection.project_orders(log, SEQ, F.col("amount")))
    found = difference.table_difference(*versions, ["order_id"])
    return found.select(
        "order_id", "change", F.col("before.status").alias("old_status"), F.col("after.status").alias("new_status"),
        F.col("before.amount").alias("old_amount"), F.col("after.amount").alias("new_amount"),
    )


# ---------------------------------------------------------------- reports


@query(sql.TRACES)
def event_traces(spark, sf_dir):
    """Root, depth and path of every event by what caused it."""
    found = trace.traces(caused_events(spark, sf_dir))
    return found.select("event_id", "root", "depth", F.array_join("path", ">").alias("path"))


@query(sql.RESULTS)
def delivery_results(spark, sf_dir):
    """A result for every record of the damaged log that is written."""
    log = raw_log(spark, sf_dir).select("seq", "key", "value")
    report, _ = reported.write_reported(log, run_dir(spark, "reported"), "first", "seq")
    return report


@query(sql.LAG)
def reader_lag(spark, sf_dir):
    """Two readers of a growing log: one that keeps up, and one that stops after the first part."""
    root, positions = run_dir(spark, "lag"), lag.Positions()
    for i, events in enumerate(event_parts(spark, sf_dir, f"{root}/in")):
        if i == 3:
            break
        log = _placed(as_log(events))
        for reader in ("keeps-up", "stops")[: 1 if i else 2]:
            rows = lag.observed(log, reader, PARTITIONS).select("event_id")
            writer = streams.write_append(rows, f"{root}/{reader}", f"{root}/checkpoint-{reader}")
            positions.of_query(streams.run_available(writer))
    ends = placed_log(spark, sf_dir).groupBy("partition").agg((F.max("seq") + 1).alias("end_offset"))
    return lag.reader_lag(ends, positions.table(spark), ["keeps-up", "stops", "never-began"])


def _placed(log: DataFrame) -> DataFrame:
    partition = key_partition("key", PARTITIONS, spread="event_id")
    return log.withColumn("partition", partition).withColumn("offset", F.col("seq"))


@query(sql.RELAYED_TWICE)
def outbox_relayed_twice(spark, sf_dir):
    """A relay that stops before it marks, one that sends again and marks, and one that finds nothing."""
    root = run_dir(spark, "relayed")
    rows = order_outbox(spark, sf_dir)
    outbox.publish(outbox.relay(rows), f"{root}/log", "stopped")
    once = outbox.relay_and_mark(rows, f"{root}/log", "again")
    once.write.parquet(f"{root}/outbox")
    once = spark.read.parquet(f"{root}/outbox")
    after = outbox.relay_and_mark(once, f"{root}/log", "nothing")
    sent = outbox.published(spark, f"{root}/log").groupBy(F.col("key").alias("aggregate_id"))
    sent = sent.agg(
        F.count("*").alias("sent"), F.count_distinct("id").alias("distinct_ids"),
        F.count_if(F.col("batch") == "nothing").alias("sent_at_last"),
    )
    left = after.groupBy("aggregate_id").agg(F.count("*").alias("outbox_rows"), F.count_if(~F.col("published")).alias("still_pending"))
    zero = F.lit(0).cast("long")
    return left.join(sent, "aggregate_id", "left").select(
        "aggregate_id", "outbox_rows", "still_pending",
        *(F.coalesce(c, zero).alias(c) for c in ("sent", "distinct_ids", "sent_at_last")),
    )


@query(sql.TAIL_READ)
def tail_read_zones(spark, sf_dir):
    """The last records of every partition, from the folders that the log's zones name."""
    root, parts = run_dir(spark, "zones"), 8
    log = placed_log(spark, sf_dir)
    low, high = table(spark, sf_dir, "events").agg(F.min("event_id"), F.max("event_id")).first()
    batch = F.concat(F.lit("b"), F.floor((F.col("seq") - low) * parts / (high - low + 1)).cast("string"))
    rows = log.select("topic", batch.alias("batch"), "partition", F.col("seq").alias("offset"), "key", "event_type")
    rows.write.partitionBy("topic", "batch").parquet(f"{root}/log")
    stored = spark.read.schema("partition int, offset long, key string, event_type string, topic string, batch string").parquet(f"{root}/log")
    for i in range(parts):
        zones.add_zones(stored, f"{root}/zones", f"b{i}")
    found = zones.tail_by_zones(stored, zones.read_zones(spark, f"{root}/zones"))
    return found.select("partition", "offset", "key", "event_type", F.lit("-").alias("status"))
