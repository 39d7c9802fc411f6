"""Every operator as a query over the given tables, with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codes import PRODUCTS, cyclic, header_text, user_of_order
from ..functions.envelope import decode_log, parse_envelope, stable_id
from ..functions.json_fields import int_or, json_fields, json_int, json_text, text_or
from ..functions.partitioner import key_partition, murmur2
from ..operators import contract, delivery, facts, inbox, outbox, projection, publishing, retry, routing, saga
from ..schema import PARTITIONS
from ..session import run_dir
from ..sources import log_store, tables
from ..streaming import queries as streams
from . import oracle as sql
from .tables import (
    as_log,
    customer_events,
    damaged_log,
    event_parts,
    event_rows,
    event_stream,
    log_value,
    offset_log,
    order_changes,
    order_log,
    order_outbox,
    placed_log,
    raw_log,
    redelivered,
    renumbered_log,
    sagas,
    table,
    source_types,
    with_other_types,
    with_payload,
    with_value,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

SEQ = ("seq",)
TARGETS = {"OrderPaid": "payments.events", "CustomerBlocked": "orders.notifications"}
#: What a projection reads: every order event, whether its type is mapped or stands for itself.
ORDERS = "Order"


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if oracle is not None:
            ORACLES[fn.__name__] = oracle
        return fn

    return register


# ---------------------------------------------------------------- projections


def _projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = order_log(spark, sf_dir, prefix=ORDERS)
    return projection.project_orders(log, SEQ, F.col("amount"))


@query(sql.PROJECTION)
def order_projection(spark, sf_dir):
    """Read model: last status, greatest amount, last event id per order."""
    return _projection(spark, sf_dir)


@query(sql.PROJECTION_OTHER_TYPES)
def order_projection_other_types(spark, sf_dir):
    """The projection over a log that also holds order types nobody mapped, and foreign types."""
    rows = with_other_types(table(spark, sf_dir, "events"))
    return projection.project_orders(as_log(rows.where(source_types((), ORDERS))), SEQ, F.col("amount"))


@query(sql.PROJECTION)
def envelope_projection(spark, sf_dir):
    """The same from the JSON text of the records, parsed once per record."""
    log = with_value(order_log(spark, sf_dir)).select("seq", "value")
    decoded = decode_log(log, ["amount"])
    return projection.project_orders(decoded, SEQ, int_or("payload.amount"))


@query(sql.PROJECTION)
def projection_upsert(spark, sf_dir):
    """A projection of the first half of the month merged with that of the second."""
    rows = event_rows(spark, sf_dir, prefix=ORDERS)
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    old, new = (
        projection.project_orders(as_log(rows.where(side)), SEQ, F.col("amount"))
        for side in (F.col("ts") < cut, F.col("ts") >= cut)
    )
    return projection.merge_orders(old, new)


@query(sql.PROJECTION)
def projection_stream(spark, sf_dir):
    """The projection as a stream over a log that grows in parts and delivers some records twice."""
    root = run_dir(spark, "projection")
    for events in event_parts(spark, sf_dir, f"{root}/in"):
        folded = streams.projection_stream(as_log(events), SEQ, F.col("amount"))
        streams.run_available(streams.write_changelog(folded, f"{root}/out", f"{root}/checkpoint"))
    return streams.read_changelog(spark, f"{root}/out", folded.schema, ["order_id"])


@query(sql.PROJECTION)
def replay_rebuild(spark, sf_dir):
    """Two replays of the log into two versions; the newest is read, and the diff must be empty."""
    root = run_dir(spark, "replay")
    for version in (1, 2):
        projection.rebuild(
            order_log(spark, sf_dir, prefix=ORDERS), root, version, SEQ, F.col("amount")
        )
    newest = tables.read_version(spark, root)
    differs = projection.diff(tables.read_version(spark, root, 1), newest, "order_id")
    return newest.join(differs.select("order_id"), "order_id", "left_anti")


@query(sql.PREFIX_DELETE)
def prefix_delete(spark, sf_dir):
    """The read model after ``delete … like 'u-1%'``."""
    return tables.delete_where(_projection(spark, sf_dir), F.col("order_id").like("u-1%"))


@query(sql.POINT_LOOKUP)
def point_lookup(spark, sf_dir):
    """One order's row; the filter moves below the aggregate."""
    return tables.lookup(_projection(spark, sf_dir), "order_id", "u-42")


# ---------------------------------------------------------------- inbox


def _inbox_inputs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The redelivered log, and the inbox and payments as its first week left them."""
    rows = event_rows(spark, sf_dir, ["OrderPaid"])
    log = redelivered(as_log(rows))
    week = as_log(rows.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz")))
    seen = week.select("event_id")
    paid = tables.first_per_key(
        week.select(F.col("aggregate_id").alias("order_id"), "amount", "seq"), ["order_id"], SEQ
    )
    return log, seen, paid.select("order_id", "amount")


@query(sql.INBOX_DEDUP)
def inbox_dedup(spark, sf_dir):
    """Event ids the inbox gains: each once, none it already had."""
    log, seen, paid = _inbox_inputs(spark, sf_dir)
    return inbox.apply_inbox(log, seen, paid, ["delivery", "seq"], amount=F.col("amount"))[0]


@query(sql.INBOX_PAYMENTS)
def inbox_payments(spark, sf_dir):
    """Payments after applying the log: the first per order, earlier ones kept."""
    log, seen, paid = _inbox_inputs(spark, sf_dir)
    delta = inbox.apply_inbox(log, seen, paid, ["delivery", "seq"], amount=F.col("amount"))[1]
    return paid.unionByName(delta)


@query(sql.FILTERED_COUNT)
def filtered_count(spark, sf_dir):
    """Payments of one order after the whole redelivered log: one."""
    log, seen, paid = _inbox_inputs(spark, sf_dir)
    delta = inbox.apply_inbox(log, seen, paid, ["delivery", "seq"], amount=F.col("amount"))[1]
    rows = tables.lookup(paid.unionByName(delta), "order_id", "u-7")
    return rows.agg(F.count("*").alias("payments"))


@query(sql.INBOX_STREAM)
def inbox_stream(spark, sf_dir):
    """Streamed de-duplication by event id over a log that grows and delivers some records again."""
    return _inbox(spark, sf_dir, None)


@query(sql.INBOX_STREAM)
def inbox_watermark_stream(spark, sf_dir):
    """The same with state that is forgotten after 12 of the 30 days; what comes again later than that is late, and dropped."""
    return _inbox(spark, sf_dir, "12 days")


def _inbox(spark: SparkSession, sf_dir: str, watermark: str | None) -> DataFrame:
    root = run_dir(spark, "inbox")
    for events in event_parts(spark, sf_dir, f"{root}/in"):
        once = streams.inbox_stream(as_log(events), watermark=watermark, spread=["delivery", "seq"])
        rows = once.select("event_id", "aggregate_id", "amount")
        streams.run_available(streams.write_append(rows, f"{root}/out", f"{root}/checkpoint"))
    return spark.read.schema(rows.schema).parquet(f"{root}/out")


@query(sql.PAYMENTS_STREAM)
def payments_stream(spark, sf_dir):
    """Streamed inbox apply, first payment per order kept by log position."""
    root = run_dir(spark, "payments")
    for events in event_parts(spark, sf_dir, f"{root}/in"):
        writer = streams.write_inbox(
            as_log(events), f"{root}/out", f"{root}/checkpoint", ["delivery", "seq"], amount=F.col("amount")
        )
        streams.run_available(writer)
    schema = T.StructType.fromDDL("order_id string, amount int")
    return streams.read_batches(spark, f"{root}/out/payments", schema).drop("batch_id")


# ---------------------------------------------------------------- outbox


@query(sql.OUTBOX_WRITE)
def outbox_write(spark, sf_dir):
    """Order and outbox rows written under one batch and read back once it is committed."""
    root = run_dir(spark, "outbox")
    outbox.write_outbox(order_changes(spark, sf_dir), root, "b1")
    orders = outbox.read_committed(spark, root, "orders").select("id", "status", "amount")
    written = outbox.read_committed(spark, root, "outbox")
    events = written.withColumn("_e", parse_envelope("payload", ["amount"])).select(
        F.col("aggregate_id").alias("id"),
        F.col("id").alias("event_id"),
        "event_type",
        int_or("_e.payload.amount").alias("event_amount"),
        (F.col("_e.eventId") == F.col("id")).alias("ids_agree"),
    )
    return orders.join(events, "id", "full_outer")


@query(sql.OUTBOX_RELAY)
def outbox_relay(spark, sf_dir):
    """Records the relay publishes for pending rows, keyed by aggregate."""
    rows = outbox.relay(order_outbox(spark, sf_dir))
    return rows.select(
        "topic",
        "key",
        F.col("id").alias("event_id"),
        json_int("value", "payload.amount").alias("amount"),
        key_partition("key", PARTITIONS).alias("partition"),
    )


@query(sql.OUTBOX_PUBLISH)
def outbox_publish(spark, sf_dir):
    """The relayed records as they stand in the log: oldest first in every partition."""
    root = run_dir(spark, "publish")
    outbox.relay_once(order_outbox(spark, sf_dir), root, "b1")
    return log_store.read_log(spark, root, ["orders.events"]).select(
        "partition",
        "offset",
        "key",
        json_text("value", "eventId").alias("event_id"),
    )


@query(sql.OUTBOX_AFTER)
def outbox_after(spark, sf_dir):
    """The outbox once the relayed ids are marked; a second relay finds nothing."""
    rows = order_outbox(spark, sf_dir)
    after = tables.mark(rows, outbox.relay(rows).select("id"), "id", "published")
    return after.groupBy("aggregate_id").agg(
        F.count("*").alias("outbox_rows"), F.count_if(~F.col("published")).alias("still_pending")
    )


@query(sql.TABLE_RESET)
def table_reset(spark, sf_dir):
    """The projection's table, filled and then reset: rows before and after."""
    root = run_dir(spark, "reset")
    projection.rebuild(order_log(spark, sf_dir, prefix=ORDERS), f"{root}/order_projection", 3, SEQ, F.col("amount"))
    filled = tables.read_version(spark, f"{root}/order_projection")
    tables.reset_tables(spark, root)
    empty = tables.read_version(spark, f"{root}/order_projection")
    counted = [df.agg(F.count("*").alias("rows")).select(F.lit(n).alias("state"), "rows") for n, df in (("filled", filled), ("reset", empty))]
    return counted[0].union(counted[1])


@query(sql.READER_COUNTS)
def reader_counts(spark, sf_dir):
    """Records each reader has taken, where readers divide the log's topics among themselves."""
    return delivery.received_counts(_by_topic(order_log(spark, sf_dir)), "topic")


# ---------------------------------------------------------------- retries


def _cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_payload(order_log(spark, sf_dir)).select("key", "event_id", "payload")


@query(sql.RETRY_OUTCOME)
def retry_outcome(spark, sf_dir):
    """Where every record ends after three tiers, with its last error header."""
    return retry.retry_chain(_cases(spark, sf_dir)).select("event_id", "outcome", "attempt", "x_error")


@query(sql.RETRY_HOPS)
def retry_hops(spark, sf_dir):
    """Every record the tiers write to retry topics and dead letters, per topic and reason."""
    hops = retry.retry_hops(_cases(spark, sf_dir))
    return hops.groupBy("target", "attempt", "x_error").agg(F.count("*").alias("records"))


@query(sql.RETRY_STAGE)
def retry_stage(spark, sf_dir):
    """The second tier alone over the log: outcome, target topic and the header as written."""
    staged = retry.retry_stage(_cases(spark, sf_dir), retry.TIERS[1])
    return staged.select("event_id", "outcome", "target", header_text("headers").alias("x_error"))


@query(sql.RETRY_DAMAGED)
def retry_damaged(spark, sf_dir):
    """Outcomes over a log in which every thirteenth payload cannot be read."""
    log = with_payload(order_log(spark, sf_dir))
    damaged = log.withColumn("payload", F.when(F.col("seq") % 13 == 0, F.lit("{bad")).otherwise(F.col("payload")))
    finals = retry.retry_chain(damaged)
    return finals.groupBy("outcome", "attempt", "x_error").agg(F.count("*").alias("records"))


@query(sql.RETRY_TIERS)
def retry_tiers_stream(spark, sf_dir):
    """The three tiers as streams over their topics, each to its end; what became of the records."""
    root = run_dir(spark, "tiers")
    log = with_value(order_log(spark, sf_dir))
    value = F.when(F.col("seq") % 13 == 0, F.lit("{bad")).otherwise(F.col("value"))
    log_store.append_log(log.withColumn("value", value), f"{root}/log", "b0", order=SEQ)
    for tier in retry.TIERS:
        source = log_store.stream_log(spark, f"{root}/log", [tier.topic])
        streams.run_available(
            streams.write_tier(source, tier, f"{root}/log", f"{root}/done", f"{root}/checkpoint{tier.attempt}")
        )
    done = spark.read.schema("attempt int").parquet(f"{root}/done").select(
        F.lit("processed").alias("outcome"), "attempt", F.lit(None).cast("string").alias("x_error")
    )
    bad = spark.read.schema("topic string").parquet(f"{root}/done_quarantine").select(
        F.lit(retry.QUARANTINED), F.lit(1), F.lit(None).cast("string")
    )
    dead = log_store.read_log(spark, f"{root}/log", [retry.DEAD_LETTERS]).select(
        F.lit("dlt"), F.lit(None).cast("int"), header_text("headers")
    )
    return done.union(bad).union(dead).groupBy("outcome", "attempt", "x_error").agg(F.count("*").alias("records"))


@query(sql.DLT_REPORT)
def dlt_report(spark, sf_dir):
    return retry.dead_letter_report(retry.retry_chain(_cases(spark, sf_dir)))


# ---------------------------------------------------------------- sagas


@query(sql.SAGA_NEXT)
def saga_next(spark, sf_dir):
    """Events the saga rules emit for the log, hop by hop."""
    log = with_payload(order_log(spark, sf_dir))
    return saga.saga_replies(log).select(
        "topic", "key", "event_type", "hop", "caused_by", "event_id", json_int("payload", "amount").alias("amount")
    )


@query(sql.SAGA_RESUMED)
def saga_resumed(spark, sf_dir):
    """What is still to be emitted once the log holds the first reply of every saga."""
    log = with_payload(order_log(spark, sf_dir)).select("topic", "event_type", "aggregate_id", "event_id", "payload")
    first = saga.saga_replies(log).where("hop = 1").select(*log.columns)
    return saga.saga_replies(log.unionByName(first)).select(
        "topic", "event_type", "hop", "caused_by", "event_id", json_int("payload", "amount").alias("amount")
    )


@query(sql.SAGA_PROGRESS)
def saga_progress(spark, sf_dir):
    """Steps seen, next step and stuck flag per saga of a user and day."""
    as_of = F.lit("2024-01-31 00:00:00").cast("timestamp")
    return saga.saga_progress(sagas(order_log(spark, sf_dir)), as_of, "10 days")


# ---------------------------------------------------------------- contracts


@query(sql.CONTRACT_CHECK)
def contract_check(spark, sf_dir):
    checked = contract.check_contract(customer_events(spark, sf_dir))
    return checked.select(
        "c_custkey", "event_version", "compatible", F.array_join("missing", ",").alias("missing")
    )


@query(sql.CONTRACT_SUMMARY)
def contract_summary(spark, sf_dir):
    return contract.contract_summary(contract.check_contract(customer_events(spark, sf_dir)))


# ---------------------------------------------------------------- placement and reading


@query(sql.MURMUR2)
def murmur2_partition(spark, sf_dir):
    """Hash and partition of every record's key, by the client's rule."""
    log = order_log(spark, sf_dir)
    return log.select(
        "event_id", "key", murmur2("key").alias("hash"), key_partition("key", PARTITIONS).alias("partition")
    )


def _by_topic(log: DataFrame) -> DataFrame:
    """The log divided into two topics, whose offsets have nothing to do with each other."""
    return routing.route(log, TARGETS).withColumn("topic", F.col("target")).drop("target")


@query(sql.KEY_PLACEMENT)
def key_placement(spark, sf_dir):
    return delivery.key_placement(_by_topic(placed_log(spark, sf_dir)))


@query(sql.KEYED_PUBLISH)
def keyed_publish(spark, sf_dir):
    """Placed orders keyed by one of three users, written to the log and read back."""
    # Every fourth number is beyond 32 bits.
    wide = F.when(F.col("o_orderkey") % 4 == 0, F.col("o_orderkey") + F.lit(1 << 33)).otherwise(F.col("o_orderkey"))
    numbers = table(spark, sf_dir, "orders").select(wide.alias("number"), "o_orderdate")
    records = publishing.placed_orders(numbers, "number")
    value = publishing.placed_value(F.col("o_orderdate"))
    root = run_dir(spark, "keyed")
    log_store.append_log(records, root, "b1", order=["order_id"], value=value)
    return streams.consume(log_store.read_log(spark, root)).select(
        "partition", "offset", "key", "order_id", "user_id", "product"
    )


@query(sql.CYCLIC_PRODUCTS)
def cyclic_products(spark, sf_dir):
    """User and product of every order number."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        user_of_order("o_orderkey").alias("user_id"),
        cyclic(PRODUCTS, "o_orderkey").alias("product"),
    )


@query(sql.END_OFFSETS)
def end_offsets(spark, sf_dir):
    return log_store.end_offsets(offset_log(spark, sf_dir))


@query(sql.LOG_OFFSETS)
def log_offsets(spark, sf_dir):
    """Offsets without gaps, numbered inside every partition in log order."""
    return renumbered_log(spark, sf_dir).select("partition", "offset", "key", "event_id")


@query(sql.LAST_N)
def last_n(spark, sf_dir):
    """The last 12 records of every partition by rank."""
    return log_store.last_n(offset_log(spark, sf_dir), 12).select("partition", "offset", "key", "event_type")


@query(sql.TAIL_READ)
def tail_read(spark, sf_dir):
    """The last 12 offsets of every partition, with type and status."""
    log = with_payload(offset_log(spark, sf_dir))
    return log_store.tail_read(log).select(
        "partition", "offset", "key", "event_type", json_text("payload", "status", "-").alias("status")
    )


@query(sql.BOUNDED_READ)
def bounded_read(spark, sf_dir):
    """A read that stops at 500 records."""
    return log_store.bounded_read(offset_log(spark, sf_dir), 500).select(
        "partition", "offset", "key", "event_type"
    )


@query(sql.BOUNDED_READ_STATUS)
def bounded_read_status(spark, sf_dir):
    return log_store.bounded_status(offset_log(spark, sf_dir), 500)


@query(sql.TAKE_ONE)
def take_one(spark, sf_dir):
    """The first record of the log."""
    log = order_log(spark, sf_dir).select("seq", "key", "event_type")
    return log_store.take_one(log, SEQ)


@query(sql.ORDER_CHECK)
def order_check(spark, sf_dir):
    """Per topic and key: partitions, and how often the amount falls from one record to the next."""
    return delivery.order_check(_by_topic(offset_log(spark, sf_dir)), "amount")


@query(sql.FULL_AND_RESUMED)
def full_and_resumed_read(spark, sf_dir):
    """A reader that starts at the beginning, stops, and goes on after the log has grown."""
    root = run_dir(spark, "resume")
    rows = event_rows(spark, sf_dir)
    cut = F.lit("2024-01-16").cast("timestamp_ntz")
    schema = T.StructType.fromDDL("run int, event_type string, event_id string")
    for run, part in ((1, rows.where(F.col("ts") < cut)), (2, rows.where(F.col("ts") >= cut))):
        log_store.append_log(as_log(part), f"{root}/log", f"b{run}", order=SEQ, value=log_value())
        log = log_store.stream_log(spark, f"{root}/log", ["orders.events"])
        read = log.withColumn("_e", parse_envelope("value")).select(
            F.lit(run).alias("run"), F.col("_e.eventType").alias("event_type"), F.col("_e.eventId").alias("event_id")
        )
        streams.run_available(streams.write_append(read, f"{root}/out", f"{root}/checkpoint"))
    read = spark.read.schema(schema).parquet(f"{root}/out")
    return read.groupBy("run", "event_type").agg(
        F.count("*").alias("records"), F.countDistinct("event_id").alias("distinct_events")
    )


# ---------------------------------------------------------------- readers and topics


def _received(spark: SparkSession, sf_dir: str, groups: dict[str, list[str]]) -> DataFrame:
    assigned = delivery.assignment(spark, groups)
    return delivery.received_and_missed(placed_log(spark, sf_dir), assigned)


SHARED = {"orders-shared": ["billing-function", "notification-function"]}
SEPARATE = {
    "billing-service": ["billing-1", "billing-2"],
    "fraud-service": ["fraud-1"],
    "notification-service": ["notification"],
}


@query(sql.GROUP_SHARED)
def group_shared(spark, sf_dir):
    """Two functions in one group: each receives a part and misses the other's."""
    return _received(spark, sf_dir, SHARED)


@query(sql.GROUP_SEPARATE)
def group_separate(spark, sf_dir):
    """Groups of their own: every group receives everything, its members divide it."""
    return _received(spark, sf_dir, SEPARATE)


@query(sql.LOAD_FACTOR)
def group_load(spark, sf_dir):
    """Deliveries of all groups together over the events of the log."""
    return delivery.load_factor(_received(spark, sf_dir, SEPARATE))


@query(sql.MISSED_EVENTS)
def missed_events(spark, sf_dir):
    """The records the second function of a shared group never sees."""
    assigned = delivery.assignment(spark, SHARED)
    missed = delivery.missed_events(placed_log(spark, sf_dir), assigned, "notification-function")
    return missed.select("partition", "key", "event_id")


@query(sql.TYPE_MIX)
def type_mix(spark, sf_dir):
    return routing.type_mix(order_log(spark, sf_dir))


@query(sql.TOPIC_SUMMARY)
def topic_summary(spark, sf_dir):
    return routing.topic_summary(order_log(spark, sf_dir))


@query(sql.TYPE_ROUTE)
def type_route(spark, sf_dir):
    """Every record with the topic its type belongs to."""
    return routing.route(order_log(spark, sf_dir), TARGETS).select("event_id", "event_type", "target")


# ---------------------------------------------------------------- facts and state


@query(sql.NOTIFICATION_ENRICH)
def notification_enrich(spark, sf_dir):
    """Paid-order facts with the customer they only name; unknown customers stay in."""
    paid = order_log(spark, sf_dir, ["OrderPaid"]).select("event_id", "user_id")
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    return facts.enrich_facts(paid, customers, "user_id")


def _states(rows: DataFrame) -> DataFrame:
    return rows.select(
        "user_id",
        F.col("event_type").alias("status"),
        "value",
        json_int("props", "k").alias("k"),
        F.col("event_id").alias("version"),
    )


@query(sql.STATE_LATEST)
def state_latest(spark, sf_dir):
    """The newest full state per user, without any lookup."""
    return facts.latest_state(_states(event_rows(spark, sf_dir)), ["user_id"])


@query(sql.STATE_LATEST)
def state_stream(spark, sf_dir):
    """The same as a stream in update mode over a log that grows in parts."""
    root = run_dir(spark, "state")
    for events in event_parts(spark, sf_dir, f"{root}/in"):
        newest = streams.state_stream(_states(events), ["user_id"])
        streams.run_available(streams.write_changelog(newest, f"{root}/out", f"{root}/checkpoint"))
    return streams.read_changelog(spark, f"{root}/out", newest.schema, ["user_id"])


# ---------------------------------------------------------------- envelopes and fields


@query(sql.PAYLOAD_EXTRACT)
def payload_extract(spark, sf_dir):
    """Typed fields of the JSON properties, with defaults for what is missing."""
    fields = json_fields("props", ["k", "amount", "product"])
    return event_rows(spark, sf_dir).withColumn("_p", fields).withColumn("k", int_or("_p.k")).select(
        "event_id",
        "k",
        int_or("_p.amount").alias("amount"),
        text_or("_p.product", "unknown").alias("product"),
        F.greatest(F.col("k"), F.lit(50)).alias("at_least_50"),
        F.greatest(F.lit(0), F.col("k") - 12).alias("clamped"),
        F.col("user_id").cast("string").alias("key"),
    )


@query(sql.ENVELOPE_ROUNDTRIP)
def envelope_roundtrip(spark, sf_dir):
    """Envelopes written as text and read again."""
    value = with_value(order_log(spark, sf_dir)).select("value")
    read = value.select(parse_envelope("value", ["amount", "case"]).alias("e"))
    return read.select(
        F.col("e.eventId").alias("event_id"),
        F.col("e.eventType").alias("event_type"),
        int_or("e.eventVersion").alias("event_version"),
        F.col("e.occurredAt").alias("occurred_at"),
        F.unix_micros(F.try_to_timestamp(F.col("e.occurredAt"))).alias("occurred_micros"),
        F.col("e.aggregateId").alias("aggregate_id"),
        int_or("e.payload.amount").alias("amount"),
        text_or("e.payload.case", "ok").alias("case_name"),
    )


@query(sql.STABLE_ID)
def stable_event_id(spark, sf_dir):
    return order_log(spark, sf_dir).select(
        F.col("seq"), stable_id("event_type", "aggregate_id", "seq").alias("stable_id")
    )


@query(sql.DELIVERY_REPORT)
def delivery_report(spark, sf_dir):
    """Accepted and rejected records of a log with damaged values, by reason."""
    return log_store.outcome_report(raw_log(spark, sf_dir))


@query(sql.CONSUMED_STREAM)
def consumer_stream(spark, sf_dir):
    """At-least-once reading of the damaged log as a stream: read, with the rejects set apart."""
    log = as_log(event_stream(spark, sf_dir))
    damaged = damaged_log(log).withColumns(
        {"partition": F.lit(0), "offset": F.col("seq")}
    )
    root = run_dir(spark, "consumed")
    rows = streams.consume(damaged)
    streams.run_available(streams.write_consumed(damaged, f"{root}/out", f"{root}/checkpoint"))
    stored = streams.read_batches(spark, f"{root}/out", rows.schema)
    return stored.groupBy(F.coalesce("reason", F.lit("accepted")).alias("outcome"), "product").agg(
        F.count("*").alias("records")
    )
