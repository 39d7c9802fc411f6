"""The demonstrations, one function per mode: a few fixed records through the library's operators.

Each takes a folder for log and tables and returns its results by name. A mode's records are one
batch of the log named after it, so running a mode again replaces its records.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_col
from ..functions.envelope import build_envelope, decode_log, stable_id
from ..functions.json_fields import json_int, json_text
from ..operators import contract, delivery, facts, inbox, outbox, projection, publishing, retry, routing, saga
from ..session import path_exists
from ..sources import log_store, tables
from ..streaming import queries as streams

Results = dict[str, DataFrame]
MODES: dict[str, Callable[[SparkSession, str], Results]] = {}
ORDERS = "orders.events"


def mode(name: str):
    def register(fn):
        MODES[name] = fn
        return fn

    return register


# ---------------------------------------------------------------- helpers


def _events(spark: SparkSession, name: str, items: list[tuple]) -> DataFrame:
    """Records of ``(topic, key, event type, aggregate, payload)``, in the order given."""
    fields = sorted({field for *_, payload in items for field in payload})
    payload_type = ", ".join(f"`{f}`: {_type_of(f, items)}" for f in fields)
    rows = [
        (n, topic, key, kind, aggregate, tuple(payload.get(f) for f in fields))
        for n, (topic, key, kind, aggregate, payload) in enumerate(items)
    ]
    df = spark.createDataFrame(
        rows,
        "seq long, topic string, key string, event_type string, aggregate_id string, "
        f"payload struct<{payload_type}>",
    )
    event_id = stable_id(F.lit(name), "seq")
    now = F.current_timestamp()
    value = build_envelope(event_id, F.col("event_type"), F.col("aggregate_id"), F.col("payload"), now)
    return df.select("seq", "topic", "key", value.alias("value"))


def _type_of(field: str, items: list[tuple]) -> str:
    values = [payload[field] for *_, payload in items if field in payload]
    return "int" if all(isinstance(v, int) for v in values) else "string"


def _send(spark: SparkSession, root: str, name: str, items: list[tuple]) -> DataFrame:
    """Appends the records and gives the delivery report."""
    return log_store.append_log(_events(spark, name, items), f"{root}/log", name, order=["seq"], tasks=3)


def _log(spark: SparkSession, root: str, *topics: str, batch: str | None = None) -> DataFrame:
    log = log_store.read_log(spark, f"{root}/log", topics)
    return log if batch is None else log.where(F.col("batch") == batch)


def _shown(log: DataFrame) -> DataFrame:
    return log.select("topic", "partition", "offset", "key", json_text("value", "eventType").alias("event_type"))


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    at = f"{root}/tables/{name}"
    return tables.read_version(spark, at) if path_exists(spark, at) else tables.empty_table(spark, name)


# ---------------------------------------------------------------- modes


@mode("init")
def init(spark, root):
    """Empty tables; the log starts with the first record."""
    tables.reset_tables(spark, f"{root}/tables")
    return {name: _table(spark, root, name) for name in tables.TABLES}


@mode("basic-entities")
def basic_entities(spark, root):
    items = [
        (ORDERS, f"order-{i % 3}", "OrderPlaced", f"order-{i % 3}", {"amount": 100 + i}) for i in range(1, 7)
    ]
    report = _send(spark, root, "basic-entities", items)
    log = _log(spark, root, ORDERS, batch="basic-entities")
    read = log_store.bounded_read(log, 6)
    return {
        "report": report,
        "records": _shown(read),
        "status": log_store.read_status(read, 6),
        "placement": delivery.key_placement(log),
    }


@mode("partition-order")
def partition_order(spark, root):
    states = ["Created", "Paid", "Packed", "Shipped"]
    keyed = [(ORDERS, "order-42", f"Order{s}", "order-42", {"status": s}) for s in states]
    loose = [(ORDERS, None, f"Order{s}", "order-no-key", {"status": s}) for s in states]
    _send(spark, root, "partition-order", keyed + loose)
    log = _log(spark, root, ORDERS, batch="partition-order")
    status = json_text("value", "payload.status", "-")
    rank = F.array_position(F.array(*[F.lit(s) for s in states]), status)
    return {
        "tail": log_store.tail_read(log).select("partition", "offset", "key", status.alias("status")),
        "order": delivery.order_check(log.withColumn("step", rank), "step"),
    }


def _paid(prefix: str, count: int, amount_from: int = 0) -> list[tuple]:
    return [
        (ORDERS, f"{prefix}{i}", "OrderPaid", f"{prefix}{i}", {"amount": amount_from + i}) for i in range(count)
    ]


def _group_mode(spark, root, name: str, items: list[tuple], groups: dict[str, list[str]]) -> Results:
    _send(spark, root, name, items)
    log = _log(spark, root, ORDERS, batch=name)
    received = delivery.received_and_missed(log, delivery.assignment(spark, groups))
    return {"received": received, "load": delivery.load_factor(received)}


@mode("consumer-groups")
def consumer_groups(spark, root):
    groups = {"billing-service": ["billing-1", "billing-2"], "fraud-service": ["fraud-1"]}
    return _group_mode(spark, root, "consumer-groups", _paid("order-", 9, 10), groups)


@mode("event-styles")
def event_styles(spark, root):
    state = {"name": "Northlight", "segment": "B2B", "status": "ACTIVE", "version": 5}
    items = [
        ("orders.notifications", "order-777", "OrderPaid", "order-777", {"note": "paid, look the rest up"}),
        ("orders.state", "customer-19", "CustomerChanged", "customer-19", state),
    ]
    _send(spark, root, "event-styles", items)
    facts_read = decode_log(_log(spark, root, "orders.notifications", batch="event-styles"))
    states = decode_log(
        _log(spark, root, "orders.state", batch="event-styles"), ["name", "segment", "status", "version"]
    )
    flat = states.select("aggregate_id", "payload.*").withColumn("version", F.col("version").cast("int"))
    known = projection.project_orders(decode_log(_log(spark, root, ORDERS))) if _has(spark, root) else None
    result = {
        "facts": facts_read.select("event_type", F.col("aggregate_id").alias("order_id"), "payload"),
        "states": facts.latest_state(flat, ["aggregate_id"]),
    }
    if known is not None:
        result["enriched"] = facts.enrich_facts(result["facts"], known, "order_id")
    return result


def _has(spark: SparkSession, root: str) -> bool:
    return not _log(spark, root, ORDERS).isEmpty()


@mode("outbox")
def outbox_mode(spark, root):
    change = spark.createDataFrame([("order-outbox-1", "PAID", 1200)], "id string, status string, amount int")
    change = change.withColumn("updated_at", F.lit("2024-01-01").cast("timestamp"))
    outbox.write_outbox(change, f"{root}/outbox", "outbox")
    pending = outbox.read_committed(spark, f"{root}/outbox", "outbox")
    report, after = outbox.relay_once(pending, f"{root}/log", "outbox")
    tables.write_version(after, f"{root}/tables/outbox", 1)
    left = _table(spark, root, "outbox")
    return {
        "report": report,
        "records": _shown(_log(spark, root, ORDERS, batch="outbox")),
        "outbox": left.select("id", "aggregate_id", "published"),
        "pending": outbox.pending(left).select("id"),
    }


@mode("inbox")
def inbox_mode(spark, root):
    paid = (ORDERS, "order-inbox-1", "OrderPaid", "order-inbox-1", {"amount": 2400})
    once = _events(spark, "inbox", [paid])
    twice = once.unionByName(once.withColumn("seq", F.col("seq") + 1))
    log_store.append_log(twice, f"{root}/log", "inbox", order=["seq"], tasks=3)
    events = decode_log(_log(spark, root, ORDERS, batch="inbox"))
    seen, payments = (tables.empty_table(spark, n) for n in ("inbox", "billing_payments"))
    new_ids, new_payments = inbox.apply_inbox(events, seen, payments)
    return {
        "inbox": new_ids,
        "payments": new_payments,
        "count": tables.lookup(new_payments, "order_id", "order-inbox-1").agg(F.count("*").alias("payments")),
    }


@mode("cqrs-saga")
def cqrs_saga(spark, root):
    created = (ORDERS, "saga-42", "OrderCreated", "saga-42", {"amount": 990})
    _send(spark, root, "cqrs-saga", [created])
    first = log_store.take_one(_log(spark, root, ORDERS, batch="cqrs-saga"))
    replies = saga.saga_replies(decode_log(first))
    kind = F.col("event_type")
    confirmed = kind == "OrderConfirmed"
    # Fields of other event types are null and so left out of the JSON text.
    extra = F.struct(
        F.when(kind == "PaymentReserved", "pay-42").alias("paymentId"),
        F.when(kind == "StockReserved", "book-1").alias("sku"),
        F.when(confirmed, "CONFIRMED").alias("status"),
        F.when(confirmed, json_int("payload", "amount")).alias("amount"),
    )
    value = build_envelope(
        F.col("event_id"), kind, F.col("aggregate_id"), extra, F.current_timestamp()
    )
    records = replies.select("topic", "key", value.alias("value"), "hop")
    log_store.append_log(records, f"{root}/log", "cqrs-saga-replies", order=["hop"], tasks=3)
    topics = [ORDERS, "payments.events", "warehouse.events"]
    whole = _log(spark, root, *topics).where(F.col("batch").startswith("cqrs-saga"))
    events = decode_log(whole)
    read_model = projection.project_orders(events)
    return {
        "events": _shown(whole),
        "progress": saga.saga_progress(events, F.current_timestamp(), "1 hour"),
        "row": tables.lookup(read_model, "order_id", "saga-42"),
    }


@mode("retry-dlt")
def retry_dlt(spark, root):
    cases = [
        ("ok-1", {"case": "ok"}),
        ("temp-1", {"case": "temporary"}),
        ("slow-1", {"case": "temporary-long"}),
        ("bad-1", {"case": "poison", "schema": "quantity below zero"}),
    ]
    _send(spark, root, "retry-dlt", [(ORDERS, k, "OrderPaid", k, p) for k, p in cases])
    records = decode_log(_log(spark, root, ORDERS, batch="retry-dlt"))
    finals = retry.retry_chain(records)
    return {
        "finals": finals.select("key", "outcome", "attempt", "x_error"),
        "hops": retry.retry_hops(records).select("key", "target", "attempt", "x_error"),
        "dead_letters": retry.dead_letter_report(finals),
    }


@mode("contract")
def contract_mode(spark, root):
    versions = [
        (1, '{"customerId":"c-1","name":"Northlight"}'),
        (2, '{"customerId":"c-1","name":"Northlight","segment":"B2B"}'),
        (3, '{"id":"c-1","fullName":"Northlight Tools"}'),
    ]
    events = spark.createDataFrame(versions, "event_version int, payload string")
    checked = contract.check_contract(events.withColumn("event_type", F.lit("CustomerChanged")))
    return {"checked": checked, "summary": contract.contract_summary(checked)}


@mode("bad-shared-group")
def bad_shared_group(spark, root):
    groups = {"orders-shared": ["billing-function", "notification-function"]}
    return _group_mode(spark, root, "bad-shared-group", _paid("bad-sg-", 6), groups)


@mode("good-separate-groups")
def good_separate_groups(spark, root):
    groups = {"billing-service-refactored": ["billing"], "notification-service-refactored": ["notification"]}
    return _group_mode(spark, root, "good-separate-groups", _paid("good-g-", 4), groups)


@mode("bad-universal-topic")
def bad_universal_topic(spark, root):
    items = [
        ("all.events", "order-1", "OrderPaid", "order-1", {"amount": 100}),
        ("all.events", "customer-1", "CustomerBlocked", "customer-1", {"reason": "unpaid invoices"}),
        ("all.events", "invoice-1", "InvoiceSent", "invoice-1", {"email": "user@example.org"}),
    ]
    _send(spark, root, "bad-universal-topic", items)
    events = decode_log(_log(spark, root, "all.events", batch="bad-universal-topic"))
    targets = {"OrderPaid": ORDERS, "CustomerBlocked": "customers.events", "InvoiceSent": "invoices.events"}
    return {
        "summary": routing.topic_summary(events),
        "routed": routing.route(events, targets).select("key", "event_type", "target"),
    }


@mode("audit-replay")
def audit_replay(spark, root):
    items = [
        ("audit.events", "replay-1", "OrderCreated", "replay-1", {"amount": 10}),
        ("audit.events", "replay-1", "OrderPaid", "replay-1", {"amount": 10}),
        ("audit.events", "replay-2", "OrderCreated", "replay-2", {"amount": 20}),
    ]
    _send(spark, root, "audit-replay", items)
    events = decode_log(_log(spark, root, "audit.events"))
    at = f"{root}/tables/replayed"
    for version in (1, 2):
        projection.rebuild(events, at, version)
    old, new = tables.read_version(spark, at, 1), tables.read_version(spark, at)
    return {"rows": new, "changes": projection.diff(old, new, "order_id")}


def _placed(spark: SparkSession, root: str, name: str, count: int) -> DataFrame:
    numbers = spark.range(1, count + 1).select(as_col("id").cast("int").alias("id"))
    records = publishing.placed_orders(numbers, "id", ORDERS)
    value = publishing.placed_value(F.current_timestamp())
    return log_store.append_log(records, f"{root}/log", name, order=["order_id"], value=value, tasks=3)


@mode("producer")
def producer(spark, root):
    report = _placed(spark, root, "producer", 12)
    log = _log(spark, root, ORDERS, batch="producer")
    return {"report": report, "placement": delivery.key_placement(log), "records": _shown(log)}


def _consume(spark: SparkSession, root: str, reader: str, expected: int | None) -> Results:
    log = log_store.stream_log(spark, f"{root}/log", [ORDERS])
    at = f"{root}/readers/{reader}"
    streams.run_available(streams.write_consumed(log, f"{at}/out", f"{at}/checkpoint"))
    schema = streams.consume(log_store.read_log(spark, f"{root}/log")).schema
    rows = streams.read_batches(spark, f"{at}/out", schema)
    result = {
        "rows": rows.where(F.col("reason").isNull()).drop("reason", "rejected_value"),
        "rejected": rows.where(F.col("reason").isNotNull()),
    }
    if expected is not None:
        result["status"] = log_store.read_status(result["rows"], expected)
    return result


@mode("consumer")
def consumer(spark, root):
    """Reads on from where this reader stopped, and says whether 12 records have come."""
    return _consume(spark, root, "order-group-1", 12)


@mode("producer-safe")
def producer_safe(spark, root):
    report = _placed(spark, root, "producer-safe", 10)
    return {"report": report, "outcome": log_store.outcome_report(_log(spark, root, ORDERS, batch="producer-safe"))}


@mode("consumer-safe")
def consumer_safe(spark, root):
    """As ``consumer``; what cannot be read is set apart with its reason and never dropped."""
    return _consume(spark, root, "consumer-safe-group", None)


@mode("all")
def run_all(spark, root):
    names = [n for n in MODES if n not in ("all", "producer", "consumer", "producer-safe", "consumer-safe")]
    return {f"{n}: {k}": df for n in names for k, df in MODES[n](spark, root).items()}
