"""Golden cases: the fixed records of each mode and what must come of them."""

import pytest

from helpers import rows
from logweir.plans.modes import MODES


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    return str(tmp_path_factory.mktemp("modes"))


def run(spark, root, name):
    return MODES[name](spark, root)


def test_init(spark, root):
    out = run(spark, root, "init")
    assert set(out) == {"orders", "outbox", "inbox", "billing_payments", "order_projection"}
    assert all(df.count() == 0 for df in out.values())


def test_basic_entities(spark, root):
    out = run(spark, root, "basic-entities")
    assert rows(out["placement"], "key", "partitions", "records") == [("order-0", 1, 2), ("order-1", 1, 2), ("order-2", 1, 2)]
    assert rows(out["status"]) == [(6, 6, True)]
    assert sum(r.records for r in out["report"].collect()) == 6


def test_partition_order(spark, root):
    out = run(spark, root, "partition-order")
    order = {r.key: r for r in out["order"].collect()}
    assert (order["order-42"].partitions, order["order-42"].records, order["order-42"].inversions) == (1, 4, 0)
    keyed = [r for r in sorted(out["tail"].collect(), key=lambda r: r.offset) if r.key == "order-42"]
    assert [r.status for r in keyed] == ["Created", "Paid", "Packed", "Shipped"]
    assert {r.partition for r in keyed} == {0}


def test_consumer_groups(spark, root):
    out = run(spark, root, "consumer-groups")
    got = {(r.group, r.member): r.received for r in out["received"].collect()}
    assert got["billing-service", "billing-1"] + got["billing-service", "billing-2"] == 9
    assert got["fraud-service", "fraud-1"] == 9


def test_event_styles(spark, root):
    out = run(spark, root, "event-styles")
    assert rows(out["facts"], "event_type", "order_id") == [("OrderPaid", "order-777")]
    state = out["states"].first()
    assert (state.aggregate_id, state["name"], state.segment, state.status, state.version) == (
        "customer-19", "Northlight", "B2B", "ACTIVE", 5,
    )


def test_outbox(spark, root):
    out = run(spark, root, "outbox")
    assert rows(out["records"], "key", "event_type") == [("order-outbox-1", "OrderPaid")]
    assert rows(out["outbox"], "aggregate_id", "published") == [("order-outbox-1", True)]
    assert out["pending"].count() == 0


def test_inbox(spark, root):
    out = run(spark, root, "inbox")
    assert out["inbox"].count() == 1
    assert rows(out["payments"]) == [("order-inbox-1", 2400)]
    assert out["count"].first()[0] == 1


def test_cqrs_saga(spark, root):
    out = run(spark, root, "cqrs-saga")
    got = {(r.topic, r.event_type) for r in out["events"].collect()}
    assert got == {
        ("orders.events", "OrderCreated"),
        ("payments.events", "PaymentReserved"),
        ("warehouse.events", "StockReserved"),
        ("orders.events", "OrderConfirmed"),
    }
    assert rows(out["row"], "order_id", "status", "amount") == [("saga-42", "CONFIRMED", 990)]
    progress = out["progress"].first()
    assert (progress.furthest_step, progress.next_step, progress.stuck) == ("OrderConfirmed", None, False)


def test_retry_dlt(spark, root):
    out = run(spark, root, "retry-dlt")
    assert rows(out["finals"], "key", "outcome", "attempt") == [
        ("bad-1", "dlt", 1), ("ok-1", "processed", 1), ("slow-1", "processed", 3), ("temp-1", "processed", 2),
    ]
    assert rows(out["dead_letters"]) == [("case=poison; attempt=1", 1, 1)]
    assert rows(out["hops"], "key", "target", "x_error") == [
        ("bad-1", "orders.dlt", "case=poison; attempt=1"),
        ("slow-1", "orders.retry.1", "case=temporary-long; attempt=1"),
        ("slow-1", "orders.retry.2", "case=temporary-long; attempt=2"),
        ("temp-1", "orders.retry.1", "case=temporary; attempt=1"),
    ]


def test_contract(spark, root):
    out = run(spark, root, "contract")
    got = sorted((r.event_version, r.compatible, tuple(r.missing)) for r in out["checked"].collect())
    assert got == [(1, True, ()), (2, True, ()), (3, False, ("customerId", "name"))]


def test_bad_shared_group(spark, root):
    got = run(spark, root, "bad-shared-group")["received"].collect()
    assert sum(r.received for r in got) == 6 and sum(r.missed for r in got) == 6
    assert all(r.received + r.missed == 6 for r in got)


def test_good_separate_groups(spark, root):
    out = run(spark, root, "good-separate-groups")
    assert {(r.received, r.missed) for r in out["received"].collect()} == {(4, 0)}
    assert out["load"].first().load_factor == 2.0


def test_bad_universal_topic(spark, root):
    out = run(spark, root, "bad-universal-topic")
    assert rows(out["summary"]) == [("all.events", 3, "CustomerBlocked,InvoiceSent,OrderPaid", 3)]
    assert len({r.target for r in out["routed"].collect()}) == 3


def test_audit_replay(spark, root):
    for _ in range(2):
        out = run(spark, root, "audit-replay")
        assert rows(out["rows"], "order_id", "status", "amount") == [
            ("replay-1", "PAID", 10), ("replay-2", "CREATED", 20),
        ]
        assert out["changes"].count() == 0


def test_producer_then_consumer(spark, tmp_path):
    root = str(tmp_path)
    out = run(spark, root, "producer")
    assert rows(out["placement"], "key", "partitions", "records") == [("10", 1, 4), ("20", 1, 4), ("30", 1, 4)]
    assert {(r.key, r.partition) for r in out["records"].collect()} == {("10", 1), ("20", 1), ("30", 0)}
    read = run(spark, root, "consumer")
    assert rows(read["status"]) == [(12, 12, True)]
    by_id = {r.order_id: r for r in read["rows"].collect()}
    assert (by_id[1].user_id, by_id[1].product, by_id[12].product) == (10, "Keyboard", "Smartwatch")
    safe = run(spark, root, "producer-safe")
    assert rows(safe["outcome"]) == [("orders.events", "accepted", 10)]
    # The same reader goes on where it stopped; another one starts from the beginning.
    assert run(spark, root, "consumer")["rows"].count() == 22
    assert run(spark, root, "consumer-safe")["rows"].count() == 22
