import pytest
from pyspark.sql import functions as F

from helpers import decoded, plan_of, rows
from logweir.functions.codes import header_text
from logweir.operators import contract, delivery, facts, inbox, outbox, projection, publishing, retry, routing, saga
from logweir.sources import log_store, tables

EVENTS = [
    (1, "e1", "OrderCreated", "a", {"amount": 10}),
    (2, "e2", "OrderPaid", "a", {"amount": 30}),
    (3, "e3", "OrderPacked", "a", {"amount": 20}),
    (4, "e4", "OrderPaid", "b", {"amount": None}),
    (5, "e5", "CustomerBlocked", "b", {"amount": 99}),
    (6, "e6", "OrderPaid", "b", {"amount": "12.9"}),
]
FOLDED = [("a", "OrderPacked", 30, "e3"), ("b", "PAID", 12, "e6")]
SEQ = ["seq"]


# ---------------------------------------------------------------- projections


def test_projection(spark):
    assert rows(projection.project_orders(decoded(spark, EVENTS), SEQ)) == FOLDED


@pytest.mark.parametrize("cut", range(7))
def test_projection_of_parts_merges_to_the_whole(spark, cut):
    log = decoded(spark, EVENTS)
    old = projection.project_orders(log.where(F.col("seq") <= cut), SEQ)
    new = projection.project_orders(log.where(F.col("seq") > cut), SEQ)
    assert rows(projection.merge_orders(old, new)) == FOLDED


def test_redelivery_does_not_change_the_projection(spark):
    log = decoded(spark, EVENTS)
    assert rows(projection.project_orders(log.unionByName(log).repartition(5), SEQ)) == FOLDED


def test_replay_twice_gives_the_same_rows(spark, tmp_path):
    log, root = decoded(spark, EVENTS), str(tmp_path / "p")
    projection.rebuild(log, root, 1, SEQ)
    projection.rebuild(log, root, 2, SEQ)
    v1, v2 = tables.read_version(spark, root, 1), tables.read_version(spark, root, 2)
    assert projection.diff(v1, v2, "order_id").count() == 0 and rows(v2) == FOLDED


def test_diff_names_the_change(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "id string, v int")
    b = spark.createDataFrame([("x", 1), ("y", 3), ("z", 4)], "id string, v int")
    assert rows(projection.diff(a, b, "id"), "id", "change") == [("y", "changed"), ("z", "added")]
    assert rows(projection.diff(b, a, "id"), "id", "change") == [("y", "changed"), ("z", "removed")]


def test_projection_is_combined_before_its_only_shuffle(spark):
    plan = plan_of(projection.project_orders(decoded(spark, EVENTS), SEQ))
    assert plan.count("Exchange") == 1 and "partial_max_by" in plan.split("Exchange")[1]


# ---------------------------------------------------------------- inbox and outbox


PAID = [
    (1, "p1", "OrderPaid", "o1", {"amount": 5}),
    (2, "p1", "OrderPaid", "o1", {"amount": 5}),
    (3, "p2", "OrderPaid", "o1", {"amount": 7}),
    (4, "p3", "OrderPaid", "o2", {"amount": 9}),
    (5, "p4", "OrderCreated", "o3", {"amount": 1}),
]


def _apply(spark, log, ids, payments):
    seen = spark.createDataFrame([(i,) for i in ids], "event_id string")
    paid = spark.createDataFrame(payments, "order_id string, amount int")
    new_ids, new_paid = inbox.apply_inbox(log, seen, paid, SEQ)
    return rows(new_ids), rows(new_paid)


def test_inbox_first_payment_stands_and_every_new_id_is_kept(spark):
    log = decoded(spark, PAID)
    assert _apply(spark, log, [], []) == ([("p1",), ("p2",), ("p3",)], [("o1", 5), ("o2", 9)])
    # Known id: skipped. Paid order: its event still enters the inbox.
    assert _apply(spark, log, ["p1"], [("o2", 1)]) == ([("p2",), ("p3",)], [("o1", 7)])


def test_inbox_twice_is_once(spark):
    log = decoded(spark, PAID)
    ids, paid = _apply(spark, log, [], [])
    assert _apply(spark, log, [i for (i,) in ids], paid) == ([], [])


def _changes(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("order-"), "id").alias("id"),
        F.lit("PAID").alias("status"),
        F.col("id").cast("int").alias("amount"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id")).alias("updated_at"),
    )


def test_outbox_rows_are_hidden_until_the_batch_is_committed(spark, tmp_path):
    root = str(tmp_path)
    outbox.write_outbox(_changes(spark, 5), root, "b1")
    orders, box = outbox.stage_outbox(_changes(spark, 9))
    orders.write.parquet(f"{root}/orders/batch=b2")
    assert outbox.read_committed(spark, root, "orders").count() == 5
    box.write.parquet(f"{root}/outbox/batch=b2")
    tables.commit(spark, root, "b2")
    assert outbox.read_committed(spark, root, "orders").count() == 14
    assert outbox.read_committed(spark, root, "outbox").count() == 14


def test_relay_publishes_oldest_first_and_once(spark, tmp_path):
    _, box = outbox.stage_outbox(_changes(spark, 40))
    root = str(tmp_path / "log")
    _, after = outbox.relay_once(box, root, "r1")
    log = log_store.read_log(spark, root).orderBy("partition", "offset").collect()
    by_partition = {}
    for r in log:
        by_partition.setdefault(r.partition, []).append(int(r.key.split("-")[1]))
    assert sum(map(len, by_partition.values())) == 40
    assert all(v == sorted(v) for v in by_partition.values())
    assert outbox.pending(after).count() == 0 and outbox.relay(after).count() == 0


def test_relay_stopped_before_marking_sends_again_and_the_inbox_absorbs_it(spark, tmp_path):
    from logweir.functions.envelope import decode_log

    _, box = outbox.stage_outbox(_changes(spark, 10))
    root = str(tmp_path / "log")
    outbox.relay_once(box, root, "r1")
    outbox.relay_once(box, root, "r2")
    events = decode_log(log_store.read_log(spark, root))
    assert events.count() == 20
    seen, paid = (tables.empty_table(spark, n) for n in ("inbox", "billing_payments"))
    ids, payments = inbox.apply_inbox(events, seen, paid, ["timestamp", "partition", "offset"])
    assert ids.count() == 10 and payments.count() == 10


def test_rows_added_while_relaying_stay_pending(spark, tmp_path):
    _, box = outbox.stage_outbox(_changes(spark, 12))
    early = box.where(F.get_json_object("payload", "$.payload.amount").cast("int") < 8)
    root = str(tmp_path / "log")
    outbox.relay_once(early, root, "r1")
    ids = log_store.read_log(spark, root).select(F.get_json_object("value", "$.eventId").alias("id"))
    assert outbox.pending(tables.mark(box, ids, "id", "published")).count() == 4


# ---------------------------------------------------------------- retries

TRUTH = {
    "ok": ("processed", 1, None),
    None: ("processed", 1, None),
    "temporary": ("processed", 2, "case=temporary; attempt=1"),
    "temporary-long": ("processed", 3, "case=temporary-long; attempt=2"),
    "poison": ("dlt", 1, "case=poison; attempt=1"),
    "weird": ("dlt", 3, "case=weird; attempt=3"),
}


def _cases(spark):
    return spark.createDataFrame(
        [(c, "{}" if c is None else f'{{"case":"{c}"}}') for c in TRUTH], "name string, payload string"
    )


def test_retry_truth_table(spark):
    got = retry.retry_chain(_cases(spark)).collect()
    assert {r.name: (r.outcome, r.attempt, r.x_error) for r in got} == TRUTH


def test_tiers_one_by_one_equal_the_chain(spark):
    left, ends = _cases(spark).withColumn("x_error", F.lit(None).cast("string")), {}
    for tier in retry.TIERS:
        staged = retry.retry_stage(left, tier).withColumn("new_error", header_text("headers")).collect()
        onward = []
        for r in staged:
            if r.outcome == "processed":
                ends[r.name] = ("processed", tier.attempt, r.x_error)
            elif r.target == retry.DEAD_LETTERS:
                ends[r.name] = ("dlt", tier.attempt, r.new_error)
            else:
                assert r.target == tier.next_topic
                onward.append((r.name, r.payload, r.new_error))
        left = spark.createDataFrame(onward, "name string, payload string, x_error string")
    assert left.count() == 0 and ends == TRUTH


def test_unreadable_records_are_quarantined(spark):
    bad = spark.createDataFrame([("a", "{bad"), ("b", None), ("c", "[1]"), ("d", "{}")], "name string, payload string")
    chain = {r.name: (r.outcome, r.attempt, r.x_error) for r in retry.retry_chain(bad).collect()}
    assert chain == {n: ("quarantined", 1, None) for n in "abc"} | {"d": ("processed", 1, None)}
    staged = {r.name: (r.outcome, r.target, r.headers) for r in retry.retry_stage(bad, retry.TIERS[0]).collect()}
    assert staged == {n: ("quarantined", None, None) for n in "abc"} | {"d": ("processed", None, None)}
    assert retry.retry_hops(bad).count() == 0


def test_hops_are_the_records_the_tiers_write(spark):
    got = {(r.name, r.attempt, r.target) for r in retry.retry_hops(_cases(spark)).collect()}
    assert got == {
        ("temporary", 1, "orders.retry.1"),
        ("temporary-long", 1, "orders.retry.1"), ("temporary-long", 2, "orders.retry.2"),
        ("poison", 1, "orders.dlt"),
        ("weird", 1, "orders.retry.1"), ("weird", 2, "orders.retry.2"), ("weird", 3, "orders.dlt"),
    }


def test_a_chain_must_end_in_the_dead_letters(spark):
    with pytest.raises(ValueError):
        retry.retry_chain(_cases(spark), retry.TIERS[:2])


# ---------------------------------------------------------------- sagas


def test_saga_replies_follow_the_rules_to_the_end(spark):
    log = decoded(spark, [(1, "c1", "OrderCreated", "s1", {"amount": 9}), (2, "x", "OrderPaid", "s2", {"amount": 1})])
    got = rows(saga.saga_replies(log), "key", "hop", "topic", "event_type")
    assert got == [
        ("s1", 1, "payments.events", "PaymentReserved"),
        ("s1", 2, "warehouse.events", "StockReserved"),
        ("s1", 3, "orders.events", "OrderConfirmed"),
    ]


def test_a_log_with_its_replies_needs_no_more(spark):
    log = decoded(spark, [(1, "c1", "OrderCreated", "s1", {"amount": 9}), (2, "c2", "OrderCreated", "s2", {"amount": 1})])
    log = log.select("topic", "event_type", "aggregate_id", "event_id", "payload")
    replies = saga.saga_replies(log)
    assert saga.saga_replies(log.unionByName(replies.select(*log.columns))).count() == 0
    some = replies.where("hop = 1 or (hop = 2 and key = 's1')").select(*log.columns)
    left = saga.saga_replies(log.unionByName(some))
    expected = replies.join(some.select("event_id"), "event_id", "left_anti")
    assert rows(left, "key", "event_type", "event_id", "caused_by") == rows(expected, "key", "event_type", "event_id", "caused_by")


def test_outbox_batches_keep_their_names_and_are_written_once(spark, tmp_path):
    root = str(tmp_path)
    outbox.write_outbox(_changes(spark, 5), root, "001")
    assert outbox.read_committed(spark, root, "orders").count() == 5
    outbox.write_outbox(_changes(spark, 3), root, "001")
    assert outbox.read_committed(spark, root, "outbox").count() == 5


def test_saga_checks_the_topic_of_the_trigger(spark):
    log = decoded(spark, [(1, "c1", "OrderCreated", "s1", {"amount": 9})], topic="payments.events")
    assert saga.saga_replies(log).count() == 0


def test_circular_rules_end(spark):
    rules = [saga.Rule("t", "A", "t", "B"), saga.Rule("t", "B", "t", "A")]
    log = decoded(spark, [(1, "e", "A", "k", {"x": 1})], topic="t")
    assert rows(saga.saga_replies(log, rules), "hop", "event_type") == [(1, "B")]


def test_saga_progress(spark):
    log = decoded(
        spark,
        [
            (0, "1", "OrderCreated", "old", {"x": 1}),
            (0, "2", "OrderCreated", "done", {"x": 1}),
            (5, "3", "OrderConfirmed", "done", {"x": 1}),
            (7000, "4", "OrderCreated", "new", {"x": 1}),
            (7100, "5", "PaymentReserved", "new", {"x": 1}),
        ],
    )
    as_of = F.timestamp_seconds(F.lit(1704067200 + 7200))
    got = rows(saga.saga_progress(log, as_of, "1 hour"), "aggregate_id", "furthest_step", "next_step", "stuck")
    assert got == [
        ("done", "OrderConfirmed", None, False),
        ("new", "PaymentReserved", "StockReserved", False),
        ("old", "OrderCreated", "PaymentReserved", True),
    ]


# ---------------------------------------------------------------- contracts, delivery, routing


def test_contract_summary(spark):
    events = spark.createDataFrame(
        [("T", 1, '{"customerId":null,"name":"A"}'), ("T", 1, "{}"), ("T", 2, "[1]"), ("T", 2, None)],
        "event_type string, event_version int, payload string",
    )
    checked = contract.check_contract(events)
    assert rows(contract.contract_summary(checked)) == [("T", 1, 2, 1, 1), ("T", 2, 2, 0, 2)]


def _placed(spark, data):
    log = spark.createDataFrame(data, "key string, partition int, offset long, step int")
    return log.withColumn("topic", F.lit("t"))


@pytest.mark.parametrize("block", [1, 2, 3, 1 << 20])
def test_order_check_does_not_depend_on_the_block(spark, block):
    steps = [1, 3, 2, 2, 5, 4, 4, 1, 9]
    hot = [("hot", 0, 2 * i, s) for i, s in enumerate(steps)]
    got = delivery.order_check(_placed(spark, [*hot, ("cold", 1, 0, 7), ("two", 1, 5, 2), ("two", 2, 1, 1)]), "step", block)
    assert rows(got) == [("t", "cold", 1, 1, 0), ("t", "hot", 1, 9, 3), ("t", "two", 2, 2, 0)]


def test_topics_are_kept_apart(spark):
    log = _placed(spark, [("k", 0, 0, 5), ("k", 0, 2, 6), ("k", 0, 1, 1), ("k", 0, 3, 2)])
    log = log.withColumn("topic", F.when(F.col("step") > 3, F.lit("a")).otherwise(F.lit("b")))
    assert rows(delivery.order_check(log, "step")) == [("a", "k", 1, 2, 0), ("b", "k", 1, 2, 0)]
    assert rows(delivery.key_placement(log)) == [("a", "k", 1, 2), ("b", "k", 1, 2)]


def test_placement_flags_keys_in_several_partitions(spark):
    log = _placed(spark, [("a", 0, 0, 1), ("a", 0, 1, 1), ("b", 0, 2, 1), ("b", 1, 0, 1)])
    assert rows(delivery.key_placement(log)) == [("t", "a", 1, 2), ("t", "b", 2, 2)]


def test_assignment_is_consecutive_ranges(spark):
    got = rows(delivery.assignment(spark, {"g": ["b", "a"], "h": ["x"]}, 3))
    assert got == [("g", "a", 0), ("g", "a", 1), ("g", "b", 2), ("h", "x", 0), ("h", "x", 1), ("h", "x", 2)]


def test_members_beyond_the_partitions_receive_nothing(spark):
    log = _placed(spark, [("a", p, o, 1) for p in range(3) for o in range(p + 1)])
    got = delivery.received_and_missed(log, delivery.assignment(spark, {"g": list("abcd")}, 3))
    assert rows(got) == [("g", "a", 1, 5), ("g", "b", 2, 4), ("g", "c", 3, 3), ("g", "d", 0, 6)]


def test_received_and_missed_make_up_the_log(spark):
    log = _placed(spark, [("a", i % 3, i, 1) for i in range(50)])
    assigned = delivery.assignment(spark, {"shared": ["x", "y"], "own": ["z"]})
    for r in delivery.received_and_missed(log, assigned).collect():
        assert r.received + r.missed == 50
        shared = assigned.where(F.col("group") == r.group)
        assert delivery.missed_events(log, shared, r.member).count() == r.missed


def test_log_is_counted_before_it_meets_the_groups(spark):
    log = _placed(spark, [("a", 0, 0, 1)])
    plan = plan_of(delivery.received_and_missed(log, delivery.assignment(spark, {"g": ["a"]})))
    below = plan.split("Join")[-1]
    assert "partial_count" in below


def test_received_counts(spark):
    df = spark.createDataFrame([("r1",), ("r1",), ("r2",)], "reader string")
    assert rows(delivery.received_counts(df)) == [("r1", 2), ("r2", 1)]


def test_routing_falls_back(spark):
    log = decoded(spark, EVENTS)
    assert {r.target for r in routing.route(log, {"OrderPaid": "paid"}).collect()} == {"paid", "orders.events"}
    assert {r.target for r in routing.route(log, {"OrderPaid": "paid"}, "rest").collect()} == {"paid", "rest"}
    assert sum(r.records for r in routing.type_mix(log).collect()) == 6


def test_facts_keep_unknown_keys_and_states_take_the_highest_version(spark):
    known = spark.createDataFrame([("a", "ACME")], "k string, name string")
    fact = spark.createDataFrame([("a",), ("b",)], "k string")
    assert {tuple(r) for r in facts.enrich_facts(fact, known, "k").collect()} == {("a", "ACME"), ("b", None)}
    states = spark.createDataFrame([("a", "x", 1), ("a", "y", 5), ("a", "z", 3)], "k string, s string, version int")
    assert rows(facts.latest_state(states, ["k"])) == [("a", "y", 5)]


def test_placed_orders_are_keyed_by_user(spark):
    placed = publishing.placed_orders(spark.range(1, 7).withColumnRenamed("id", "n"), "n")
    assert rows(placed, "n", "key", "product")[:3] == [(1, "10", "Keyboard"), (2, "20", "Mouse"), (3, "30", "Monitor")]
    payload = F.get_json_object(publishing.placed_value(F.current_timestamp()), "$.payload")
    assert placed.where("n = 2").select(payload).first()[0] == '{"orderId":2,"userId":20,"product":"Mouse"}'


def test_lookup_tables_are_literals(spark):
    from logweir import session

    table = session.lookup_table(spark, [("a", 1, ["x"]), (None, 2, [])], "k string, v int, p array<string>")
    assert [tuple(r) for r in table.collect()] == [("a", 1, ["x"]), (None, 2, [])]
    assert table.dtypes == [("k", "string"), ("v", "int"), ("p", "array<string>")]
    assert session.lookup_table(spark, [], "k string").count() == 0
