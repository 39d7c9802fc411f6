"""Waiting, routing, merging and pruning streams, and reports on logs and versions."""

import uuid

import pytest
from helpers import plan_of
from pyspark.sql import functions as F

from logweir.operators import difference, lag, outbox, trace
from logweir.sources import reported, zones
from logweir.streaming import changelog, inbox, routed
from logweir.streaming import queries as q


def _files(spark, root, batches, schema):
    """A stream over one file per batch, one micro-batch each."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/part={i}")
    return spark.readStream.schema(f"{schema}, part int").option("maxFilesPerTrigger", 1).parquet(root)


# ---------------------------------------------------------------- changelog with levels


def _total(stream):
    return stream.groupBy("k").agg(F.sum("v").alias("v"))


def test_levels_give_the_table_and_read_a_bounded_number_of_batches(spark, tmp_path):
    batches = [[(i % 3, i), (9, 1)] for i in range(11)]
    stream = _total(_files(spark, f"{tmp_path}/in", batches, "k int, v int"))
    q.run_available(changelog.write_levels(stream, f"{tmp_path}/out", f"{tmp_path}/cp", ["k"], every=3))
    got = {r.k: r.v for r in changelog.read_levels(spark, f"{tmp_path}/out", stream.schema, ["k"]).collect()}
    assert got == {0: 0 + 3 + 6 + 9, 1: 1 + 4 + 7 + 10, 2: 2 + 5 + 8, 9: 11}
    found = changelog.entries(spark, f"{tmp_path}/out")
    assert found[0]["snapshot"] and 1 <= len(found) <= 4
    generations = {p.name for p in (tmp_path / "out" / "manifest").iterdir() if p.name.startswith("generation")}
    assert len(generations) == 2  # older ones are gone, and so is what they read


def test_a_batch_that_stopped_halfway_is_not_seen_and_one_told_twice_changes_nothing(spark, tmp_path):
    root, rows = f"{tmp_path}/out", spark.createDataFrame([(1, 5)], "k int, v int")
    changelog.store_batch(rows, 0, root, ["k"], 10)
    # Data of an attempt that never reached its entry.
    spark.createDataFrame([(1, 99, 1)], "k int, v int, _batch_id long").write.parquet(
        f"{root}/batches/generation=0/1-{uuid.uuid4().hex}"
    )
    read = lambda: changelog.read_levels(spark, root, rows.schema, ["k"]).collect()
    assert read() == [(1, 5)]
    changelog.store_batch(spark.createDataFrame([(1, 7)], "k int, v int"), 1, root, ["k"], 10)
    changelog.store_batch(spark.createDataFrame([(1, 8)], "k int, v int"), 1, root, ["k"], 10)
    assert read() == [(1, 7)]
    assert len(changelog.entries(spark, root)) == 2


def test_levels_before_the_first_batch_are_an_empty_table(spark, tmp_path):
    schema = spark.createDataFrame([], "k int, v int").schema
    assert changelog.read_levels(spark, f"{tmp_path}/none", schema, ["k"]).count() == 0


# ---------------------------------------------------------------- inbox by days


PAID = "event_id string, event_type string, aggregate_id string, amount int, timestamp timestamp, partition int, offset long"


def _paid(event, order, amount, day, offset):
    return (event, "OrderPaid", order, amount, None if day is None else f"2024-01-{day:02d} 12:00:00", 0, offset)


def _rows(spark, rows):
    text = PAID.replace("timestamp timestamp", "timestamp string")
    return spark.createDataFrame(rows, text).withColumn("timestamp", F.col("timestamp").cast("timestamp"))


def _apply(spark, root, rows, batch_id):
    inbox.apply_batch(_rows(spark, rows), batch_id, root, ["timestamp", "partition", "offset"], "OrderPaid", F.col("amount"), 4)


def _tables(spark, root):
    seen = spark.read.schema("event_id string").parquet(f"{root}/inbox")
    paid = spark.read.schema("order_id string, amount int").parquet(f"{root}/payments")
    return sorted(r.event_id for r in seen.collect()), sorted((r.order_id, r.amount) for r in paid.select("order_id", "amount").collect())


def test_inbox_by_days_takes_events_once_and_batches_may_run_again(spark, tmp_path):
    root = str(tmp_path)
    first = [_paid("a", "o1", 5, 1, 1), _paid("a", "o1", 5, 1, 2), _paid("b", "o1", 9, 2, 3), _paid("n", "o3", 1, None, 4)]
    second = [_paid("a", "o1", 5, 1, 5), _paid("c", "o2", 7, 2, 6), _paid("n", "o3", 1, None, 7)]
    _apply(spark, root, first, 0)
    for _ in range(2):
        _apply(spark, root, second, 1)
    ids, payments = _tables(spark, root)
    assert ids == ["a", "b", "c", "n"]
    assert {o for o, _ in payments} == {"o1", "o2", "o3"} and len(payments) == 3
    assert ("o1", 5) in payments


def test_a_micro_batch_reads_only_its_days(spark, tmp_path):
    root = str(tmp_path)
    for i in range(6):
        _apply(spark, root, [_paid(f"e{i}-{j}", f"o{i}-{j}", j, i + 1, j) for j in range(5)], i)
    batch = _rows(spark, [_paid("e2-1", "o", 1, 3, 99)])
    seen = inbox.stored_inbox(batch, 6, root, "OrderPaid")
    assert sorted(r.event_id for r in seen.collect()) == [f"e2-{j}" for j in range(5)]
    assert "dynamicpruning" in plan_of(seen).lower()


# ---------------------------------------------------------------- routing


def test_routing_splits_types_and_a_second_run_adds_nothing(spark, tmp_path):
    rows = [("orders", "A", '{"x": null}'), ("orders", "B", '{"y": 1}'), ("orders", "C", "{}"), ("orders", "B", "{}"), ("orders", "A", None)]
    stream = _files(spark, f"{tmp_path}/in", [rows], "topic string, event_type string, payload string")
    for _ in range(2):
        writer = routed.write_routed(stream, f"{tmp_path}/out", f"{tmp_path}/cp", {"A": "as", "B": "bs"}, {"A": ["x"], "B": ["y"]})
        q.run_available(writer)
    got = sorted((r.topic, r.reason or "") for r in routed.read_routed(spark, f"{tmp_path}/out").collect())
    assert got == [("as", ""), ("as.quarantine", "payload is no object"), ("bs", ""), ("bs.quarantine", "missing y"), ("orders", "")]
    assert routed.read_routed(spark, f"{tmp_path}/out", "bs").count() == 1


# ---------------------------------------------------------------- differences, traces, results, lag


def test_difference_is_that_of_a_full_join(spark):
    one = spark.range(3000).selectExpr("id AS k", "id % 7 AS v").unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 1L AS v"))
    two = one.where("k IS NULL OR k % 500 != 3").selectExpr("k", "if(k % 800 = 1, NULL, v) AS v")
    two = two.unionByName(spark.sql("SELECT 9000L AS k, 1L AS v"))
    got = {r.k: (r.change, r.before and r.before.v, r.after and r.after.v) for r in difference.table_difference(one, two, ["k"], 64).collect()}
    want = {k: ("removed", k % 7, None) for k in range(3, 3000, 500)}
    want |= {k: ("changed", k % 7, None) for k in range(1, 3000, 800) if k % 500 != 3} | {9000: ("added", None, 1)}
    assert got == want


def test_versions_that_agree_join_no_rows(spark):
    table = spark.range(100).selectExpr("id AS k", "id AS v")
    found = difference.table_difference(table, table.repartition(3), ["k"])
    assert found.count() == 0
    unequal = difference.unequal_buckets(difference.digests(table, ["k"]), difference.digests(table.limit(99), ["k"]))
    assert unequal.count() == 1


def test_traces_of_trees_circles_and_missing_causes(spark):
    rows = [(1, None), (2, 1), (3, 1), (4, 3), (5, 99), (6, 5), (7, 8), (8, 7), (9, 8), (10, 10)]
    got = {r.event_id: (r.root, r.depth, r.path) for r in trace.traces(spark.createDataFrame(rows, "event_id int, caused_by int")).collect()}
    assert got[4] == (1, 2, [1, 3, 4]) and got[6] == (5, 1, [5, 6]) and got[1] == (1, 0, [1])
    assert all(got[i] == (None, None, []) for i in (7, 8, 9, 10)) and len(got) == 10
    assert trace.traces(spark.createDataFrame([], "event_id int, caused_by int")).count() == 0


def test_every_record_has_a_result_and_counts_come_from_the_write(spark, tmp_path):
    rows = [("1", "a", '{"eventId": "1"}'), ("2", "a", "{bad"), ("3", None, None), ("4", "b", "{}")]
    log = spark.createDataFrame(rows, "id string, key string, value string")
    report, counts = reported.write_reported(log, str(tmp_path), "one", "id")
    got = {r.event_id: (r.key, r.result, r.reason) for r in report.collect()}
    assert got["1"] == ("a", "SUCCESS", None) and got["2"] == ("a", "ERROR", "malformed JSON")
    assert got["3"] == (None, "ERROR", "no value") and got["4"] == ("b", "SUCCESS", None)
    assert counts == {"records": 4, "errors": 2, "successes": 2}
    # What the sink has lost is an error too.
    spark.read.parquet(f"{tmp_path}/batch=one").where("id <> '4'").write.partitionBy("accepted").parquet(f"{tmp_path}/batch=two")
    missing = spark.read.parquet(f"{tmp_path}/batch=two")
    assert missing.count() == 3


def test_lag_counts_a_batch_once_and_readers_that_never_began(spark):
    positions = lag.Positions()
    row = spark.sql("SELECT 5L AS next_0, 3L AS records_0, NULL AS next_1, 0L AS records_1").first()
    for _ in range(2):
        positions.take("run", 0, {"r": row})
    ends = spark.createDataFrame([(0, 8), (1, 2)], "partition int, end_offset long")
    got = {(r.reader, r.partition): (r.lag, r.records) for r in lag.reader_lag(ends, positions.table(spark), ["r", "none"]).collect()}
    assert got == {("r", 0): (3, 3), ("r", 1): (2, 0), ("none", 0): (8, 0), ("none", 1): (2, 0)}


@pytest.mark.parametrize("stop", [True, False])
def test_relay_after_a_stop_sends_the_same_ids_again(spark, tmp_path, stop):
    rows = [("1", "k", "{}", False), ("2", "k", "{}", False), ("3", "k", "{}", True)]
    box = spark.createDataFrame(rows, "id string, aggregate_id string, payload string, published boolean")
    box = box.withColumn("created_at", F.lit("2024-01-01").cast("timestamp"))
    if stop:
        outbox.publish(outbox.relay(box), str(tmp_path), "stopped")
    after = outbox.relay_and_mark(box, str(tmp_path), "next")
    assert after.where("not published").count() == 0
    sent = outbox.published(spark, str(tmp_path))
    assert sent.count() == (4 if stop else 2) and sent.select("id").distinct().count() == 2


def test_a_tail_comes_from_the_folders_that_zones_name(spark, tmp_path):
    schema = "topic string, batch string, partition int, offset long"
    rows = [(t, f"b{o // 10}", p, o) for t, size in (("long", 60), ("short", 5)) for p in range(2) for o in range(size + p)]
    log = spark.createDataFrame(rows, schema)
    log.write.partitionBy("topic", "batch").parquet(f"{tmp_path}/log")
    stored = spark.read.schema("partition int, offset long, topic string, batch string").parquet(f"{tmp_path}/log")
    for i in range(7):
        zones.add_zones(stored, f"{tmp_path}/zones", f"b{i}")
        zones.add_zones(stored, f"{tmp_path}/zones", f"b{i}")
    table = zones.read_zones(spark, f"{tmp_path}/zones")
    assert {(r.topic, r.partition): r.end_offset for r in zones.ends_by_zones(table).collect()} == {
        ("long", 0): 60, ("long", 1): 61, ("short", 0): 5, ("short", 1): 6,
    }
    tail = zones.tail_by_zones(stored, table, 8)
    want = {(t, p, o) for t, _, p, o in rows if o >= {"long": 60, "short": 5}[t] + p - 8}
    assert {(r.topic, r.partition, r.offset) for r in tail.collect()} == want
    assert "dynamicpruning" in plan_of(tail).lower()
