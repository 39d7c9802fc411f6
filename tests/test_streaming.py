"""Streaming forms equal the batch forms, with several files, any order, and redelivery."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import records, rows
from logweir.functions.envelope import decode_log
from logweir.operators import inbox, projection, retry
from logweir.sources import log_store as ls
from logweir.sources import tables
from logweir.streaming import queries as q

KINDS = ["OrderCreated", "OrderPaid", "OrderConfirmed", "OrderPacked", "CustomerBlocked"]
CASES = ["ok", "temporary", "temporary-long", "poison", "weird"]


def _items(n, seed=3):
    rnd = random.Random(seed)
    return [
        (i, f"e{i}", rnd.choice(KINDS), f"o{rnd.randrange(6)}", {"amount": rnd.randrange(100), "case": rnd.choice(CASES)})
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def log_root(spark, tmp_path_factory):
    """Five batches; every seventh record comes again in a later one."""
    root = str(tmp_path_factory.mktemp("log") / "log")
    items = _items(120)
    again = [item for item in items if item[0] % 7 == 0]
    parts = [items[:40], items[40:80], again, items[80:], again]
    for n, part in enumerate(parts):
        ls.append_log(records(spark, part), root, f"b{n}", order=["seq"], tasks=3)
    return root


def _stream(spark, root, topics=("orders.events",), per_batch=2):
    return ls.stream_log(spark, root, topics, files_per_batch=per_batch)


def test_projection(spark, log_root, tmp_path):
    folded = q.projection_stream(decode_log(_stream(spark, log_root)), ["timestamp", "event_id"])
    q.run_available(q.write_changelog(folded, f"{tmp_path}/out", f"{tmp_path}/cp"))
    got = q.read_changelog(spark, f"{tmp_path}/out", folded.schema, ["order_id"])
    batch = projection.project_orders(decode_log(ls.read_log(spark, log_root)), ["timestamp", "event_id"])
    assert rows(got) == rows(batch)
    assert q.read_batches(spark, f"{tmp_path}/out", folded.schema).select("batch_id").distinct().count() > 1


def test_inbox_dedup(spark, log_root, tmp_path):
    once = q.inbox_stream(decode_log(_stream(spark, log_root))).select("event_id")
    q.run_available(q.write_append(once, f"{tmp_path}/out", f"{tmp_path}/cp"))
    got = [r[0] for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    expected = {i[1] for i in _items(120) if i[2] == "OrderPaid"}
    assert len(got) == len(expected) and set(got) == expected


def test_inbox_dedup_of_one_hot_id(spark, tmp_path):
    root = str(tmp_path / "log")
    hot = [(i, "same", "OrderPaid", "o1", {"amount": 5}) for i in range(300)]
    for n in range(2):
        ls.append_log(records(spark, hot + [(301, "other", "OrderPaid", "o1", {"amount": 5})]), root, f"b{n}", order=["seq"])
    once = q.inbox_stream(decode_log(_stream(spark, root, per_batch=1)), spread=["partition", "offset"]).select("event_id")
    q.run_available(q.write_append(once, f"{tmp_path}/out", f"{tmp_path}/cp"))
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == [("other",), ("same",)]


@pytest.mark.parametrize("spread", [[], ["partition", "offset"]])
def test_inbox_dedup_with_bounded_state(spark, log_root, tmp_path, spread):
    log = decode_log(_stream(spark, log_root))
    once = q.inbox_stream(log, watermark="1 day", spread=spread).select("event_id")
    q.run_available(q.write_append(once, f"{tmp_path}/out", f"{tmp_path}/cp"))
    assert spark.read.parquet(f"{tmp_path}/out").count() == len([i for i in _items(120) if i[2] == "OrderPaid"])


@pytest.mark.parametrize("spread", [[], ["partition", "offset"]])
def test_payments_by_arrival(spark, log_root, tmp_path, spread):
    amount = F.get_json_object("payload", "$.amount").cast("int")
    paid = q.payments_stream(decode_log(_stream(spark, log_root)), amount, spread=spread)
    q.run_available(q.write_append(paid, f"{tmp_path}/out", f"{tmp_path}/cp"))
    got = spark.read.parquet(f"{tmp_path}/out")
    assert got.count() == got.select("order_id").distinct().count()
    assert {r[0] for r in got.select("order_id").collect()} == {i[3] for i in _items(120) if i[2] == "OrderPaid"}


def test_inbox_exact_form(spark, log_root, tmp_path):
    order = ["timestamp", "partition", "offset"]
    events = decode_log(_stream(spark, log_root, per_batch=100))
    q.run_available(q.write_inbox(events, f"{tmp_path}/out", f"{tmp_path}/cp", order))
    seen, paid = (tables.empty_table(spark, n) for n in ("inbox", "billing_payments"))
    ids, payments = inbox.apply_inbox(decode_log(ls.read_log(spark, log_root)), seen, paid, order)
    assert rows(spark.read.parquet(f"{tmp_path}/out/inbox"), "event_id") == rows(ids)
    assert rows(spark.read.parquet(f"{tmp_path}/out/payments"), "order_id", "amount") == rows(payments)


def test_inbox_exact_form_over_several_batches(spark, log_root, tmp_path):
    events = decode_log(_stream(spark, log_root, per_batch=1))
    q.run_available(q.write_inbox(events, f"{tmp_path}/out", f"{tmp_path}/cp"))
    seen = spark.read.parquet(f"{tmp_path}/out/inbox")
    assert seen.count() == seen.select("event_id").distinct().count()
    assert seen.count() == len([i for i in _items(120) if i[2] == "OrderPaid"])
    paid = spark.read.parquet(f"{tmp_path}/out/payments")
    assert paid.count() == paid.select("order_id").distinct().count()


def test_retry_tiers(spark, tmp_path):
    root = str(tmp_path / "log")
    items = _items(60)
    ls.append_log(records(spark, items), root, "b0", order=["seq"], tasks=2)
    for tier in retry.TIERS:
        source = _stream(spark, root, [tier.topic])
        case = F.coalesce(F.get_json_object("value", "$.payload.case"), F.lit("ok"))
        q.run_available(
            q.write_tier(source, tier, root, f"{tmp_path}/done", f"{tmp_path}/cp{tier.attempt}", case=case)
        )
    finals = retry.retry_chain(decode_log(ls.read_log(spark, root, ["orders.events"])))
    done = spark.read.parquet(f"{tmp_path}/done").select(F.get_json_object("value", "$.eventId").alias("event_id"), "attempt")
    assert rows(done) == rows(finals.where("outcome = 'processed'"), "event_id", "attempt")
    from logweir.functions.codes import header_text

    dead = ls.read_log(spark, root, ["orders.dlt"]).select(
        F.get_json_object("value", "$.eventId").alias("event_id"), header_text("headers").alias("x_error")
    )
    assert rows(dead) == rows(finals.where("outcome = 'dlt'"), "event_id", "x_error")
    assert done.count() + dead.count() == 60


def test_state_in_update_mode(spark, log_root, tmp_path):
    log = decode_log(_stream(spark, log_root)).select("aggregate_id", "event_type", F.col("timestamp").alias("version"))
    newest = q.state_stream(log, ["aggregate_id"])
    q.run_available(q.write_changelog(newest, f"{tmp_path}/out", f"{tmp_path}/cp"))
    got = q.read_changelog(spark, f"{tmp_path}/out", newest.schema, ["aggregate_id"])
    last = {}
    for i, _, kind, agg, _ in _items(120):
        last[agg] = kind
    assert {r.aggregate_id: r.event_type for r in got.collect()} == last


def test_reader_resumes_and_a_new_one_replays(spark, tmp_path):
    root = str(tmp_path / "log")
    counts = []
    for n in range(2):
        ls.append_log(records(spark, _items(60)[n * 30 : n * 30 + 30]), root, f"b{n}", order=["seq"], tasks=2)
        q.run_available(q.write_append(_stream(spark, root).select("key", "offset"), f"{tmp_path}/out", f"{tmp_path}/cp"))
        counts.append(spark.read.parquet(f"{tmp_path}/out").count())
    assert counts == [30, 60]
    q.run_available(q.write_append(_stream(spark, root).select("key"), f"{tmp_path}/out2", f"{tmp_path}/cp2"))
    assert spark.read.parquet(f"{tmp_path}/out2").count() == 60


def test_a_batch_run_again_replaces_its_rows(spark, tmp_path):
    """A stop after the sink wrote but before the commit: the same batch id comes again."""
    root = str(tmp_path / "log")
    ls.append_log(records(spark, _items(30)), root, "b0", order=["seq"], tasks=2)
    for checkpoint in ("cp1", "cp2"):
        q.run_available(q.write_consumed(_stream(spark, root, per_batch=1), f"{tmp_path}/out", f"{tmp_path}/{checkpoint}"))
    assert spark.read.parquet(f"{tmp_path}/out").count() == 30


def test_consumer_sets_malformed_records_apart(spark, tmp_path):
    root = str(tmp_path / "log")
    good = records(spark, _items(10))
    bad = good.limit(4).withColumn("value", F.lit("{bad"))
    ls.append_log(good.unionByName(bad), root, "b0", order=["seq", "value"], tasks=2)
    q.run_available(q.write_consumed(_stream(spark, root), f"{tmp_path}/out", f"{tmp_path}/cp"))
    out = spark.read.parquet(f"{tmp_path}/out")
    assert out.count() == 14
    assert {(r.reason, r.rejected_value) for r in out.where("reason is not null").collect()} == {("malformed JSON", "{bad")}
    assert {r["product"] for r in out.collect()} == {"unknown"}
