import pytest
from pyspark.sql import functions as F

from helpers import plan_of, records, rows
from logweir.schema import LOG_SCHEMA
from logweir.sources import log_store as ls
from logweir.sources import tables


def some(spark, ids, start=0):
    items = [(start + n, f"e{i}", "OrderPaid", f"order-{i % 7}", {"amount": i}) for n, i in enumerate(ids)]
    return records(spark, items)


def test_append_numbers_each_partition_without_gaps(spark, tmp_path):
    root = str(tmp_path / "log")
    report = ls.append_log(some(spark, range(50)), root, "b1", order=["seq"])
    log = ls.read_log(spark, root)
    assert set(LOG_SCHEMA.fieldNames()) <= set(log.columns) and log.count() == 50
    for r in report.collect():
        assert (r.first_offset, r.last_offset) == (0, r.records - 1)
    # Offsets follow the publishing order inside a partition, and a key stays in one.
    per = {}
    for p, o, t in sorted((r.partition, r.offset, r.timestamp) for r in log.collect()):
        per.setdefault(p, []).append((o, t))
    assert all([o for o, _ in v] == list(range(len(v))) and v == sorted(v, key=lambda x: x[1]) for v in per.values())
    assert log.groupBy("key").agg(F.countDistinct("partition").alias("n")).where("n > 1").count() == 0


def test_second_batch_goes_on_and_a_repeat_replaces_it(spark, tmp_path):
    root = str(tmp_path / "log")
    ls.append_log(some(spark, range(20)), root, "b1", order=["seq"])
    ends = dict(rows(ls.end_offsets(ls.read_log(spark, root)), "partition", "end_offset"))
    for _ in range(2):
        report = ls.append_log(some(spark, range(20, 50), 20), root, "b2", order=["seq"])
        assert all(r.first_offset == ends.get(r.partition, 0) for r in report.collect())
        assert ls.read_log(spark, root).count() == 50
    positions = ls.read_log(spark, root).select("partition", "offset")
    assert positions.distinct().count() == 50


def test_one_hot_partition_is_spread_over_tasks(spark, tmp_path):
    one_key = some(spark, range(400)).withColumn("key", F.lit("order-42"))
    root = str(tmp_path / "log")
    ls.append_log(one_key, root, "b1", order=["seq"], tasks=8)
    log = ls.read_log(spark, root)
    assert [r.offset for r in log.orderBy("offset").collect()] == list(range(400))
    assert log.select(F.input_file_name()).distinct().count() > 4


def test_topics_prune_folders_and_hold_their_own_offsets(spark, tmp_path):
    root = str(tmp_path / "log")
    both = some(spark, range(10)).unionByName(some(spark, range(10)).withColumn("topic", F.lit("audit.events")))
    ls.append_log(both, root, "b1", order=["seq"])
    audit = ls.read_log(spark, root, ["audit.events"])
    assert audit.count() == 10 and "PartitionFilters: [isnotnull(topic" in plan_of(audit)
    assert audit.agg(F.min("offset")).first()[0] == 0


def test_records_without_key_are_kept(spark, tmp_path):
    root = str(tmp_path / "log")
    ls.append_log(some(spark, range(30)).withColumn("key", F.lit(None).cast("string")), root, "b1", order=["seq"])
    log = ls.read_log(spark, root)
    assert log.count() == 30 and log.where("key is not null").count() == 0
    assert log.select("partition").distinct().count() == 3


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_dense_offsets_do_not_depend_on_the_block(spark, block):
    log = spark.range(0, 200, 3).select(
        F.lit("t").alias("topic"), (F.col("id") % 2).cast("int").alias("partition"), F.col("id").alias("seq")
    )
    got = ls.dense_offsets(log, "seq", block=block)
    for p in (0, 1):
        part = got.where(F.col("partition") == p).orderBy("seq").collect()
        assert [r.offset for r in part] == list(range(len(part)))


def test_tail_read_counts_offsets_and_last_n_counts_rows(spark):
    data = [("t", 0, o) for o in range(20)] + [("t", 1, o) for o in (0, 5, 18, 19)] + [("t", 2, 3)]
    log = spark.createDataFrame(data, "topic string, partition int, offset long")
    tail = rows(ls.tail_read(log, 12), "partition", "offset")
    assert tail == [(0, o) for o in range(8, 20)] + [(1, 18), (1, 19), (2, 3)]
    assert rows(ls.tail_read(log, 12, [1]), "partition", "offset") == [(1, 18), (1, 19)]
    assert rows(ls.last_n(log, 3), "partition", "offset") == [
        (0, 17), (0, 18), (0, 19), (1, 5), (1, 18), (1, 19), (2, 3),
    ]


def test_last_n_is_limited_before_the_shuffle(spark):
    log = spark.createDataFrame([("t", 0, 1)], "topic string, partition int, offset long")
    plan = plan_of(ls.last_n(log, 3))
    assert "WindowGroupLimit" in plan.split("Exchange")[-1]


def test_bounded_read_reports_shortfall(spark):
    log = spark.createDataFrame([("t", 0, o) for o in range(5)], "topic string, partition int, offset long")
    assert rows(ls.read_status(ls.bounded_read(log, 3), 3)) == [(3, 3, True)]
    assert rows(ls.read_status(ls.bounded_read(log, 9), 9)) == [(5, 9, False)]
    plan = plan_of(ls.bounded_read(log, 3))
    assert "Sort" not in plan and "TakeOrdered" not in plan


def test_take_one(spark):
    log = spark.createDataFrame([("t", 0, o) for o in (4, 2, 3)], "topic string, partition int, offset long")
    assert rows(ls.take_one(log)) == [("t", 0, 2)]
    with pytest.raises(Exception, match="no record to take"):
        ls.take_one(log.where("offset > 9")).collect()


def test_quarantine_keeps_everything(spark):
    values = ["{}", '{"a":1}', "", "  ", None, "{bad", "[1]", '"txt"', "null"]
    log = spark.createDataFrame([(v,) for v in values], "value string").withColumn("topic", F.lit("t"))
    good, bad = ls.split_valid(log)
    assert good.count() == 2 and bad.count() == 7
    assert {(r.value, r.reason) for r in bad.collect()} == {
        ("", "empty value"), ("  ", "empty value"), (None, "no value"), ("{bad", "malformed JSON"),
        ("[1]", "not a JSON object"), ('"txt"', "not a JSON object"), ("null", "not a JSON object"),
    }
    assert dict(rows(ls.outcome_report(log), "outcome", "records"))["accepted"] == 2


def test_kafka_options():
    source = ls.kafka_source_options("h:1", ["a", "b"])
    assert source["subscribe"] == "a,b" and source["startingOffsets"] == "earliest"
    sink = ls.kafka_sink_options("h:1", "a")
    assert (sink["kafka.acks"], sink["kafka.enable.idempotence"], sink["topic"]) == ("all", "true", "a")
    assert sink["kafka.delivery.timeout.ms"] == "120000" and sink["kafka.retries"] == "5"


def test_rows_of_the_kafka_source_become_log_rows(spark):
    raw = spark.createDataFrame(
        [(bytearray(b"k"), bytearray(b"{}"), "t", 1, 2, None)],
        "key binary, value binary, topic string, partition int, offset long, timestamp timestamp",
    ).withColumn("headers", F.lit(None).cast(LOG_SCHEMA["headers"].dataType))
    log = ls.from_kafka(raw)
    assert log.select(*LOG_SCHEMA.fieldNames()).schema == LOG_SCHEMA
    assert (log.first().key, log.first().value) == ("k", "{}")


# ---------------------------------------------------------------- tables


def test_first_and_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, 3), ("a", 2, 1), ("b", 5, 9)], "k string, v int, at int")
    assert rows(tables.first_per_key(df, ["k"], ["at"])) == [("a", 2, 1), ("b", 5, 9)]
    assert rows(tables.last_per_key(df, ["k"], ["at"])) == [("a", 1, 3), ("b", 5, 9)]


def test_insert_if_absent_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 9, 0), ("b", 2, 2), ("b", 3, 1)], "k string, v int, at int")
    delta = tables.insert_if_absent(target, new, ["k"], ["at"]).drop("at")
    assert rows(delta) == [("b", 3)]
    assert tables.insert_if_absent(target.unionByName(delta), new, ["k"], ["at"]).count() == 0


def test_upsert_rules(spark):
    old = spark.createDataFrame([("a", "CREATED", 10), ("b", "PAID", 7)], "id string, status string, amount int")
    new = spark.createDataFrame([("a", "PAID", 4), ("c", "CREATED", 1)], "id string, status string, amount int")
    merged = tables.upsert(old, new, "id", {"status": "last", "amount": "max"})
    assert rows(merged) == [("a", "PAID", 10), ("b", "PAID", 7), ("c", "CREATED", 1)]
    with pytest.raises(ValueError):
        tables.upsert(old, new, "id", {"status": "sum"})


def test_mark_delete_lookup(spark):
    box = spark.createDataFrame([("1", False), ("2", False), ("3", True)], "id string, published boolean")
    after = tables.mark(box, spark.createDataFrame([("2",)], "id string"), "id", "published")
    assert rows(after) == [("1", False), ("2", True), ("3", True)]
    some_rows = spark.createDataFrame([("replay-1",), ("x",), (None,)], "order_id string")
    left = tables.delete_where(some_rows, F.col("order_id").like("replay-%"))
    assert {r[0] for r in left.collect()} == {"x", None}
    assert tables.lookup(box, "id", "1").count() == 1


def test_reset_keeps_the_schema(spark, tmp_path):
    tables.reset_tables(spark, str(tmp_path))
    for name, ddl in tables.TABLES.items():
        back = tables.read_version(spark, f"{tmp_path}/{name}")
        assert back.count() == 0 and back.columns == [c.split()[0] for c in ddl.split(", ")]


def test_reset_empties_what_was_there(spark, tmp_path):
    full = spark.createDataFrame([("e", None)], tables.TABLES["inbox"])
    tables.write_version(full, f"{tmp_path}/inbox", 4)
    tables.reset_tables(spark, str(tmp_path))
    assert tables.read_version(spark, f"{tmp_path}/inbox").count() == 0
    assert tables.read_version(spark, f"{tmp_path}/inbox", 4).count() == 1


def test_a_version_is_seen_only_once_committed(spark, tmp_path):
    root = str(tmp_path / "t")
    tables.write_version(spark.range(3), root, 1)
    spark.range(9).write.parquet(f"{root}/version=00000002")
    assert tables.read_version(spark, root).count() == 3
    tables.commit(spark, root, "00000002")
    assert tables.read_version(spark, root).count() == 9
    assert tables.read_version(spark, root, 1).count() == 3


def test_jdbc_options_split_the_read():
    options = tables.jdbc_options("jdbc:x", "outbox", "u", "p", ("created_at", "2024-01-01", "2024-02-01", 8), fetchsize="1000")
    assert options["numPartitions"] == "8" and options["fetchsize"] == "1000" and options["dbtable"] == "outbox"
    assert "partitionColumn" not in tables.jdbc_options("jdbc:x", "outbox", "u", "p")


def test_the_shared_folder_named_by_the_cluster_is_used(spark):
    from types import SimpleNamespace

    from logweir.session import run_dir, shared_root

    class Context:
        directory = None

        def getCheckpointDir(self):
            return self.directory

        def setCheckpointDir(self, value):
            self.directory = value

    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default=None: "/shared/checkpoints"), sparkContext=Context()
    )
    assert shared_root(cluster) == "/shared/checkpoints" == cluster.sparkContext.directory
    assert run_dir(cluster, "a").startswith("/shared/checkpoints/a-")
    assert run_dir(spark, "a") != run_dir(spark, "a")


def test_staging_folders_do_not_stay(spark, tmp_path):
    import os

    from logweir.session import shared_root

    folder = shared_root(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    ls.append_log(some(spark, range(5)), str(tmp_path / "log"), "b1", order=["seq"])
    assert not [f for f in set(os.listdir(folder)) - before if f.startswith("stage-")]


def test_a_cluster_without_a_shared_folder_is_refused():
    from types import SimpleNamespace

    import pytest

    from logweir.session import shared_root

    unset = SimpleNamespace(get=lambda name, default=None: default)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    with pytest.raises(ValueError):
        shared_root(SimpleNamespace(conf=unset, sparkContext=context))


def test_a_batch_written_again_loses_the_topics_it_no_longer_has(spark, tmp_path):
    root = str(tmp_path / "log")
    both = some(spark, range(6)).withColumn("topic", F.when(F.col("seq") < 3, F.lit("a")).otherwise(F.lit("b")))
    ls.append_log(both, root, "b1", order=["seq"])
    ls.append_log(both, root, "b2", order=["seq"])
    ls.append_log(both.where("topic = 'a'"), root, "b1", order=["seq"])
    left = ls.read_log(spark, root).groupBy("topic", "batch").count().collect()
    assert sorted(map(tuple, left)) == [("a", "b1", 3), ("a", "b2", 3), ("b", "b2", 3)]
