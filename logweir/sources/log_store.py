"""A keyed, partitioned, offset-ordered log on files, and the options of the Kafka connector.

Layout: ``<root>/topic=<name>/batch=<id>/*.parquet`` with the columns of ``LOG_SCHEMA``.
A batch is replaced as a whole when it is written again, topics it no longer has included, so a repeated
write adds nothing. Its offsets are then counted behind those of the other batches.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import as_col
from ..functions.json_fields import is_object
from ..functions.partitioner import key_partition
from ..schema import HEADERS, LOG_SCHEMA, PARTITIONS
from ..session import drop_folder, path_exists, run_dir

FILE_COLUMNS = LOG_SCHEMA.fieldNames()
STORED_SCHEMA = T.StructType([*LOG_SCHEMA.fields, T.StructField("batch", T.StringType())])

# Settings of a producer that does not lose or repeat records.
SAFE_PRODUCER = {
    "kafka.acks": "all",
    "kafka.retries": "5",
    "kafka.enable.idempotence": "true",
    "kafka.max.in.flight.requests.per.connection": "5",
    "kafka.delivery.timeout.ms": "120000",
}


# ---------------------------------------------------------------- reading


def read_log(spark: SparkSession, root: str, topics: Iterable[str] | None = None) -> DataFrame:
    """The whole retained log from its beginning; ``topics`` prunes directories."""
    log = spark.read.schema(STORED_SCHEMA).parquet(root)
    return log if topics is None else log.where(F.col("topic").isin(*topics))


def stream_log(
    spark: SparkSession, root: str, topics: Iterable[str] | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """The log as a stream from its beginning.

    Where reading goes on after a stop is decided by the query's checkpoint: a new checkpoint
    replays everything, a kept one resumes.
    """
    reader = spark.readStream.schema(STORED_SCHEMA)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    log = reader.parquet(root)
    return log if topics is None else log.where(F.col("topic").isin(*topics))


def kafka_source_options(bootstrap: str, topics: Iterable[str], **extra: str) -> dict[str, str]:
    """Options for ``format("kafka")`` reading from the earliest record, headers included."""
    return {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": "earliest",
        "includeHeaders": "true",
        **extra,
    }


def kafka_sink_options(bootstrap: str, topic: str | None = None, **extra: str) -> dict[str, str]:
    """Options for ``format("kafka")`` writing reliably; without ``topic`` rows carry their own."""
    options = {"kafka.bootstrap.servers": bootstrap, "includeHeaders": "true", **SAFE_PRODUCER}
    if topic:
        options["topic"] = topic
    return {**options, **extra}


def from_kafka(records: DataFrame) -> DataFrame:
    """Rows of Spark's Kafka source in the log's column set."""
    return records.select(
        "topic",
        "partition",
        "offset",
        "timestamp",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        "headers",
    )


# ---------------------------------------------------------------- positions


def end_offsets(log: DataFrame) -> DataFrame:
    """Next free offset per partition; partial maxima leave one row per task for the shuffle."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("end_offset"))


def tail_read(log: DataFrame, n: int = 12, partitions: Iterable[int] | None = None) -> DataFrame:
    """Records with ``offset >= max(0, end - n)`` in every partition of the log.

    The ends come from one scan of the position columns, one row per partition of the log. They are joined with the
    log; beside that each topic's lowest bound goes to the scan, which skips the row groups before it whatever
    the other topics hold.
    """
    chosen = log if partitions is None else log.where(F.col("partition").isin(*partitions))
    ends = end_offsets(chosen)
    rows = [(e["topic"], e["partition"], max(0, e["end_offset"] - n)) for e in ends.collect()]
    schema = T.StructType([ends.schema["topic"], ends.schema["partition"], T.StructField("_first", T.LongType())])
    bounds = log.sparkSession.createDataFrame(rows, schema)
    lowest = {}
    for topic, _, first in rows:
        lowest[topic] = min(first, lowest.get(topic, first))
    coarse = F.lit(False)
    for topic, first in lowest.items():
        coarse = coarse | (F.col("topic").eqNullSafe(F.lit(topic)) & (F.col("offset") >= F.lit(first)))
    there = bounds.toDF("_topic", "_partition", "_first")
    same = F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
    return chosen.where(coarse).join(there, same).where(F.col("offset") >= F.col("_first")).select(*log.columns)


def last_n(log: DataFrame, n: int, order: str = "offset") -> DataFrame:
    """The last ``n`` records of every partition; equals ``tail_read`` where offsets have no gaps.

    Spark keeps only ``n`` rows per partition of the log in each task before the shuffle.
    """
    newest = Window.partitionBy("topic", "partition").orderBy(F.desc(order))
    return log.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= n).drop("_rank")


POSITION = ("topic", "partition", "offset")


def bounded_read(log: DataFrame, expected: int, block: int = 1 << 16) -> DataFrame:
    """At most ``expected`` records, the first in (topic, partition, offset) order, without sorting the log.

    Counts per block of offsets, from the position columns alone, say in which block the read ends; the
    place in it is found among that block's records. The read is then everything up to one position: a filter of
    constant size, however many topics and partitions there are.
    """
    if expected <= 0:
        return log.where(F.lit(False))
    blocks = log.groupBy("topic", "partition", F.floor(F.col("offset") / block).alias("b")).agg(F.count("*").alias("n"))
    running = F.sum("n").over(Window.orderBy("topic", "partition", "b"))
    end = blocks.withColumn("upto", running).where(F.col("upto") >= expected).orderBy("upto").first()
    if end is None:
        return log
    inside = F.col("topic").eqNullSafe(F.lit(end["topic"])) & F.col("partition").eqNullSafe(F.lit(end["partition"]))
    inside = inside & F.floor(F.col("offset") / block).eqNullSafe(F.lit(end["b"]))
    rank = expected - (end["upto"] - end["n"])
    last = log.where(inside).select("offset").orderBy("offset").limit(rank).agg(F.max("offset")).first()[0]
    return log.where(_upto(dict(zip(POSITION, (end["topic"], end["partition"], last)))))


def _upto(place: dict[str, object]) -> Column:
    """Whether a row stands at ``place`` or before it; NULL is before everything."""
    names = list(place)
    out = F.lit(True)
    for name in reversed(names):
        value = F.lit(place[name])
        before = F.col(name).isNull() | (F.col(name) < value) if place[name] is not None else F.lit(False)
        out = F.coalesce(before, F.lit(False)) | (F.col(name).eqNullSafe(value) & out)
    return out


def bounded_status(log: DataFrame, expected: int) -> DataFrame:
    """What ``read_status`` says of a bounded read, from a count of the log's rows without reading them."""
    rows = log.agg(F.least(F.count("*"), F.lit(max(expected, 0)).cast("bigint")).alias("read"))
    return rows.select("read", F.lit(expected).cast("bigint").alias("expected"), (F.col("read") >= expected).alias("complete"))


def read_status(rows: DataFrame, expected: int) -> DataFrame:
    """How many records a bounded read gave and whether that was all it waited for."""
    return rows.agg(F.count("*").alias("read")).select(
        "read",
        F.lit(expected).cast("bigint").alias("expected"),
        (F.col("read") >= expected).alias("complete"),
    )


def take_one(rows: DataFrame, order: Iterable[str] = ("topic", "partition", "offset")) -> DataFrame:
    """The first record; running the result fails when there is none."""
    first = rows.orderBy(*order).limit(1)
    columns = first.columns
    # A global aggregate gives one row even for empty input, which is where the error is raised.
    held = first.agg(F.first(F.struct(*columns)).alias("row"))
    checked = F.when(F.col("row").isNull(), F.raise_error(F.lit("no record to take"))).otherwise(
        F.col("row")
    )
    return held.select(checked.alias("row")).select("row.*")


def dense_offsets(
    log: DataFrame, sequence: str, group: Iterable[str] = ("topic", "partition"), block: int = 1 << 20
) -> DataFrame:
    """Adds ``offset``, counted from 0 along ``sequence`` inside each partition of the log.

    ``sequence`` is a unique whole number. A log has few partitions, so numbering each in one
    task would put a third of all rows there. Rows are numbered inside blocks of ``block``
    consecutive sequence values instead, which bounds a group by ``block`` rows however the keys
    are spread, and each block starts after the rows of the blocks before it. The block counts
    are small, and the join on (partition, block) shares its shuffle with the numbering.
    """
    group = list(group)
    keys = [*group, "_block"]
    blocked = log.withColumn("_block", F.floor(F.col(sequence) / block))
    counts = blocked.groupBy(*keys).agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        *keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    within = Window.partitionBy(*keys).orderBy(sequence)
    # NULL equals NULL here: a record without a partition is numbered too.
    there = starts.toDF(*(f"_at_{c}" for c in keys), "_start")
    same = reduce(and_, (F.col(c).eqNullSafe(F.col(f"_at_{c}")) for c in keys))
    return (
        blocked.join(there, same)
        .withColumn("offset", F.col("_start") + F.row_number().over(within) - 1)
        .select(*log.columns, "offset")
    )


# ---------------------------------------------------------------- writing


def append_log(
    records: DataFrame,
    root: str,
    batch: str,
    order: Iterable[str],
    partitions: int = PARTITIONS,
    spread: str | None = None,
    value: Column | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Appends records (``topic, key, value`` and optional ``timestamp, headers``) as one batch.

    Partition comes from the key, offset from ``order`` inside the partition, after the offsets
    already there. Records without a key are spread by the column ``spread``. Returns the
    delivery report: per topic and partition the count and offsets.

    Given as an expression over the records' columns, ``value`` is built after the shuffle: then
    the columns travel instead of the longer text, and drawing the ranges does not build it.

    The rows are range-partitioned by (topic, partition, order), so one hot partition is spread
    over many tasks, and written once with their running row ids. The bases that turn row ids
    into offsets are a table of one row per task and partition.
    """
    spark = records.sparkSession
    order = list(order)
    have = set(records.columns)
    keyless = F.struct(*order) if spread is None else F.col(spread)
    rows = records.withColumn("partition", key_partition("key", partitions, spread=keyless))
    if "timestamp" not in have:
        rows = rows.withColumn("timestamp", F.current_timestamp())
    if "headers" not in have:
        rows = rows.withColumn("headers", F.lit(None).cast(HEADERS))

    place = ["topic", "partition"]
    ranges = [*place, *order]
    staged_at = run_dir(spark, "stage")
    # Without a number of tasks adaptive execution merges neighbouring ranges that are small.
    spread_out = rows.repartitionByRange(tasks, *ranges) if tasks else rows.repartitionByRange(*ranges)
    (
        spread_out.sortWithinPartitions(*ranges)
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("value", F.col("value") if value is None else value)
        .select(*place, "timestamp", "key", "value", "headers", "_row")
        .write.parquet(staged_at)
    )
    staged = spark.read.parquet(staged_at)

    # The row id holds the task number above bit 33 and counts up inside a task.
    per_task = staged.groupBy(*place, F.shiftright("_row", 33).alias("_task")).agg(
        F.count("*").alias("_rows"), F.min("_row").alias("_first")
    )
    before = Window.partitionBy(*place).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_task.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    stale = set()
    if path_exists(spark, root):
        mine = read_log(spark, root).where(F.col("batch") == batch)
        stale = _topics(mine) - _topics(staged)
        earlier = end_offsets(read_log(spark, root).where(F.col("batch") != batch))
        bases = bases.join(earlier, place, "left")
    else:
        bases = bases.withColumn("end_offset", F.lit(None).cast("bigint"))
    shift = F.coalesce("end_offset", F.lit(0)) + F.col("_before") - F.col("_first")
    bases = bases.select(*place, "_task", shift.alias("_shift"))

    # One row per task and partition of the log: bounded by tasks + number of log partitions.
    placed = staged.withColumn("_task", F.shiftright("_row", 33)).join(
        F.broadcast(bases), [*place, "_task"]
    )
    (
        placed.withColumn("offset", F.col("_row") + F.col("_shift"))
        .withColumn("batch", F.lit(batch))
        .select(*FILE_COLUMNS, "batch")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("topic", "batch")
        .parquet(root)
    )
    for topic in stale:
        drop_folder(spark, f"{root}/topic={topic}/batch={batch}")
    drop_folder(spark, staged_at)
    return delivery_report(read_log(spark, root).where(F.col("batch") == batch))


def _topics(log: DataFrame) -> set[str]:
    return {row["topic"] for row in log.select("topic").distinct().collect()}


def delivery_report(log: DataFrame) -> DataFrame:
    """Where records of a log landed: count and first and last offset per partition."""
    return log.groupBy("topic", "partition").agg(
        F.count("*").alias("records"),
        F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"),
    )


# ---------------------------------------------------------------- malformed records


def reject_reason(value="value"):
    """Why a value cannot be read as an envelope; NULL when it can."""
    text = as_col(value)
    return (
        F.when(text.isNull(), F.lit("no value"))
        .when(F.trim(text) == "", F.lit("empty value"))
        .when(is_object(text), F.lit(None).cast("string"))
        .when(F.try_parse_json(text).isNull(), F.lit("malformed JSON"))
        .otherwise(F.lit("not a JSON object"))
    )


def classify(log: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``reason``: NULL for accepted rows. One pass; write it partitioned to keep both sides."""
    return log.withColumn("reason", reject_reason(value))


def split_valid(log: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and quarantined rows with their reason. Together they are the whole input."""
    tagged = classify(log, value)
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(
        F.col("reason").isNotNull()
    )


def outcome_report(log: DataFrame, by: Mapping[str, str] | Iterable[str] = ("topic",)) -> DataFrame:
    """Count of accepted and rejected rows per group and reason."""
    return (
        classify(log)
        .groupBy(*by, F.coalesce("reason", F.lit("accepted")).alias("outcome"))
        .agg(F.count("*").alias("records"))
    )
