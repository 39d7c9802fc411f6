"""Structured Streaming forms of the operators. Each only wires a source to a sink."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.envelope import parse_checked, readable
from ..functions.json_fields import is_object, long_or, text_or
from ..operators.inbox import first_payments, fresh_events
from ..operators.projection import fold_orders, order_facts
from ..operators.retry import DEAD_LETTERS, QUARANTINED, Tier, retry_stage
from ..schema import LOG_ORDER
from ..session import path_exists
from ..sources.log_store import append_log, reject_reason
from ..sources.tables import last_per_key

# Parts a hot key is split into by streaming de-duplication, where the caller does not say: a cluster wants some
# for every core that should share it.
SALTS = 16


def run_available(writer: DataStreamWriter) -> StreamingQuery:
    """Processes everything present and stops; a kept checkpoint goes on from there next time."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


# ---------------------------------------------------------------- changelog sink


def write_changelog(rows: DataFrame, root: str, checkpoint: str, mode: str = "update") -> DataStreamWriter:
    """Each micro-batch replaces its own ``batch_id`` folder, so a batch run again changes nothing."""

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/batch_id={batch_id}")

    return rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(store)


def read_changelog(spark: SparkSession, root: str, schema: T.StructType, keys: Iterable[str]) -> DataFrame:
    """The table a changelog amounts to: the row of the latest batch per key."""
    return latest_changes(read_batches(spark, root, schema), keys)


def read_batches(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    stored = T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])
    return spark.read.schema(stored).parquet(root)


def latest_changes(changes: DataFrame, keys: Iterable[str]) -> DataFrame:
    return last_per_key(changes, keys, ["batch_id"]).drop("batch_id")


# ---------------------------------------------------------------- read models


def projection_stream(
    events: DataFrame, order: Iterable[str] = LOG_ORDER, amount: Column | None = None
) -> DataFrame:
    """The projection's own aggregate. State is one row per order; redelivery does not change it."""
    return fold_orders(order_facts(events, amount), order)


def state_stream(states: DataFrame, keys: Iterable[str], version: str = "version") -> DataFrame:
    """Latest state per key, in update mode."""
    return last_per_key(states, keys, [version])


# ---------------------------------------------------------------- idempotent apply


def _once(
    rows: DataFrame, keys: list[str], spread: Sequence[str], within_watermark: bool = False, salts: int = SALTS
) -> DataFrame:
    """Each key once, remembered in the state store.

    Streaming de-duplication does not combine before its shuffle. Where ``spread`` names the
    columns that tell deliveries apart (partition and offset), rows are first reduced per key
    and one of ``salts`` salts, so a key delivered over and over is shared by that many tasks and
    the last step sees it at most that often. State then holds each key twice.
    """
    drop = DataFrame.dropDuplicatesWithinWatermark if within_watermark else DataFrame.dropDuplicates
    if spread:
        salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)))
        rows = drop(salted, [*keys, "_salt"]).drop("_salt")
    return drop(rows, keys)


def inbox_stream(
    events: DataFrame,
    event_type: str = "OrderPaid",
    watermark: str | None = None,
    spread: Sequence[str] = (),
    salts: int = SALTS,
) -> DataFrame:
    """Events of a type, each id once.

    Without a watermark every id is remembered for good, like an inbox table. With one, state
    stays bounded and a redelivery later than the watermark counts as new.
    """
    wanted = events.where(F.col("event_type") == event_type)
    if watermark is not None:
        wanted = wanted.withWatermark("timestamp", watermark)
    return _once(wanted, ["event_id"], spread, watermark is not None, salts)


def payments_stream(
    events: DataFrame, amount: Column, event_type: str = "OrderPaid", spread: Sequence[str] = (), salts: int = SALTS
) -> DataFrame:
    """Payments, the first to arrive per order, out of events taken once."""
    once = inbox_stream(events, event_type, spread=spread, salts=salts)
    paid = once.select(F.col("aggregate_id").alias("order_id"), amount.alias("amount"), *spread)
    return _once(paid, ["order_id"], spread, salts=salts).select("order_id", "amount")


def write_inbox(
    events: DataFrame,
    root: str,
    checkpoint: str,
    order: Iterable[str] = LOG_ORDER,
    event_type: str = "OrderPaid",
    amount: Column | None = None,
) -> DataStreamWriter:
    """The exact form: per micro-batch the batch operator against the tables written so far.

    Unlike plain de-duplication it keeps the first payment by log position within a batch. The
    new inbox rows are stored first and the payments derived from them, so the log is reduced
    once. Both are stored under the batch id, and a batch run again ignores its own earlier output.
    """
    order = list(order)

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        earlier = F.col("batch_id") < batch_id
        seen = _stored(spark, f"{root}/inbox", "event_id string").where(earlier)
        paid = _stored(spark, f"{root}/payments", "order_id string, amount int").where(earlier)
        here = f"{root}/inbox/batch_id={batch_id}"
        fresh = fresh_events(batch, seen, order, event_type, amount)
        fresh.write.mode("overwrite").parquet(here)
        new = first_payments(spark.read.schema(fresh.schema).parquet(here), paid, order)
        new.write.mode("overwrite").parquet(f"{root}/payments/batch_id={batch_id}")

    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)


def _stored(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table written by batch id, empty before its first batch."""
    fields = T.StructType([*T.StructType.fromDDL(schema).fields, T.StructField("batch_id", T.LongType())])
    if not path_exists(spark, path):
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).parquet(path)


# ---------------------------------------------------------------- retry tiers


def write_tier(
    records: DataFrame,
    tier: Tier,
    log_root: str,
    done_root: str,
    checkpoint: str,
    order: Sequence[str] = LOG_ORDER,
    dead_letters: str = DEAD_LETTERS,
    case: Column | None = None,
) -> DataStreamWriter:
    """One tier as a query of its own: successes to ``done_root``, failures back into the log, and
    records that cannot be read to ``<done_root>_quarantine``.

    ``records`` is the stream of the tier's topic, its ``value`` an envelope; a ``payload`` column is
    used where there is one. The log batch is named after tier and
    micro-batch, so a batch run again replaces what it had forwarded.
    """

    def forward(batch: DataFrame, batch_id: int) -> None:
        if "payload" not in batch.columns:
            # An envelope without payload has no case; what is no envelope has no payload and cannot be read.
            none = F.when(is_object("value"), F.lit("{}"))
            batch = batch.withColumn("payload", F.coalesce(F.get_json_object("value", "$.payload"), none))
        # Read for the successes, for the ranges of the failures and for writing them.
        staged = retry_stage(batch, tier, dead_letters, case).persist(StorageLevel.DISK_ONLY)
        done = staged.where(F.col("outcome") == "processed").withColumn("attempt", F.lit(tier.attempt))
        try:
            done.select("key", "value", "attempt").write.mode("overwrite").parquet(
                f"{done_root}/attempt_no={tier.attempt}/batch_id={batch_id}"
            )
            bad = staged.where(F.col("outcome") == QUARANTINED)
            bad.select("key", "value", F.lit(tier.topic).alias("topic")).write.mode("overwrite").parquet(
                f"{done_root}_quarantine/attempt_no={tier.attempt}/batch_id={batch_id}"
            )
            failed = staged.where(F.col("outcome") == "forwarded").withColumn("topic", F.col("target"))
            append_log(failed, log_root, f"{tier.topic}-{batch_id}", order=order)
        finally:
            staged.unpersist()

    return records.writeStream.option("checkpointLocation", checkpoint).foreachBatch(forward)


# ---------------------------------------------------------------- at-least-once consumer


def consume(log: DataFrame) -> DataFrame:
    """Placed orders out of raw records, with defaults; malformed records keep their reason."""
    parsed = log.withColumn("_e", parse_checked("value", ["orderId", "userId", "product"]))
    ids = [long_or("_e.payload.orderId"), long_or("_e.payload.userId")]
    too_large = ids[0].isNull() | ids[1].isNull()
    reason = F.when(~readable("_e", "value"), reject_reason("value")).when(too_large, F.lit("id beyond 64 bits"))
    return parsed.withColumn("reason", reason).select(
        "topic",
        "partition",
        "offset",
        "key",
        ids[0].alias("order_id"),
        ids[1].alias("user_id"),
        text_or("_e.payload.product", "unknown").alias("product"),
        "reason",
        F.when(F.col("reason").isNotNull(), F.col("value")).alias("rejected_value"),
    )


def write_consumed(log: DataFrame, root: str, checkpoint: str) -> DataStreamWriter:
    """Processes, then commits: a stop in between reads the batch again and replaces its folder."""
    return write_changelog(consume(log), root, checkpoint, mode="append")


def write_append(
    rows: DataFrame, root: str, checkpoint: str, partition_by: Sequence[str] = ()
) -> DataStreamWriter:
    """Spark's file sink, which commits each micro-batch exactly once."""
    writer = rows.writeStream.format("parquet").option("path", root)
    writer = writer.option("checkpointLocation", checkpoint).outputMode("append")
    return writer.partitionBy(*partition_by) if partition_by else writer

