"""Outbox: business rows and their events written together, then relayed to the log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.envelope import build_envelope, stable_id
from ..session import path_exists
from ..sources.log_store import append_log, read_log
from ..sources.tables import commit, committed, mark


def stage_outbox(changes: DataFrame, event_type: str = "OrderPaid") -> tuple[DataFrame, DataFrame]:
    """Order rows and outbox rows of the same changes (``id, status, amount, updated_at``).

    The outbox id is the envelope's event id. It is derived from the whole change, so both tables and any second
    attempt agree on it, and two changes of one order at one time have ids of their own.
    """
    event_id = stable_id(F.lit(event_type), F.col("id"), F.unix_micros("updated_at"), F.col("status"), F.col("amount"))
    kind = F.lit(event_type)
    payload = F.struct(F.col("amount"))
    orders = changes.select("id", "status", "amount", "updated_at")
    outbox = changes.select(
        event_id.alias("id"),
        F.col("id").alias("aggregate_id"),
        kind.alias("event_type"),
        build_envelope(event_id, kind, F.col("id"), payload, F.col("updated_at")).alias("payload"),
        F.lit(False).alias("published"),
        F.col("updated_at").alias("created_at"),
    )
    return orders, outbox


def write_outbox(changes: DataFrame, root: str, batch: str, event_type: str = "OrderPaid") -> None:
    """Writes both tables under one batch; neither is visible until the batch is committed.

    A batch that is committed already is left alone, so that a job run again never shows readers one table
    before and the other after."""
    spark = changes.sparkSession
    if path_exists(spark, f"{root}/_commits") and not committed(spark, root).where(F.col("entry") == batch).isEmpty():
        return
    orders, outbox = stage_outbox(changes, event_type)
    orders.write.mode("overwrite").parquet(f"{root}/orders/batch={batch}")
    outbox.write.mode("overwrite").parquet(f"{root}/outbox/batch={batch}")
    commit(spark, root, batch)


def read_committed(spark: SparkSession, root: str, table: str) -> DataFrame:
    """Rows of committed batches. The commit list prunes batch folders at run time."""
    found = spark.read.option("basePath", f"{root}/{table}").parquet(f"{root}/{table}").schema
    # Folder names are names: read as numbers, 001 would come back as 1 and match no commit.
    schema = T.StructType([f for f in found if f.name != "batch"] + [T.StructField("batch", T.StringType())])
    rows = spark.read.schema(schema).option("basePath", f"{root}/{table}").parquet(f"{root}/{table}")
    done = committed(spark, root).withColumnRenamed("entry", "batch")
    return rows.join(done, "batch", "left_semi").drop("batch")


def pending(outbox: DataFrame) -> DataFrame:
    return outbox.where(~F.col("published"))


def relay(outbox: DataFrame, topic: str = "orders.events") -> DataFrame:
    """Log records of the pending rows, keyed by aggregate.

    ``created_at, id`` is the publishing order; the sink turns it into offsets, oldest first in
    every partition, without bringing the rows of one aggregate together first.
    """
    return pending(outbox).select(
        F.lit(topic).alias("topic"),
        F.col("aggregate_id").alias("key"),
        F.col("payload").alias("value"),
        "created_at",
        "id",
    )


def relay_once(
    outbox: DataFrame, log_root: str, batch: str, topic: str = "orders.events"
) -> tuple[DataFrame, DataFrame]:
    """Publishes what is pending, then marks it. Returns the delivery report and the outbox after.

    A stop between the two leaves rows pending, and they are sent again with the same event ids.
    Marking goes by the ids found in the log, so rows added meanwhile stay pending.
    """
    report = append_log(relay(outbox, topic), log_root, batch, order=["created_at", "id"], spread="id")
    sent = read_log(outbox.sparkSession, log_root, [topic]).where(F.col("batch") == batch)
    ids = sent.select(F.get_json_object("value", "$.eventId").alias("id")).distinct()
    return report, mark(outbox, ids, "id", "published")


def publish(records: DataFrame, root: str, batch: str) -> None:
    """Appends relayed records to a log of plain folders, one per topic and batch; a batch written again replaces itself."""
    records.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "topic", "batch"
    ).parquet(root)


def published(spark: SparkSession, root: str, batch: str | None = None) -> DataFrame:
    """Records of a log of plain folders, of one batch only where that is named."""
    schema = "key string, value string, created_at timestamp, id string, topic string, batch string"
    rows = spark.read.schema(schema).parquet(root)
    return rows if batch is None else rows.where(F.col("batch") == batch)


def relay_and_mark(outbox: DataFrame, root: str, batch: str, topic: str = "orders.events") -> DataFrame:
    """Publishes what is pending, then gives the outbox with what is found in the log marked.

    A stop between the two leaves rows pending, and the next relay sends them again under the same event ids.
    """
    publish(relay(outbox, topic), root, batch)
    return mark(outbox, published(outbox.sparkSession, root, batch).select("id").distinct(), "id", "published")
