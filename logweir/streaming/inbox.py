"""The exact inbox, reading of its history only what a micro-batch can touch.

An event id is stored under the day of its event, which every delivery of it carries, and a payment under a bucket of its order id.
A micro-batch joins the days and buckets it holds with the stored tables, and Spark prunes all other folders when it runs. So what is
read grows with the batch and its days, not with the history. ``batch_id`` is the lowest folder: a batch that is run again replaces
its own rows and ignores them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from ..operators.inbox import first_payments, fresh_events
from ..schema import LOG_ORDER
from ..session import path_exists

BUCKETS = 32
#: The day of events without a time.
NO_DAY = "none"


def day_of(time: str) -> Column:
    return F.coalesce(F.date_format(time, "yyyy-MM-dd"), F.lit(NO_DAY))


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def touched(spark: SparkSession, path: str, schema: str, part: str, wanted: DataFrame, batch_id: int) -> DataFrame:
    """Rows of earlier batches in the folders ``part`` that ``wanted`` names (one row per folder, so bounded)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(f"{schema}, batch_id long").parquet(path).where(F.col("batch_id") < batch_id)
    return stored.join(F.broadcast(wanted), part, "left_semi")


def write_days(
    events: DataFrame,
    root: str,
    checkpoint: str,
    order: Iterable[str] = LOG_ORDER,
    event_type: str = "OrderPaid",
    amount: Column | None = None,
    buckets: int = BUCKETS,
) -> DataStreamWriter:
    """Per micro-batch: events that the inbox lacks, then the first payment of each order that has none."""
    order = list(order)

    def apply(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, root, order, event_type, amount, buckets)

    return events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)


def stored_inbox(batch: DataFrame, batch_id: int, root: str, event_type: str) -> DataFrame:
    """Inbox rows of the days that a micro-batch holds."""
    days = batch.where(F.col("event_type") == event_type).select(day_of("timestamp").alias("day")).distinct()
    return touched(batch.sparkSession, f"{root}/inbox", "event_id string, day string", "day", days, batch_id)


def apply_batch(
    batch: DataFrame, batch_id: int, root: str, order: list[str], event_type: str, amount: Column | None, buckets: int
) -> None:
    spark = batch.sparkSession
    write = {"partitionOverwriteMode": "dynamic"}
    time = [c for c in ("timestamp",) if c not in order]
    seen = stored_inbox(batch, batch_id, root, event_type)
    fresh = fresh_events(batch, seen, [*order, *time], event_type, amount)
    fresh = fresh.withColumns({"day": day_of("timestamp"), "batch_id": F.lit(batch_id).cast("long")})
    fresh.write.options(**write).mode("overwrite").partitionBy("day", "batch_id").parquet(f"{root}/inbox")
    # The batch's own rows, read back from their folders.
    mine = spark.read.schema(fresh.schema).parquet(f"{root}/inbox").where(F.col("batch_id") == batch_id)
    wanted = mine.where(F.col("order_id").isNotNull()).select(bucket_of("order_id", buckets).alias("bucket")).distinct()
    paid = touched(spark, f"{root}/payments", "order_id string, amount int, bucket int", "bucket", wanted, batch_id)
    new = first_payments(mine, paid.select("order_id", "amount"), order)
    new = new.withColumns({"bucket": bucket_of("order_id", buckets), "batch_id": F.lit(batch_id).cast("long")})
    new.write.options(**write).mode("overwrite").partitionBy("bucket", "batch_id").parquet(f"{root}/payments")
