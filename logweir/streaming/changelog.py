"""A changelog with levels: recent micro-batches above a snapshot that has absorbed the older ones.

Data is written under names of its own and becomes visible when its entry is added to the manifest, so a reader finds a
micro-batch as a whole or not at all, also while one is tried again. After ``every`` batches the writer merges them into a new
snapshot and begins a new generation of the manifest; what the generation before the last one used is then removed, so a reader has a
whole generation's time to finish. Reading costs the snapshot and at most ``every`` batches, however long the stream has run.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..session import drop_folder, path_exists
from ..sources.tables import last_per_key

ENTRY = "batch_id long, snapshot boolean, path string, generation long"
STAMP = "_batch_id"


def entries(spark: SparkSession, root: str) -> list:
    """The manifest's newest generation, oldest first: a snapshot and what came after it, or the first batches."""
    if not path_exists(spark, f"{root}/manifest"):
        return []
    found = spark.read.schema(ENTRY).parquet(f"{root}/manifest")
    newest = found.agg(F.max("generation")).first()[0]
    return found.where(F.col("generation") == newest).orderBy("batch_id", F.desc("snapshot")).collect()


def _added(spark: SparkSession, root: str, generation: int, batch_id: int, snapshot: bool, path: str) -> None:
    row = spark.createDataFrame([(batch_id, snapshot, path)], "batch_id long, snapshot boolean, path string")
    row.coalesce(1).write.mode("append").parquet(f"{root}/manifest/generation={generation}")


def _stored(spark: SparkSession, root: str, schema: T.StructType, found: list) -> DataFrame:
    stamped = T.StructType([*schema.fields, T.StructField(STAMP, T.LongType())])
    if not found:
        return spark.createDataFrame([], stamped)
    return spark.read.schema(stamped).parquet(*(f"{root}/{e['path']}" for e in found))


def store_batch(batch: DataFrame, batch_id: int, root: str, keys: Iterable[str], every: int) -> None:
    """Adds a micro-batch; one that is in the manifest already is left alone."""
    spark, keys = batch.sparkSession, list(keys)
    found = entries(spark, root)
    generation = found[0]["generation"] if found else 0
    if not found or found[-1]["batch_id"] < batch_id:
        path = f"batches/generation={generation}/{batch_id}-{uuid.uuid4().hex}"
        batch.withColumn(STAMP, F.lit(batch_id).cast("long")).write.parquet(f"{root}/{path}")
        _added(spark, root, generation, batch_id, False, path)
        found = entries(spark, root)
    if sum(not e["snapshot"] for e in found) >= every:
        path = f"snapshots/{generation + 1}-{uuid.uuid4().hex}"
        table = last_per_key(_stored(spark, root, batch.schema, found), keys, [STAMP])
        table.write.parquet(f"{root}/{path}")
        _added(spark, root, generation + 1, found[-1]["batch_id"], True, path)
        _forget(spark, root, generation - 1)


def _forget(spark: SparkSession, root: str, generation: int) -> None:
    """Removes what a generation read; its entries name it."""
    at = f"{root}/manifest/generation={generation}"
    if generation >= 0 and path_exists(spark, at):
        old = spark.read.parquet(at).where("snapshot").select("path").collect()  # one snapshot at most
        for name in [f"batches/generation={generation}", *(e["path"] for e in old)]:
            drop_folder(spark, f"{root}/{name}")
        drop_folder(spark, at)


def write_levels(
    rows: DataFrame, root: str, checkpoint: str, keys: Iterable[str], mode: str = "update", every: int = 20
) -> DataStreamWriter:
    """Rows of an aggregate in update mode, each micro-batch one entry of the manifest."""
    keys = list(keys)

    def store(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, root, keys, every)

    return rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(store)


def read_levels(spark: SparkSession, root: str, schema: T.StructType, keys: Iterable[str]) -> DataFrame:
    """The table: the row of the latest batch per key."""
    return last_per_key(_stored(spark, root, schema, entries(spark, root)), keys, [STAMP]).drop(STAMP)
