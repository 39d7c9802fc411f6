"""Where in a log's files which offsets lie, kept as a table beside the log.

One row per file and log partition with its lowest and highest offset. Ends of the log come from it without reading the log, and
a tail read is sent to the few folders that can hold a tail: the zones are joined with the log, and Spark prunes the other folders
when it runs. No position passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PLACE = ("topic", "partition")


def zones_of(log: DataFrame) -> DataFrame:
    """``topic, batch, partition, file, lowest, highest, records`` of a log read from files, from its position columns alone."""
    rows = log.select("topic", "batch", "partition", "offset", F.col("_metadata.file_name").alias("file"))
    return rows.groupBy("topic", "batch", "partition", "file").agg(
        F.min("offset").alias("lowest"), F.max("offset").alias("highest"), F.count("*").alias("records")
    )


def add_zones(log: DataFrame, root: str, batch: str) -> None:
    """Stores the zones of a batch that has been written; told again, they replace themselves."""
    zones_of(log.where(F.col("batch") == batch)).write.mode("overwrite").parquet(f"{root}/of={batch}")


def read_zones(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(root).drop("of")


def ends_by_zones(zones: DataFrame) -> DataFrame:
    """Next free offset per topic and partition."""
    return zones.groupBy(*PLACE).agg((F.max("highest") + 1).alias("end_offset"))


def tail_by_zones(log: DataFrame, zones: DataFrame, n: int = 12) -> DataFrame:
    """Records with ``offset >= max(0, end - n)`` in every partition, out of the folders that hold some."""
    first = F.greatest(F.col("end_offset") - n, F.lit(0).cast("long")).alias("first")
    bounds = ends_by_zones(zones).select(*(F.col(c).alias(f"_{c}") for c in PLACE), first)
    here = F.col("topic").eqNullSafe(F.col("_topic")) & F.col("partition").eqNullSafe(F.col("_partition"))
    held = zones.where(F.col("records") > 0).join(bounds, here).where(F.col("highest") >= F.col("first"))
    # At most n folders for each partition of the log, and far fewer where batches are not tiny.
    rows = log.join(F.broadcast(held.select("topic", "batch").distinct()), ["topic", "batch"], "left_semi")
    return rows.join(bounds, here & (F.col("offset") >= F.col("first"))).select(*log.columns)
