"""Which event led to which: depth and path of every event below the one its trace began with."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import drop_folder, run_dir


def traces(events: DataFrame) -> DataFrame:
    """``event_id, root, depth, path`` of ``events (event_id, caused_by)``, ids being unique.

    An event begins a trace if it has no cause, or one that the log lacks. Each round joins the events of one depth with those
    they caused and writes them, so rounds are as many as the deepest trace has steps and every event is written once. An
    event that many others name is on the side of the join with one row per id. Events on a circle, or caused by one,
    are reached from no beginning: they have neither root nor depth, and an empty path.
    """
    spark = events.sparkSession
    links = events.select("event_id", "caused_by")
    known = links.select(F.col("event_id").alias("known"))
    begun = links.join(known, F.col("caused_by") == F.col("known"), "left_anti")
    root = run_dir(spark, "traces")
    level = begun.select("event_id", F.col("event_id").alias("root"), F.lit(0).alias("depth"), F.array("event_id").alias("path"))
    depth = 0
    while True:
        at = f"{root}/step={depth}"
        level.write.parquet(at)
        level = spark.read.schema(level.schema).parquet(at)
        if level.isEmpty():
            break
        depth += 1
        above = level.select(F.col("event_id").alias("cause"), "root", "path")
        caused = links.join(above, links["caused_by"] == above["cause"])
        level = caused.select("event_id", "root", F.lit(depth).alias("depth"), F.concat("path", F.array("event_id")).alias("path"))
    if depth:
        drop_folder(spark, at)
    reached = spark.read.schema(level.schema).parquet(*(f"{root}/step={i}" for i in range(depth))) if depth else level
    apart = links.join(reached.select("event_id"), "event_id", "left_anti")
    none = F.lit(None)
    return reached.unionByName(
        apart.select(
            "event_id",
            none.cast(level.schema["root"].dataType).alias("root"),
            none.cast("int").alias("depth"),
            F.array().cast(level.schema["path"].dataType).alias("path"),
        )
    )
