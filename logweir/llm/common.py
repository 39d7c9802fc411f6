"""Helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import drop_folder, run_dir

# A word: any run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts lineage, survives lost executors."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Hands Python workers ``rows`` texts at a time. Spark's own default of ten thousand is copied several times over, in a
    worker and beside the heap of its executor, and whole texts are long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def dropped(df: DataFrame) -> None:
    """Removes a ``staged`` table that nothing reads any more."""
    for folder in {path.rpartition("/")[0] for path in df.inputFiles()}:
        drop_folder(df.sparkSession, folder)


def numbered(df: DataFrame, *order: str) -> DataFrame:
    """``df`` with ``task`` and ``place``: the place of every row (from 0) in the given order.

    Rows are dealt by ranges of ``order``, sorted and written; a table of one row per task says where each range
    begins. What is numbered must be a written table, since Spark samples it for the ranges; an order without ties spreads any
    group of equal keys.
    """
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    rows = staged(rows, "numbered").withColumn("task", F.shiftright("at", 33))
    tasks = rows.groupBy("task").agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    tasks = tasks.select("task", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(tasks), "task").withColumn("place", F.col("before") + inside).drop("before", "at")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_remainder(name: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; NULL for a NULL id."""
    return F.pmod(F.crc32(F.col(name).cast("string").cast("binary")), F.lit(n))


def hash_sample(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """About ``rows`` rows of ``df`` at most, chosen by a hash of ``key``, so that reruns agree.

    The expected size is exactly bounded by ``rows``; the deviation is that of a binomial draw.
    """
    total = df.count()
    if total <= rows:
        return df
    cut = int(rows / total * 2**32)
    place = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(2**32))
    return df.where(place < F.lit(cut))


def batches_of(column: pa.ChunkedArray | pa.Array, limit: int) -> Iterator[tuple[int, int]]:
    """Row ranges of a string column that hold about ``limit`` bytes each, one row at least."""
    import pyarrow.compute as pc

    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        done = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, done + limit, side="right"))
        stop = max(stop, start + 1)
        yield start, stop
        start = stop
