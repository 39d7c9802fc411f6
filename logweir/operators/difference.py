"""Where two versions of a keyed table differ, by a tree of digests."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Buckets of keys, and how many of them a node above has.
BUCKETS, FAN = 1 << 14, 1 << 7


def bucket_of(keys: Iterable[str], buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def digests(table: DataFrame, keys: list[str], buckets: int = BUCKETS) -> DataFrame:
    """``bucket, rows, one, two``: the rows' hashes of each bucket, put together in any order.

    Combined inside each task, so at most ``buckets`` rows a task are shuffled, whatever the table.
    """
    columns = sorted(table.columns)
    return table.groupBy(bucket_of(keys, buckets).alias("bucket")).agg(
        F.count("*").alias("rows"),
        F.bit_xor(F.xxhash64(*columns)).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(1), *columns)).alias("two"),
    )


def _unequal(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Values of ``on`` whose digests differ, or that one side lacks."""
    names = ("rows", "one", "two")
    other = right.select(F.col(on).alias("_on"), *(F.col(n).alias(f"_{n}") for n in names))
    same = [F.col(n).eqNullSafe(F.col(f"_{n}")) for n in names]
    joined = left.join(other, F.col(on) == F.col("_on"), "full_outer")
    return joined.where(~(same[0] & same[1] & same[2])).select(F.coalesce(on, "_on").alias(on))


def unequal_buckets(left: DataFrame, right: DataFrame, fan: int = FAN) -> DataFrame:
    """Buckets that differ between two tables of ``digests``: first the nodes above, then the buckets of those that differ."""
    above = lambda d: d.groupBy(F.floor(F.col("bucket") / fan).alias("node")).agg(
        F.sum("rows").alias("rows"), F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two")
    )
    nodes = _unequal(above(left), above(right), "node")
    below = lambda d: d.join(nodes, F.floor(F.col("bucket") / fan) == F.col("node"), "left_semi")
    return _unequal(below(left), below(right), "bucket")


def table_difference(left: DataFrame, right: DataFrame, keys: Iterable[str], buckets: int = BUCKETS) -> DataFrame:
    """Rows that differ: the keys, ``change`` (removed, added, changed) and the values of either side as structs.

    ``left`` and ``right`` have the same columns and one row per key; NULL is a key like others. Both are read once for their
    digests and, only where these differ, a second time for the rows of the unequal buckets. Versions that agree join no rows. A
    difference goes unseen only if two 64-bit hashes of a bucket agree by chance.
    """
    keys = list(keys)
    values = [c for c in left.columns if c not in keys]
    spark = left.sparkSession
    # At most as many rows as there are buckets.
    found = [r["bucket"] for r in unequal_buckets(digests(left, keys, buckets), digests(right, keys, buckets)).collect()]
    unequal = spark.createDataFrame([(b,) for b in found], "bucket int")

    def part(table: DataFrame, side: str) -> DataFrame:
        rows = table.withColumn("bucket", bucket_of(keys, buckets))
        rows = rows.join(F.broadcast(unequal), "bucket", "left_semi") if found else rows.where(F.lit(False))
        named = (F.col(k).alias(f"{side}_{k}") for k in keys)
        return rows.select(*named, F.struct(*values).alias(side))

    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"before_{k}").eqNullSafe(F.col(f"after_{k}"))
    joined = part(left, "before").join(part(right, "after"), same, "full_outer")
    change = (
        F.when(F.col("after").isNull(), F.lit("removed"))
        .when(F.col("before").isNull(), F.lit("added"))
        .when(~F.col("before").eqNullSafe(F.col("after")), F.lit("changed"))
    )
    chosen = (F.when(F.col("before").isNull(), F.col(f"after_{k}")).otherwise(F.col(f"before_{k}")).alias(k) for k in keys)
    return joined.select(*chosen, change.alias("change"), "before", "after").where("change is not null")
