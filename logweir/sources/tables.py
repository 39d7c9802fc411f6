"""Effects on keyed tables as DataFrame operations, and versioned writes of the result.

Parquet has no MERGE or UPDATE, so an effect gives the table after it; ``write_version`` stores
that next to the old one and readers move on when the version is committed.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import position
from ..schema import TABLES
from ..session import path_exists


def first_per_key(rows: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """The earliest row of each key. Combined before the shuffle, so a hot key costs one row per task."""
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    if not rest:
        return rows.distinct()
    held = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), position(order)).alias("_row"))
    return held.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def last_per_key(rows: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    held = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), position(order)).alias("_row"))
    return held.select(*[c if c in keys else F.col(f"_row.{c}").alias(c) for c in rows.columns])


def insert_if_absent(
    target: DataFrame, rows: DataFrame, keys: Iterable[str], order: Iterable[str]
) -> DataFrame:
    """Rows to append: the first per key among those whose key is not in ``target``.

    Reducing to one row per key comes first, so the anti-join sees each key once and reuses the
    reduction's partitioning.
    """
    keys = list(keys)
    return first_per_key(rows, keys, order).join(target.select(*keys), keys, "left_anti")


def upsert(
    target: DataFrame, delta: DataFrame, key: str, rules: Mapping[str, str]
) -> DataFrame:
    """The table after merging ``delta`` (one row per key) into ``target``.

    ``rules`` gives the merge of each column: ``last`` takes the new value, ``max`` the greater.
    Both sides hold a key once, so no key is hot in the join.
    """
    old, new = target.alias("old"), delta.alias("new")

    def merged(column: str, rule: str) -> Column:
        before, after = F.col(f"old.{column}"), F.col(f"new.{column}")
        if rule == "max":
            return F.greatest(before, after)
        if rule == "last":
            return F.when(F.col("new._in"), after).otherwise(before)
        raise ValueError(f"unknown merge rule {rule!r}")

    joined = old.join(delta.withColumn("_in", F.lit(True)).alias("new"), key, "full_outer")
    return joined.select(key, *[merged(c, r).alias(c) for c, r in rules.items()])


def mark(target: DataFrame, ids: DataFrame, key: str, flag: str) -> DataFrame:
    """Sets ``flag`` where the row's key is among ``ids`` (one row per key)."""
    hits = ids.select(F.col(key)).withColumn("_hit", F.lit(True))
    joined = target.join(hits, key, "left")
    changed = F.col(flag) | F.col("_hit").isNotNull()
    return joined.select(*[changed.alias(c) if c == flag else F.col(c) for c in target.columns])


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows that a delete leaves: those for which the condition is false or unknown."""
    return target.where(~F.coalesce(condition, F.lit(False)))


def lookup(target: DataFrame, key: str, value: object) -> DataFrame:
    return target.where(F.col(key) == F.lit(value))


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])


def reset_tables(spark: SparkSession, root: str) -> None:
    """Empties every versioned table of the schema below ``root``: a new, empty version above what is there."""
    for name in TABLES:
        at = f"{root}/{name}"
        newest = committed(spark, at).agg(F.max("entry")).first()[0] if path_exists(spark, at) else None
        write_version(empty_table(spark, name), at, 0 if newest is None else int(newest) + 1)


# ---------------------------------------------------------------- databases


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    split_by: tuple[str, object, object, int] | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options for ``format("jdbc")``; filters such as ``pending`` are pushed to the database.

    ``split_by`` (column, lowest, highest, parts) makes Spark read in parallel; without it one
    task reads the whole table. The driver jar is the caller's.
    """
    options = {"url": url, "dbtable": table, "user": user, "password": password}
    if split_by:
        column, lowest, highest, parts = split_by
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lowest),
            "upperBound": str(highest),
            "numPartitions": str(parts),
        }
    return {**options, **extra}


# ---------------------------------------------------------------- commits


def commit(spark: SparkSession, root: str, entry: str) -> None:
    """Makes ``entry`` visible to readers, after its data has been written."""
    spark.range(1).select(F.lit(entry).alias("entry")).coalesce(1).write.mode("append").parquet(
        f"{root}/_commits"
    )


def committed(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema("entry string").parquet(f"{root}/_commits").distinct()


def write_version(table: DataFrame, root: str, version: int) -> None:
    """Writes a new version beside the old ones; readers see it once it is complete."""
    table.write.mode("overwrite").parquet(f"{root}/version={version:08d}")
    commit(table.sparkSession, root, f"{version:08d}")


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A committed version, by default the newest. Only its number passes through the driver."""
    number = f"{version:08d}" if version is not None else None
    if number is None:
        number = committed(spark, root).agg(F.max("entry")).first()[0]
    return spark.read.parquet(f"{root}/version={number}")
