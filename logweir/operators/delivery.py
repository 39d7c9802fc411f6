"""Who receives what: key placement, order per key, and readers that share or split a log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import PARTITIONS
from ..session import lookup_table


def key_placement(log: DataFrame) -> DataFrame:
    """Rows and partitions per topic and key. Counting per partition first keeps hot keys small."""
    return (
        log.groupBy("topic", "key", "partition")
        .agg(F.count("*").alias("_rows"))
        .groupBy("topic", "key")
        .agg(F.count("*").alias("partitions"), F.sum("_rows").alias("records"))
    )


def order_check(log: DataFrame, sequence: str, block: int = 1 << 20) -> DataFrame:
    """Per topic and key: in how many partitions it is, and how often ``sequence`` falls along the offsets.

    Order exists inside a partition only. Neighbours are compared inside blocks of ``block``
    offsets, so a group has at most ``block`` rows even where one key fills a partition. The
    last value of a block is then compared with the first of the key's next one, on one row
    per key and block.
    """
    blocked = log.select(
        "topic", "key", "partition", "offset", sequence, F.floor(F.col("offset") / block).alias("_block")
    )
    within = Window.partitionBy("topic", "key", "partition", "_block").orderBy("offset")
    marked = blocked.withColumn(
        "_falls", (F.lag(sequence).over(within) > F.col(sequence)).cast("int")
    )
    blocks = marked.groupBy("topic", "key", "partition", "_block").agg(
        F.count("*").alias("_rows"),
        F.coalesce(F.sum("_falls"), F.lit(0)).alias("_inside"),
        F.min_by(sequence, "offset").alias("_first"),
        F.max_by(sequence, "offset").alias("_last"),
    )
    across = Window.partitionBy("topic", "key", "partition").orderBy("_block")
    seams = blocks.withColumn("_seam", (F.lag("_last").over(across) > F.col("_first")).cast("int"))
    per_place = seams.groupBy("topic", "key", "partition").agg(
        F.sum("_rows").alias("_rows"),
        (F.sum("_inside") + F.coalesce(F.sum("_seam"), F.lit(0))).alias("_falls"),
    )
    return per_place.groupBy("topic", "key").agg(
        F.count("*").alias("partitions"),
        F.sum("_rows").alias("records"),
        F.sum("_falls").alias("inversions"),
    )


def assignment(
    spark: SparkSession, groups: Mapping[str, Sequence[str]], partitions: int = PARTITIONS
) -> DataFrame:
    """Partitions of each member: a group's members, in name order, get consecutive ranges.

    The first members get one more where the partitions do not divide evenly. One row per group
    and partition, so the table stays as small as the number of partitions times groups.
    """
    rows = []
    for group, members in groups.items():
        share, extra = divmod(partitions, len(members))
        start = 0
        for i, member in enumerate(sorted(members)):
            end = start + share + (1 if i < extra else 0)
            rows += [(group, member, p) for p in range(start, end)]
            if start == end:
                rows.append((group, member, None))
            start = end
    return lookup_table(spark, rows, "group string, member string, partition int")


def received_and_missed(log: DataFrame, assigned: DataFrame) -> DataFrame:
    """Per member: records received, and records of the log that it never sees.

    The log is counted per partition before it meets the assignment, so giving every group a
    full copy multiplies a few counts, not the log.
    """
    everything = Window.partitionBy(F.lit("all"))
    # From here on there is one row per partition or member, so totals over all are no bottleneck.
    counted = (
        log.groupBy("partition")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_total", F.sum("_rows").over(everything))
    )
    members = assigned.join(counted, "partition", "left")
    received = members.groupBy("group", "member").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("received"), F.max("_total").alias("_total")
    )
    missed = F.coalesce(F.max("_total").over(everything), F.lit(0)) - F.col("received")
    return received.select("group", "member", "received", missed.alias("missed"))


def load_factor(received: DataFrame) -> DataFrame:
    """Deliveries over events: how much the readers together take in."""
    return received.agg(
        F.sum("received").alias("deliveries"),
        F.max(F.col("received") + F.col("missed")).alias("events"),
    ).withColumn("load_factor", F.col("deliveries") / F.col("events"))


def missed_events(log: DataFrame, assigned: DataFrame, member: str) -> DataFrame:
    """Records one member does not receive because another one of its group does."""
    own = assigned.where((F.col("member") == member) & F.col("partition").isNotNull())
    return log.join(own.select("partition").distinct(), "partition", "left_anti")


def received_counts(deliveries: DataFrame, reader: str = "reader") -> DataFrame:
    """Running totals of readers: records each has taken."""
    return deliveries.groupBy(reader).agg(F.count("*").alias("records"))
