"""The given tables seen as event logs, outboxes and customer events."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codes import switch
from ..functions.envelope import build_envelope, stable_id
from ..functions.partitioner import key_partition
from ..schema import PARTITIONS
from ..sources.log_store import dense_offsets

# How the event types of the ``events`` table read as order events, and the
# processing case each one carries (``view`` carries none).
TYPE_OF = {
    "signup": "OrderCreated",
    "purchase": "OrderPaid",
    "click": "OrderConfirmed",
    "view": "OrderPlaced",
    "error": "CustomerBlocked",
}
CASE_OF = {"click": "temporary", "signup": "temporary-long", "error": "poison", "purchase": "unknown"}

EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_rows(
    spark: SparkSession, sf_dir: str, types: Iterable[str] | None = None, prefix: str | None = None
) -> DataFrame:
    """``events``, cut down to the wanted order event types where the parquet files are read.

    ``types`` names them, ``prefix`` takes all that begin so. Types that ``TYPE_OF`` does not map
    keep their own name in the log, so they are wanted by that.
    """
    rows = table(spark, sf_dir, "events")
    return rows if types is None and prefix is None else rows.where(source_types(types or (), prefix))


def event_parts(spark: SparkSession, sf_dir: str, root: str, parts: int = 3) -> Iterator[DataFrame]:
    """``events`` as a stream that grows: yields it once per part written, then once more after the first
    part has been delivered again. Each time a query with a kept checkpoint finds the new files only.

    Parts follow the event numbers, so they are the log's order; ``delivery`` is 1 for what comes again.
    """
    rows = table(spark, sf_dir, "events")
    low, high = rows.agg(F.min("event_id"), F.max("event_id")).first()
    part = F.floor((F.col("event_id") - low) * parts / (high - low + 1))
    schema = f"{EVENTS_SCHEMA}, delivery int, part int"
    for delivery, wanted in [*((0, p) for p in range(parts)), (1, 0)]:
        rows.where(part == wanted).write.parquet(f"{root}/delivery={delivery}/part={wanted}")
        yield spark.readStream.schema(schema).parquet(root)


def late_parts(spark: SparkSession, sf_dir: str, root: str, parts: int = 3) -> Iterator[DataFrame]:
    """``events`` as a stream with late and repeated records: every fifth event comes with the part after its own, and
    every seventh comes again then. Yields the stream once per delivery."""
    rows = table(spark, sf_dir, "events")
    low, high = rows.agg(F.min("event_id"), F.max("event_id")).first()
    part = F.floor((F.col("event_id") - low) * parts / (high - low + 1))
    late, again = F.col("event_id") % 5 == 0, F.col("event_id") % 7 == 0
    for p in range(parts + 1):
        here = ((part == p) & ~late) | ((part == p - 1) & (late | again))
        rows.where(here).write.parquet(f"{root}/part={p}")
        yield spark.readStream.schema(f"{EVENTS_SCHEMA}, part int").parquet(root)


def caused_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the event that caused them, in blocks of fifty: a tree that branches in two, one event whose cause is
    not in the log, and a circle of three."""
    number = F.col("event_id") % 50
    block = F.col("event_id") - number
    cause = (
        F.when(number == 0, F.lit(None))
        .when(number < 46, block + F.floor((number - 1) / 2))
        .when(number == 46, F.lit(-1))
        .when(number == 47, block + 49)
        .otherwise(F.col("event_id") - 1)
    )
    return table(spark, sf_dir, "events").select("event_id", cause.cast("bigint").alias("caused_by"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a stream, whether the table is one file or a folder of files."""
    return spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parque[t]")


def source_types(types: Iterable[str], prefix: str | None = None) -> Column:
    wanted = set(types)
    kind = F.col("event_type")
    own = {name for name in wanted if name not in TYPE_OF}
    mapped = {s for s, k in TYPE_OF.items() if k in wanted or (prefix is not None and k.startswith(prefix))}
    found = kind.isin(*sorted(own | mapped))
    if prefix is None:
        return found
    return found | (kind.startswith(prefix) & ~kind.isin(*TYPE_OF))


def as_log(rows: DataFrame) -> DataFrame:
    """``events`` rows as decoded log records; columns nobody asks for are pruned by Catalyst.

    ``seq`` is the unique, growing event number and so stands for the log's total order.
    """
    kind = switch(F.col("event_type"), TYPE_OF, F.col("event_type"))
    position = ["delivery"] if "delivery" in rows.columns else []
    return rows.select(
        *position,
        F.lit("orders.events").alias("topic"),
        F.col("event_id").alias("seq"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("key"),
        F.col("event_id").cast("string").alias("event_id"),
        kind.alias("event_type"),
        F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("aggregate_id"),
        F.col("user_id"),
        # Amounts beyond 32 bits read as NULL.
        F.col("value").try_cast("int").alias("amount"),
        switch(F.col("event_type"), CASE_OF, F.lit(None).cast("string")).alias("case"),
    )


def order_log(
    spark: SparkSession, sf_dir: str, types: Iterable[str] | None = None, prefix: str | None = None
) -> DataFrame:
    return as_log(event_rows(spark, sf_dir, types, prefix))


def with_other_types(rows: DataFrame) -> DataFrame:
    """``events`` in which every seventh view is of an order type that ``TYPE_OF`` does not map, and
    every eleventh one of a type that is no order type."""
    number, view = F.col("event_id"), F.col("event_type") == "view"
    kind = (
        F.when(view & (number % 7 == 0), F.lit("OrderPacked"))
        .when(view & (number % 11 == 0), F.lit("StockCounted"))
        .otherwise(F.col("event_type"))
    )
    return rows.withColumn("event_type", kind)


def placed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order log with the partition of every key.

    Spreading rows without a key makes the partition non-null, which spares joins on it a filter
    that would compute it a second time.
    """
    partition = key_partition("key", PARTITIONS, spread="event_id")
    return order_log(spark, sf_dir).withColumn("partition", partition)


def offset_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order log with partitions and offsets.

    The event number serves as offset: unique and growing inside each partition, with gaps as in
    a compacted topic. Readers need no more than that, and no row has to be renumbered.
    """
    return placed_log(spark, sf_dir).withColumn("offset", F.col("seq"))


def renumbered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order log with offsets counted from 0 without gaps."""
    return dense_offsets(placed_log(spark, sf_dir), "seq")


def redelivered(log: DataFrame) -> DataFrame:
    """Every record delivered twice, the second time after the whole first pass."""
    again = log.withColumn("delivery", F.lit(1))
    return log.withColumn("delivery", F.lit(0)).unionByName(again)


def log_value() -> Column:
    """A record's envelope as JSON text, over the columns of the order log."""
    payload = F.struct("amount", "case")
    return build_envelope(
        F.col("event_id"), F.col("event_type"), F.col("aggregate_id"), payload, F.col("timestamp")
    )


def with_value(log: DataFrame) -> DataFrame:
    return log.withColumn("value", log_value())


def with_payload(log: DataFrame) -> DataFrame:
    return log.withColumn("payload", F.to_json(F.struct("amount", "case")))


def sagas(log: DataFrame) -> DataFrame:
    """The order log with one aggregate per user and day instead of per user."""
    day = F.date_format("timestamp", "yyyy-MM-dd")
    return log.withColumn("aggregate_id", F.concat_ws("/", "key", day))


def damaged_log(log: DataFrame) -> DataFrame:
    """The log as text, with values damaged by event type to exercise the quarantine."""
    damaged = (
        F.when(F.col("event_type") == "CustomerBlocked", F.lit("{bad"))
        .when(F.col("event_type") == "OrderPlaced", F.lit("[1]"))
        .when(F.col("event_type") == "OrderConfirmed", F.lit(""))
        .when((F.col("event_type") == "OrderCreated") & (F.col("amount") < 10), F.lit(None))
        .otherwise(F.col("value"))
    )
    return with_value(log).withColumn("value", damaged)


def raw_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_log(order_log(spark, sf_dir))


def customer_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer events in three versions: as first agreed, with a new field, with renamed fields.

    Customers in debt have no name; the field is there and null.
    """
    version = (F.pmod("c_custkey", F.lit(3)) + 1).cast("int")
    known = F.when(F.col("c_acctbal") >= 0, F.col("c_name"))
    customer = F.concat(F.lit("c-"), F.col("c_custkey").cast("string"))
    keep_nulls = {"ignoreNullFields": "false"}
    first = F.struct(customer.alias("customerId"), known.alias("name"))
    second = F.struct(
        customer.alias("customerId"), known.alias("name"), F.col("c_mktsegment").alias("segment")
    )
    third = F.struct(customer.alias("id"), known.alias("fullName"))
    payload = (
        F.when(version == 1, F.to_json(first, keep_nulls))
        .when(version == 2, F.to_json(second, keep_nulls))
        .otherwise(F.to_json(third, keep_nulls))
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.lit("CustomerChanged").alias("event_type"),
        version.alias("event_version"),
        payload.alias("payload"),
    )


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as order changes: id, status, whole amount and time."""
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("order-"), F.col("o_orderkey").cast("string")).alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").try_cast("int").alias("amount"),
        F.col("o_orderdate").cast("timestamp").alias("updated_at"),
    )


def order_outbox(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` as an outbox with the customer as aggregate; orders in status P are unpublished."""
    kind = F.lit("OrderPaid")
    event_id = stable_id(kind, F.col("o_orderkey"))
    aggregate = F.concat(F.lit("c-"), F.col("o_custkey").cast("string"))
    payload = F.struct(
        F.col("o_orderkey").alias("orderId"), F.col("o_totalprice").try_cast("int").alias("amount")
    )
    created = F.col("o_orderdate").cast("timestamp")
    return table(spark, sf_dir, "orders").select(
        event_id.alias("id"),
        aggregate.alias("aggregate_id"),
        kind.alias("event_type"),
        build_envelope(event_id, kind, aggregate, payload, created).alias("payload"),
        (F.col("o_orderstatus") != "P").alias("published"),
        created.alias("created_at"),
        F.col("o_orderkey").alias("order_key"),
    )
