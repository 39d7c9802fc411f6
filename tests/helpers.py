"""Small logs for tests."""

from pyspark.sql import functions as F

from logweir.functions.envelope import build_envelope


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def records(spark, items, topic="orders.events"):
    """Log records from ``(seq, event id, type, aggregate, payload dict)``, keyed by aggregate."""
    fields = sorted({f for *_, payload in items for f in payload})
    schema = "seq long, event_id string, event_type string, aggregate_id string, p struct<" + (
        ", ".join(f"`{f}`: string" for f in fields) or "none: string"
    ) + ">"
    data = [
        (seq, eid, kind, agg, tuple(None if p.get(f) is None else str(p[f]) for f in fields) or (None,))
        for seq, eid, kind, agg, p in items
    ]
    df = spark.createDataFrame(data, schema)
    when = F.timestamp_seconds(F.lit(1704067200) + F.col("seq"))
    value = build_envelope(F.col("event_id"), F.col("event_type"), F.col("aggregate_id"), F.col("p"), when)
    return df.select(
        F.lit(topic).alias("topic"),
        F.col("aggregate_id").alias("key"),
        value.alias("value"),
        when.alias("timestamp"),
        "seq",
    )


def decoded(spark, items, topic="orders.events"):
    from logweir.functions.envelope import decode_log

    return decode_log(records(spark, items, topic))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
