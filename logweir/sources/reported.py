"""Writing records with a result for each of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .log_store import classify

SUCCESS, ERROR = "SUCCESS", "ERROR"


def write_reported(records: DataFrame, root: str, batch: str, event_id: str, key: str = "key") -> tuple[DataFrame, dict]:
    """Writes ``records`` as one batch and reports: one row per record, and counts.

    Records that cannot be read as an envelope are written too, apart and with their reason. The counts are taken while the
    records are written. The report reads only ids and keys, and compares what was handed in with what is found in
    the sink: a record that is not there is an ERROR like a refused one, and the batch goes on. A batch written again replaces itself.
    """
    path = f"{root}/batch={batch}"
    counts = Observation(f"delivery-{batch}")
    refused = F.col("reason").isNotNull()
    tagged = classify(records).observe(
        counts, F.count("*").alias("records"), F.count_if(refused).alias("errors"), F.count_if(~refused).alias("successes")
    )
    tagged.withColumn("accepted", ~refused).write.mode("overwrite").partitionBy("accepted").parquet(path)
    found = records.sparkSession.read.schema(f"{event_id} {records.schema[event_id].dataType.simpleString()}, reason string, accepted boolean")
    # An id delivered more than once has one result per record of its own in the report, and the same in the sink.
    stored = found.parquet(path).groupBy(F.col(event_id).alias("_id")).agg(
        F.max("accepted").alias("accepted"), F.max("reason").alias("reason")
    )
    sent = records.select(F.col(event_id).alias("event_id"), F.col(key).alias("key"))
    told = sent.join(stored, sent["event_id"].eqNullSafe(stored["_id"]), "left")
    reason = F.when(F.col("accepted").isNull(), F.lit("not written")).when(~F.col("accepted"), F.col("reason"))
    result = F.when(F.col("accepted"), F.lit(SUCCESS)).otherwise(F.lit(ERROR))
    return told.select("event_id", "key", result.alias("result"), reason.alias("reason")), counts.get
