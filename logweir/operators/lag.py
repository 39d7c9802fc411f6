"""How far readers are behind a log, from what their own queries report."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

POSITIONS = "reader string, partition int, position long, records long"


def observed(log: DataFrame, reader: str, partitions: int) -> DataFrame:
    """``log`` that reports, with every micro-batch, the next offset and the records per partition.

    The figures are taken while the batch is processed: no second pass, no shuffle.
    """
    figures = []
    for p in range(partitions):
        here = F.col("partition") == p
        figures.append(F.max(F.when(here, F.col("offset") + 1)).alias(f"next_{p}"))
        figures.append(F.count_if(here).alias(f"records_{p}"))
    return log.observe(reader, *figures)


class Positions:
    """Next offset and records so far per reader and partition, out of progress events. A progress event comes after the
    micro-batch has been committed, so a position is never ahead of what a reader has done."""

    def __init__(self) -> None:
        self.at: dict[tuple[str, int], list[int]] = {}
        self.seen: set[tuple[str, int]] = set()

    def take(self, run: str, batch_id: int, metrics: dict) -> None:
        """Figures of one micro-batch; the same batch told twice counts once."""
        if (run, batch_id) in self.seen:
            return
        self.seen.add((run, batch_id))
        for reader, row in metrics.items():
            for name, value in row.asDict().items():
                kind, _, partition = name.rpartition("_")
                held = self.at.setdefault((reader, int(partition)), [0, 0])
                if kind == "next":
                    held[0] = max(held[0], value or 0)
                else:
                    held[1] += value or 0

    def of_query(self, query: StreamingQuery) -> Positions:
        """Takes what a query has reported so far."""
        for progress in query.recentProgress:
            self.take(str(query.id), progress.batchId, progress.observedMetrics)
        return self

    def table(self, spark: SparkSession) -> DataFrame:
        """One row per reader and partition of the log."""
        rows = [(reader, partition, *held) for (reader, partition), held in sorted(self.at.items())]
        return spark.createDataFrame(rows, POSITIONS)


class PositionListener(StreamingQueryListener):
    """Feeds ``positions`` from all queries of a session: ``spark.streams.addListener``."""

    def __init__(self, positions: Positions) -> None:
        self.positions = positions

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        self.positions.take(str(progress.id), progress.batchId, progress.observedMetrics)

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        pass


def reader_lag(ends: DataFrame, positions: DataFrame, readers: Iterable[str]) -> DataFrame:
    """Per reader and partition: end offset, position and the difference; a reader that has reported nothing stands at 0.

    ``ends (partition, end_offset)`` has a row per partition of the log; readers are a handful.
    """
    named = F.explode(F.array(*(F.lit(r) for r in readers))).alias("reader")
    rows = ends.select("partition", "end_offset", named).join(positions, ["reader", "partition"], "left")
    position = F.coalesce("position", F.lit(0).cast("long"))
    return rows.select(
        "reader", "partition", "end_offset", position.alias("position"),
        (F.col("end_offset") - position).alias("lag"),
        F.coalesce("records", F.lit(0).cast("long")).alias("records"),
    )
