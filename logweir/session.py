"""Session settings and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Tasks that write a few topics keep a writer open for each instead of sorting by topic first.
    "spark.sql.maxConcurrentOutputFileWriters": "16",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state."
    "RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, app: str = "logweir", **extra: str) -> SparkSession:
    """Session with the library's settings; ``extra`` uses ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in extra.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; where that is unset, what ``setCheckpointDir`` was given.

    A local folder is made only where both are unset and the master is local: the executors of a
    cluster could not see each other's.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current is None:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="logweir-"))
        current = spark.sparkContext.getCheckpointDir()
    return current


def run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared root."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    location = spark._jvm.org.apache.hadoop.fs.Path(path)
    settings = spark._jsparkSession.sessionState().newHadoopConf()
    return location.getFileSystem(settings), location


def path_exists(spark: SparkSession, path: str) -> bool:
    files, location = _file_system(spark, path)
    return files.exists(location)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Removes a staging folder this library has written."""
    files, location = _file_system(spark, path)
    files.delete(location, True)


def lookup_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Driver-built rules as a DataFrame of literals, whose size Catalyst knows when it picks the join."""
    kind = T.StructType.fromDDL(schema)
    if not rows:
        return spark.createDataFrame([], kind)
    literals = F.array(*(F.struct(*(F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(row, kind))) for row in rows))
    return spark.range(1).select(F.inline(literals))
