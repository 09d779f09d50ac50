"""Session settings used by the library."""
from __future__ import annotations

import atexit
import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app: str = "mendstream", master: str | None = None, partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators are tuned for."""
    b = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        b = b.master(master).config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
    if partitions:
        b = b.config("spark.sql.shuffle.partitions", str(partitions))
    return b.getOrCreate()


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in spark.checkpoint.dir or by setCheckpointDir.

    Only a local session may do without: it gets a temporary folder. On a cluster each executor would write to a disk of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    named = named or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("shared intermediates need a folder that all executors see: set spark.checkpoint.dir")
    return _local_scratch()


@functools.cache
def _local_scratch() -> str:
    folder = tempfile.mkdtemp(prefix="mendstream-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


TABLES: list[str] = []  # shared tables of this driver, oldest first


def reuse(df: DataFrame) -> DataFrame:
    """A frame that several branches of a plan read, as a table in the shared folder.

    It is computed once, its lineage is cut for planner and recovery alike, and readers prune its columns.
    """
    path = f"{scratch_dir(df.sparkSession)}/reuse-{uuid.uuid4()}"
    df.write.parquet(path)
    TABLES.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession, tables: list[str]) -> None:
    """Delete shared tables whose results have been written elsewhere."""
    for path in tables:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
        TABLES.remove(path)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, in whatever store it names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def bounded(dim: DataFrame, rows: int = 100_000) -> DataFrame:
    """A configuration table with a broadcast hint if it has at most ``rows`` rows; a larger one is joined by a shuffle."""
    return F.broadcast(dim) if dim.limit(rows + 1).count() <= rows else dim
