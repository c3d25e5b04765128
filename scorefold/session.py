"""Session settings and the folder that survives the loss of an executor."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
STAGING = "scorefold_staging"

RUNTIME_CONF = {
    # Event times, window ends and month partitions are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key that holds a large share of the rows is split, even at the price of a shuffle.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM never compiles methods above 8000 bytes of bytecode.  Wide rule-driven
    # projections exceed that as one generated stage, so they run as several.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Keyed window state does not have to fit on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    A local-mode session without the setting uses a folder below its warehouse;
    a cluster session without it is an error, because a folder on one machine is
    lost with that machine.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a folder shared by all executors")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier call has returned."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once into the shared folder and read from there.

    Files have a known size, so Catalyst itself broadcasts a small one.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let iterative jobs checkpoint into the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` computed once, as a table in the shared folder that is dropped afterwards.

    Later steps read only the columns they need from it, and a lost executor
    costs no recomputation.
    """
    spark = df.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {STAGING} LOCATION '{shared_root(spark)}/{STAGING}'")
    name = f"{STAGING}.batch_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(name)
    try:
        yield spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
