"""Spark session helpers shared by the library, the tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "callscope") -> SparkSession:
    """A local session tuned for this library (tests, bench, smoke runs).

    On a cluster the session comes from the launcher; nothing here is needed
    there except `ensure_checkpoint_dir`.
    """
    master = master or os.environ.get("CALLSCOPE_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local data: keep several partitions for the CPU-bound regex work
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "256k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("CALLSCOPE_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by `spark.checkpoint.dir`.

    A cluster sets it to a shared file system; we only invent one (under the
    local temp folder) when it is unset, which happens in tests and local runs.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = spark.sparkContext.getCheckpointDir()
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        current = tempfile.mkdtemp(prefix="callscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", current)
    spark.sparkContext.setCheckpointDir(current)
    return spark.sparkContext.getCheckpointDir() or current


def stored(df, name: str):
    """`df` written under the shared checkpoint folder and read back: what is
    read several times is built once, and outlives lost executors."""
    path = scratch_path(df.sparkSession, "stored", name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, kind: str, name: str) -> str:
    """A fresh folder under the shared checkpoint dir, one per run."""
    base = ensure_checkpoint_dir(spark)
    return f"{base.rstrip('/')}/{kind}/{name}-{uuid.uuid4().hex}"
