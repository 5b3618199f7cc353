"""Session settings the operators rely on, and where scratch tables go."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Run-time settings: safe to set on a session somebody else created.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A key holding a third of the rows makes one join partition huge; AQE cuts such a partition
    # by map output and repeats the matching part of the other side.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # State spills to local disk and is checkpointed to the shared folder; heap does not bound it.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
}


def configure(spark: SparkSession, timezone: str = "UTC") -> SparkSession:
    """Apply the run-time settings; one time zone rules every date and window."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", timezone)
    return spark


def local_session(cpus: int | str = 8, shuffle_partitions: int | str | None = None) -> SparkSession:
    """A local session for tests and the bench. Clusters bring their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("streammart")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("STREAMMART_DRIVER_MEMORY", "12g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A run-time setting for as long as the block runs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Where it is not set, the context's checkpoint folder; a local session without one gets one.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        folder = tempfile.mkdtemp(prefix="streammart-")
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; nothing is created until it is written to."""
    return f"{shared_dir(spark)}/streammart/{label}-{uuid.uuid4().hex}"
