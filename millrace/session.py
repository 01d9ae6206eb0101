"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings a session for this library should be built with. ANSI mode is left
# at its default (on); coercions in the library use the try_ functions.
RECOMMENDED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM never compiles a method above 8,000 bytes of bytecode, and fused
    # code over a hundred sensor columns gets there. With this limit such a
    # stage runs as many small compiled methods instead of one interpreted one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Settings for streams whose state grows with the rows: it is held in RocksDB, on the
# executors' disks and in the checkpoint, with a bounded share of memory. Spark's default
# holds the whole state of two batches as objects in the executors' heaps.
STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "500",
}


def state_on_disk(spark: SparkSession) -> SparkSession:
    """The session, set to run its streams with ``STATE_ON_DISK``. A stream that has run
    with another store keeps to it: its checkpoint can't be read otherwise."""
    for name, value in STATE_ON_DISK.items():
        spark.conf.set(name, value)
    return spark


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    """The builder with the recommended settings."""
    for name, value in RECOMMENDED.items():
        builder = builder.config(name, value)
    return builder


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the session zone so that timestamps without a zone mean UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only where the setting is empty (local tests) is a temporary folder made,
    and then only for a local master: executors elsewhere could not read it.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if not named and context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="millrace-"))
    return named or context.getCheckpointDir()


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives executor loss."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
