"""Sessions and shared working folders."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here expects. A cluster submits with the same ones.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # the default of 256 MB leaves a partition of 200 MB among partitions of 4 MB unsplit
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(app: str = "millrace", cpus: int | str = 8, memory: str = "8g",
                  partitions: int = 8) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.driver.memory", memory)
               .config("spark.sql.shuffle.partitions", str(partitions))
               .config("spark.ui.enabled", "false"))
    for key, value in JOB_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named in ``spark.checkpoint.dir``.

    Only a local session without the setting gets a temporary folder of its own.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(named)
        return named.rstrip("/")
    if context.getCheckpointDir() is None:
        if not re.match(r"local(\[|$)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder; nothing is created there yet."""
    return f"{shared_root(spark)}/millrace/{label}-{uuid.uuid4().hex[:12]}"
