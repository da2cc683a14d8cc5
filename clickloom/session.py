"""Spark session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only settings that differ from Spark's own defaults and that the operators rely on.
# Cluster sizing (executors, memory, shuffle partitions) stays with the deployment.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Keeps streaming state on executor disk, so it may exceed the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # A line that repeats a key keeps its last value, as in the JSON source.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Each task merges its own sessions before the shuffle: a hot user then sends one row
    # per session and task instead of one per event.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def build_session(app_name: str = "clickloom", master: str | None = None,
                  conf: dict[str, str] | None = None) -> SparkSession:
    """A session with ``DEFAULTS``; entries of ``conf`` win over them."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="clickloom-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, not yet existing folder below :func:`scratch_root`."""
    return f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"


def checkpointed(df):
    """``df`` cut from its lineage by a reliable checkpoint in the shared folder."""
    spark = df.sparkSession
    root = scratch_root(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return df.checkpoint()
