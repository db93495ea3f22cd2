"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app_name: str = "pairwright", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings every operator is tested under."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder that every executor can reach.

    The cluster names its shared folder in ``spark.checkpoint.dir``.  Only a
    local session, where driver and executors are one process, may fall back
    to a temporary folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return os.path.join(tempfile.mkdtemp(prefix="pairwright-"), purpose)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Point ``DataFrame.checkpoint`` at the shared folder if nothing has yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        base = spark.conf.get("spark.checkpoint.dir", None)
        spark.sparkContext.setCheckpointDir(base or shared_folder(spark, "checkpoint"))


def shuffle_partitions(spark: SparkSession) -> int:
    """The partition count the session was sized for."""
    return max(
        int(spark.conf.get("spark.sql.shuffle.partitions")),
        spark.sparkContext.defaultParallelism,
    )
