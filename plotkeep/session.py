"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "plotkeep", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators assume.

    Shuffle partition counts and memory are left to the cluster; AQE coalesces
    and splits partitions from measured sizes.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.ui.enabled": "false",
        # call sites of every column expression cost more than planning them
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder: on a cluster
    that would be a different disk on every machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return os.path.join(tempfile.gettempdir(), "plotkeep-local")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder. Nothing is created or removed."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df, label: str = "cut"):
    """Write a frame to the shared folder and read it back.

    Survives executor loss, which a local checkpoint does not.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
