"""Session settings the engine expects."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "modlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC time, adaptive execution and skew handling on.

    On a cluster leave ``master`` unset and let the submit command decide it; any
    keyword (dots written as double underscores) overrides a setting.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for checkpoints and working tables: the cluster's own, else (tests) a new local one."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        found = tempfile.mkdtemp(prefix="modlens-ckpt-", dir=os.environ.get("TMPDIR"))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the folder all executors share, and read again: its lineage ends there."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
