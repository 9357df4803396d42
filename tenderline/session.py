"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # rows that are placed by bid already stay there when they are joined by bid and more
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app_name: str = "tenderline", master: str | None = None, **overrides: str) -> SparkSession:
    """A session with the defaults above; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can see, named by ``spark.checkpoint.dir``; there is no default."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return folder


def run_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/tenderline/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where one frame feeds several branches: each branch then prunes and
    filters a small columnar table instead of recomputing the source scans, and a
    lost executor costs a re-read rather than a re-run.
    """
    path = run_folder(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
