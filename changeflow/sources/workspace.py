"""Where a job keeps its intermediate tables and checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def workspace(spark: SparkSession, purpose: str = "job") -> str:
    """A fresh folder below the shared folder that the cluster names in its settings.

    Without that setting only a local session gets one, on its own disk; on a cluster a
    machine-local folder would be lost with the machine, so that is refused.
    """
    shared = spark.conf.get(_SETTING, None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="changeflow-")
    return f"{shared.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a table and read it back: cuts the lineage and tells Spark its real size."""
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
