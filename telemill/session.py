"""What the package needs from the caller's session."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared folder that `spark.checkpoint.dir` names.

    Only a session on a single machine may do without the setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.gettempdir()
    return f"{base.rstrip('/')}/telemill/{name}-{uuid.uuid4().hex}"


def reliable(df: DataFrame) -> DataFrame:
    """The same rows from a reliable checkpoint in the shared folder; Spark removes it when it is no longer used."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(scratch_dir(spark, "checkpoint"))
    return df.checkpoint()
