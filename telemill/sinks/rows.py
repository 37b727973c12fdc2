"""Accepted rows alone, as a folder partitioned by the hour."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from telemill.plans.logtype import LogType, resolve


def read_rows(spark: SparkSession, path: str, log_type: str | LogType) -> DataFrame:
    """Rows of the folder in table order, partition keys with the type's own types."""
    spec = resolve(log_type)
    return spark.read.schema(spec.schema).parquet(path).select(*spec.columns)
