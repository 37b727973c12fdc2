"""Partitioned catalog tables for accepted rows and for rejected lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.functions.clock import instant_clock
from telemill.operators.classify import LINE_COLUMNS, QUARANTINE
from telemill.plans.logtype import PARTITIONS, LogType, resolve

HIVE_MODE = "hive.exec.dynamic.partition.mode"


def table_ddl(table: str, log_type: str | LogType, location: str | None = None) -> str:
    spec = resolve(log_type)
    place = f" LOCATION '{location}'" if location else ""
    return f"CREATE TABLE IF NOT EXISTS {table} ({spec.ddl}) USING parquet PARTITIONED BY ({', '.join(PARTITIONS)}){place}"


def create_table(spark: SparkSession, table: str, log_type: str | LogType, location: str | None = None) -> None:
    spark.sql(table_ddl(table, log_type, location))


def write_table(df: DataFrame, table: str, log_type: str | LogType, rebalance: bool = False) -> None:
    """Append to the table by position; partitions are made as rows need them.

    `rebalance` shuffles first so that every hour lands in few files. Spark sizes
    the pieces by volume: a busy hour is split over tasks, quiet ones share one.
    """
    rows = df.select(*resolve(log_type).columns)
    if rebalance:
        rows = rows.hint("rebalance", *[F.col(c) for c in PARTITIONS])
    _insert(rows, table)


def create_quarantine(spark: SparkSession, table: str, location: str | None = None) -> None:
    """A table for rejected lines, partitioned by `day`, the UTC day of their messages."""
    types = {**LINE_COLUMNS, "reason": "string"}
    columns = ", ".join(f"`{c}` {types[c]}" for c in QUARANTINE)
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}, day date) USING parquet PARTITIONED BY (day){place}")


def write_quarantine(rejected: DataFrame, table: str) -> None:
    day = instant_clock(F.col("timestamp")).cast("date").alias("day")
    _insert(rejected.select(*QUARANTINE, day), table)


def _insert(rows: DataFrame, table: str) -> None:
    """Append by position. Tables of Hive's own format take new partitions only in this mode."""
    conf = rows.sparkSession.conf
    before = conf.get(HIVE_MODE, None)
    conf.set(HIVE_MODE, "nonstrict")
    try:
        rows.write.mode("append").insertInto(table)
    finally:
        conf.unset(HIVE_MODE) if before is None else conf.set(HIVE_MODE, before)
