"""Accepted rows and rejected lines side by side, written in one pass.

A landing folder is partitioned by `status` first and by the hour below, so
reading either side prunes the other, and a stream needs one query with one
checkpoint for both. Rejected lines are dated by their message, in UTC, and have no hour.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.functions.clock import PARTS, instant_clock
from telemill.operators.classify import BAD, DROPPED, LINE_COLUMNS, OK, QUARANTINE
from telemill.plans.logtype import PARTITIONS, LogType, resolve
from telemill.sinks.files import batch_writer, write_files

LAYOUT = ("status", *PARTITIONS)


def landing_rows(classified: DataFrame, log_type: str | LogType) -> DataFrame:
    """The classified lines as they are stored; skipped lines are left out."""
    spec = resolve(log_type)
    accepted = F.col("status") == OK
    keys = [k.alias(p) for p, k in zip(PARTITIONS, _keys(spec))]
    evidence = [F.when(~accepted, F.col(c)).alias(c) for c in QUARANTINE]
    data = [c for c in spec.columns if c not in PARTITIONS]
    return classified.where(F.col("status") != DROPPED).select(*data, *evidence, "status", *keys)


def by_folder(classified: DataFrame, log_type: str | LogType) -> DataFrame:
    """The classified lines, shuffled so that every landing partition lands in few files.

    What is observed of a write goes above it: Spark leaves out what is below a shuffle without rows.
    """
    names = [f"_{p}" for p in PARTITIONS]
    keyed = classified.select("*", *[k.alias(n) for n, k in zip(names, _keys(resolve(log_type)))])
    return keyed.hint("rebalance", "status", *names).drop(*names)


def _keys(spec: LogType) -> list[Column]:
    return [F.when(F.col("status") == OK, F.col(p)).otherwise(_day_part(spec, p)) for p in PARTITIONS]


def _day_part(spec: LogType, part: str) -> Column:
    """A partition key of a rejected line, as the log type writes such keys; NULL for the hour."""
    kind = spec.schema[part].dataType.simpleString()
    if part == PARTITIONS[-1]:
        return F.lit(None).cast(kind)
    value = F.call_function(PARTS[part], instant_clock(F.col("timestamp"))).cast("string")
    return (value if part == PARTITIONS[0] else F.lpad(value, 2, "0")).cast(kind)


def write_landing(
    classified: DataFrame, log_type: str | LogType, path: str, rebalance: bool = False, writer: str | None = None
) -> None:
    write_files(landing_rows(classified, log_type), path, LAYOUT, writer or batch_writer(), rebalance)


def _read(spark: SparkSession, path: str, log_type: str | LogType) -> DataFrame:
    spec = resolve(log_type)
    types = {**LINE_COLUMNS, "reason": "string"}
    evidence = ", ".join(f"`{c}` {types[c]}" for c in QUARANTINE)
    # A given schema: partition values would be guessed otherwise, '07' as 7.
    return spark.read.schema(f"{spec.ddl}, {evidence}, status string").parquet(path)


def read_accepted(spark: SparkSession, path: str, log_type: str | LogType) -> DataFrame:
    spec = resolve(log_type)
    return _read(spark, path, spec).where(F.col("status") == OK).select(*spec.columns)


def read_rejected(spark: SparkSession, path: str, log_type: str | LogType) -> DataFrame:
    """Rejected lines; `y`, `m` and `d`, the UTC day of their messages, prune the read."""
    return _read(spark, path, log_type).where(F.col("status") == BAD).select(*QUARANTINE, *PARTITIONS[:-1])
