"""What a batch held, counted while it is written."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from telemill.operators.classify import BAD, DROPPED, OK, classify
from telemill.plans.logtype import LogType, resolve

# The metrics and how they are stored; a label has the type of its column.
METRICS = {
    "rows": "bigint",
    "bad_rows": "bigint",
    "dropped_rows": "bigint",
    "min_label": "string",
    "max_label": "string",
}


def batch_metrics(log_type: str | LogType) -> list[Column]:
    """Aggregates over classified lines; the labels are those of accepted rows."""
    spec = resolve(log_type)
    status = F.col("status")
    label = F.when(status == OK, F.col(spec.label))
    return [
        F.count_if(status == OK).alias("rows"),
        F.count_if(status == BAD).alias("bad_rows"),
        F.count_if(status == DROPPED).alias("dropped_rows"),
        F.min(label).alias("min_label"),
        F.max(label).alias("max_label"),
    ]


def batch_report(df: DataFrame, log_type: str | LogType, tz: str = "UTC") -> DataFrame:
    """One row about a frame of lines."""
    spec = resolve(log_type)
    report = classify(df, spec, tz).agg(*batch_metrics(spec))
    return report.select(
        F.lit(spec.name).alias("log_type"), F.lit(spec.segment_label).alias("segment_label"), *METRICS
    )


def observe_batch(
    classified: DataFrame, log_type: str | LogType, observation: Observation | str
) -> DataFrame:
    """The same lines; the metrics come for free with whatever action runs on them."""
    return classified.observe(observation, *batch_metrics(log_type))
