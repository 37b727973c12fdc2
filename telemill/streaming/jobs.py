"""Continuous ingestion and archiving."""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemill.operators.classify import accepted, rejected
from telemill.operators.report import METRICS, observe_batch
from telemill.plans.batch import check_target, classify_messages
from telemill.plans.logtype import PARTITIONS, LogType, resolve
from telemill.sinks.archive import archive_lines, write_archive
from telemill.sinks.files import stream_writer, write_files
from telemill.sinks.landing import write_landing
from telemill.sinks.tables import write_quarantine, write_table
from telemill.sources.offsets import record_coverage
from telemill.streaming.stop import start_drainable

INTERVAL = "30 seconds"
LOGGER = logging.getLogger("telemill.streaming")

# Reports are kept in folders of so many batches, so that readers can skip old ones.
BLOCK = 10_000


def _start(
    frame: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, interval: str | None, name: str
) -> StreamingQuery:
    writer = frame.writeStream.queryName(name)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return start_drainable(writer, write, frame.sparkSession, checkpoint)


def _by_time(batch: DataFrame) -> DataFrame:
    """A batch that came in fewer parts than the session has cores, dealt in runs of time before anything is decoded.

    So all cores work on it, and the tasks' rows lie in few folders each. Messages of one time are told apart by offset.
    """
    cores = batch.sparkSession.sparkContext.defaultParallelism
    parts = batch.select(F.spark_partition_id().alias("part")).distinct().count()
    order = [c for c in ("timestamp", "topic", "partition", "offset") if c in batch.columns]
    return batch.repartitionByRange(cores, *order) if 0 < parts < cores and order else batch


def ingest_stream(
    messages: DataFrame,
    log_type: str | LogType,
    checkpoint: str,
    path: str | None = None,
    table: str | None = None,
    quarantine: str | None = None,
    tz: str = "UTC",
    mode: str = "quarantine",
    on_error: str = "mark",
    codec: str = "arrow",
    interval: str | None = INTERVAL,
    name: str | None = None,
    rebalance: bool = False,
    coverage: str | None = None,
) -> StreamingQuery:
    """Start a query that decodes, normalises and appends a stream of messages.

    path      files, exactly once: a landing folder (mode `quarantine`) or a
              folder of rows (`drop`, `failfast`). Other streams and batch jobs
              may write to the same folder at the same time.
    table     a catalog table, and the table `quarantine` for bad lines: at
              least once. A batch that is known to be finished is not written
              again; one that broke off between its writes is.
    interval  time between micro-batches; None takes what is there and ends
    name      of the query; the log type and the checkpoint's id by default
    rebalance shuffles every batch for fewer, larger files (see `write_table`)
    coverage  a folder that notes which offsets have been stored (see `covered_offsets`);
              a batch's messages are read once more for it

    Every finished batch is logged and adds a report (see `read_reports`). A
    lost or renewed checkpoint starts over: rows come again, none is hidden.
    `request_stop` ends the query between two batches, from any process.
    """
    check_target(path, table, quarantine, mode)
    spec = resolve(log_type)
    strictness = "failfast" if mode == "failfast" else "drop"
    lines_of = lambda batch: classify_messages(batch, spec, tz, on_error, codec)
    writer = stream_writer(messages.sparkSession, checkpoint)
    name = name or f"{spec.name}-{writer[-8:]}"

    def to_files(batch: DataFrame, observation: Observation, batch_id: int) -> None:
        observed, own = observe_batch(batch, spec, observation), f"{writer}-{batch_id:09d}"
        if mode == "quarantine":
            write_landing(observed, spec, path, rebalance, own)
        else:
            write_files(accepted(observed, spec, strictness), path, PARTITIONS, own, rebalance)

    def to_tables(batch: DataFrame, observation: Observation, batch_id: int) -> None:
        # Two tables are filled from one batch, so it is decoded once and kept.
        kept = batch.persist() if quarantine else batch
        try:
            rows = accepted(observe_batch(kept, spec, observation), spec, strictness)
            write_table(rows, table, spec, rebalance)
            if quarantine and observation.get["bad_rows"]:
                write_quarantine(rejected(kept), quarantine)
        finally:
            if quarantine:
                kept.unpersist()

    store, reports = to_files if table is None else to_tables, f"{checkpoint}/reports"

    def write(batch: DataFrame, batch_id: int) -> None:
        place = f"{reports}/block={batch_id // BLOCK}/batch_id={batch_id}"
        if _exists(batch.sparkSession, place):
            return
        observation = Observation()
        store(lines_of(_by_time(batch)), observation, batch_id)
        if coverage is not None:
            record_coverage(batch, coverage, f"{writer}-{batch_id:09d}")
        metrics = observation.get
        values = [F.lit(metrics.get(m)).cast(t).alias(m) for m, t in METRICS.items()]
        report = batch.sparkSession.range(1, numPartitions=1).select(F.lit(spec.name).alias("log_type"), *values)
        report.write.mode("overwrite").json(place)
        log_batch(name, spec, batch_id, metrics)

    return _start(messages, write, checkpoint, interval, name)


def log_batch(name: str, spec: LogType, batch_id: int, metrics: dict) -> None:
    counts = [metrics.get(m) or 0 for m in ("rows", "bad_rows", "dropped_rows")]
    if not any(counts):
        LOGGER.info("%s: batch %s: no new segments", name, batch_id)
        return
    LOGGER.info(
        "%s: batch %s, %s: %s rows from %s to %s, %s bad, %s dropped",
        name, batch_id, spec.segment_label, counts[0], metrics.get("min_label"), metrics.get("max_label"), *counts[1:],
    )


def read_reports(spark: SparkSession, checkpoint: str, first_batch: int = 0) -> DataFrame:
    """One row for each finished batch of a query, from `first_batch` on; labels as text."""
    columns = ", ".join(f"{m} {t}" for m, t in METRICS.items())
    schema = f"block bigint, batch_id bigint, log_type string, {columns}"
    place = f"{checkpoint}/reports"
    if not _exists(spark, place):
        return spark.createDataFrame([], schema).drop("block")
    found = spark.read.schema(schema).json(place)
    return found.where((F.col("block") >= first_batch // BLOCK) & (F.col("batch_id") >= first_batch)).drop("block")


def _exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a report; one whose write broke off is none."""
    try:
        return spark.read.schema("log_type string").json(path).first() is not None
    except AnalysisException:
        return False


def archive_stream(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    codec: str = "arrow",
    interval: str | None = INTERVAL,
    name: str | None = None,
    rebalance: bool = False,
) -> StreamingQuery:
    """Start a query that adds every line, unparsed, to its minute's folder; exactly once (see `archive_segments`, `request_stop`)."""
    writer = stream_writer(messages.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_archive(archive_lines(_by_time(batch), codec), path, f"{writer}-{batch_id:09d}", rebalance)

    return _start(messages, write, checkpoint, interval, name or f"archive-{writer[-8:]}")
