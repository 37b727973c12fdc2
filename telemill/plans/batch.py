"""Batch jobs: backfill with the operators that the streams use."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from telemill.operators.classify import accepted, classify, rejected
from telemill.operators.envelope import decode_segments
from telemill.operators.lines import explode_lines
from telemill.operators.report import METRICS, observe_batch
from telemill.plans.logtype import PARTITIONS, LogType, resolve
from telemill.session import reliable
from telemill.sinks.files import batch_writer, write_files
from telemill.sinks.landing import by_folder, write_landing
from telemill.sinks.tables import write_quarantine, write_table
from telemill.sources.offsets import record_coverage

MODES = ("quarantine", "drop", "failfast")


def classify_messages(
    messages: DataFrame, log_type: str | LogType, tz: str = "UTC", on_error: str = "mark", codec: str = "arrow"
) -> DataFrame:
    """Messages to lines with a verdict."""
    return classify(explode_lines(decode_segments(messages, on_error, codec)), log_type, tz)


def check_target(path: str | None, table: str | None, quarantine: str | None, mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {', '.join(MODES)}, not {mode!r}")
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table")
    if table is not None and (mode == "quarantine") != (quarantine is not None):
        raise ValueError("a quarantine table goes with a table and mode 'quarantine'")
    if path is not None and quarantine is not None:
        raise ValueError("with a path, rejected lines go to the same path")


def ingest_batch(
    messages: DataFrame,
    log_type: str | LogType,
    path: str | None = None,
    table: str | None = None,
    quarantine: str | None = None,
    tz: str = "UTC",
    mode: str = "quarantine",
    on_error: str = "mark",
    codec: str = "arrow",
    rebalance: bool = False,
    run: str | None = None,
    coverage: str | None = None,
) -> dict:
    """Decode, normalise and append a bounded set of messages; returns the batch report.

    mode        `quarantine` keeps bad lines, `drop` leaves them out, `failfast` raises
    path        a landing folder (mode `quarantine`, one pass) or a folder of rows
    table       a catalog table made by `create_table`; bad lines go to the table
                `quarantine`. The classified lines are kept in the shared
                checkpoint folder meanwhile, so messages are read once.
    run         a name for this job, for a path: run again under it, the job replaces
                what it wrote before, also what it left when it died
    coverage    a folder that notes which offsets have been stored (see `covered_offsets`);
                their messages are read once more for it
    """
    check_target(path, table, quarantine, mode)
    if run is not None and path is None:
        raise ValueError("only jobs that write to a path can be run again by name")
    spec, writer = resolve(log_type), batch_writer(run)
    observation = Observation()
    classified = classify_messages(messages, spec, tz, on_error, codec)
    if quarantine is not None:
        classified = reliable(classified)
    landed = path is not None and mode == "quarantine"
    observed = observe_batch(by_folder(classified, spec) if landed and rebalance else classified, spec, observation)
    strictness = "failfast" if mode == "failfast" else "drop"
    if landed:
        write_landing(observed, spec, path, writer=writer)
    elif path is not None:
        write_files(accepted(observed, spec, strictness), path, PARTITIONS, writer, rebalance)
    else:
        write_table(accepted(observed, spec, strictness), table, spec, rebalance)
        if quarantine is not None and observation.get["bad_rows"]:
            write_quarantine(rejected(classified), quarantine)
    if coverage is not None:
        record_coverage(messages, coverage, writer)
    return _report(spec, observation)


def _report(spec: LogType, observation: Observation) -> dict:
    metrics = observation.get
    return {"log_type": spec.name, **{m: metrics.get(m) for m in METRICS}}
