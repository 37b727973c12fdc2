"""Rejected lines that a changed rule accepts, added to the rows of their landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from telemill.operators.classify import OK, QUARANTINE, classify
from telemill.operators.envelope import BAD_ENVELOPE, NULL_ENVELOPE
from telemill.plans.logtype import PARTITIONS, LogType, resolve
from telemill.sinks.files import batch_writer, write_files
from telemill.sinks.landing import LAYOUT, _read, read_rejected

PLACE = ("topic", "partition", "offset", "pos")


def pending_rejects(spark: SparkSession, path: str, log_type: str | LogType) -> DataFrame:
    """Rejected lines that have not been replayed, once for each place in the topic, with reason and place.

    Lines without a place cannot be told from each other and are left out, as are messages that could not be decoded.
    """
    spec = resolve(log_type)
    bad = read_rejected(spark, path, spec).select(*QUARANTINE)
    bad = bad.where(~F.col("reason").isin(BAD_ENVELOPE, NULL_ENVELOPE)).where(" and ".join(f"`{c}` is not null" for c in PLACE))
    # rows that came straight from a message do not carry their place
    promoted = _read(spark, path, spec).where((F.col("status") == OK) & F.col("offset").isNotNull()).select(*PLACE)
    return bad.join(promoted, list(PLACE), "left_anti").dropDuplicates(list(PLACE))


def replay_quarantine(spark: SparkSession, path: str, log_type: str | LogType, tz: str = "UTC", rebalance: bool = True) -> int:
    """Judge the pending rejects of a landing folder by the log type as it is now; returns how many became rows.

    These rows keep their places in the topic, by which a replay leaves out what an earlier one stored: it can be
    repeated at any time, also after one that broke off. The rejected lines stay where they are.

    They come from a shuffle by their places, which leaves some of every hour to each task: without `rebalance` every
    task writes a file for each hour.
    """
    spec = resolve(log_type)
    lines = pending_rejects(spark, path, spec).drop("reason")
    found = classify(lines, spec, tz).where(F.col("status") == OK)
    data = [c for c in spec.columns if c not in PARTITIONS]
    evidence = [F.col(c) if c in PLACE else F.lit(None).cast(t).alias(c) for c, t in _evidence_types(found)]
    rows = found.select(*data, *evidence, *LAYOUT)
    if rebalance:
        rows = rows.hint("rebalance", *[F.col(c) for c in LAYOUT])
    observation = Observation()  # above the shuffle: Spark leaves out what is below one without rows
    write_files(rows.observe(observation, F.count(F.lit(1)).alias("rows")), path, LAYOUT, batch_writer())
    return observation.get["rows"]


def _evidence_types(found: DataFrame) -> list[tuple[str, str]]:
    types = dict(found.dtypes)
    return [(c, types[c]) for c in QUARANTINE]
