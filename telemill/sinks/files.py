"""Folders that many writers fill at the same time.

Every job and every micro-batch has a folder of its own, `writer=<id>`, with the partition keys below. It is written by
a plain overwrite of that one folder: a micro-batch that comes again, or a batch job that is run again under its id,
replaces what it left and counts once. Nobody else's files are touched, and readers see all writers and prune by the
keys below them. There is no log beside the files that could hide some of them.

A batch job that dies while it commits may leave a part of its rows in its folder. Run it again under the same id.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WRITER = "writer"


def batch_writer(run: str | None = None) -> str:
    """The id of a batch job: that of the run if it has one, else a new one."""
    return f"batch-{run or uuid.uuid4().hex}"


def stream_writer(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream with this checkpoint, kept in the checkpoint: a renewed one is a new writer."""
    place = f"{checkpoint.rstrip('/')}/telemill"
    try:
        kept = spark.read.schema("value string").text(place).first()
    except AnalysisException:
        kept = None
    if kept is not None:
        return kept[0]
    writer = f"stream-{uuid.uuid4().hex}"
    spark.range(1, numPartitions=1).select(F.lit(writer).alias("value")).write.mode("overwrite").text(place)
    return writer


def write_files(
    rows: DataFrame,
    path: str,
    layout: Sequence[str],
    writer: str,
    rebalance: bool = False,
    format: str = "parquet",
    order: Sequence[str] = (),
) -> None:
    """Write rows to `<path>/writer=<writer>/<layout>/`, in place of what this writer has there.

    `rebalance` shuffles first so that every partition lands in few files. `order` sorts each file; the sort is local to
    the task, and its first keys are those that the writer sorts by in any case.
    """
    if rebalance:
        rows = rows.hint("rebalance", *[F.col(c) for c in layout])
    if order:
        kept = [c for c in rows.columns if c not in order or c in layout]
        rows = rows.sortWithinPartitions(*layout, *order).select(*kept)
    save = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if format == "text":
        save = save.option("lineSep", "\n")
    save.partitionBy(*layout).format(format).save(f"{path.rstrip('/')}/{WRITER}={writer}")
