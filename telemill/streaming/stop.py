"""Ending a stream between two batches, asked for from any process that reaches its checkpoint.

The request is an empty file in the checkpoint. The driver of the query looks for it after every batch, and every
`POLL_SECONDS` while no batch runs. A batch that runs is finished first. Whether Spark had noted it by then or not makes
no difference: a batch that is reported, or replaces its own folder, counts once when it comes again.
"""

from __future__ import annotations

import logging
import threading
import time
from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

MARK = "telemill-stop"
POLL_SECONDS = 5.0
LOGGER = logging.getLogger("telemill.streaming")


class _Mark:
    """The request's file."""

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/{MARK}")
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def make(self) -> None:
        self.fs.create(self.path, True).close()

    def remove(self) -> None:
        self.fs.delete(self.path, False)


def request_stop(spark: SparkSession, checkpoint: str) -> None:
    """Ask the query with this checkpoint to end after the batch that it is at.

    The query removes the request as it ends. A request that no query was there to see is dropped when one starts.
    """
    _Mark(spark, checkpoint).make()


def start_drainable(
    writer: DataStreamWriter,
    write: Callable[[DataFrame, int], None],
    spark: SparkSession,
    checkpoint: str,
    poll_seconds: float | None = None,
) -> StreamingQuery:
    """Start a query that calls `write` for every batch and ends when it is asked to (see `request_stop`)."""
    mark = _Mark(spark, checkpoint)
    mark.remove()
    between = threading.Lock()  # held while a batch is written, and while the query is being told to end
    begun, ending = threading.Event(), threading.Event()
    started: list[StreamingQuery] = []

    def end() -> None:
        """Tell the query to end and wait until it knows: it begins no other batch then."""
        query = started[0]
        ending.set()
        LOGGER.info("%s: asked to stop", query.name)
        # `stop` returns when the query's thread is done, which may be waiting for our batch to return
        threading.Thread(target=query.stop, daemon=True).start()
        while query.isActive:
            time.sleep(0.02)

    def batch(rows: DataFrame, batch_id: int) -> None:
        begun.wait()
        with between:
            write(rows, batch_id)
            if not ending.is_set() and mark.exists():
                end()

    def watch() -> None:
        query = started[0]
        try:
            while not query.awaitTermination(POLL_SECONDS if poll_seconds is None else poll_seconds):
                if not ending.is_set() and between.acquire(blocking=False):
                    try:
                        if mark.exists():
                            end()
                    finally:
                        between.release()
            if ending.is_set():
                mark.remove()
        except (StreamingQueryException, Py4JError, OSError) as error:  # told by the query itself, or the session is gone
            LOGGER.debug("no longer watching %s: %s", checkpoint, error)

    started.append(writer.foreachBatch(batch).option("checkpointLocation", checkpoint).start())
    begun.set()
    threading.Thread(target=watch, daemon=True).start()
    return started[0]
