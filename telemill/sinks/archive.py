"""Unparsed lines as text, by the minute of their message."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.functions.clock import minute_label
from telemill.operators.envelope import decode_segments
from telemill.operators.lines import explode_lines
from telemill.sinks.files import batch_writer, write_files

LAYOUT = ("segment",)
ORDER = ("topic", "partition", "offset", "pos")


def archive_lines(messages: DataFrame, codec: str = "arrow") -> DataFrame:
    """`line` and `segment` (`YYYYmmddHHMM`, UTC) of every line, with its lineage.

    Undecodable messages have no lines, and lines that are null are left out.
    """
    lines = explode_lines(decode_segments(messages, on_error="drop", codec=codec))
    return lines.where("line is not null").withColumn("segment", minute_label(F.col("timestamp")))


def write_archive(lines: DataFrame, path: str, writer: str, rebalance: bool = False) -> None:
    rows = lines.select("line", "segment", *ORDER)
    write_files(rows, path, LAYOUT, writer, rebalance, "text", ORDER)


def archive_segments(
    messages: DataFrame, path: str, codec: str = "arrow", rebalance: bool = False, run: str | None = None
) -> None:
    """Add the lines to `<path>/writer=<id>/segment=<YYYYmmddHHMM>/`, beside those of other jobs and streams.

    Messages of one minute add up. Within a file, lines keep the order they had in the topic. Only a line feed ends a
    line: carriage returns stay, and a line that holds a line feed is read back as several.

    `rebalance` shuffles, for few files a minute when tasks hold lines of many minutes; a busy minute is split. A job
    that is run again under the name `run` replaces what it wrote before.
    """
    write_archive(archive_lines(messages, codec), path, batch_writer(run), rebalance)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.schema("line string, segment string").option("lineSep", "\n").text(path)
    return lines.select("segment", "line")
