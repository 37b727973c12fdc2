"""Lines of decoded messages, and their fields."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.functions import text
from telemill.operators.envelope import LINEAGE


def explode_lines(df: DataFrame) -> DataFrame:
    """One row per line, with `pos`, its place in the message, and the lineage.

    A message without lines because of its envelope stays as one row that
    carries `envelope` and, as `line`, the undecodable bytes in hex.
    """
    lineage = [c for c in LINEAGE if c in df.columns]
    lines = F.col("lines")
    kept = list(lineage)
    if "envelope" in df.columns:
        kept.append("envelope")
        lines = F.coalesce(lines, F.when(F.col("envelope").isNotNull(), F.array("raw")))
    return df.select(*kept, F.posexplode(lines).alias("pos", "line"))


def split_fields(df: DataFrame, separator: str = ",", line_col: str = "line") -> DataFrame:
    """Add `fields`: the line cut at every separator."""
    return df.withColumn("fields", text.split_fields(F.col(line_col), separator))


def tokenize_quoted(df: DataFrame, line_col: str = "line") -> DataFrame:
    """Add `fields`, the line's blank-separated tokens, and `open_quote`."""
    tokens = df.withColumn("fields", text.tokenize_quoted(F.col(line_col)))
    return tokens.withColumn("open_quote", text.has_open_quote(F.col("fields")))
