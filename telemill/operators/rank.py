"""The running number of every row in an order of the whole frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemill.session import reliable

# monotonically_increasing_id has the partition above these bits and the row's number in it below.
ROW_BITS = 33


def running_rank(df: DataFrame, order: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Add `name`, the row's place (from 0) when all rows are sorted by `order`.

    Rows are dealt to partitions by ranges of `order` and counted there; the counts of the partitions before are added.
    One shuffle, and no task holds more than its range: end `order` with something that tells rows with equal keys
    apart, else these share a task. The sorted rows are kept in the shared checkpoint folder, as the numbers must not
    change when a task is run again.
    """
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = reliable(sorted_rows.withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright("_id", ROW_BITS).alias("_part")
    # a row for each partition, whatever the volume
    counts = numbered.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_first"))
    ranked = numbered.withColumn("_part", part).join(F.broadcast(firsts), "_part")
    row = F.col("_id").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return ranked.select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_first") + row).alias(name))
