"""Which offsets of a topic have been stored, which have not, and how to share them out.

Ranges are rows `topic`, `partition`, `first` and `last`, both ends included. Offsets are taken in chunks of `CHUNK`, so that
no task holds a whole Kafka partition, however much of the topic is in it.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

KEY = ["topic", "partition"]
RANGES = "topic string, partition int, first bigint, last bigint"
CHUNK = 1 << 20


def _chunk(column: str):
    return F.call_function("div", F.col(column), F.lit(CHUNK))


def offset_ranges(messages: DataFrame) -> DataFrame:
    """The offsets of some messages as ranges without gaps; repeated messages count once, null offsets are left out."""
    offsets = messages.select(*KEY, "offset").where("offset is not null").distinct().withColumn("chunk", _chunk("offset"))
    place = F.row_number().over(Window.partitionBy(*KEY, "chunk").orderBy("offset"))
    islands = offsets.withColumn("island", F.col("offset") - place).groupBy(*KEY, "chunk", "island")
    return merge_ranges(islands.agg(F.min("offset").alias("first"), F.max("offset").alias("last")))


def merge_ranges(ranges: DataFrame) -> DataFrame:
    """Ranges that overlap or touch, as one."""
    order = Window.partitionBy(*KEY).orderBy("first", "last")
    reach = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(reach.isNull() | (F.col("first") > reach + 1), 1).otherwise(0)
    marked = ranges.select(*KEY, "first", "last", begins.alias("begins"))
    numbered = marked.withColumn("n", F.sum("begins").over(order))
    return numbered.groupBy(*KEY, "n").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("n")


def record_coverage(messages: DataFrame, coverage: str, writer: str) -> None:
    """Note that `writer` has stored these messages; noted again, it counts once."""
    offset_ranges(messages).coalesce(1).write.mode("overwrite").parquet(f"{coverage.rstrip('/')}/writer={writer}")


def covered_offsets(spark: SparkSession, coverage: str) -> DataFrame:
    """The ranges that all jobs and streams which note their coverage in this folder have stored."""
    try:
        noted = spark.read.schema(RANGES).parquet(coverage)
    except AnalysisException:
        noted = spark.createDataFrame([], RANGES)
    return merge_ranges(noted)


def missing_offsets(covered: DataFrame, wanted: DataFrame) -> DataFrame:
    """What `covered` lacks of the ranges `wanted`."""
    wanted, covered = merge_ranges(wanted), merge_ranges(covered)
    inside = [F.col(f"w.{k}") == F.col(f"c.{k}") for k in KEY]
    inside += [F.col("c.first") <= F.col("w.last"), F.col("c.last") >= F.col("w.first")]
    met = wanted.alias("w").join(covered.alias("c"), inside, "left")
    met = met.select(*[f"w.{k}" for k in KEY], F.col("w.first").alias("a"), F.col("w.last").alias("b"), "c.first", "c.last")
    each = Window.partitionBy(*KEY, "a", "b").orderBy("first")
    before = met.withColumn("from", F.coalesce(F.lag("last").over(each) + 1, "a")).withColumn("to", F.coalesce(F.col("first") - 1, "b"))
    after = met.groupBy(*KEY, "a", "b").agg(F.max("last").alias("last")).select(*KEY, (F.col("last") + 1).alias("from"), F.col("b").alias("to"))
    gaps = before.select(*KEY, "from", "to").union(after).where("from <= to")
    return gaps.select(*KEY, F.col("from").alias("first"), F.col("to").alias("last"))


def uncovered(messages: DataFrame, covered: DataFrame) -> DataFrame:
    """The messages whose offsets are in none of the ranges `covered`.

    Messages and ranges meet by chunk. A Kafka read is better limited by `offset_options` of the missing ranges.
    """
    chunks = F.explode(F.sequence(_chunk("first"), _chunk("last"))).alias("chunk")
    ranges = covered.select(*KEY, "first", "last", chunks)
    same = [F.col(f"m.{k}") == F.col(f"r.{k}") for k in KEY] + [F.col("m._chunk") == F.col("r.chunk")]
    inside = F.col("m.offset").between(F.col("r.first"), F.col("r.last"))
    met = messages.withColumn("_chunk", _chunk("offset")).alias("m").join(ranges.alias("r"), [*same, inside], "left_anti")
    return met.drop("_chunk")


def plan_offsets(messages: DataFrame, ranges: int) -> DataFrame:
    """Offset ranges with about as many bytes each, `ranges` of them for all of the topic: with `bytes` and `messages`.

    A Kafka partition that holds most of the bytes is cut into most of the ranges. A range ends where the bytes before it,
    within its Kafka partition, pass a multiple of the size aimed at; only a message larger than that size is larger.
    """
    sizes = messages.where("offset is not null").select(*KEY, "offset", _chunk("offset").alias("chunk"), F.octet_length("value").alias("size"))
    sizes = sizes.withColumn("size", F.coalesce(F.col("size").cast("bigint"), F.lit(0)))
    chunks = sizes.groupBy(*KEY, "chunk").agg(F.sum("size").alias("chunk_bytes"))
    before = Window.partitionBy(*KEY).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("before", F.coalesce(F.sum("chunk_bytes").over(before), F.lit(0)))
    aim = sizes.agg(F.greatest(F.lit(1), F.ceil(F.sum("size") / ranges)).alias("aim"))
    within = Window.partitionBy(*KEY, "chunk").orderBy("offset").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("within", F.coalesce(F.sum("size").over(within), F.lit(0))).join(chunks, [*KEY, "chunk"])
    placed = placed.crossJoin(F.broadcast(aim))  # one row
    cut = placed.withColumn("n", F.call_function("div", F.col("before") + F.col("within"), F.col("aim")))
    return cut.groupBy(*KEY, "n").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("messages")
    ).drop("n")


def offset_options(ranges: DataFrame) -> list[dict[str, str]]:
    """Options of Spark's Kafka source for reads that together take these ranges of one topic, and nothing else.

    A read takes one range of every Kafka partition, so there are as many reads as some partition has ranges.
    """
    reads: list[dict[int, tuple[int, int]]] = []
    seen: dict[int, int] = {}
    topics = set()
    for r in ranges.select(*KEY, "first", "last").orderBy(*KEY, "first").toLocalIterator():
        topics.add(r.topic)
        turn = seen.get(r.partition, 0)
        seen[r.partition] = turn + 1
        if turn == len(reads):
            reads.append({})
        reads[turn][r.partition] = (r.first, r.last + 1)
    if len(topics) > 1:
        raise ValueError(f"ranges of one topic at a time, not of {', '.join(sorted(topics))}")
    name = next(iter(topics), "")
    return [
        {
            "assign": json.dumps({name: sorted(read)}),
            "startingOffsets": json.dumps({name: {str(p): a for p, (a, _) in sorted(read.items())}}),
            "endingOffsets": json.dumps({name: {str(p): b for p, (_, b) in sorted(read.items())}}),
        }
        for read in reads
    ]
