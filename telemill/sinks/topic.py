"""Packed messages with the columns of Spark's Kafka sink: `key`, `value`, `topic` and `partition`.

A source's messages go to one Kafka partition, so that consumers find them in order. A source with more than its share of
the bytes is spread over as many partitions as its share fills, in turns by bucket. Where a message goes is told by its
source and bucket alone, so a task that is run again sends it to the same partition. Spark's Kafka sink delivers at least
once: what a task had sent before it died comes again.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemill.session import reliable
from telemill.sinks.files import batch_writer, stream_writer, write_files

COLUMNS = ("key", "value", "topic", "partition")
LAYOUT = ("topic",)


def _source(by: Sequence[str]) -> Column:
    """The source as JSON text; a null is a value like others."""
    return F.to_json(F.struct(*[F.col(c) for c in by]), {"ignoreNullFields": "false"})


def topic_widths(packed: DataFrame, by: Sequence[str], partitions: int) -> DataFrame:
    """Rows `source` and `width` for the sources that need more than one of `partitions` by their share of the bytes.

    These are fewer than `partitions`, whatever the volume: each holds more than an even share.
    """
    sizes = packed.groupBy(_source(by).alias("source")).agg(F.sum(F.length("value")).alias("bytes"))
    sizes = reliable(sizes)
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    width = F.ceil(F.col("bytes") * partitions / F.lit(total)).cast("int")
    return sizes.where(F.col("bytes") * partitions > total).select("source", F.least(width, F.lit(partitions)).alias("width"))


def to_topic(
    packed: DataFrame,
    topic: str,
    partitions: int,
    by: Sequence[str] = (),
    bucket: str | None = None,
    widths: DataFrame | None = None,
) -> DataFrame:
    """Messages (`value`, `by`, see `pack_segments`) as the rows that Spark's Kafka sink takes.

    partitions  of the topic; one is chosen for every message
    by          columns that make the source: the key is their JSON. Without, there is no key and messages are dealt
    bucket      a whole number that deals a wide source's messages out in turns; a hash of their bytes without
    widths      see `topic_widths`. Measured where `packed` is not a stream, which reads it once more; a stream takes those
                of a batch, and without any gives every source one partition
    """
    if partitions < 1:
        raise ValueError("partitions must be positive")
    turn = F.xxhash64("value") if bucket is None else F.coalesce(F.col(bucket).cast("bigint"), F.lit(0))
    if not by:
        place = F.pmod(turn, F.lit(partitions)).cast("int")
        return packed.select(F.lit(None).cast("binary").alias("key"), "value", F.lit(topic).alias("topic"), place.alias("partition"))
    if widths is None and not packed.isStreaming:
        widths = topic_widths(packed, by, partitions)
    rows = packed.select(_source(by).alias("source"), "value", turn.alias("turn"))
    if widths is None:
        rows = rows.withColumn("width", F.lit(1))
    else:
        rows = rows.join(F.broadcast(widths.select("source", "width")), "source", "left").fillna(1, ["width"])
    home = F.pmod(F.xxhash64("source"), F.lit(partitions))
    place = F.pmod(home + F.pmod("turn", "width"), F.lit(partitions)).cast("int")
    return rows.select(F.col("source").cast("binary").alias("key"), "value", F.lit(topic).alias("topic"), place.alias("partition"))


def kafka_sink_options(servers: str | Iterable[str], **more: str) -> dict[str, str]:
    """Options of Spark's Kafka sink; by default all replicas acknowledge, and a producer's own retries count once."""
    options = {
        "kafka.bootstrap.servers": servers if isinstance(servers, str) else ",".join(servers),
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }
    return options | {k: str(v) for k, v in more.items()}


def write_segments_batch(messages: DataFrame, servers: str | Iterable[str], **options: str) -> None:
    """Send the messages to their topic (see `to_topic`, `kafka_sink_options`)."""
    messages.select(*COLUMNS).write.format("kafka").options(**kafka_sink_options(servers, **options)).save()


def write_segments_stream(
    messages: DataFrame,
    servers: str | Iterable[str],
    checkpoint: str,
    interval: str | None = "30 seconds",
    name: str | None = None,
    **options: str,
) -> StreamingQuery:
    """Start a query that sends a stream of messages to their topic; `interval` None takes what is there and ends."""
    writer = messages.select(*COLUMNS).writeStream.format("kafka").options(**kafka_sink_options(servers, **options))
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return (writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)).start()


def write_segment_files(
    messages: DataFrame, path: str, checkpoint: str | None = None, interval: str | None = None, run: str | None = None
) -> StreamingQuery | None:
    """Keep the messages as files that `read_segment_files` reads, beside those of other jobs and streams.

    A stream needs a `checkpoint` and returns its query; its batches count once. A job run again under the name `run`
    replaces what it wrote before. Files give no offsets and no times: these are null when read.
    """
    rows = messages.select(*COLUMNS)
    if not messages.isStreaming:
        write_files(rows, path, LAYOUT, batch_writer(run))
        return None
    if checkpoint is None:
        raise ValueError("a stream needs a checkpoint")
    writer = stream_writer(messages.sparkSession, checkpoint)

    def write(batch: DataFrame, batch_id: int) -> None:
        write_files(batch, path, LAYOUT, f"{writer}-{batch_id:09d}")

    started = rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (started.trigger(availableNow=True) if interval is None else started.trigger(processingTime=interval)).start()
