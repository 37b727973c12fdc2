"""Where messages come from: Kafka, or files that hold what Kafka would give."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The columns of Spark's Kafka source that are used here.
MESSAGE_SCHEMA = (
    StructType()
    .add("key", "binary")
    .add("value", "binary")
    .add("topic", "string")
    .add("partition", "integer")
    .add("offset", "long")
    .add("timestamp", "timestamp")
)


def kafka_options(
    servers: str | Iterable[str],
    topic: str,
    partitions: Iterable[int] | None = None,
    group_id: str | None = None,
    starting_offsets: str | None = None,
    ending_offsets: str | None = None,
    max_offsets_per_trigger: int | None = None,
    min_partitions: int | None = None,
    poll_timeout_ms: int | None = None,
    **more: str,
) -> dict[str, str]:
    """Options of Spark's Kafka source.

    partitions      read only these (`assign`), else subscribe to the whole topic
    group_id        prefix of the consumer groups; the topic by default
    min_partitions  split Kafka partitions further, for more tasks than
                    partitions or when one partition holds most of the data
    """
    options = {"kafka.bootstrap.servers": servers if isinstance(servers, str) else ",".join(servers)}
    if partitions is None:
        options["subscribe"] = topic
    else:
        options["assign"] = json.dumps({topic: sorted(set(partitions))})
    options["groupIdPrefix"] = group_id or topic
    optional = {
        "startingOffsets": starting_offsets,
        "endingOffsets": ending_offsets,
        "maxOffsetsPerTrigger": max_offsets_per_trigger,
        "minPartitions": min_partitions,
        "kafkaConsumer.pollTimeoutMs": poll_timeout_ms,
    }
    options.update({k: str(v) for k, v in optional.items() if v is not None})
    options.update(more)
    return options


def read_segments_stream(spark: SparkSession, servers, topic: str, **options) -> DataFrame:
    """Stream of a topic's messages (see `kafka_options`)."""
    return spark.readStream.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def read_segments_assigned(spark: SparkSession, servers, topic: str, partitions, **options) -> DataFrame:
    """Stream of the messages in some of a topic's partitions."""
    return read_segments_stream(spark, servers, topic, partitions=partitions, **options)


def read_segments_batch(spark: SparkSession, servers, topic: str, **options) -> DataFrame:
    """The messages between two offsets, for backfills."""
    return spark.read.format("kafka").options(**kafka_options(servers, topic, **options)).load()


def read_segment_files(
    spark: SparkSession,
    path: str,
    streaming: bool = False,
    max_files_per_trigger: int = 1000,
    format: str = "parquet",
) -> DataFrame:
    """Messages kept as files with the columns of `MESSAGE_SCHEMA`."""
    reader = spark.readStream if streaming else spark.read
    if streaming:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.schema(MESSAGE_SCHEMA).format(format).load(path)


def assigned(messages: DataFrame, partitions: Iterable[int]) -> DataFrame:
    """Only the messages of the given partitions."""
    return messages.where(F.col("partition").isin(*partitions))
