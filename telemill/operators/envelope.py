"""Messages to lines and back."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from telemill.functions import avro
from telemill.operators.rank import running_rank
from telemill.session import reliable

BAD_ENVELOPE = "BAD_ENVELOPE"
NULL_ENVELOPE = "NULL_ENVELOPE"

LINEAGE = ("topic", "partition", "offset", "timestamp")

# Buckets with more lines than this are listed and broadcast: a row for so many lines at most.
BUSY = 20_000


def decode_segments(df: DataFrame, on_error: str = "mark", codec: str = "arrow") -> DataFrame:
    """Decode `value` of a Kafka-shaped frame into `lines array<string>`.

    Keeps the record's topic, partition, offset and timestamp where present and
    adds `envelope`: NULL for a good message, else why it has no lines.

    on_error  `mark` keeps undecodable messages, with their bytes as hex in
              `raw`; `drop` turns them into messages without lines; `fail` raises.
    codec     `arrow` decodes Arrow batches in Python; `spark-avro` uses Spark's
              Avro connector, which must be on the class path.
    """
    if on_error not in ("mark", "drop", "fail"):
        raise ValueError(f"on_error must be mark, drop or fail, not {on_error!r}")
    if codec not in ("arrow", "spark-avro"):
        raise ValueError(f"codec must be arrow or spark-avro, not {codec!r}")
    lineage = [c for c in LINEAGE if c in df.columns]
    value = F.col("value")
    decode = avro.decode if codec == "arrow" else avro.decode_with_connector
    decoded = df.select(*lineage, "value", decode(value).alias("lines"))
    if codec == "spark-avro":  # the connector takes any bytes for text
        decoded = decoded.withColumn("lines", F.when(F.forall("lines", F.is_valid_utf8), F.col("lines")))

    missing = F.col("lines").isNull()
    is_null_branch = F.substring(value, 1, 1) == F.unhex(F.lit(avro.NULL_SEGMENT))
    reason = F.when(missing, F.when(is_null_branch, NULL_ENVELOPE).otherwise(BAD_ENVELOPE))
    lines = F.col("lines")
    if on_error == "drop":
        lines = F.coalesce(lines, F.array().cast("array<string>"))
        reason = F.lit(None).cast("string")
    elif on_error == "fail":
        lines = F.coalesce(lines, F.raise_error(reason).cast("array<string>"))
    raw = F.when(reason == BAD_ENVELOPE, F.hex(value))
    return decoded.select(*lineage, lines.alias("lines"), reason.alias("envelope"), raw.alias("raw"))


def encode_segments(df: DataFrame, lines_col: str = "lines", value_col: str = "value") -> DataFrame:
    """Replace an array of lines by its message bytes."""
    kept = [c for c in df.columns if c not in (lines_col, value_col)]
    return df.select(*kept, avro.encode(F.col(lines_col)).alias(value_col))


def pack_segments(
    df: DataFrame,
    size: int,
    pos: str | None = None,
    by: Sequence[str] = (),
    line_col: str = "line",
    stamp: str | None = None,
) -> DataFrame:
    """Gather lines into messages of at most `size` lines: columns `*by`, `bucket`, `value`.

    Without `pos`, lines are cut where they lie: no shuffle, so neither skew nor
    volume matters, and `bucket` is absent.

    With `pos`, a line's place within its source `by`, the lines of places
    `bucket * size` to `bucket * size + size - 1` share a message whatever the
    partitioning. A busy source is spread over its buckets. Should places repeat,
    a bucket becomes several messages. With `stamp`, a message carries the
    earliest time of its lines as `timestamp`.

    NULL lines have no encoding and are left out (`null_lines` counts them); a
    bucket of nothing else gives no message. Places are whole numbers, NULL is a
    place of its own. Buckets are counted first. Those with more than `size`
    lines, whose places repeat, are numbered throughout in order of their places,
    spread over ranges, and cut at every `size`: no task holds a whole bucket of
    more than BUSY lines.
    """
    if size < 1:
        raise ValueError("size must be positive")
    df = df.where(F.col(line_col).isNotNull())
    if pos is None:
        if by or stamp:
            raise ValueError("`by` and `stamp` need `pos`")
        return _pack_in_place(df, size, line_col)
    place = F.col(pos).cast("bigint")
    bucket = F.call_function("div", place - F.pmod(place, F.lit(size)), F.lit(size))
    item = F.struct(F.col(pos).alias("at"), avro.frame(F.col(line_col)).alias("frame"))
    times = [F.col(stamp).alias("stamp")] if stamp else []
    framed = df.select(*by, bucket.alias("bucket"), item.alias("item"), *times)
    keys = [*by, "bucket"]
    overfull = framed.groupBy(*keys).agg(F.count(F.lit(1)).alias("lines")).where(F.col("lines") > size)
    overfull = reliable(overfull)
    is_busy = F.col("lines") > BUSY
    busy, others = overfull.agg(F.count_if(is_busy), F.count_if(~is_busy)).first()
    parts = []
    if busy:
        # shuffled by its key, such a bucket would come to one task
        listed = F.broadcast(overfull.where(is_busy).select(*keys))
        repeated = _by_bucket(framed, listed, keys, "left_semi")
        framed = _by_bucket(framed, listed, keys, "left_anti")
        parts.append(_gather(_cut_overfull(repeated, keys, size, F.broadcast), [*keys, "piece"], stamp))
    if others:
        listed = overfull.where(~is_busy).select(*keys)
        repeated = _by_bucket(framed, listed, keys, "left_semi")
        framed = _by_bucket(framed, listed, keys, "left_anti")
        parts.append(_gather(_cut_overfull(repeated, keys, size), [*keys, "piece"], stamp))
    packed = _gather(framed, keys, stamp)
    for part in parts:
        packed = packed.unionByName(part.drop("piece"))
    value = avro.seal(F.col("items.frame"), F.size("items")).alias("value")
    return packed.select(*by, "bucket", value, *(["timestamp"] if stamp else []))


def _gather(framed: DataFrame, keys: Sequence[str], stamp: str | None) -> DataFrame:
    """The lines of each group as `items`, in order; groups hold one message each."""
    earliest = [F.min("stamp").alias("timestamp")] if stamp else []
    return framed.groupBy(*keys).agg(F.array_sort(F.collect_list("item")).alias("items"), *earliest)


def _by_bucket(lines: DataFrame, buckets: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    same = [F.col(f"l.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys]
    return lines.alias("l").join(buckets.alias("b"), same, how)


def _cut_overfull(
    framed: DataFrame, keys: Sequence[str], size: int, sent: Callable[[DataFrame], DataFrame] = lambda buckets: buckets
) -> DataFrame:
    """Add `piece`: the lines of each bucket numbered by place and cut at every `size`; `sent` may broadcast the buckets."""
    tied = framed.withColumn("_tie", F.monotonically_increasing_id())  # lines may be equal, too
    ranked = running_rank(tied, [*keys, "item.at", F.xxhash64("item"), "_tie"], "_rank").drop("_tie")
    first = ranked.groupBy(*keys).agg(F.min("_rank").alias("_first"))
    joined = _by_bucket(ranked, sent(first), keys, "inner")
    piece = F.call_function("div", F.col("_rank") - F.col("_first"), F.lit(size)).alias("piece")
    return joined.select(*[F.col(f"l.`{c}`") for c in framed.columns], piece)


def null_lines(df: DataFrame, line_col: str = "line") -> DataFrame:
    """One row, `lines`: how many lines `pack_segments` leaves out."""
    return df.agg(F.count_if(F.col(line_col).isNull()).alias("lines"))


def _pack_in_place(df: DataFrame, size: int, line_col: str) -> DataFrame:
    schema = StructType([StructField("lines", ArrayType(StringType()))])

    def cut(batches):
        for batch in batches:
            count = batch.num_rows
            starts = pa.array([*range(0, count, size), count], pa.int32())
            lists = pa.ListArray.from_arrays(starts, batch.column(0))
            yield pa.RecordBatch.from_arrays([lists], names=["lines"])

    return encode_segments(df.select(line_col).mapInArrow(cut, schema))
