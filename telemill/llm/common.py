"""What several operators share: checkpoints, folds, hashing and Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemill.session import scratch_dir

#: Bytes of text that a Python worker handles at a time.
SLICE_BYTES = 2 << 20

#: With this setting, a query's shuffle files are removed when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: The white space that separates words: blank, and tab to carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The same rows from a reliable checkpoint in the shared folder that the session names."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or scratch_dir(spark, "cut"))
    return df.checkpoint()


def passed(df: DataFrame) -> DataFrame:
    """`cut`, and the executors remove the files of its shuffles at once, as nothing needs them any more.

    Otherwise they stay until the driver's collector has met the last trace of the frame, and disks hold the shuffles of
    all steps of a long operator. The session's setting is put back; should another thread of the session write meanwhile,
    files of its queries go at their end or later, which changes no result.
    """
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return cut(df.select("*"))  # a query takes the setting as it is when its frame is made
    finally:
        conf.set(CLEANUP, before)


@contextmanager
def setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """What is run inside has another setting of the session, which is put back."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows from a Parquet folder in the shared scratch folder; Spark then knows how large they are."""
    path = scratch_dir(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fold(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """crc32 of the id as text, modulo `folds`; 0 for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % folds, F.lit(0))


def spread(df: DataFrame, *keys: Column | str) -> DataFrame:
    """Deal rows out by `keys` over as many partitions as the session's shuffles have."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


# ---------------------------------------------------------------- Arrow


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that `column`, text or binary, has about `most` bytes in each piece; a longer value has its own."""
    ends = np.cumsum(lengths(batch.column(column)))
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def lengths(column: pa.Array) -> np.ndarray:
    """Bytes of each value; 0 for null."""
    sizes = pc.binary_length(column)
    return np.asarray(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False), np.int64)


def joined(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column of texts one after the other, and the n + 1 places where values start and end."""
    values = column.to_pylist() if column.type not in (pa.string(), pa.binary()) else None
    if values is not None:
        column = pa.array(values, pa.string())
    filled = pc.fill_null(column, "" if column.type == pa.string() else b"")
    if isinstance(filled, pa.ChunkedArray):
        filled = filled.combine_chunks()
    _, offsets, data = filled.buffers()
    places = np.frombuffer(offsets, np.int32)[filled.offset : filled.offset + len(filled) + 1].astype(np.int64)
    if data is None or not len(filled):
        return np.zeros(0, np.uint8), np.zeros(len(filled) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[places[0] : places[-1]], places - places[0]


def map_slices(
    df: DataFrame, column: str, schema: str, function: Callable[[pa.RecordBatch], dict[str, pa.Array | list | np.ndarray]]
) -> DataFrame:
    """Apply `function` to pieces of the Arrow batches of `df`; it returns the columns of `schema`."""
    empty = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(empty)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, column):
                made = function(piece)
                yield pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of Arrow batches, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}


def map_rows(df: DataFrame, schema: str, function: Callable[[Iterator[dict]], Iterator[dict]]) -> DataFrame:
    """Turn the rows of each partition, as a stream of few large rows, into others; arrays of numbers become binary."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for made in function(rows_of(batches)):
            row = {k: v.tobytes() if isinstance(v, np.ndarray) else v for k, v in made.items()}
            yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


# ---------------------------------------------------------------- hashing


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


#: A 64-bit word for every byte value, and for `A-Z` that of the small letter.
BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
LOWER = BYTES[[b + 32 if 65 <= b <= 90 else b for b in range(256)]]
BLANK = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
BASE = np.uint64(0xD6E8FEB86659FD93)


def powers(n: int) -> np.ndarray:
    """BASE to the power of 0, 1, ..., n - 1, modulo 2**64."""
    out = np.full(max(n, 1), BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word, `A-Z` lower-cased, and how many words each text has."""
    blank = BLANK[data]
    first = ~blank
    first[1:] &= blank[:-1]
    inner = places[:-1][places[:-1] < len(data)]
    first[inner] = ~blank[inner]
    starts = np.flatnonzero(first)
    counts = np.diff(np.searchsorted(starts, places))
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    kept = np.flatnonzero(~blank)
    begin = np.searchsorted(kept, starts)
    sizes = np.diff(np.append(begin, len(kept)))
    within = np.arange(len(kept)) - np.repeat(begin, sizes)
    values = LOWER[data[kept]] * powers(int(sizes.max()))[within]
    return mix(np.add.reduceat(values, begin) + sizes.astype(np.uint64)), counts
