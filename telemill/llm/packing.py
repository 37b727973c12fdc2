"""Best-fit packing of tokenized documents with certified bounds.

Partitions pack their pieces by best-fit decreasing and certify the number of their sequences: a dual feasible function
maps lengths to weights that no full sequence can exceed, so the sum of weights bounds the sequences from below. Where
there is a gap between the two, the sequences that are not full are opened, partitions exchange what was in them and
pack it again.
"""

from __future__ import annotations

import binascii
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm import tokens
from telemill.llm.common import cut, slices, spread

CAPACITY = 2048

#: Pieces that a partition packs at a time, on average, and how often partitions with gaps exchange pieces.
PARTITION, ROUNDS = 20_000, 4

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


def pieces(docs: DataFrame, capacity: int = CAPACITY, ranks: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    """The pieces that documents are packed in: ids of `text` and a closing 0, cut into `capacity` ids where longer.

    The first piece of a longer document is the shorter one. A null text is empty, its only id the closing 0. Rows are
    independent of each other; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                out: dict[str, list] = defaultdict(list)
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    found = np.append(tokens.ids(text or "", ranks), np.uint32(0)).astype("<u4")
                    first = len(found) % capacity or capacity
                    cuts = [0, *range(first, len(found) + 1, capacity)]
                    for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
                        out["doc_id"].append(doc_id)
                        out["piece"].append(n)
                        out["start"].append(a)
                        out["length"].append(b - a)
                        out["ids_crc32"].append(binascii.crc32(found[a:b].tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[c], pa.int32() if c == "piece" else pa.int64()) for c in _NAMES], _NAMES
                )

    return docs.select("doc_id", "text").mapInArrow(run, PIECES)


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each of `lengths`, which descend: the fullest one with room, or a new one."""
    room: list[list[int]] = [[] for _ in range(capacity + 1)]  # bins by what is left in them
    held = 0  # bit i: some bin has i left
    out = np.empty(len(lengths), np.int64)
    bins = 0
    for i, n in enumerate(lengths.tolist()):
        fits = held >> n
        if fits:
            left = n + (fits & -fits).bit_length() - 1
            bin_ = room[left].pop()
            if not room[left]:
                held ^= 1 << left
        else:
            left, bin_ = capacity, bins
            bins += 1
        out[i] = bin_
        room[left - n].append(bin_)
        held |= 1 << (left - n)
    return out


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """The most bins that a family of dual feasible functions proves necessary.

    For each k the function that counts lengths above capacity - k as a full bin, drops those below k and keeps the
    others as they are; and for each whole number m the one that rounds a length to 1/m of a bin where it is not on a
    multiple of 1/(m + 1).
    """
    if not len(lengths):
        return 0
    sizes = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    count = np.concatenate([[0], np.cumsum(sizes)])  # count[i]: lengths below i
    total = np.concatenate([[0], np.cumsum(sizes * np.arange(capacity + 1))])
    k = np.arange(capacity // 2 + 1)
    full = count[-1] - count[capacity - k + 1]
    between = total[capacity - k + 1] - total[k]
    best = int((full - (-between // capacity)).max())
    x = np.flatnonzero(sizes)
    for m in range(1, 65):
        scaled = x * (m + 1)
        on = scaled % capacity == 0
        # in units of 1 / (m * capacity), so that everything stays whole
        weight = np.where(on, x * m, scaled // capacity * capacity)
        best = max(best, -(-int((weight * sizes[x]).sum()) // (m * capacity)))
    return best


def _packer(capacity: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.concat(list(batches), ignore_index=True)
        for part, group in held.groupby("part"):
            group = group.sort_values(
                ["length", "doc_id", "piece", "start", "ids_crc32"], ascending=[False, True, True, True, True]
            )
            lengths = group["length"].to_numpy()
            bins = best_fit_decreasing(lengths, capacity)
            filled = np.bincount(bins, lengths).astype(np.int64)
            ends = pd.Series(lengths, index=group.index).groupby(bins).cumsum()
            bound = lower_bound(lengths, capacity)
            group["bin"] = bins
            group["offset"] = ends.to_numpy() - lengths
            group["filled"] = filled[bins]
            group["bins"] = len(filled)
            group["bound"] = bound
            yield group

    def run_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        batches = [b for b in batches if len(b)]
        if batches:
            yield from run(iter(batches))

    return run_all


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, partition: int = PARTITION, rounds: int = ROUNDS
) -> tuple[DataFrame, DataFrame]:
    """Pack `pieces` (of at most `capacity`) into sequences; rows with their place, and certificates by round and part.

    The rows have `sequence_id`, `offset` and `round` more; the certificates `round`, `part`, `bins` and `bound`. A part
    whose bins equal its bound is final, and so are full bins; the others are dealt out anew in the next round, until
    the last. Parts are dealt by a hash of the piece and of the place of its row, so that rows that repeat a piece are
    spread too; they have about `partition` pieces, whatever these are, and no part grows with the data. Equal pieces may
    be swapped with each other, which changes nothing. Other files of the same rows may be packed otherwise. Pieces of full
    length are sequences of their own from the start. An empty frame gives empty frames.
    """
    spark = pieces.sparkSession
    packed: list[DataFrame] = []
    proofs: list[DataFrame] = []
    full = pieces.where(F.col("length") == capacity)
    name = F.xxhash64("doc_id", "piece", "start", "ids_crc32")
    packed.append(
        full.select(
            *_NAMES, F.lit(-1).alias("round"), F.lit(0).alias("part"),
            F.monotonically_increasing_id().alias("bin"), F.lit(0).cast("bigint").alias("offset"),
        )
    )
    loose = pieces.where(F.col("length") < capacity).withColumn("row", F.monotonically_increasing_id())
    for r in range(rounds):
        n = loose.count()
        if not n and r:
            break
        parts = max(1, math.ceil(n / partition))
        dealt = loose.withColumn("part", F.pmod(F.xxhash64(name, "row", F.lit(r)), F.lit(parts)).cast("int"))
        schema = f"{PIECES}, row bigint, part int, bin bigint, offset bigint, filled bigint, bins bigint, bound bigint"
        done = cut(dealt.select(*_NAMES, "row", "part").repartition(parts, "part").mapInPandas(_packer(capacity), schema))
        proofs.append(done.groupBy(F.lit(r).alias("round"), "part").agg(F.max("bins").alias("bins"), F.max("bound").alias("bound")))
        final = (F.col("filled") == capacity) | (F.col("bins") == F.col("bound"))
        final = final | F.lit(r == rounds - 1 or parts == 1)
        packed.append(done.where(final).select(*_NAMES, F.lit(r).alias("round"), "part", "bin", "offset"))
        loose = done.where(~final).select(*_NAMES, "row")
    rows, proof = packed[0], proofs[0]
    for more in packed[1:]:
        rows = rows.union(more)
    for more in proofs[1:]:
        proof = proof.union(more)
    # round, part and bin as one number; full pieces have negative ones
    sequence = F.when(F.col("round") < 0, -1 - F.col("bin")).otherwise(
        F.shiftleft(F.col("part").cast("bigint") * rounds + F.col("round"), 24) + F.col("bin")
    )
    return rows.select(*_NAMES, sequence.alias("sequence_id"), "offset", "round"), proof


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, **settings) -> DataFrame:
    """Tokenize `docs` (`doc_id`, `text`) and pack them: a row per piece, with its `sequence_id` and `offset`."""
    return pack(cut(pieces(docs, capacity)), capacity, **settings)[0]
