"""Alignment of two tokenizers, with corpus-wide counts in minimal perfect hash tables.

Both tokenizers cut the same bytes. Places where both end a token cut a text into groups, and tokens whose bytes overlap are
linked. How many documents hold a pair of ids linked is counted over the whole corpus:

1. Texts are encoded in slices of about a megabyte, whose ids are stored. Each slice tells the shards (dealt by a hash of the
   first id) its distinct pairs and in how many of its documents they are.
2. A shard gathers its distinct pairs and builds a minimal perfect hash of them: levels of bit maps; a pair that falls on a
   bit alone stays, the others go on to the next level. A pair's slot is the rank of its bit.
3. The counts are added in dense vectors indexed by slot, one vector for each `FAN_IN` messages to a shard, then these
   vectors. Slots keep their pairs, so a pair is verified before it is counted or looked up.
4. The shards answer every slice about its pairs: the count, and whether it is the highest of the first id, all of whose
   pairs are in one shard. Slices are aligned again from the stored ids, and look the answers up.

A shard holds at most its share of the pairs that the vocabularies allow, whatever the corpus: with 50,257 and 32,000 ids
and 256 shards about 200 first ids, 6.3 million pairs. No table is broadcast or collected.

Texts that are null or empty, or that one of the tokenizers does not give back byte by byte, have no tokens. Rows that
repeat are documents of their own, and ids may be null. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm import tokens
from telemill.llm.common import lengths, map_rows, mix, setting, stored

#: Bytes of text in a slice, shards of pairs, and messages to a shard that one task adds up.
SLICE, SHARDS, FAN_IN = 1 << 20, 256, 1024

#: Bytes of an Arrow batch; slices and their answers are large rows, of which the session's bound takes dozens at a time.
BATCH_BYTES = 4 << 20


# ---------------------------------------------------------------- tokenizers


@lru_cache(maxsize=1)
def _byte_of_letter() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others, in order, from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevel:
    """Ids and token bytes of a byte-level vocabulary; encodes a blank and the text."""

    def __init__(self, vocabulary: str):
        self.vocabulary = vocabulary
        own, letters = tokens.tokenizer(vocabulary), _byte_of_letter()
        names = [own.id_to_token(i) for i in range(own.get_vocab_size())]
        self.bytes = [bytes(letters[c] for c in x) if all(c in letters for c in x) else x.encode() for x in names]
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)

    def ids(self, text: str) -> list[int]:
        return tokens.plain_ids_of(" " + text, self.vocabulary)


class Pieces:
    """Ids and token bytes of a sentence-piece model, which puts a blank in front of the text by itself."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:-1], 16)]) if self.model.is_byte(i) else piece.replace("▁", " ").encode())
        self.sizes = np.array([len(x) for x in self.bytes], np.int64)

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text)


@lru_cache(maxsize=2)
def tokenizers_of(a: str, b: str) -> tuple[ByteLevel, Pieces]:
    """`a`, `b`: files of public_tokenizers, or paths."""
    return ByteLevel(a), Pieces(tokens.place(b))


def tokens_of(text: str | None, a: ByteLevel, b: Pieces) -> tuple[np.ndarray, np.ndarray]:
    kinds = _kind(len(a.bytes)), _kind(len(b.bytes))
    if text:
        want, first, second = b" " + text.encode(), a.ids(text), b.ids(text)
        if b"".join(map(a.bytes.__getitem__, first)) == want and b"".join(map(b.bytes.__getitem__, second)) == want:
            return np.array(first, kinds[0]), np.array(second, kinds[1])
    return np.zeros(0, kinds[0]), np.zeros(0, kinds[1])


# ---------------------------------------------------------------- alignment


class Aligned:
    """Groups and links of the documents of a slice, laid out one after the other."""

    def __init__(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray):
        self.a, self.b, self.n_a, self.n_b = a, b, n_a, n_b
        ends_a, ends_b = np.cumsum(sizes_a[a]), np.cumsum(sizes_b[b])
        marks = np.zeros(int(ends_a[-1]) + 1 if len(a) else 1, np.uint8)  # a byte for every byte of text
        marks[ends_a] = 1
        marks[ends_b] |= 2
        marks = marks[marks > 0]
        in_a, in_b, both = (marks & 1).astype(bool), marks > 1, marks == 3
        # between two neighbouring ends lies one overlap, of one token of each side
        before_a, before_b, group = (np.cumsum(x) - x for x in (in_a, in_b, both))
        self.group_a, self.group_b, self.last_a, self.last_b = group[in_a], group[in_b], both[in_a], both[in_b]
        self.doc_a = np.repeat(np.arange(len(n_a)), n_a)
        self.doc = self.doc_a[before_a]
        codes, self.pairs = pd.factorize((a[before_a].astype(np.int64) << 32) | b[before_b])
        order = np.argsort(self.pairs)  # distinct pairs in order, and the number of its pair for every link
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        self.pairs, self.number = self.pairs[order].astype(np.uint64), number[codes]

    def per_document(self, values: np.ndarray | None = None) -> np.ndarray:
        """Links of every document, or the sum over its links of what each distinct pair has."""
        edges = np.searchsorted(self.doc, np.arange(len(self.n_a) + 1))
        if values is None:
            return np.diff(edges)
        total = np.concatenate([[0], np.cumsum(values[self.number])])
        return total[edges[1:]] - total[edges[:-1]]

    def groups(self) -> np.ndarray:
        return np.bincount(self.doc_a[self.last_a], minlength=len(self.n_a))

    def documents(self) -> np.ndarray:
        """In how many documents each distinct pair is."""
        size = max(1, len(self.n_a))
        return np.bincount(np.unique(self.number * size + self.doc) // size, minlength=len(self.pairs))

    def digests(self) -> list[str]:
        """SHA-256 of every document's groups, `a1,a2|b1;a3|b2,b3`; '' without tokens."""
        text, sizes = _decimals(int(max(self.a.max(initial=0), self.b.max(initial=0))) + 1)
        groups = int(self.last_a.sum())
        # a token stands behind its own side's tokens before it and the other's in earlier groups; of `a`, also in its own
        behind_a = np.concatenate([[0], np.cumsum(np.bincount(self.group_b, minlength=groups))])
        behind_b = np.cumsum(np.bincount(self.group_a, minlength=groups))
        parts = np.empty(len(self.a) + len(self.b), text[","].dtype)
        parts[np.arange(len(self.a)) + behind_a[self.group_a]] = np.where(self.last_a, text["|"][self.a], text[","][self.a])
        parts[np.arange(len(self.b)) + behind_b[self.group_b]] = np.where(self.last_b, text[";"][self.b], text[","][self.b])
        letters = parts.view(np.uint8)
        letters = letters[letters > 0].tobytes()
        length = [np.concatenate([[0], np.cumsum(sizes[ids])]) for ids in (self.a, self.b)]
        ends = [np.cumsum(n) for n in (self.n_a, self.n_b)]
        ends = length[0][ends[0]] + length[1][ends[1]]
        starts = np.concatenate([[0], ends[:-1]])
        return [hashlib.sha256(letters[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(starts.tolist(), ends.tolist())]


@lru_cache(maxsize=4)
def _decimals(size: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The numbers up to `size` with a mark behind, padded with zero bytes, and how long these texts are."""
    width = len(str(size)) + 1
    made = {mark: np.array([f"{i}{mark}".encode() for i in range(size)], f"S{width}") for mark in "|,;"}
    return made, np.array([len(str(i)) + 1 for i in range(size)], np.int64)


# ---------------------------------------------------------------- minimal perfect hashing


class PerfectHash:
    """Gives each of n distinct 64-bit keys a slot from 0 to n - 1 of its own, in about 4 bits a key.

    Other keys get any slot or none: whoever looks up compares the slot's key.
    """

    def __init__(self, levels: list[np.ndarray]):
        """`levels`: the bit maps, packed; each with the number of its bits in front, as a 64-bit word."""
        self.levels, self.maps, self.ranks, before = levels, [], [], 0
        for level in levels:
            size = int(level[:8].view(np.uint64)[0])
            bits = np.unpackbits(level[8:], count=size).view(bool)
            self.maps.append(bits)
            self.ranks.append(np.cumsum(bits) - 1 + before)
            before += int(bits.sum())
        self.size = before

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        levels = []
        while len(keys):
            size = 2 * len(keys)
            place = cls._place(keys, len(levels), size)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(np.concatenate([np.array([size], np.uint64).view(np.uint8), np.packbits(alone)]))
            keys = keys[~alone[place]]
        return cls(levels)

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        seed = np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64))
        return (mix(keys ^ seed) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some that are not in the table."""
        out, left = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for number, (bits, ranks) in enumerate(zip(self.maps, self.ranks)):
            place = self._place(keys[left], number, len(bits))
            here = bits[place]
            out[left[here]] = ranks[place[here]]
            left = left[~here]
        return out

    def packed(self) -> list[bytes]:
        return [x.tobytes() for x in self.levels]

    @classmethod
    def unpacked(cls, levels: list[bytes]) -> PerfectHash:
        return cls([np.frombuffer(x, np.uint8).copy() for x in levels])


class Table:
    """The pairs of a shard by slot."""

    def __init__(self, row: dict):
        self.shard, self.hash = row["shard"], PerfectHash.unpacked(row["levels"])
        self.pairs = np.frombuffer(row["pairs"], np.uint64)

    def slots(self, pairs: np.ndarray) -> np.ndarray:
        slots = self.hash.slots(pairs)
        if (slots < 0).any() or not np.array_equal(self.pairs[slots], pairs):
            raise ValueError("a pair is not in its shard's table")
        return slots


# ---------------------------------------------------------------- the jobs in tasks


def _encode(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = tokenizers_of(a, b)
        number = TaskContext.get().partitionId() << 32
        keys, ids, held = [], [], 0

        def made() -> pa.RecordBatch:
            flat = [np.concatenate([pair[side] for pair in ids]) for side in (0, 1)]
            counts = [[len(pair[side]) for pair in ids] for side in (0, 1)]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([keys], pa.list_(pa.int64())),
                    *[pa.array([x.tobytes()], pa.binary()) for x in flat],
                    *[pa.array([np.array(x, np.int64).tobytes()], pa.binary()) for x in counts],
                ],
                names=["slice", "keys", "a", "b", "n_a", "n_b"],
            )

        for batch in batches:
            sizes = lengths(batch.column(1))
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_py()
                keys.append(batch.column(0)[i].as_py())
                ids.append(tokens_of(text, first, second))
                held += int(sizes[i])
                if held >= SLICE:
                    yield made()
                    number, keys, ids, held = number + 1, [], [], 0
        if keys:
            yield made()

    return run


def _aligned(row: dict, a: str, b: str) -> Aligned:
    first, second = tokenizers_of(a, b)
    ids = [np.frombuffer(row[c], _kind(len(t.bytes))).astype(np.int64) for c, t in (("a", first), ("b", second))]
    counts = [np.frombuffer(row[c], np.int64) for c in ("n_a", "n_b")]
    return Aligned(*ids, *counts, first.sizes, second.sizes)


def _kind(size: int) -> type:
    """The numbers that hold the ids of a vocabulary."""
    return np.uint16 if size <= 1 << 16 else np.uint32


def _by_owner(pairs: np.ndarray) -> list[np.ndarray]:
    """Which of the distinct pairs each shard owns, shard by shard; empty ones are left out."""
    shard = (mix(pairs >> np.uint64(32)) % np.uint64(SHARDS)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return [(int(shard[x[0]]), x) for x in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(x)]


def _told(a: str, b: str, salts: int):
    def one(row: dict) -> Iterator[dict]:
        aligned = _aligned(row, a, b)
        pairs, counts = aligned.pairs, aligned.documents()
        del aligned
        for shard, part in _by_owner(pairs):
            yield {
                "shard": shard, "salt": row["slice"] % salts, "slice": row["slice"],
                "pairs": pairs[part], "counts": counts[part].astype(np.int64),
            }

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:  # a slice's arrays go before the next one's are made
            yield from one(row)

    return run


def _by_shard(rows: Iterator[dict], *keys: str) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Runs of rows with the same keys; a run is read before the next begins."""
    from itertools import groupby

    return groupby(rows, lambda row: tuple(row[k] for k in keys))


def _distinct(rows: Iterator[dict]) -> Iterator[dict]:
    for (shard, _), run in _by_shard(rows, "shard", "salt"):
        yield {"shard": shard, "pairs": _union(run)}


def _union(run: Iterator[dict]) -> np.ndarray:
    known = np.zeros(0, np.uint64)
    held, size = [], 0
    for row in run:
        held.append(np.frombuffer(row["pairs"], np.uint64))
        size += len(held[-1])
        if size > max(1 << 20, len(known)):  # the work stays in proportion to what comes in
            known, held, size = np.unique(np.concatenate([known, *held])), [], 0
    return np.unique(np.concatenate([known, *held]))


def _hashed(rows: Iterator[dict]) -> Iterator[dict]:
    for (shard,), run in _by_shard(rows, "shard"):
        pairs = _union(run)
        table = PerfectHash.of(pairs)
        by_slot = np.empty(len(pairs), np.uint64)
        by_slot[table.slots(pairs)] = pairs
        yield {"shard": shard, "levels": table.packed(), "pairs": by_slot}


def _vectors(rows: Iterator[dict]) -> Iterator[dict]:
    """A dense vector of counts for every shard and salt; the shard's table comes before its messages."""
    for (shard, _), run in _by_shard(rows, "shard", "salt"):
        table = Table(next(run))
        vector = np.zeros(len(table.pairs), np.int64)
        for row in run:  # a message has each pair once
            vector[table.slots(np.frombuffer(row["pairs"], np.uint64))] += np.frombuffer(row["counts"], np.int64)
        yield {"shard": shard, "vector": vector}


def _summed(rows: Iterator[dict]) -> Iterator[dict]:
    for (shard,), run in _by_shard(rows, "shard"):
        total = None
        for row in run:
            vector = np.frombuffer(row["vector"], np.int64)
            total = vector if total is None else total + vector
        yield {"shard": shard, "vector": total}


def _answer(rows: Iterator[dict]) -> Iterator[dict]:
    for _, run in _by_shard(rows, "shard", "salt"):
        first = next(run)
        table, vector = Table(first), np.frombuffer(first["vector"], np.int64)
        ids, most = np.unique(table.pairs >> np.uint64(32), return_inverse=True)
        highest = np.zeros(len(ids), np.int64)
        np.maximum.at(highest, most, vector)
        best = vector == highest[most]
        for row in run:
            pairs = np.frombuffer(row["pairs"], np.uint64)
            slots = table.slots(pairs)
            yield {"slice": row["slice"], "shard": row["shard"], "counts": vector[slots], "best": best[slots]}


def _looked_up(a: str, b: str):
    def one(row: dict) -> dict:
        aligned = _aligned(row, a, b)
        told = {x["shard"]: x for x in row["told"] or []}
        counts, best = np.zeros(len(aligned.pairs), np.int64), np.zeros(len(aligned.pairs), np.int64)
        for shard, part in _by_owner(aligned.pairs):  # answers are in the order of what was asked
            counts[part] = np.frombuffer(told[shard]["counts"], np.int64)
            best[part] = np.frombuffer(told[shard]["best"], bool)
        return {
            "keys": row["keys"],
            "n_a": aligned.n_a.tolist(),
            "n_b": aligned.n_b.tolist(),
            "n_groups": aligned.groups().tolist(),
            "n_links": aligned.per_document().tolist(),
            "n_best": aligned.per_document(best).tolist(),
            "count_sum": aligned.per_document(counts).tolist(),
            "groups_sha256": aligned.digests(),
        }

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            yield one(row)

    return run


# ---------------------------------------------------------------- the operator


def _dealt(df: DataFrame, keys: list[str], *then: str) -> DataFrame:
    """Rows of equal keys in one partition, one key after the other, tables before messages."""
    order = [F.col(c).asc_nulls_first() for c in then]
    return df.repartition(*keys).sortWithinPartitions(*keys, *order)


def align(docs: DataFrame, a: str = "byte_bpe_50k.json", b: str = "piece_bpe_32k.model") -> DataFrame:
    """For every document how its tokens by `a` (byte-level, of a blank and the text) and `b` (pieces) lie to each other.

    `doc_id`, `n_a`, `n_b`, `n_groups`, `n_links`, `n_best` (links whose count is the highest of their first id),
    `count_sum` (over links) and `groups_sha256`. A pair's count is the number of documents in which it is linked.

    All of it runs here, with Arrow batches of `BATCH_BYTES`; what is returned reads the stored rows.
    """
    with setting(docs.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)):
        done = _aligned_slices(docs, a, b)
    rows = done.select(F.explode(F.arrays_zip(*done.columns)).alias("x"))
    return rows.select(F.col("x.keys").alias("doc_id"), *[F.col(f"x.{c}") for c in done.columns[1:]])


def _aligned_slices(docs: DataFrame, a: str, b: str) -> DataFrame:
    """A row for every slice, with the columns of `align` as arrays."""
    encoded = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        _encode(a, b), "slice bigint, keys array<bigint>, a binary, b binary, n_a binary, n_b binary"
    )
    slices = stored(encoded, "alignment")
    salts = max(1, math.ceil(slices.count() / FAN_IN))
    told = map_rows(slices, "shard bigint, salt bigint, slice bigint, pairs binary, counts binary", _told(a, b, salts))
    messages = stored(told, "alignment")

    distinct = map_rows(_dealt(messages.select("shard", "salt", "pairs"), ["shard", "salt"]), "shard bigint, pairs binary", _distinct)
    hashed = map_rows(_dealt(distinct, ["shard"]), "shard bigint, levels array<binary>, pairs binary", _hashed)
    tables = stored(hashed, "alignment")
    salted = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")).alias("salt")

    counted = messages.unionByName(tables.select("*", salted), allowMissingColumns=True)
    vectors = map_rows(_dealt(counted, ["shard", "salt"], "slice"), "shard bigint, vector binary", _vectors)
    sums = map_rows(_dealt(vectors, ["shard"]), "shard bigint, vector binary", _summed)

    full = stored(tables.join(sums, "shard"), "alignment").select("*", salted)
    asked = messages.drop("counts").unionByName(full, allowMissingColumns=True)
    answers = map_rows(_dealt(asked, ["shard", "salt"], "slice"), "slice bigint, shard bigint, counts binary, best binary", _answer)
    answers = answers.groupBy("slice").agg(F.collect_list(F.struct("shard", "counts", "best")).alias("told"))

    columns = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    schema = ", ".join(["keys array<bigint>", *[f"{c} array<bigint>" for c in columns], "groups_sha256 array<string>"])
    return stored(map_rows(slices.join(answers, "slice", "left"), schema, _looked_up(a, b)), "alignment")
