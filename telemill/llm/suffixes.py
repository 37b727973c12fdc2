"""Removal of repeated passages: bytes covered by a string of a given length that also starts elsewhere.

Sampled grams (the smallest hash among those of a string) decide which strings can be equal: equal strings have the same
gram at the same distance. Each gram stands for a run of string starts, and their bytes are its context. Runs whose
contexts are equal are repeated as a whole, which needs no more than counting; grams that occur once have no repeated
string. What is left, the edges of repeated passages, goes to a suffix sort: starts with the same gram at the same
distance are merge-sorted by their suffixes, two suffixes are compared by a binary search for their common extension on
prefix polynomial hashes, and neighbours that agree on the whole length are verified byte by byte.

A gram with too many contexts for one sort is divided by content first: starts whose distances are close to each other
go together, and of those the ones that agree on the bytes that all strings of such starts hold. So equal strings meet
in one sort, and a context has few parts, however many others its gram has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm.common import BASE, BYTES, cut, mix, powers, slices, spread

#: Starts of strings that are hashed at a time, so that a long text needs no more memory.
STRETCH = 1 << 19

#: Texts that a task remembers, so that it works on copies once.
SEEN = 200_000

#: Words of 64 bits in the bitmap of texts that are needed again: a megabyte.
SIEVE_WORDS = 1 << 17

#: Contexts that are sorted together, at most, and starts that are sorted at a time, at least.
BLOCK, SORTED = 4096, 100_000

#: Pieces into which the rows of a copied text are dealt.
SALTS = 64

_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


def inverse_powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _INVERSE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Hashes:
    """Polynomial hashes of all stretches of some bytes, from those of its prefixes."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTES[data] * powers(len(data))[: len(data)], out=self.sums[1:])
        self.back = inverse_powers(len(data) + 1)

    def __call__(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + length] - self.sums[start]) * self.back[start]


def text_key(data: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(data, digest_size=8).digest(), "little", signed=True)


def grams(data: np.ndarray, length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of string starts with the same sampled gram: gram, context hash, first start, starts, gram's distance.

    A string's gram is that of half its length with the smallest hash, the first of several.
    """
    half = length // 2
    window = length - half + 1
    for begin in range(0, len(data) - length + 1, STRETCH):
        part = data[begin : begin + STRETCH + length - 1]
        hashes = Hashes(part)
        gram = mix(hashes(np.arange(len(part) - half + 1), half))
        count = len(part) - length + 1
        # the place in the low bits makes the smallest key the first place
        keys = (gram & ~np.uint64((1 << 24) - 1)) | np.arange(len(gram), dtype=np.uint64)
        blocks = np.concatenate([keys, np.full(-len(keys) % window, ~np.uint64(0))]).reshape(-1, window)
        before = np.minimum.accumulate(blocks, axis=1).ravel()
        after = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        place = (np.minimum(after[:count], before[window - 1 : window - 1 + count]) & np.uint64((1 << 24) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
        starts = np.diff(np.append(first, count))
        distance = place[first] - first
        context = mix(hashes(first, starts + length - 1) + mix((distance * 65536 + starts).astype(np.uint64)))
        yield gram[place[first]], context, first + begin, starts, distance


def find_grams(docs: DataFrame, length: int) -> DataFrame:
    """The runs of all texts, with a `count` for contexts that repeat in the task's piece of the input.

    Of those one row goes on, and all their starts are reported as repeated at once: rows with count 0, merged to long
    stretches. So a text that repeats itself has few rows, and no gram is common for that.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in slices(batch, "text"):
                columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in range(6)]
                for text in piece.column("text").to_pylist():
                    data = (text or "").encode()
                    key = text_key(data)
                    if len(data) < length or key in seen:
                        continue
                    seen.add(key)
                    for gram, context, start, starts, distance in grams(np.frombuffer(data, np.uint8), length):
                        new = (gram.view(np.int64), context.view(np.int64), np.full(len(gram), key), start, starts, distance)
                        for column, values in zip(columns, new):
                            column.append(values)
                if len(seen) > SEEN:
                    seen.clear()
                made = [pa.array(c, f.type) for c, f in zip(_combined(*map(np.concatenate, columns)), _GRAMS)]
                yield pa.RecordBatch.from_arrays(made, schema=_GRAMS)

    return docs.select("text").mapInArrow(
        run, "gram bigint, context bigint, key bigint, start bigint, starts bigint, distance int, count bigint"
    )


def _combined(gram, context, key, start, starts, distance) -> list[np.ndarray]:
    pair = mix(gram.view(np.uint64)) ^ context.view(np.uint64)
    _, first, which, count = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
    rows = [x[first] for x in (gram, context, key, start, starts, distance)] + [count]
    several = np.flatnonzero(count[which] > 1)
    order = several[np.lexsort((start[several], key[several]))]
    at, begin, end = key[order], start[order], start[order] + starts[order]
    new = np.ones(len(order), bool)
    new[1:] = (at[1:] != at[:-1]) | (begin[1:] != end[:-1])
    head = np.flatnonzero(new)
    size = end[np.append(head[1:], len(order)) - 1] - begin[head] if len(head) else begin[head]
    spread_out = mix(at[head].view(np.uint64) ^ mix(begin[head].view(np.uint64))).view(np.int64)
    none = np.zeros(len(head), np.int64)
    more = [spread_out, none, at[head], begin[head], size, none, none]
    return [np.concatenate(c) for c in zip(rows, more)]


_GRAMS = pa.schema(
    [
        ("gram", pa.int64()),
        ("context", pa.int64()),
        ("key", pa.int64()),
        ("start", pa.int64()),
        ("starts", pa.int64()),
        ("distance", pa.int32()),
        ("count", pa.int64()),
    ]
)


# ---------------------------------------------------------------- texts that are needed again


def sieve(keys: DataFrame) -> np.ndarray:
    """A bitmap of hashed `key`s: SIEVE_WORDS words at most reach the driver, however many keys there are."""
    word = F.expr(f"cast(pmod(key, {64 * SIEVE_WORDS}) div 64 as int)")
    bit = F.expr("shiftleft(1L, cast(pmod(key, 64) as int))")
    out = np.zeros(SIEVE_WORDS, np.uint64)
    for row in keys.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits")).collect():
        out[row["word"]] = np.int64(row["bits"]).view(np.uint64)
    return out


def texts_of(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """`key` and `data` of the texts whose key may be one of `keys`; copies of a text once per task."""
    bits = sieve(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for piece in slices(batch, "text"):
                found = {}
                for text in piece.column("text").to_pylist():
                    data = (text or "").encode()
                    key = text_key(data)
                    place = key % (64 * SIEVE_WORDS)
                    if int(bits[place // 64]) >> (place % 64) & 1 and key not in seen:
                        seen.add(key)
                        found[key] = data
                if len(seen) > SEEN:
                    seen.clear()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.binary())], ["key", "data"]
                )

    return docs.select("text").mapInArrow(run, "key bigint, data binary")


# ---------------------------------------------------------------- suffix sort


class Suffixes:
    """Sorts suffixes of `data` by their first `length` bytes, within segments."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.hashes = data, length, Hashes(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many bytes the suffixes at `a` and `b` share, `length` at most, by binary search on hashes."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length)
        while (open_ := low < high).any():
            middle = (low + high + 1) // 2
            same = self.hashes(a, middle) == self.hashes(b, middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)
        return low

    def less(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common(a, b)
        end = n == self.length
        at = np.where(end, 0, n)
        return np.where(end, or_equal, self.data[a + at] < self.data[b + at])

    def sort(self, suffixes: np.ndarray, segments: np.ndarray) -> np.ndarray:
        """The order of `suffixes` in their segments (ascending numbers), by merging runs of doubling size.

        An element's place in a merged run is its place in its own run plus its rank in the other.
        """
        n = len(suffixes)
        order = np.arange(n)
        first = np.searchsorted(segments, segments)
        last = np.searchsorted(segments, segments, "right")
        local = order - first
        width, largest = 1, int((last - first).max(initial=0))
        while width < largest:
            run = local // width
            low = first + (run ^ 1) * width
            some = np.flatnonzero(low < last)
            low, high = low[some], np.minimum(low[some] + width, last[some])
            begin = low.copy()
            mine = suffixes[order[some]]
            left = (run[some] & 1) == 0
            while (open_ := np.flatnonzero(low < high)).size:
                middle = (low[open_] + high[open_]) // 2
                # of equal ones those of the left run come first
                below = self.less(suffixes[order[middle]], mine[open_], ~left[open_])
                low[open_] = np.where(below, middle + 1, low[open_])
                high[open_] = np.where(below, high[open_], middle)
            pair = first[some] + (run[some] & ~1) * width
            to = pair + local[some] - run[some] * width + low - begin
            moved = order.copy()
            moved[to] = order[some]
            order = moved
            width *= 2
        return order

    def equal(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether suffixes agree on `length` bytes: by their hashes, and then verified byte by byte."""
        same = self.common(a, b) == self.length
        at = np.flatnonzero(same)
        for some in np.array_split(at, max(1, len(at) * self.length >> 22)):
            offsets = np.arange(self.length)
            agree = self.data[a[some, None] + offsets] == self.data[b[some, None] + offsets]
            same[some] = agree.all(axis=1)
        return same


def _runs(owner: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of consecutive starts of one owner, from rows in order."""
    if not len(owner):
        return owner, start, start
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    return owner[first], start[first], start[np.append(first[1:], len(owner)) - 1]


def compare(rows: list[dict], length: int) -> dict[str, np.ndarray]:
    """Repeated starts among contexts, as runs."""
    rows = list({(r["gram"], r["key"], r["start"]): r for r in rows}.values())
    data = np.frombuffer(b"".join(r["context"] for r in rows), np.uint8)
    sizes = np.array([len(r["context"]) for r in rows])
    counts = sizes - length + 1
    owner = np.repeat(np.arange(len(rows)), counts)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    _, group = np.unique(np.array([r["gram"] for r in rows]), return_inverse=True)
    distance = np.array([r["distance"] for r in rows])[owner] - within
    segment = group[owner] * length + distance
    by = np.argsort(segment, kind="stable")
    owner, within, segment = owner[by], within[by], segment[by]
    places = (np.cumsum(sizes) - sizes)[owner] + within
    suffixes = Suffixes(data, length)
    order = suffixes.sort(places, segment)
    repeated = np.zeros(len(order), bool)
    next_ = np.flatnonzero(segment[1:] == segment[:-1]) + 1  # segments keep their places
    same = next_[suffixes.equal(places[order[next_ - 1]], places[order[next_]])]
    repeated[same] = repeated[same - 1] = True
    keys, starts = np.array([r["key"] for r in rows]), np.array([r["start"] for r in rows])
    at = np.sort(owner[order[repeated]] * (1 << 32) + within[order[repeated]])
    who, first, last = _runs(at >> 32, at & ((1 << 32) - 1))
    return {"key": keys[who], "from": starts[who] + first, "to": starts[who] + last}


_CONTEXT = "gram bigint, key bigint, start bigint, distance int, context binary"


def _divided(contexts: DataFrame, length: int, width: int) -> DataFrame:
    """Contexts cut into those of starts with `width` neighbouring distances, `gram` now naming what these have in common.

    That is the place of the distances and the bytes that all strings at these distances hold, `length` + 1 - `width`
    of them. Equal strings are at the same distance, so they come under the same name.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "context"):
                rows = []
                for gram, key, start, distance, context in zip(*(c.to_pylist() for c in piece.columns)):
                    hashes = Hashes(np.frombuffer(context, np.uint8))
                    least = distance - (len(context) - length)
                    of = np.arange(least // width, distance // width + 1)
                    common = hashes(distance - of * width, length + 1 - width)
                    names = mix(common ^ mix((of * 65536 + width).astype(np.uint64) ^ np.int64(gram).view(np.uint64)))
                    for name, first in zip(names.view(np.int64).tolist(), (of * width).tolist()):
                        far, near = min(distance, first + width - 1), max(least, first)
                        at = distance - far
                        rows.append((name, key, start + at, far, context[at : at + far - near + length]))
                columns = list(zip(*rows)) or [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _CONTEXTS)], schema=_CONTEXTS)

    return contexts.select("gram", "key", "start", "distance", "context").mapInArrow(run, _CONTEXT)


def divide(contexts: DataFrame, length: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Contexts of common grams as parts that can be sorted, and runs of starts already known to be repeated.

    Parts that agree byte by byte are repeated as a whole, and one of them goes on for all; parts with a name of their
    own have no repeated string. Names that still have too many different parts are divided finer, and single strings
    need no sort. What has a name in common agrees on all but `width` bytes, so a context goes on only where the edges
    of a passage may lie.
    """
    coarse = max(1, length // 16)
    parts, known = [], []
    for width in sorted({coarse, max(1, coarse // 5), 1}, reverse=True):
        if contexts.isEmpty():
            break
        pieces = cut(_divided(contexts, length, width))
        place = F.struct("key", "start")
        unique = pieces.groupBy("gram", "distance", "context").agg(F.min(place).alias("one"), F.max(place).alias("other"))
        unique = cut(unique)
        same = unique.where("one <> other").select("gram", "distance", "context")
        starts = (F.length("context") - length).cast("bigint")
        runs = pieces.join(same, ["gram", "distance", "context"])
        known.append(runs.select("key", F.col("start").alias("from"), (F.col("start") + starts).alias("to")))
        sizes = unique.groupBy("gram").agg(F.count(F.lit(1)).alias("different")).where("different > 1")
        open_ = unique.join(sizes, "gram").select("gram", "one.key", "one.start", "distance", "context", "different")
        if width > 1:
            parts.append(open_.where(F.col("different") <= BLOCK).drop("different"))
        contexts = open_.where(F.col("different") > BLOCK).drop("different")
    return parts, known


def repeated_starts(docs: DataFrame, length: int) -> DataFrame:
    """`key`, `from`, `to`: starts of strings of `length` bytes that start elsewhere too."""
    found = find_grams(docs, length)
    by_gram, by_context = Window.partitionBy("gram"), Window.partitionBy("gram", "context")
    counted = (
        found.withColumn("all", F.sum("count").over(by_gram))
        .withColumn("same", F.sum("count").over(by_context))
        .where("count = 0 or all > 1")
        .withColumn("nth", F.row_number().over(by_context.orderBy("key", "start")))
        .withColumn("open", F.expr("count > 0 and all > same and nth = 1"))
        .withColumn("known", F.expr("count = 0 or same > 1"))
        .where("known or open")
    )
    counted = cut(counted.select("gram", "key", "start", "starts", "distance", "all", "known", "open"))
    whole = counted.where("known").select(
        "key", F.col("start").alias("from"), (F.col("start") + F.col("starts") - 1).alias("to")
    )
    asked = counted.where("open").groupBy("key").agg(
        F.collect_list(F.struct("gram", "start", "starts", "distance", "all")).alias("asked")
    )
    texts = texts_of(docs, counted.where("open").select("key")).join(asked, "key")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "data"):
                rows = []
                for key, data, asked in zip(*(piece.column(c).to_pylist() for c in ("key", "data", "asked"))):
                    for a in asked:
                        context = data[a["start"] : a["start"] + a["starts"] + length - 1]
                        rows.append((a["gram"], key, a["start"], a["distance"], context, a["all"]))
                columns = list(zip(*rows)) or [[]] * 6
                schema = _CONTEXTS.append(pa.field("all", pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    contexts = cut(texts.mapInArrow(extract, f"{_CONTEXT}, all bigint"))
    parts, known = divide(contexts.where(F.col("all") > BLOCK).drop("all"), length)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        starts = 0
        for batch in batches:
            for row in batch.to_pylist():
                if starts > SORTED and row["gram"] != held[-1]["gram"]:
                    yield pa.RecordBatch.from_pydict(compare(held, length), schema=_STARTS)
                    held, starts = [], 0
                held.append(row)
                starts += len(row["context"]) - length + 1
        if held:
            yield pa.RecordBatch.from_pydict(compare(held, length), schema=_STARTS)

    sorted_ = contexts.where(F.col("all") <= BLOCK).drop("all")
    for part in parts:
        sorted_ = sorted_.union(part)
    dealt = spread(sorted_, "gram").sortWithinPartitions("gram")
    starts = whole.union(dealt.mapInArrow(sort, "key bigint, `from` bigint, `to` bigint"))
    for runs in known:
        starts = starts.union(runs)
    return starts


_CONTEXTS = pa.schema(
    [
        ("gram", pa.int64()),
        ("key", pa.int64()),
        ("start", pa.int64()),
        ("distance", pa.int32()),
        ("context", pa.binary()),
    ]
)
_STARTS = pa.schema([(c, pa.int64()) for c in ("key", "from", "to")])


def remove_repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """What is left of each text when repeated strings of `length` bytes are removed, without the texts themselves.

    A row per row of `docs` (`doc_id`, `text`; other columns are ignored): `doc_id`, `n_bytes`, `n_removed`, `n_spans`
    (removed runs) and `kept_sha256`. A byte goes if a string of `length` bytes over it also starts somewhere else, in
    any text or the same one. Texts are named by 64 bits of a hash.

    A null text is empty; texts shorter than `length` stay as they are; repeated rows repeat each other and go whole. An
    empty frame gives an empty frame. Long texts are hashed in stretches. A passage with thousands of different
    surroundings is divided by what these have in common. Rows of copied texts, known by their count, go on in pieces.
    """
    named = cut(_named(docs))
    copies = named.where(f"n_bytes >= {length}").groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    copies = cut(copies.where("copies > 1").select("key", F.lit(True).alias("copied")))
    starts = cut(repeated_starts(docs, length).join(copies.select("key"), "key", "left_anti"))
    runs = starts.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("runs"))
    texts = texts_of(docs, starts.select("key")).join(runs, "key").dropDuplicates(["key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, data, spans in zip(*(batch.column(c).to_pylist() for c in ("key", "data", "runs"))):
                kept, at, removed, count = hashlib.sha256(), 0, 0, 0
                end = -1  # of the removed run so far
                for s in spans:
                    if s["from"] > end:
                        count += 1
                        kept.update(data[at : s["from"]])
                        end = s["from"]
                    stop = s["to"] + length
                    if stop > end:
                        removed += stop - end
                        end = at = stop
                kept.update(data[at:])
                rows.append((key, removed, count, kept.hexdigest()))
            columns = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _LEFT)], schema=_LEFT)

    left = texts.mapInArrow(run, "key bigint, removed bigint, spans bigint, left_sha256 string")
    dealt = copies.withColumn("salt", F.explode(F.expr(f"sequence(0L, {SALTS - 1}L)")))
    salted = named.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    marked = cut(salted.join(dealt, ["key", "salt"], "left"))
    single = marked.where("copied is null").join(left, "key", "left")
    copied = marked.where("copied").select(
        "doc_id",
        "n_bytes",
        F.col("n_bytes").alias("n_removed"),
        F.lit(1).cast("bigint").alias("n_spans"),
        F.sha2(F.lit(""), 256).alias("kept_sha256"),
    )
    return copied.union(
        single.select(
            "doc_id",
            "n_bytes",
            F.coalesce("removed", F.lit(0)).cast("bigint").alias("n_removed"),
            F.coalesce("spans", F.lit(0)).cast("bigint").alias("n_spans"),
            F.coalesce("left_sha256", "sha256").alias("kept_sha256"),
        )
    )


_LEFT = pa.schema([("key", pa.int64()), ("removed", pa.int64()), ("spans", pa.int64()), ("left_sha256", pa.string())])


def _named(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [(t or "").encode() for t in batch.column("text").to_pylist()]
            columns = [
                batch.column("doc_id"),
                pa.array([text_key(d) for d in data], pa.int64()),
                pa.array([len(d) for d in data], pa.int64()),
                pa.array([hashlib.sha256(d).hexdigest() for d in data], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_bytes", "sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, key bigint, n_bytes bigint, sha256 string")
