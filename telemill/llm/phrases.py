"""Phrase collocations by direct-address tiling.

Words are numbered by falling frequency, so that frequent ones have small numbers. A pair of neighbours is a cell of a
square that the numbers span; the square is cut into tiles of 1,024 by 1,024 cells. Tiles with many entries are counted
by a dense `bincount` over their cells, sparse ones as sorted coordinates. Pairs that are frequent enough are numbered by
frequency in turn, and neighbouring pairs, which share a word, are the phrases of three words: the same step again, until
phrases are as long as wanted. A phrase can only be frequent if the two that it extends are, so nothing is lost.

How the work is spread: texts are encoded once, in slices of about 4 MB, as numbers local to the slice. A slice tells the
owners of words (groups, dealt by a hash of the word) and of tiles (likewise) how often it holds each word or pair; owners
add, number what is frequent, and answer each slice about its own: by places in its message, which the slice can make again.
Every slice sends a pair once, so a frequent one is combined before it is shuffled, and the messages to one group are dealt
over several tasks (`salt`). No vocabulary is ever broadcast or collected whole. Owners hold the distinct words or pairs of
one group, a number that is set by the number of words.

What is stored or shuffled is packed: numbers by rank are small, and their bytes of equal weight compress well together. The
shuffle files of a step are removed when it ends.

Rows without text, and empty texts, hold no words. A null language is `und`. Repeated rows count again, whatever their
ids. A text is never cut: one longer than a slice is a slice of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm.common import BYTES, CLEANUP, cut, joined, lengths, map_rows, mix, powers, setting, stored
from telemill.operators.rank import running_rank

#: Bytes of text in a slice.
SLICE = 4 << 20
#: log2 of a tile's edge.
EDGE = 10
#: A tile with at least so many entries is counted in a dense vector of all its cells.
DENSE = 1 << 2 * EDGE - 5
#: Words per group of tiles, messages that one task adds up for a group, and entries that it holds before it adds.
GROUP_WORDS, FAN_IN, HELD = 1 << 20, 256, 1 << 19
#: Bytes of a batch that is sent to a Python worker: rows are large, and both sides hold a batch whole.
BATCH_BYTES = 8 << 20
#: Entries that are added at a time, on average: tiles are dealt to so many parts.
PART = 1 << 18

_BREAK = np.isin(np.arange(256), [*b".,;:!?", *range(0x0A, 0x0E)])
_GAP = _BREAK | np.isin(np.arange(256), [0x20, 0x09])
_SMALL = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


# ---------------------------------------------------------------- packing


def _packed(values: np.ndarray, rising: bool = False) -> bytes:
    """Numbers from 0 as few bytes: differences if they rise, then the bytes of equal weight together, compressed."""
    values = np.asarray(values, np.int64)
    if rising:
        values = np.diff(values, prepend=0)
    width = max(1, -(-int(values.max(initial=0)).bit_length() // 8))
    planes = np.ascontiguousarray(values.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T)
    return struct.pack("<QB", len(values), width) + _compressed(planes.tobytes())


def _unpacked(data: bytes, rising: bool = False) -> np.ndarray:
    size, width = struct.unpack_from("<QB", data)
    values = np.zeros((size, 8), np.uint8)
    values[:, :width] = np.frombuffer(_restored(data[9:], size * width), np.uint8).reshape(width, size).T
    values = values.reshape(-1).view("<i8").astype(np.int64, copy=False)
    return np.cumsum(values) if rising else values


def _compressed(data: bytes) -> bytes:
    return pa.compress(data, codec="zstd", asbytes=True) if data else b""


def _restored(data: bytes, size: int) -> bytes:
    return pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True) if size else b""


def _told(keys: pa.Array) -> dict:
    """Texts as the columns `data` and `sizes`."""
    data, places = joined(keys)
    return {"data": _compressed(data.tobytes()), "sizes": _packed(np.diff(places))}


def _heard(row: dict) -> pa.Array:
    places = np.concatenate([[0], np.cumsum(_unpacked(row["sizes"]))])
    data = _restored(row["data"], int(places[-1]))
    return pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places.astype(np.int32)), pa.py_buffer(data))


# ---------------------------------------------------------------- texts to numbers


def _encoded(texts: list[pa.Array], langs: list[pa.Array]) -> dict:
    """Words of many texts as numbers, -1 between pieces, and the words (with languages and counts) that they stand for."""
    data, places = joined(pa.chunked_array(texts, pa.string()).combine_chunks())
    data = _SMALL[data]
    gap = _GAP[data]
    first, last = ~gap, ~gap
    first[1:] &= gap[:-1]
    last[:-1] &= gap[1:]
    inner = places[1:-1][(places[1:-1] > 0) & (places[1:-1] < len(data))]
    first[inner], last[inner - 1] = ~gap[inner], ~gap[inner - 1]
    starts, stops = np.flatnonzero(first), np.flatnonzero(last) + 1
    text = np.searchsorted(places, starts, "right") - 1
    piece = np.searchsorted(np.flatnonzero(_BREAK[data]), starts) + text  # grows with every break and every text
    offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype(np.int32)
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[~gap])).dictionary_encode()
    tongues = pa.chunked_array(langs, pa.string()).combine_chunks().fill_null("und").dictionary_encode()
    size = max(1, len(words.dictionary))
    tongue = tongues.indices.to_numpy().astype(np.int64)[text]
    codes, distinct = pd.factorize(tongue * size + words.indices.to_numpy())
    counts = np.bincount(codes, minlength=len(distinct))
    order = np.argsort(-counts, kind="stable")  # by falling frequency
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    cuts = np.flatnonzero(piece[1:] != piece[:-1]) + 1
    distinct = distinct[order]
    chosen = words.dictionary.take(pa.array(distinct % size)), tongues.dictionary.take(pa.array(distinct // size))
    return {
        "codes": np.insert(rank[codes], cuts, -1),
        "keys": pc.binary_join_element_wise(*chosen, " "),  # no word has a blank
        "counts": counts[order],
        "langs": tongues.dictionary.to_pylist(),
        "totals": np.bincount(tongue, minlength=len(tongues.dictionary)).tolist(),
    }


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    texts, langs, held = [], [], 0

    def made() -> pa.RecordBatch:
        row = _encoded(texts, langs)
        keys = _told(row["keys"])
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()),
                pa.array([_packed(row["codes"] + 1)], pa.binary()),
                pa.array([keys["data"]], pa.binary()),
                pa.array([keys["sizes"]], pa.binary()),
                pa.array([_packed(row["counts"])], pa.binary()),
                pa.array([row["langs"]], pa.list_(pa.string())),
                pa.array([row["totals"]], pa.list_(pa.int64())),
            ],
            names=["slice", "codes", "data", "sizes", "counts", "langs", "totals"],
        )

    for batch in batches:
        sizes = lengths(batch.column(0))
        start = 0
        while start < batch.num_rows:  # whole texts until the slice is full
            fill = np.searchsorted(np.cumsum(sizes[start:]), SLICE - held, "left") + 1
            part = batch.slice(start, int(fill))
            start += part.num_rows
            texts.append(part.column(0))
            langs.append(part.column(1))
            held += int(lengths(part.column(0)).sum())
            if held >= SLICE:
                yield made()
                number, texts, langs, held = number + 1, [], [], 0
    if texts:
        yield made()


def _renumbered(codes: np.ndarray, places: np.ndarray, ids: np.ndarray) -> dict:
    """Codes stand for ids from now on, in their order; what has no id becomes -1, and neighbouring -1 one."""
    order = np.argsort(ids)
    places, ids = places[order], ids[order]
    most = max(int(codes.max(initial=-1)), int(places.max(initial=-1)))
    table = np.full(most + 2, -1, np.int64)  # the last one is that of -1
    table[places] = np.arange(len(places))
    new = table[codes]
    kept = (new >= 0) | np.append(new[1:] >= 0, False)
    return {"codes": _packed(new[kept] + 1), "ids": _packed(ids, rising=True)}


def _places(found: list[dict], group: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What the owners answered, as places among all that the slice told, and ids; `order` is that of the messages."""
    starts = np.searchsorted(group[order], [x["group"] for x in found])
    places = [order[start + _unpacked(x["places"], rising=True)] for start, x in zip(starts, found)]
    return np.concatenate(places), np.concatenate([_unpacked(x["ids"]) for x in found])


# ---------------------------------------------------------------- words


def _word_groups(keys: pa.Array, groups: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each word, and the order in which they are told: by group."""
    data, places = joined(keys)
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    sizes = np.diff(places)
    within = np.arange(len(data)) - np.repeat(places[:-1], sizes)
    hashes = np.add.reduceat(BYTES[data] * powers(int(sizes.max()))[within], places[:-1])
    group = (mix(hashes) % np.uint64(groups)).astype(np.int64)
    return group, np.argsort(group, kind="stable")


def _word_messages(groups: int, salts: int, counted: bool):
    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            keys, counts = _heard(row), _unpacked(row["counts"])
            group, order = _word_groups(keys, groups)
            for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
                if len(part):
                    made = {"group": int(group[part[0]]), "salt": row["slice"] % salts, **_told(keys.take(pa.array(part)))}
                    yield made | ({"n": _packed(counts[part])} if counted else {"slice": row["slice"]})

    return run


def _sum_of_words(held: list[tuple]) -> tuple[pa.Array, np.ndarray]:
    keys = pa.chunked_array([x[0] for x in held], pa.string()).combine_chunks().dictionary_encode()
    counts = np.concatenate([x[1] for x in held])
    order = np.argsort(keys.indices.to_numpy(), kind="stable")
    starts = np.searchsorted(keys.indices.to_numpy()[order], np.arange(len(keys.dictionary)))
    return keys.dictionary, np.add.reduceat(counts[order], starts) if len(order) else counts


def _words_added(rows: Iterator[dict]) -> Iterator[dict]:
    """Adds up the messages to each group, which come one after the other: `group`, words and their counts."""
    group, held, size, distinct = None, [], 0, 0
    for row in rows:
        if row["group"] != group:
            if held:
                yield {"group": group, "sum": _sum_of_words(held)}
            group, held, size, distinct = row["group"], [], 0, 0
        held.append((_heard(row), _unpacked(row["n"])))
        size += len(held[-1][1])
        if size > max(HELD, distinct):
            held = [_sum_of_words(held)]
            size, distinct = 0, len(held[0][1])
    if held:
        yield {"group": group, "sum": _sum_of_words(held)}


def _word_parts(rows: Iterator[dict]) -> Iterator[dict]:
    for row in _words_added(rows):
        keys, n = row["sum"]
        yield {"group": row["group"], **_told(keys), "n": _packed(n)}


def _frequent_words(least: int):
    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in _words_added(rows):
            keys, n = row["sum"]
            kept = np.flatnonzero(n >= least)
            if len(kept):
                names = [x.partition(" ") for x in keys.take(pa.array(kept)).to_pylist()]
                yield {"group": row["group"], "lang": [x[2] for x in names], "word": [x[0] for x in names], "n": n[kept].tolist()}

    return run


def _word_answers(rows: Iterator[dict]) -> Iterator[dict]:
    """For each message, which of its words are frequent and their ids; the group's table comes before its messages."""
    table, ids, asked = None, None, None
    for row in rows:
        if row["slice"] is None:
            table = pa.array([f"{x['word']} {x['lang']}" for x in row["frequent"]], pa.string())
            ids, asked = np.array([x["id"] for x in row["frequent"]], np.int64), row["group"]
        elif row["group"] == asked:
            at = pc.index_in(_heard(row), value_set=table)
            hit = np.flatnonzero(at.is_valid().to_numpy(zero_copy_only=False))
            if len(hit):
                known = ids[at.fill_null(0).to_numpy()[hit]]
                yield {"slice": row["slice"], "group": asked, "places": _packed(hit, rising=True), "ids": _packed(known)}


def _with_ids(groups: int):
    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            places, ids = _places(row["found"], *_word_groups(_heard(row), groups))
            yield {"slice": row["slice"], **_renumbered(_unpacked(row["codes"]) - 1, places, ids)}

    return run


# ---------------------------------------------------------------- pairs


def _pairs(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct pairs of neighbours and their counts, and the number of its pair (or -1) for every place but the last."""
    left, right = codes[:-1].astype(np.int64), codes[1:].astype(np.int64)
    both = (left >= 0) & (right >= 0)
    keys, inverse, counts = np.unique(left[both] * size + right[both], return_inverse=True, return_counts=True)
    numbers = np.full(max(0, len(codes) - 1), -1, np.int32)
    numbers[both] = inverse
    return keys // max(1, size), keys % max(1, size), counts, numbers


def _group_of(p: np.ndarray, q: np.ndarray, groups: int) -> np.ndarray:
    tile = mix((p >> EDGE).astype(np.uint64)) * np.uint64(3) + mix((q >> EDGE).astype(np.uint64) + np.uint64(1))
    return (mix(tile) % np.uint64(groups)).astype(np.int64)


def _pair_groups(row: dict, groups: int) -> tuple[np.ndarray, ...]:
    """The pairs of a slice with their counts, the number of the pair of every place, groups, and the order of telling."""
    ids = _unpacked(row["ids"], rising=True)
    left, right, counts, numbers = _pairs(_unpacked(row["codes"]) - 1, len(ids))
    p, q = ids[left], ids[right]
    group = _group_of(p, q, groups)
    return p, q, counts, numbers, group, np.lexsort((q, p, group))


def _messages(groups: int, salts: int):
    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            p, q, counts, _, group, order = _pair_groups(row, groups)
            for part in np.split(order, np.flatnonzero(np.diff(group[order])) + 1):
                if len(part):
                    yield {
                        "group": int(group[part[0]]), "salt": row["slice"] % salts, "slice": row["slice"],
                        "p": _packed(p[part], rising=True), "q": _packed(q[part]), "n": _packed(counts[part]),
                    }

    return run


def tiled_sum(p: np.ndarray, q: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs with their counts added: dense vectors for full tiles, sorted coordinates for the others."""
    if not len(p):
        return p, q, n
    width = int(q.max() >> EDGE) + 1
    tile = (p >> EDGE) * width + (q >> EDGE)
    mask = (1 << EDGE) - 1
    cell = ((p & mask) << EDGE) | (q & mask)
    order = np.argsort(tile, kind="stable")
    tile, cell, n = tile[order], cell[order], n[order]
    starts = np.flatnonzero(np.insert(tile[1:] != tile[:-1], 0, True))
    sizes = np.diff(np.append(starts, len(tile)))
    full = np.repeat(sizes >= DENSE, sizes)
    done = []
    for start, size in zip(starts[sizes >= DENSE], sizes[sizes >= DENSE]):
        part = slice(start, start + size)
        # exact: counts stay below 2**53
        counts = np.bincount(cell[part], weights=n[part], minlength=1 << 2 * EDGE)
        cells = np.flatnonzero(counts)
        done.append((np.full(len(cells), tile[start]), cells, counts[cells].astype(np.int64)))
    tile, cell, n = tile[~full], cell[~full], n[~full]
    if len(tile):
        order = np.lexsort((cell, tile))
        tile, cell, n = tile[order], cell[order], n[order]
        first = np.flatnonzero(np.insert((tile[1:] != tile[:-1]) | (cell[1:] != cell[:-1]), 0, True))
        done.append((tile[first], cell[first], np.add.reduceat(n, first)))
    tile, cell, n = (np.concatenate(x) for x in zip(*done))
    return (tile // width << EDGE) | (cell >> EDGE), (tile % width << EDGE) | (cell & mask), n


def _added(least: int):
    """Adds up the messages to each group, which come one after the other; pairs below `least` are left out."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        group, held, size, distinct = None, [], 0, 0

        def made():
            p, q, n = _sum_by_parts(held)
            kept = n >= least
            if kept.any():
                yield {"group": group, "p": p[kept], "q": q[kept], "n": n[kept]}

        for row in rows:
            if row["group"] != group:
                if held:
                    yield from made()
                group, held, size, distinct = row["group"], [], 0, 0
            held.append(tuple(np.frombuffer(row[c], np.int64) for c in "pqn"))
            size += len(held[-1][0])
            if size > max(HELD, distinct):  # as many new ones as there are distinct ones, so that adding stays linear
                held = [_sum_by_parts(held)]
                size, distinct = 0, len(held[0][0])
        if held:
            yield from made()

    return run


def _sum_by_parts(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`tiled_sum` of all that is held, which is emptied; whole tiles of some parts at a time, as adding takes much room."""
    p, q, n = (np.concatenate(x) for x in zip(*held))
    held.clear()
    parts = min(256, -(-len(p) // PART))
    if parts < 2:
        return tiled_sum(p, q, n)
    part = (mix((p >> EDGE).astype(np.uint64) + mix((q >> EDGE).astype(np.uint64))) % np.uint64(parts)).astype(np.uint8)
    order = np.argsort(part, kind="stable")
    ends = np.cumsum(np.bincount(part, minlength=parts))
    p, q, n = p[order], q[order], n[order]
    del part, order
    made = [tiled_sum(p[a:b], q[a:b], n[a:b]) for a, b in zip([0, *ends[:-1]], ends)]
    return tuple(np.concatenate(x) for x in zip(*made))


def _pairs_of(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        yield {"group": row["group"], "p": _unpacked(row["p"], rising=True), "q": _unpacked(row["q"]), "n": _unpacked(row["n"])}


def _parts(rows: Iterator[dict]) -> Iterator[dict]:
    for row in _added(1)(_pairs_of(rows)):
        order = np.lexsort((row["q"], row["p"]))
        p, q, n = (row[c][order] for c in "pqn")
        yield {"group": row["group"], "p": _packed(p, rising=True), "q": _packed(q), "n": _packed(n)}


def _frequent(least: int):
    """`_added` with lists of numbers, in one Python worker."""

    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in _added(least)(_pairs_of(rows)):
            yield {"group": row["group"], **{c: row[c].tolist() for c in "pqn"}}

    return run


def _key(p: np.ndarray, q: np.ndarray, seed: int) -> np.ndarray:
    return mix(mix(p.astype(np.uint64) + np.uint64(seed)) + q.astype(np.uint64))


def _answers(rows: Iterator[dict]) -> Iterator[dict]:
    """For each message, which of its pairs are frequent and their ids; the group's table comes before its messages."""
    table, asked = None, None
    for row in rows:
        if row["slice"] is None:
            p, q, ids = (np.array([x[c] for x in row["frequent"]], np.int64) for c in ("p", "q", "id"))
            seed = 0
            while len(np.unique(_key(p, q, seed))) < len(p):  # keys that collide: others
                seed += 1
            order = np.argsort(_key(p, q, seed))
            table, asked = (p[order], q[order], ids[order], _key(p, q, seed)[order], seed), row["group"]
            continue
        if row["group"] != asked:
            continue  # a group without frequent pairs
        p, q = _unpacked(row["p"], rising=True), _unpacked(row["q"])
        at = np.minimum(np.searchsorted(table[3], _key(p, q, table[4])), len(table[0]) - 1)
        hit = np.flatnonzero((table[0][at] == p) & (table[1][at] == q))
        if len(hit):
            known = table[2][at[hit]]
            yield {"slice": row["slice"], "group": asked, "places": _packed(hit, rising=True), "ids": _packed(known)}


def _next_level(groups: int):
    def run(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            *_, numbers, group, order = _pair_groups(row, groups)
            yield {"slice": row["slice"], **_renumbered(numbers, *_places(row["found"], group, order))}

    return run


_LEVEL = "slice bigint, codes binary, ids binary"
_COUNTS = "group bigint, p binary, q binary, n binary"
_WORDS = "data binary, sizes binary"
_SLICES = f"slice bigint, codes binary, {_WORDS}, counts binary, langs array<string>, totals array<bigint>"
_ANSWERS = "slice bigint, group bigint, places binary, ids binary"


def _dealt(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of equal keys in one partition, one key after the other."""
    return df.repartition(*keys).sortWithinPartitions(*keys)


def _answered(messages: DataFrame, frequent: DataFrame, salts: int, answers) -> DataFrame:
    """What each slice is told: `frequent`, a struct in each row, meets the messages to its `group` in one partition."""
    tables = frequent.groupBy("group").agg(F.collect_list("frequent").alias("frequent"))
    tables = tables.select("group", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)).cast("array<bigint>")).alias("salt"), "frequent")
    asked = messages.unionByName(tables, allowMissingColumns=True)
    asked = asked.repartition("group", "salt").sortWithinPartitions("group", "salt", F.col("slice").asc_nulls_first())
    found = map_rows(asked, _ANSWERS, answers)
    return found.groupBy("slice").agg(F.collect_list(F.struct("group", "places", "ids")).alias("found"))


# ---------------------------------------------------------------- phrases


def frequent_phrases(docs: DataFrame, least: int, longest: int) -> tuple[list[DataFrame], DataFrame]:
    """For 1, 2, ..., `longest` words: the phrases with at least `least` occurrences; and all words of each language.

    Phrases have `id` (their rank by frequency), `lang`, `phrase`, `last` (word), `a` (occurrences), `p` and `q` (ids of the
    phrases without their last and first word), and as arrays the counts of their beginnings and ends of 1, 2, ... words.
    """
    texts = docs.select(F.col("text").cast("string"), F.col("lang").cast("string"))
    slices = stored(texts.mapInArrow(_slices, _SLICES), "phrases")
    totals = slices.select(F.explode(F.arrays_zip("langs", "totals")).alias("x")).groupBy("x.langs").agg(F.sum("x.totals"))
    totals = cut(totals.toDF("lang", "n").where("n > 0"))
    size = totals.agg(F.sum("n")).first()[0] or 0
    count = slices.count()
    groups, salts = max(32, math.ceil(size / GROUP_WORDS)), max(1, math.ceil(count / FAN_IN))

    told = slices.select("slice", "data", "sizes", "counts")
    messages = map_rows(told, f"group bigint, salt bigint, {_WORDS}, n binary", _word_messages(groups, salts, True))
    parts = map_rows(_dealt(messages, "group", "salt"), f"group bigint, {_WORDS}, n binary", _word_parts)
    sums = "group bigint, lang array<string>, word array<string>, n array<bigint>"
    words = map_rows(_dealt(parts, "group"), sums, _frequent_words(least))
    words = words.select("group", F.explode(F.arrays_zip("lang", "word", "n")).alias("x"))
    words = cut(words.selectExpr("group", "x.lang as lang", "x.word as word", "x.n as a"))
    ranked = cut(running_rank(words, [F.desc("a"), "lang", "word"], "id"))
    none = F.array().cast("array<bigint>")
    level = ranked.select(
        "id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), "a",
        F.lit(None).cast("bigint").alias("p"), F.lit(None).cast("bigint").alias("q"), none.alias("heads"), none.alias("tails"),
    )
    levels = [cut(level)]
    asking = map_rows(told, f"group bigint, salt bigint, slice bigint, {_WORDS}", _word_messages(groups, salts, False))
    found = _answered(asking, ranked.select("group", F.struct("lang", "word", "id").alias("frequent")), salts, _word_answers)
    state = stored(map_rows(slices.select("slice", "codes", "data", "sizes").join(found, "slice"), _LEVEL, _with_ids(groups)), "phrases")
    while len(levels) < longest:
        messages = map_rows(
            state, "group bigint, salt bigint, slice bigint, p binary, q binary, n binary", _messages(groups, salts)
        )
        messages = stored(messages, "phrases")
        parts = map_rows(_dealt(messages.select("group", "salt", "p", "q", "n"), "group", "salt"), _COUNTS, _parts)
        sums = "group bigint, p array<bigint>, q array<bigint>, n array<bigint>"
        pairs = map_rows(_dealt(parts, "group"), sums, _frequent(least))
        pairs = pairs.select("group", F.explode(F.arrays_zip("p", "q", "n")).alias("x")).select("group", "x.p", "x.q", F.col("x.n").alias("a"))
        ranked = cut(running_rank(pairs, [F.desc("a"), "p", "q"], "id"))
        levels.append(cut(_described(ranked, levels[-1])))
        if len(levels) == longest or ranked.isEmpty():
            break
        found = _answered(messages.drop("n"), ranked.select("group", F.struct("p", "q", "id").alias("frequent")), salts, _answers)
        state = stored(map_rows(state.join(found, "slice"), _LEVEL, _next_level(groups)), "phrases")
    return levels, totals


def _described(ranked: DataFrame, shorter: DataFrame) -> DataFrame:
    """Phrases one word longer than `shorter`, with their words and the counts of their beginnings and ends."""
    head = shorter.selectExpr("id as p", "lang", "phrase", "heads", "a as head")
    tail = shorter.selectExpr("id as q", "last", "tails", "a as tail")
    return ranked.join(head, "p").join(tail, "q").selectExpr(
        "id", "lang", "phrase || ' ' || last as phrase", "last", "a", "p", "q",
        "concat(heads, array(head)) as heads", "concat(tails, array(tail)) as tails",
    )


#: Of all cuts of a phrase the one with the lowest score, ties to the shortest first part; decimals have 38 digits.
_SCORED = """array_min(transform(sequence(1, size(heads)), k -> named_struct(
    'score', (cast(1000 as decimal(4, 0)) * cast(a as decimal(19, 0)) * cast(n as decimal(19, 0)))
        div (cast(element_at(heads, k) as decimal(19, 0)) * cast(element_at(tails, size(heads) + 1 - k) as decimal(19, 0))),
    'k', k, 'l', element_at(heads, k), 'r', element_at(tails, size(heads) + 1 - k))))"""


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, cover: int = 100, top: int = 2000) -> DataFrame:
    """The `top` phrases of each language by score: `lang`, `rank`, `phrase`, `a`, `l`, `r`, `n`, `score`.

    Phrases have 2 to `longest` words and at least `least` occurrences within the pieces that punctuation and line ends
    cut texts into. A cut into two parts that occur `l` and `r` times scores floor(1000 * a * n / (l * r)), n being all words
    of the language; the lowest counts. A phrase within a longer frequent one that has `cover` percent of its occurrences or
    more is left out. Ties go to the more frequent, then to the first phrase by bytes.
    """
    spark = docs.sparkSession
    with setting(spark, "spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES)), setting(spark, CLEANUP, "true"):
        levels, totals = frequent_phrases(docs, least, longest)  # checkpoints, so all of it has run
    kept = []
    for shorter, longer in zip(levels[1:], [*levels[2:], None]):
        if longer is not None:
            # a phrase's count lies between those of the ones around it, so one more word decides
            around = longer.selectExpr("p as id", "a").union(longer.selectExpr("q", "a")).groupBy("id").agg(F.max("a").alias("most"))
            shorter = shorter.join(around, "id", "left").where(f"most is null or 100 * most < {cover} * a").drop("most")
        kept.append(shorter)
    if not kept:
        kept = [levels[0].where("false")]
    phrases = kept[0]
    for more in kept[1:]:
        phrases = phrases.unionByName(more)
    scored = phrases.join(totals, "lang").withColumn("best", F.expr(_SCORED))
    scored = scored.selectExpr("lang", "phrase", "a", "best.l as l", "best.r as r", "n", "best.score as score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
