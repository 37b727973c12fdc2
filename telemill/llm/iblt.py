"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A sketch is a table of cells; each paragraph digest is added to one cell in each of three thirds. Sketches of two
versions subtract cell by cell, what they share cancels, and peeling (cells that hold one digest give it, which empties
others) recovers the digests that differ. That fails if too many differ for the table, and then the next table, twice
as large, is tried. Tables fold: adding the halves of each third gives the table of half the size. A fingerprint is the
smallest table that gives all its own digests, so it folds to every smaller size and, by its digests, grows to every
larger one: any two fingerprints can be told apart down to the last digest.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import BYTES, mix, powers, slices, spread

#: Cells in the smallest table; each larger one has twice as many.
CELLS = 12

#: A paragraph is cut where a blank is, if the bytes before it say so, about every 2**CUT_BITS blanks: then a change in a
#: long paragraph changes a few digests only.
CUT_BITS = 4

_CELL = np.dtype([("count", "<i2"), ("key", "<u8"), ("check", "<u4")])


def paragraph_digests(data: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct digests of the paragraphs in each text, and the n + 1 places where texts start.

    A paragraph ends with its line, or within the line at a blank that its last bytes choose. Equal paragraphs of one
    text count by their number: the second has another digest than the first.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(places), np.int64)
    values = BYTES[data]
    local = values.copy()
    for back, salt in ((1, 3), (2, 5), (3, 7), (4, 11)):
        local[back:] += values[:-back] * np.uint64(salt)
    cuts = (data == 32) & (mix(local) >> np.uint64(64 - CUT_BITS) == 0)
    heads = (places[:-1, None] + np.arange(4)).ravel()
    cuts[heads[heads < n]] = False  # what precedes them is another text
    ends = cuts | (data == 10)
    ends[places[1:][places[1:] > 0] - 1] = True
    stops = np.flatnonzero(ends) + 1
    starts = np.concatenate([[0], stops[:-1]])
    sizes = stops - starts
    within = np.arange(n) - np.repeat(starts, sizes)
    digests = mix(np.add.reduceat(values * powers(int(sizes.max()))[within], starts) + sizes.astype(np.uint64))
    texts = np.searchsorted(places, starts, "right") - 1
    order = np.lexsort((digests, texts))
    digests, texts = digests[order], texts[order]
    same = np.zeros(len(digests), bool)
    same[1:] = (digests[1:] == digests[:-1]) & (texts[1:] == texts[:-1])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(digests))))
    digests = mix(digests + (np.arange(len(digests)) - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return digests, np.searchsorted(texts, np.arange(len(places)))


class Tables:
    """Tables of many documents at once, each `cells` cells in a common array from its `base` on."""

    def __init__(self, base: np.ndarray, cells: np.ndarray):
        self.base, self.cells = base, cells
        size = int(base[-1] + cells[-1]) if len(base) else 0
        self.count, self.key, self.check = np.zeros(size, np.int64), np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        self.owner = np.repeat(np.arange(len(base)), cells)

    @classmethod
    def of(cls, cells: np.ndarray) -> Tables:
        return cls(np.cumsum(cells) - cells, cells)

    def add(self, owner: np.ndarray, digests: np.ndarray, sign: np.ndarray | int = 1) -> None:
        third = (self.cells[owner] // 3).astype(np.uint64)
        check = _check(digests)
        for i in range(3):
            at = self.base[owner] + i * third.astype(np.int64) + (mix(digests + np.uint64(i)) % third).astype(np.int64)
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, digests)
            np.bitwise_xor.at(self.check, at, check)

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owners, digests and signs of what the tables hold, and which tables came out empty. Empties the tables."""
        found: list[tuple] = []
        for _ in range(len(self.count) + 1):
            at = np.flatnonzero(np.abs(self.count) == 1)
            at = at[_check(self.key[at]) == self.check[at]]
            if not len(at):
                break
            _, one = np.unique(mix(self.owner[at].astype(np.uint64)) ^ self.key[at], return_index=True)
            at = at[one]
            owner, digests, sign = self.owner[at], self.key[at], self.count[at]
            found.append((owner, digests, sign))
            self.add(owner, digests, -sign)
        left = np.zeros(len(self.base), bool)
        left[self.owner[(self.count != 0) | (self.key != 0) | (self.check != 0)]] = True
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.zeros(0, t) for t in (int, np.uint64, int)]
        return *columns, ~left

    def put(self, other: Tables, mine: np.ndarray, theirs: np.ndarray, sign: int) -> None:
        """Add the tables `theirs` of `other`, folded to the size of mine, to the tables `mine`."""
        cells = other.cells[theirs]
        at = np.repeat(other.base[theirs] - np.cumsum(cells) + cells, cells) + np.arange(cells.sum())
        into = np.repeat(mine, cells)
        third, place = np.divmod(at - other.base[other.owner[at]], (other.cells // 3)[other.owner[at]])
        new = self.cells[into] // 3
        to = self.base[into] + third * new + place % new
        np.add.at(self.count, to, sign * other.count[at])
        np.bitwise_xor.at(self.key, to, other.key[at])
        np.bitwise_xor.at(self.check, to, other.check[at])

    def digests(self) -> tuple[np.ndarray, np.ndarray]:
        """Owners in order, and the digests they hold."""
        copy = Tables(self.base, self.cells)
        copy.count, copy.key, copy.check = self.count.copy(), self.key.copy(), self.check.copy()
        owner, digests, *_ = copy.peel()
        order = np.argsort(owner, kind="stable")
        return owner[order], digests[order]

    def texts(self) -> list[str]:
        cells = np.zeros(len(self.count), _CELL)
        cells["count"], cells["key"], cells["check"] = self.count, self.key, self.check
        return [base64.b64encode(cells[b : b + n].tobytes()).decode() for b, n in zip(self.base, self.cells)]

    @classmethod
    def read(cls, texts: list[str]) -> Tables:
        """The inverse of `texts`."""
        cells = [np.frombuffer(base64.b64decode(t), _CELL) for t in texts]
        made = cls.of(np.array([len(c) for c in cells], np.int64))
        whole = np.concatenate([np.zeros(0, _CELL), *cells])
        made.count[:], made.key[:], made.check[:] = whole["count"], whole["key"], whole["check"]
        return made


def _check(digests: np.ndarray) -> np.ndarray:
    return mix(digests ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)


def _cells(least: np.ndarray) -> np.ndarray:
    """The size of the smallest table with at least so many cells."""
    return CELLS << np.ceil(np.log2(np.maximum(least, CELLS) / CELLS)).astype(np.int64)


def fingerprints(digests: np.ndarray, places: np.ndarray) -> Tables:
    """For each document the smallest table that gives all its digests."""
    counts = np.diff(places)
    owner = np.repeat(np.arange(len(counts)), counts)
    cells, open_ = _cells(counts), np.arange(len(counts))
    while len(open_):
        tried = Tables.of(cells[open_])
        some = np.isin(owner, open_)
        tried.add(np.searchsorted(open_, owner[some]), digests[some])
        *_, done = tried.peel()
        cells[open_[~done]] *= 2
        open_ = open_[~done]
    out = Tables.of(cells)
    out.add(owner, digests)
    return out


def differences(a: Tables, b: Tables, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many digests only table `left[i]` of `a` has, and only table `right[i]` of `b`."""
    sizes = [np.bincount(t.owner, t.count, minlength=len(t.base)).astype(np.int64) // 3 for t in (a, b)]
    cells = _cells(np.abs(sizes[0][left] - sizes[1][right]))
    out = np.zeros((2, len(left)), np.int64)
    open_ = np.arange(len(left))
    grown: list = [None, None]
    while len(open_):
        tried = Tables.of(cells[open_])
        for side, (whole, which, sign) in enumerate(((a, left, 1), (b, right, -1))):
            fits = whole.cells[which[open_]] >= tried.cells
            tried.put(whole, np.flatnonzero(fits), which[open_][fits], sign)
            if not fits.all():
                if grown[side] is None:
                    grown[side] = whole.digests()
                held, digests = grown[side]
                for i in np.flatnonzero(~fits):
                    mine = digests[slice(*np.searchsorted(held, [which[open_[i]], which[open_[i]] + 1]))]
                    tried.add(np.full(len(mine), i), mine, sign)
        owner, _, sign, done = tried.peel()
        for side, which in enumerate((1, -1)):
            out[side, open_[done]] = np.bincount(owner[sign == which], minlength=len(open_))[done]
        cells[open_[~done]] *= 2
        open_ = open_[~done]
    return out[0], out[1]


def likeness(a: Tables, b: Tables, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Shared digests over all digests of each pair; 1 for two empty ones."""
    sizes = np.bincount(a.owner, a.count, minlength=len(a.base)).astype(np.int64) // 3
    only_a, only_b = differences(a, b, left, right)
    shared, every = sizes[left] - only_a, sizes[left] + only_b
    return np.where(every > 0, shared / np.maximum(every, 1), 1.0)


# ---------------------------------------------------------------- neighbours


def with_next(docs: DataFrame) -> DataFrame:
    """`docs` (`doc_id`, `text`) in sorted partitions: `bucket`, `copy`, `key`, `doc_id`, `text`.

    Buckets are ranges of ids. The first row of each bucket comes once more, as a copy, behind the last row of the
    bucket before it, and the first row of all behind the last one; so each row has its successor in its partition. Rows
    go by id, null first, then by text. The driver sees a bound and the smallest id of each bucket, nothing that grows
    with the rows.
    """
    spark = docs.sparkSession
    count = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shares = [i / count for i in range(1, count)]
    bounds = np.unique(np.array(keyed.agg(F.percentile_approx("key", shares, 20 * count)).first()[0] or [], np.int64))

    @F.pandas_udf("int")
    def bucket(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), "right").astype(np.int32))

    firsts = sorted(tuple(r) for r in keyed.groupBy(bucket("key").alias("b")).agg(F.min("key")).collect())
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    known, into = np.array(sorted(before), np.int64), np.array([before[k] for k in sorted(before)], np.int32)

    @F.pandas_udf("array<int>")
    def places(key: pd.Series) -> pd.Series:
        keys = key.to_numpy()
        own = np.searchsorted(bounds, keys, "right").astype(np.int32)
        at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
        return pd.Series([[b, into[i]] if known[i] == k else [b] for b, i, k in zip(own, at, keys)])

    dealt = keyed.select(F.posexplode(places("key")).alias("copy", "bucket"), "key", "doc_id", "text")
    return spread(dealt, "bucket").sortWithinPartitions("bucket", "copy", "key", "text")


def edited(text: str, following: str) -> str:
    """`text` with its last half replaced by as many code points from the start of the text that follows."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of each text of `docs` and of its edited text, and how alike they and its successor's are.

    A null text counts as empty. The successor is the next row by `doc_id` (null first; repeated ids by text), that of
    the last row the first; a single row follows itself. Equal texts have equal fingerprints and likeness 1, also two
    empty ones. Other columns are ignored; an empty frame gives an empty frame.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for piece in slices(batch, "text"):
                yield from zip(*(piece.column(c).to_pylist() for c in ("bucket", "copy", "doc_id", "text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, closed = 0, None
        for bucket, copy, doc_id, text in rows(batches):
            if bucket == closed:
                continue
            held.append((doc_id, text))
            size += len(text)
            if copy or size > CHUNK:
                yield _compared(held)
                held, size = held[-1:], len(text)
            if copy:
                held, size, closed = [], 0, bucket

    return with_next(docs).mapInArrow(run, SCHEMA)


SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)

#: Characters of text that are worked on at a time.
CHUNK = 1 << 19


def _digested(texts: list[str]) -> Tables:
    data = [t.encode() for t in texts]
    places = np.concatenate([[0], np.cumsum([len(d) for d in data])]).astype(np.int64)
    return fingerprints(*paragraph_digests(np.frombuffer(b"".join(data), np.uint8), places))


def _compared(held: list[tuple]) -> pa.RecordBatch:
    """A row for each of `held` but the last, which only follows."""
    texts = [t for _, t in held]
    n = len(held) - 1
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    whole, new = _digested(texts), _digested(changed)
    places = np.arange(n)
    columns = [
        pa.array([i for i, _ in held[:n]], pa.int64()),
        pa.array([len(t) for t in texts[:n]], pa.int64()),
        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed], pa.string()),
        pa.array(whole.texts()[:n], pa.string()),
        pa.array(new.texts(), pa.string()),
        pa.array(likeness(whole, new, places, places), pa.float64()),
        pa.array(likeness(whole, whole, places, places + 1), pa.float64()),
    ]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCHEMA.split(", ")])
