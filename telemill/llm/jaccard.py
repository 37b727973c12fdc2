"""Similarity self-join of documents on the Jaccard similarity of their word n-gram sets, by PartEnum signatures.

Sets are dealt into bands by size. In a band, two similar sets differ in at most k elements. The feature domain is cut
into floor(k / 2) + 1 parts and each part into three pieces; similar sets then differ in at most one element of some
part, and so agree on two of its three pieces. Every pair of pieces, with its part and band, gives one signature: a
hash of the set's elements there. Sufficiently similar sets share one of them, whatever their other elements are.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm.common import joined, map_slices, mix, passed, slices, spread
from telemill.llm.components import components
from telemill.llm.shingles import shingle_sets

#: Ratio of the largest to the smallest size in a band.
BAND = Fraction(4, 3)
PIECES = 3

#: One part in so many is spare, and one in so many may go without its common signatures (see `_enumerate`, `_met`).
SPARE, SPARE_COMMON = 20, 16

#: A signature is common if more rows than these have it.
COMMON = 64

#: The low bits of a signature: its band and part. All ones: too large a set to tell.
BAND_BITS, PART_BITS = 6, 18
PLACE = (1 << BAND_BITS + PART_BITS) - 1

#: Sets that a task remembers to have signed.
SEEN = 200_000

#: Words of 64 bits in the bitmap of ids whose texts are wanted: a megabyte.
SIEVE_WORDS = 1 << 17

#: Nodes of a leader that are compared with each other at a time, on average.
BLOCK = 512

#: Rounds in which pairs of blocks are compared, at most. More rounds hold less on disk at a time, the work is the same.
MOST_ROUNDS = 32


@lru_cache(maxsize=64)
def bands(similarity: Fraction, largest: int) -> np.ndarray:
    """The largest size of each band, up to the first band that holds `largest`."""
    tops = [1]
    while tops[-1] < largest:
        tops.append(max(tops[-1] + 1, int(tops[-1] * BAND)))
    return np.array(tops)


def differing(similarity: Fraction, top: int) -> int:
    """Most elements in which two similar sets of at most `top` elements can differ.

    With sizes a and b and d differing elements the similarity is (a + b - d) / (a + b + d).
    """
    return int((1 - similarity) / (1 + similarity) * 2 * top)


def signatures(hashes: np.ndarray, places: np.ndarray, similarity: Fraction) -> list[np.ndarray]:
    """Per set its signatures: those of its own band, and of the next if a similar larger set may be there.

    A pair meets in the band of the larger set. Bands in which similar sets are equal have no signatures.
    """
    sizes = np.diff(places)
    tops = bands(similarity, int(sizes.max(initial=1) / similarity) + 1)
    own = np.searchsorted(tops, sizes)
    last = np.searchsorted(tops, np.floor_divide(sizes * similarity.denominator, similarity.numerator))
    out = []
    for i, n in enumerate(sizes):
        made = []
        for band in range(own[i], last[i] + 1) if n else ():
            top = int(tops[band])
            k = differing(similarity, top)
            if k:
                other = min(top, int(n) * similarity.denominator // similarity.numerator)
                most = int((1 - similarity) / (1 + similarity) * (int(n) + other))
                made.append(_enumerate(hashes[places[i] : places[i + 1]], k // 2 + 1, band, most // 2))
        out.append(np.concatenate(made) if made else np.zeros(0, np.uint64))
    return out


def _may_lack(parts: int) -> int:
    """In how many parts a set may do without its common signatures; `parts` as `_enumerate` has them."""
    return parts // SPARE_COMMON + int(parts > 3)


def _enumerate(hashes: np.ndarray, parts: int, band: int, torn: int) -> np.ndarray:
    """A signature for every part and left-out piece.

    `torn`: the most parts in which a similar set of this band can differ in more than one element; for the largest sets
    one less than `parts`, for smaller ones fewer. In all others the two agree, but for one element.

    Many unlike sets agree where neither has an element. So there are parts to spare, and a set that has such empty
    places in so few parts that similar sets agree in one more, beside those which `_met` may leave out, need not name
    them. A set with more of them names them all.
    """
    lacking = _may_lack(parts)
    parts += parts // SPARE + min(2, parts // 2) + lacking  # small sets are mostly empty in many parts
    name = mix(np.array([band], np.uint64))
    cell = (mix(hashes ^ name) % np.uint64(parts * PIECES)).astype(np.int64)
    sums = np.zeros(parts * PIECES, np.uint64)
    np.add.at(sums, cell, mix(hashes + name))
    count = np.bincount(cell, minlength=parts * PIECES).reshape(parts, PIECES)
    # leaving out one piece of a part keeps the other two
    kept = sums.reshape(parts, PIECES).sum(axis=1, keepdims=True, dtype=np.uint64) - sums.reshape(parts, PIECES)
    named = mix(kept.ravel() ^ mix(np.arange(parts * PIECES, dtype=np.uint64) + name))
    told = band < (1 << BAND_BITS) - 1 and parts <= 1 << PART_BITS
    place = (band << PART_BITS) + np.arange(parts).repeat(PIECES) if told else PLACE
    named = named & np.uint64(~PLACE & (1 << 64) - 1) | np.asarray(place).astype(np.uint64)
    empty = count.sum(axis=1, keepdims=True) == count
    return named if empty.any(axis=1).sum() > parts - torn - 1 - lacking else named[~empty.ravel()]


def _digest(hashes: np.ndarray, places: np.ndarray) -> list[np.ndarray]:
    """128 bits for each set, as two columns of longs."""
    out = []
    for salt in (0x2545F4914F6CDD1D, 0x369DEA0F31A53F85):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes ^ np.uint64(salt)), out=sums[1:])
        out.append((sums[places[1:]] - sums[places[:-1]]).view(np.int64))
    return out


def _lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.view(np.int64)))


def bucket_counts(hashes: np.ndarray, places: np.ndarray) -> list[bytes]:
    """How many elements of each set fall in each bucket of the domain, a byte per bucket, about one for four elements.

    The distance of two such vectors is never more than the number of elements in which the sets differ. Halves add up
    to the vector for half as many buckets.
    """
    spread = mix(hashes ^ np.uint64(0x8EBC6AF09C88C6E3))
    out = []
    for a, b in zip(places[:-1], places[1:]):
        size = 1 << min(12, max(6, int(b - a).bit_length() - 2))
        counts = np.bincount((spread[a:b] % np.uint64(size)).astype(np.int64), minlength=size)
        out.append(np.minimum(counts, 255).astype(np.uint8).tobytes())
    return out


def _sketch(width: int):
    def run(piece: pa.RecordBatch) -> dict:
        hashes, places = shingle_sets(*joined(piece.column("text")), width)
        d1, d2 = _digest(hashes, places)
        made = {"n_shingles": np.diff(places), "d1": d1, "d2": d2, "buckets": bucket_counts(hashes, places)}
        return dict(zip(piece.schema.names, piece.columns)) | made

    return run


def _signed(width: int, similarity: Fraction):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # sets that this task has signed, so that copies are left out before the shuffle
        for batch in batches:
            for piece in slices(batch, "text"):
                hashes, places = shingle_sets(*joined(piece.column("text")), width)
                d1 = _digest(hashes, places)[0]
                made = signatures(hashes, places, similarity)
                made = [s[:0] if d in seen or seen.add(d) else s for d, s in zip(d1.tolist(), made)]
                if len(seen) > SEEN:
                    seen.clear()
                nodes = np.repeat(d1, [len(s) for s in made])
                flat = np.concatenate([np.zeros(0, np.uint64), *made]).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(nodes)], ["signature", "node"])

    return run


def _sets(width: int):
    def run(piece: pa.RecordBatch) -> dict:
        hashes, places = shingle_sets(*joined(piece.column("text")), width)
        d1, d2 = _digest(hashes, places)
        right = (d1 == piece.column("d1").to_numpy()) & (d2 == piece.column("d2").to_numpy())
        kept = {c: piece.column(c) for c in ("leader", "at", "node")}
        return kept | {"elements": _lists(places, hashes), "right": right}

    return run


#: Stands for a null id, so that null ids come after all others.
NO_ID = (1 << 63) - 1


def near_duplicates(docs: DataFrame, width: int = 5, similarity: str = "0.8") -> DataFrame:
    """Group `docs` (`doc_id`, `text`; other columns are ignored) by links of Jaccard similarity `similarity` or more.

    Returns a row per input row: `doc_id`, `n_shingles`, `digest` (two longs in an array, the same for equal sets; null
    without words), `component` (a name for the group; null without words) and `component_id`, the smallest `doc_id`
    that links reach. Words are what lies between ASCII white
    space, with A-Z lower-cased; a text of fewer than `width` words has its whole sequence as only shingle.

    Null and empty texts have no shingles, link with nothing and are their own component. Rows with equal sets are
    linked, rows with the same id and different texts are separate documents. Null ids come after all others, so a
    component with null ids only has a null id. An empty frame gives an empty frame.

    Equal sets are one node, named by 64 bits of their digest. Nodes that share a signature meet under the smallest of
    them; a node leaves out signatures that many rows have where it has enough others for every similar set. What counts of buckets cannot tell apart there is connected, and every node is verified against the leader (the
    smallest node) of what it is connected with, which leaves out no pair:

    * Two nodes whose distances from their leader add up to no more than a link's are linked. The node with the most
      slack stands in for all of them.
    * Where a leader's nodes are then in more than one component, those that share none of their rarest elements, as many
      as a link cannot do without, are told apart. What these elements connect is compared with each other in blocks of
      bounded size. A task has two blocks, as sets of differences from the leader, and gives a spanning forest of its
      links, never its pairs. This part is quadratic in the number of different sets that rare elements connect and that
      are yet not linked.
    """
    similarity = Fraction(similarity)
    key = F.coalesce("doc_id", F.lit(NO_ID))
    rows = passed(sketches(docs.select("doc_id", "text"), width))
    nodes = rows.where("n_shingles > 0").groupBy("d1", "d2").agg(
        F.min(key).alias("rep"), F.first("n_shingles").alias("size"), F.first("buckets").alias("buckets")
    )
    links = _links(docs, nodes, width, similarity)
    grouped = nodes.drop("buckets").join(components(links), nodes.d1 == F.col("node"), "left")
    grouped = grouped.withColumn("component", F.coalesce("component", "d1"))
    smallest = grouped.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = grouped.join(smallest, "component").select(
        "d1", "d2", "component", F.expr(f"nullif(component_id, {NO_ID})").alias("component_id")
    )
    some = F.col("n_shingles") > 0
    return rows.join(named, ["d1", "d2"], "left").select(
        "doc_id",
        "n_shingles",
        F.when(some, F.array("d1", "d2")).alias("digest"),
        "component",
        F.when(some, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def sketches(docs: DataFrame, width: int, keep_text: bool = False) -> DataFrame:
    """Set size `n_shingles`, digest `d1`, `d2` and `buckets` of each row; other columns stay, the text if asked for."""
    docs = docs.drop("n_shingles", "d1", "d2", "buckets")
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if keep_text or f.name != "text"]
    schema = ", ".join([*kept, "n_shingles bigint, d1 bigint, d2 bigint, buckets binary"])
    return map_slices(docs, "text", schema, _sketch(width))


def _links(docs: DataFrame, nodes: DataFrame, width: int, similarity: Fraction) -> DataFrame:
    """Links (`a`, `b`) between nodes (their `d1`), enough to connect what is connected by links."""
    met = _met(docs, width, similarity)
    near = _canopies(met, nodes, similarity)
    stars = passed(components(near).where("node <> component").select(F.col("component").alias("leader"), "node"))
    deltas = passed(_differences(docs, stars, nodes, width, similarity))
    links = deltas.where("linked").select(F.col("leader").alias("a"), F.col("node").alias("b"))
    links = passed(links.union(_by_slack(deltas)))
    return links.union(_in_blocks(_undecided(deltas, links, similarity), similarity))


def _met(docs: DataFrame, width: int, similarity: Fraction) -> DataFrame:
    """Nodes that share a signature, with the smallest of them as `leader`; leaders are with themselves.

    A line that many texts have gives signatures that many unlike sets share, in groups that grow with the input. A node
    leaves out its common signatures in a band if these are in no more than `_may_lack` parts: similar sets agree in
    more parts than both their common signatures and their empty places can be in (see `_enumerate`), and whether a
    signature is common is the same for both.
    """
    signed = docs.select("text").mapInArrow(_signed(width, similarity), "signature bigint, node bigint")
    sharing = Window.partitionBy("signature")
    rows, least, most = F.count(F.lit(1)).over(sharing), F.min("node").over(sharing), F.max("node").over(sharing)
    led = signed.select("signature", "node", least.alias("leader"), most.alias("last"), rows.alias("n"))
    common = F.expr(f"if(n > {COMMON} and leader <> last, cast(signature & {PLACE} as int), null)")
    led = led.withColumn("place", common).where("node <> leader or place is not null")
    led = passed(led.select("leader", "node", "place").distinct())
    band = F.expr(f"shiftright(place, {PART_BITS})")
    told = led.where(f"place <> {PLACE}").groupBy("node", band.alias("band")).agg(F.count_distinct("place").alias("parts"))
    tops = [1]
    while len(tops) < 1 << BAND_BITS:
        tops = bands(similarity, tops[-1] + 1).tolist()
    most = F.array(*[F.lit(_may_lack(differing(similarity, top) // 2 + 1)) for top in tops])
    few = told.where(F.col("parts") <= F.get(most, "band")).select(F.col("node").alias("lacks"), "band")
    left = led.join(few, (F.col("node") == F.col("lacks")) & (band == F.col("band")), "left_anti")
    met = passed(left.where("node <> leader").select("leader", "node").distinct())
    return met.union(met.select("leader", "leader").distinct())


def _canopies(met: DataFrame, nodes: DataFrame, similarity: Fraction) -> DataFrame:
    """Edges (`a`, `b`) whose components hold every linked pair of what has met under one leader, and little else.

    Distances of bucket counts are bounds of the sets' and keep the triangle inequality. A node that is in no core yet
    becomes a centre; what is within `core` of it is in its core, and what is within `core` and a link's length is
    connected with it. So a node's links are connected with the centre of its core. Under one leader that is done in
    blocks, two at a time, and gives a forest. Counts are small, so blocks are larger here and make fewer copies.
    """
    part, whole = _share(similarity)
    counts = met.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / (2 * BLOCK)).cast("int").alias("blocks"))
    known = nodes.select(F.col("d1").alias("node"), "size", "buckets")
    rows = _dealt(met.join(counts.where("blocks > 1"), "leader", "left").fillna(1, ["blocks"]).join(known, "node"))
    rows = spread(rows.select("leader", "i", "j", "node", "size", "buckets"), "leader", "i", "j")

    def forest(nodes: np.ndarray, sizes: np.ndarray, buckets: list[bytes]) -> tuple[list[int], list[int]]:
        least = min(map(len, buckets))
        counts = np.stack([np.frombuffer(b, np.uint8).reshape(-1, least).sum(axis=0) for b in buckets]).astype(np.int32)
        most = int(sizes.max())
        link = part * (most + most * similarity.denominator // similarity.numerator) // whole
        left, right = [], []
        open_, label = np.ones(len(nodes), bool), np.arange(len(nodes))
        for i in range(len(nodes)):
            if open_[i]:
                apart = np.abs(counts - counts[i]).sum(axis=1)
                open_ &= apart > link // 2
                found = np.unique(label[apart <= link // 2 + link])
                other = found[found != label[i]]
                left += [nodes[i]] * len(other)
                right += nodes[other].tolist()
                label[np.isin(label, other)] = label[i]
        return left, right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def made(table: pa.Table) -> pa.RecordBatch:
            keys = np.stack([table.column(c).to_numpy() for c in ("leader", "i", "j")])
            ends = np.append(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1, keys.shape[1])
            nodes, sizes = table.column("node").to_numpy(), table.column("size").to_numpy()
            buckets, start, out = table.column("buckets").to_pylist(), 0, ([], [])
            for end in ends:
                if end - start > 1:
                    for column, values in zip(out, forest(nodes[start:end], sizes[start:end], buckets[start:end])):
                        column += values
                start = end
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            last = [batch.column(c)[-1].as_py() for c in ("leader", "i", "j")]
            tail = batch.num_rows
            keys = [batch.column(c).to_numpy() for c in ("leader", "i", "j")]
            while tail and all(k[tail - 1] == v for k, v in zip(keys, last)):
                tail -= 1
            if tail:
                yield made(pa.Table.from_batches([*held, batch.slice(0, tail)]))
                held = []
            held.append(batch.slice(tail))
        if held:
            yield made(pa.Table.from_batches(held))

    return rows.sortWithinPartitions("leader", "i", "j", "node").mapInArrow(run, "a bigint, b bigint")


def _dealt(rows: DataFrame, turn: int = 0, rounds: int = 1) -> DataFrame:
    """Rows of a `leader` with `blocks`, once for each pair `i`, `j` of blocks that they are in and whose round it is.

    That of a pair is the remainder of `i` + `j`, so a round only makes its own copies.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    first = F.pmod(F.lit(turn) - F.col("own"), F.lit(rounds))
    rows = rows.withColumn("own", own).withColumn("first", first).where("first < blocks")
    others = F.sequence(F.col("first"), F.col("blocks") - 1, F.lit(rounds))
    dealt = rows.withColumn("other", F.explode(others)).drop("first")
    return dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))


def _sieved(rows: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The rows that have a `key` of `wanted`, and few others, without a shuffle of them.

    A bitmap of hashed keys goes ahead, of at most SIEVE_WORDS rows whatever the input is. It lets more through the more
    keys are wanted, and all of them at worst.
    """
    word = F.expr(f"cast(pmod(xxhash64({key}), {64 * SIEVE_WORDS}) div 64 as int)")
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64({key}), 64) as int))")
    words = wanted.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    sieved = rows.join(F.broadcast(words), word == F.col("word"))
    return sieved.where(F.col("bits").bitwiseAND(bit) != 0).select(*rows.columns)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts of `wanted`, by id; not all texts are shuffled for a few."""
    texts = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("rep"), "text")
    return _sieved(texts, wanted, "rep").join(wanted, "rep")


def _differences(docs: DataFrame, stars: DataFrame, nodes: DataFrame, width: int, similarity: Fraction) -> DataFrame:
    """Per leader and node the elements that only one of them has, and whether the two are linked.

    Of these elements the first `added` are the node's, the others the leader's.

    A link between sets of a and b elements allows (a + b) * part / whole differing ones; `slack` is what a node leaves
    of its own share, in units of 1 / whole. The sets come from the texts whose digest is the node's. A large star is
    dealt out in blocks, each with the leader before its nodes, which pass one by one.
    """
    part, whole = _share(similarity)
    blocks = stars.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    own = F.array(F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    members = stars.join(blocks, "leader").select("leader", "node", own.alias("at"))
    members = members.union(blocks.select("leader", F.col("leader").alias("node"), every.alias("at")))
    wanted = passed(members.join(nodes.select(F.col("d1").alias("node"), "d1", "d2", "rep"), "node"))
    sets = map_slices(
        _texts(docs, wanted),
        "text",
        "leader bigint, at array<int>, node bigint, elements array<bigint>, right boolean",
        _sets(width),
    )
    dealt = sets.where("right").select("leader", F.explode("at").alias("block"), "node", "elements")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, last = None, np.zeros(0, np.int64), None
        for batch in batches:
            rows: list[tuple] = []
            keys = zip(*(batch.column(c).to_pylist() for c in ("leader", "block", "node")))
            elements = batch.column("elements")
            for i, (leader, block, node) in enumerate(keys):
                if (leader, block, node) == last:
                    continue  # another row with the same set
                last = leader, block, node
                mine = elements[i].values.to_numpy()
                if (leader, block) != now:
                    now, first = (leader, block), mine  # the leader is the smallest node
                    continue
                added = np.setdiff1d(mine, first, assume_unique=True)
                delta = np.concatenate([added, np.setdiff1d(first, mine, assume_unique=True)])
                far = whole * len(delta)
                linked = far <= part * (len(first) + len(mine))
                rows.append((leader, node, len(mine), delta, len(added), linked, part * len(mine) - far))
            columns = list(zip(*rows)) or [[]] * len(_DELTAS)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DELTAS)], schema=_DELTAS)

    sorted_ = spread(dealt, "leader", "block").sortWithinPartitions("leader", "block", "node")
    return sorted_.mapInArrow(
        run, "leader bigint, node bigint, size bigint, delta array<bigint>, added int, linked boolean, slack bigint"
    )


_DELTAS = pa.schema(
    [
        ("leader", pa.int64()),
        ("node", pa.int64()),
        ("size", pa.int64()),
        ("delta", pa.list_(pa.int64())),
        ("added", pa.int32()),
        ("linked", pa.bool_()),
        ("slack", pa.int64()),
    ]
)


def _share(similarity: Fraction) -> tuple[int, int]:
    share = (1 - similarity) / (1 + similarity)
    return share.numerator, share.denominator


def _by_slack(deltas: DataFrame) -> DataFrame:
    """Links between nodes of a star that follow from their distances from its leader."""
    best = deltas.groupBy("leader").agg(F.max(F.struct("slack", "node")).alias("best"))
    near = deltas.where("not linked").select("leader", "node", "slack").join(best, "leader")
    close = near.where("best.slack + slack >= 0 and best.node <> node")
    return close.select(F.col("best.node").alias("a"), F.col("node").alias("b"))


def _undecided(deltas: DataFrame, links: DataFrame, similarity: Fraction) -> DataFrame:
    """Those rows of `deltas` that may have links between components, by what their rarest elements connect (`leader`).

    What is wanted is found by names alone; elements are only shuffled for the nodes that are then left.
    """
    labels = components(links)
    label = F.coalesce("component", "node").alias("label")
    named = passed(deltas.select("leader", "node").join(labels, "node", "left").select("leader", "node", label))
    split = F.min("label") != F.max("label")
    mixed = named.groupBy("leader").agg(split.alias("split")).where("split").select("leader")
    # leaders that the sieve lets through in error stay with one label
    met = components(_sharing(_sieved(deltas, mixed, "leader"), similarity)).withColumnRenamed("component", "connected")
    named = named.drop("leader").join(met, "node").withColumnRenamed("connected", "leader")
    mixed = named.groupBy("leader").agg(split.alias("split")).where("split").select("leader")
    wanted = passed(named.join(mixed, "leader").select("leader", "node"))
    found = _sieved(deltas.select("node", "size", "delta"), wanted, "node").join(wanted, "node")
    return found.select("leader", "node", "size", "delta")


def _sharing(rows: DataFrame, similarity: Fraction) -> DataFrame:
    """Edges (`a`, `b`) that connect every two linked nodes of a leader.

    Two linked sets of sizes a <= b share at least b * similarity elements, and (a + b) * similarity / (1 + similarity). So
    in any one order of elements, the first ones of each set, as many as it may lack and one more, have one in common; for
    the smaller set fewer do (`few`) than for the larger (`most`). Here the order is from rare to frequent among the
    leader's nodes, and the leader's own elements come last: nodes whose first ones reach into these stand together.
    Elements that one node has alone come before all others, so they need no place in the order: the others' are counted
    from the end.
    """
    few, most = 2 * similarity / (1 + similarity), similarity
    prefix = lambda s: F.expr(f"size - (size * {s.numerator} + {s.denominator - 1}) div {s.denominator} + 1")
    rows = rows.withColumn("few", prefix(few)).withColumn("most", prefix(most))
    element = F.explode(F.slice("delta", F.lit(1), F.col("added"))).alias("element")
    added = rows.select("leader", "node", "few", "most", "added", element)
    counted = added.withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("leader", "element"))).where("n > 1")
    order = Window.partitionBy("leader", "node").orderBy(F.desc("n"), F.desc("element"))
    rare = counted.withColumn("rank", F.col("added") - F.row_number().over(order) + 1).where("rank <= most")
    reaching = rows.where("added < most").select("leader", F.lit(None).cast("bigint"), "node", F.expr("added < few"))
    keys = rare.select("leader", "element", "node", F.expr("rank <= few").alias("early")).union(reaching)
    centre = F.min(F.expr("if(early, node, null)")).over(Window.partitionBy("leader", "element"))
    return keys.select(centre.alias("a"), F.col("node").alias("b")).where("a is not null")


def _in_blocks(rows: DataFrame, similarity: Fraction) -> DataFrame:
    """Links between nodes of one leader, from all pairs of its blocks; a forest per pair of blocks.

    Rows are dealt to as many pairs as their leader has blocks, in as many rounds as they have copies on average. So
    disks hold about as much of them at a time as the rows themselves take. Every pair has its round.
    """
    part, whole = _share(similarity)

    def forest(group: pd.DataFrame) -> pd.DataFrame:
        nodes, sizes = group["node"].to_numpy(), group["size"].to_numpy()
        far = group["delta"].map(len).to_numpy()
        members = np.repeat(np.arange(len(nodes)), far)
        _, element, count = np.unique(
            np.concatenate([*group["delta"], np.zeros(0, np.int64)]), return_inverse=True, return_counts=True
        )
        # what only one node has is shared by none
        members, element = members[count[element] > 1], (np.cumsum(count > 1) - 1)[element[count[element] > 1]]
        shared = np.zeros((len(nodes), len(nodes)), np.float32)
        order = np.argsort(element, kind="stable")
        members, element = members[order], element[order]
        for start in range(0, int(element.max(initial=-1)) + 1, 2048):
            a, b = np.searchsorted(element, [start, start + 2048])
            held = np.zeros((len(nodes), 2048), np.float32)
            held[members[a:b], element[a:b] - start] = 1
            shared += held @ held.T
        apart = far[:, None] + far[None, :] - 2 * shared.astype(np.int64)
        linked = whole * apart <= part * (sizes[:, None] + sizes[None, :])
        np.fill_diagonal(linked, True)
        label, before = np.arange(len(nodes)), None
        while before is None or (label != before).any():
            before = label
            label = np.where(linked, label[None, :], len(nodes)).min(axis=1)
        other = label != np.arange(len(nodes))
        return pd.DataFrame({"a": nodes[label[other]], "b": nodes[other]})

    count = rows.groupBy("leader").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = passed(rows.join(count, "leader"))
    n, copies = rows.agg(F.count(F.lit(1)), F.sum("blocks")).first()
    rounds = min(MOST_ROUNDS, -(-copies // n)) if n else 1
    found = []
    for turn in range(rounds):
        dealt = _dealt(rows, turn, rounds).select("leader", "i", "j", "node", "size", "delta")
        found.append(passed(dealt.groupBy("leader", "i", "j").applyInPandas(forest, "a bigint, b bigint")))
    return reduce(DataFrame.union, found)
