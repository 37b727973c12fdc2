"""Chat formatting as prefix trees: conversations that begin with the same turns share them.

A turn with all turns before it is a node; equal ones are one node, whatever conversation they are from. The nodes of a
tree (those with the same first turn) are laid out depth first, each node's tokens once, in one token sequence. A
node's tokens attend to themselves and to the intervals of its ancestors, and their positions go on from the parent's,
as if every conversation were alone.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm import tokens
from telemill.llm.common import SLICE_BYTES, cut, spread

#: The role whose texts are learned.
LEARNED = "assistant"

_MARK = re.compile(r"([\\<\"])")
_TURN = re.compile(r'<turn role="([^\\"]*(?:\\.[^\\"]*)*)">\n([^\\<]*(?:\\.[^\\<]*)*)</turn>\n', re.S)


def escape(text: str) -> str:
    """Puts a backslash before what could end a role or begin a mark of the template, and before backslashes."""
    return _MARK.sub(r"\\\1", text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def template(role: str, text: str) -> tuple[str, str, str]:
    """A turn before, in and after its text."""
    return f'<turn role="{escape(role)}">\n', escape(text), "</turn>\n"


def parse(formatted: str) -> list[tuple[str, str]]:
    """Roles and texts of a formatted conversation."""
    out, at = [], 0
    while at < len(formatted):
        turn = _TURN.match(formatted, at)
        if not turn:
            raise ValueError(f"no turn at {at}")
        out.append((unescape(turn[1]), unescape(turn[2])))
        at = turn.end()
    return out


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, dict]]:
    """Rows that are sorted by conversation, and whether one begins with them."""
    now, begun = None, False
    for batch in batches:
        for row in batch.to_pylist():
            yield not begun or row["conv_id"] != now, row
            now, begun = row["conv_id"], True


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows in batches of bounded size."""
    made, held = [], 0
    for row in rows:
        made.append(row)
        held += sum(len(x) * (16 if isinstance(x, list) else 1) for x in row if isinstance(x, (str, bytes, list)))
        if len(made) == 1000 or held > SLICE_BYTES:
            yield _batch(made, schema)
            made, held = [], 0
    yield _batch(made, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def hashed(turns: DataFrame) -> DataFrame:
    """A row per turn of `turns` (`conv_id`, `turn`, `role`, `text`) with its `tree`, `parent`, `node` and `depth`.

    Turns of a conversation go by `turn`, then role and text; null roles and texts are empty. They pass as a sorted
    stream, of which only the last node is held.
    """
    said = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    said = spread(said, "conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        tree = node = None
        depth = 0
        for first, t in _rows(batches):
            if first:
                tree, node, depth = None, None, 0
            parent, depth = node, depth + 1
            made = hashlib.blake2b(parent or b"", digest_size=16)
            for part in (t["role"].encode(), t["text"].encode()):
                made.update(len(part).to_bytes(8, "little") + part)
            node = made.digest()
            tree = tree or node
            yield t["conv_id"], depth, tree, parent, node, t["role"], t["text"]

    schema = "conv_id bigint, depth int, tree binary, parent binary, node binary, role string, text string"
    return said.mapInArrow(lambda batches: _batches(nodes(batches), _NODES), schema)


_NODES = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("depth", pa.int32()),
        ("tree", pa.binary()),
        ("parent", pa.binary()),
        ("node", pa.binary()),
        ("role", pa.string()),
        ("text", pa.string()),
    ]
)


def runs(members: DataFrame) -> DataFrame:
    """A row per node with the run of nodes that it belongs to, named by the first, and its places.

    `members` has `conv_id`, `depth`, `node`, its tokens `n`, how many conversations `share` it, and of one of these
    `mine`. A node goes on with the run of its parent if the same conversations share them: then no other follows the
    parent, and none ends there. `offset` is its place in the run and `position` that in the conversation. The first
    node of a run also has the `path` of runs down to it, so paths are as long as conversations have branches.
    """
    members = spread(members, "conv_id").sortWithinPartitions("conv_id", "depth")

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        path: list[bytes] = []
        share = offset = position = 0
        for first, m in _rows(batches):
            if first:
                path, share, position = [], 0, 0
            begins = m["share"] != share
            if begins:
                path.append(m["node"])
                share, offset = m["share"], 0
            if m["mine"]:
                yield m["node"], path[-1], offset, position, m["n"], list(path) if begins else None
            offset += m["n"]
            position += m["n"]

    schema = "node binary, run binary, offset bigint, position bigint, n bigint, path array<binary>"
    return members.mapInArrow(lambda batches: _batches(places(batches), _PLACES), schema)


_PLACES = pa.schema(
    [
        ("node", pa.binary()),
        ("run", pa.binary()),
        ("offset", pa.int64()),
        ("position", pa.int64()),
        ("n", pa.int64()),
        ("path", pa.list_(pa.binary())),
    ]
)


def _tokenized(nodes: DataFrame) -> DataFrame:
    """`tokens` of the template and the text of each node, and `learned`, the tokens from and to which loss counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokens.plain_ids
        for batch in batches:
            ids, start, stop = [], [], []
            for role, text in zip(batch.column("role").to_pylist(), batch.column("text").to_pylist()):
                before, inner, after = map(encode, template(role, text))
                ids.append(before + inner + after)
                start.append(len(before))
                stop.append(len(before) + len(inner) * (role == LEARNED))
            kept = [batch.column(c) for c in _KEPT]
            made = [pa.array(ids, pa.list_(pa.int32())), pa.array(start, pa.int32()), pa.array(stop, pa.int32())]
            yield pa.RecordBatch.from_arrays(kept + made, [*_KEPT, "tokens", "learn_from", "learn_to"])

    return nodes.mapInArrow(
        run,
        "node binary, tree binary, parent binary, depth int, share bigint, owner bigint, tokens array<int>,"
        " learn_from int, learn_to int",
    )


_KEPT = ["node", "tree", "parent", "depth", "share", "owner"]


def format_conversations(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The segments of the trees, and which nodes each conversation consists of.

    Segments have a row per node: `tree` (its first turn), `node`, `parent`, `depth`, `tokens`, `learn_from` and `learn_to`
    (the loss counts for tokens in between), `start` and `end` (its place in the tree's sequence), `position` (of its
    first token; position ids count on from there) and `attends`, the intervals of its ancestors, those of an unbranched
    run of turns as one. Conversations have rows `conv_id`, `depth` and `node`.

    Null roles and texts are empty, a null turn comes first, null ids are one conversation; rows that repeat a turn are
    turns of their own. An empty frame gives empty frames. A common first turn makes a large tree: its runs are rows,
    sorted over all tasks by their path, and summed up by task; no tree is gathered. Nor is a conversation: one task
    passes its turns one by one, and `attends` has an interval for each branch above, not for each turn.
    """
    said = cut(hashed(turns))
    once = [F.first(c).alias(c) for c in ("tree", "parent", "depth", "role", "text")]
    nodes = said.groupBy("node").agg(*once, F.count("*").alias("share"), F.first("conv_id").alias("owner"))
    nodes = cut(_tokenized(nodes))
    sizes = nodes.select("node", "share", "owner", F.size("tokens").cast("bigint").alias("n"))
    members = said.select("conv_id", "depth", "node")
    mine = F.col("conv_id").eqNullSafe(F.col("owner")).alias("mine")
    placed = cut(runs(members.join(sizes, "node").select("conv_id", "depth", "node", "n", "share", mine)))

    lengths = placed.groupBy("run").agg(F.sum("n").alias("n"))
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = placed.where("path is not null").select("run", "path").join(lengths, "run")
    laid = laid.repartitionByRange(parts, "path").sortWithinPartitions("path")
    laid = cut(laid.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place")))
    narrow = laid.select("run", F.col("path")[0].alias("tree"), "part", "place", "n")
    so_far = Window.partitionBy("tree", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = narrow.groupBy("tree", "part").agg(F.sum("n").alias("n"))
    sums = sums.select("tree", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = narrow.withColumn("within", F.sum("n").over(so_far)).join(sums, ["tree", "part"])
    end = F.col("before") + F.col("within")
    spans = cut(within.select("run", (end - F.col("n")).alias("from"), end.alias("to")))

    above = laid.where("size(path) > 1").select(
        "run", F.posexplode(F.expr("slice(path, 1, size(path) - 1)")).alias("level", "up")
    )
    above = above.join(spans.select(F.col("run").alias("up"), "from", "to"), "up")
    above = above.groupBy("run").agg(F.sort_array(F.collect_list(F.struct("level", "from", "to"))).alias("above"))
    above = spans.select("run", "from").join(above, "run", "left")
    start = F.col("from") + F.col("offset")
    segments = (
        nodes.join(placed.drop("path"), "node")
        .join(above, "run")
        .select(
            "tree", "node", "parent", "depth", "tokens", "learn_from", "learn_to", start.alias("start"),
            (start + F.col("n")).alias("end"), "position",
            F.expr(
                "concat(transform(coalesce(above, array()), x -> struct(x.from as start, x.to as end)),"
                " if(offset > 0, array(struct(from as start, from + offset as end)), array()))"
            ).alias("attends"),
        )
    )
    return segments, members


def read_back(segments: DataFrame, members: DataFrame) -> DataFrame:
    """What formatted conversations say: `conv_id` and the digests of their turns and of what is learned.

    The segments of a conversation's nodes are decoded from their tokens and parsed, one after the other.
    """
    held = segments.select("node", "tokens", "learn_from", "learn_to")
    rows = spread(members.join(held, "node"), "conv_id").sortWithinPartitions("conv_id", "depth")

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        decode = tokens.encoding().decode_bytes
        said = None
        for first, row in _rows(batches):
            if first:
                if said:
                    yield conv_id, n_turns, said.hexdigest(), loss_chars, learned.hexdigest(), chars
                conv_id, said, learned = row["conv_id"], hashlib.sha256(), hashlib.sha256()
                n_turns = loss_chars = chars = 0
            formatted = decode(row["tokens"]).decode()
            for role, text in parse(formatted):
                said.update(f"{role}\n{text}\n".encode())
                n_turns += 1
            loss = unescape(decode(row["tokens"][row["learn_from"] : row["learn_to"]]).decode())
            learned.update(loss.encode())
            loss_chars += len(loss)
            chars += len(formatted)
        if said:
            yield conv_id, n_turns, said.hexdigest(), loss_chars, learned.hexdigest(), chars

    return rows.mapInArrow(
        lambda batches: _batches(digests(batches), _DIGESTS),
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string,"
        " formatted_chars bigint",
    )


_DIGESTS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("n_turns", pa.int64()),
        ("turns_sha256", pa.string()),
        ("loss_chars", pa.int64()),
        ("loss_sha256", pa.string()),
        ("formatted_chars", pa.int64()),
    ]
)
