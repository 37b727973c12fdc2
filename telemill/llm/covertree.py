"""Exact top-k search by inner product: cover trees over blocks of queries and of vectors, walked together.

Queries and vectors are dealt into blocks of bounded size, and every pair of a query block with a vector block is a
group of its own, which builds both trees and walks them. A pair of nodes is left out where even the best product that
their centres and covering radii allow is below the worst k-th score of the node's queries. What a pair of blocks gives
is at most k rows per query.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Stands for a null id, so that it comes last.
NO_ID = (1 << 63) - 1

#: Vectors and queries in a block, on average.
VECTORS, QUERIES = 4096, 1024

#: Points that a node holds without children, the ratio of the radii of a node and its children, and the fewest points
#: that a child must have on average: where a net groups no more than that, the node stays whole and is scored whole.
LEAF, SHRINK, GROUPS = 48, 1.6, 8

#: The key of no vector.
NONE = np.iinfo(np.int64).min

#: Vectors of leaves that are scored at a time.
BATCH = 1024


@dataclass
class Node:
    """`points` covers the node and all below it; `children` have a smaller radius."""

    centre: int
    radius: float
    points: np.ndarray
    longest: float
    children: list[Node] = field(default_factory=list)


def build(x: np.ndarray) -> Node:
    """A cover tree, level by level: the children's centres are a net, more than their radius apart, that covers all."""
    norms = np.sqrt((x * x).sum(axis=1))

    def node(centre: int, points: np.ndarray, apart: np.ndarray) -> Node:
        return Node(centre, float(apart.max(initial=0.0)), points, float(norms[points].max(initial=0.0)))

    def distances(centre: int, points: np.ndarray) -> np.ndarray:
        d = x[points] - x[centre]
        return np.sqrt(np.einsum("ij,ij->i", d, d))

    everything = np.arange(len(x))
    root = node(0, everything, distances(0, everything))
    todo = [root]
    while todo:
        parent = todo.pop()
        if len(parent.points) <= LEAF or parent.radius == 0:
            continue
        cover = parent.radius / SHRINK
        rest, centre = parent.points, parent.centre
        while len(rest) and len(parent.children) * GROUPS <= len(parent.points):
            apart = distances(centre, rest)
            near = apart <= cover
            parent.children.append(node(centre, rest[near], apart[near]))
            rest, apart = rest[~near], apart[~near]
            if len(rest):
                centre = int(rest[apart.argmax()])
        if len(rest):
            parent.children = []
        todo += parent.children
    return root


class Search:
    """Queries `q` with the best `k` of the vectors `c`, as keys that grow with the score and fall with the place."""

    def __init__(self, q: np.ndarray, c: np.ndarray, own: np.ndarray, k: int):
        self.q, self.c, self.own, self.k = q, c, own, k
        self.keys = np.full((len(q), k), NONE)
        self.worst = np.full(len(q), -math.inf)
        self.places = len(c)

    def run(self) -> np.ndarray:
        if len(self.q) and len(self.c):
            self.walk(build(self.q), [build(self.c)])
        return self.keys

    def bounds(self, a: Node, nodes: list[Node]) -> np.ndarray:
        """The highest product that a point of `a` may have with one of each of `nodes`."""
        centres = self.c[[n.centre for n in nodes]]
        radius = np.array([n.radius for n in nodes])
        q = self.q[a.centre]
        length = math.sqrt(q @ q)
        by_radius = centres @ q + a.radius * np.sqrt((centres * centres).sum(axis=1)) + radius * (length + a.radius)
        return np.minimum(by_radius, a.longest * np.array([n.longest for n in nodes])) * (1 + 1e-12) + 1e-6

    def walk(self, a: Node, nodes: list[Node]) -> None:
        """Both trees step down together; a leaf of queries takes the most promising nodes first."""
        if a.children:
            opened = [x for n in self.kept(a, nodes) for x in (n.children or [n])]
            for child in a.children:
                self.walk(child, opened)
            return
        while nodes:
            nodes = self.kept(a, nodes)
            leaves, count = [], 0
            while nodes and count < BATCH and not nodes[0].children:
                leaves.append(nodes.pop(0))
                count += len(leaves[-1].points)
            if leaves:
                self.score(a.points, np.concatenate([n.points for n in leaves]))
            elif nodes:
                # open what may be better than the first leaf
                front = nodes[:64]
                nodes = nodes[64:] + [x for f in front for x in (f.children or [f])]

    def kept(self, a: Node, nodes: list[Node]) -> list[Node]:
        """Nodes that may hold a result of one of the queries, the best bound first."""
        if not nodes:
            return nodes
        bounds = self.bounds(a, nodes)
        order = np.argsort(-bounds, kind="stable")
        least = self.worst[a.points].min()
        return [nodes[i] for i in order[: np.searchsorted(-bounds[order], -least, "right")]]

    def score(self, queries: np.ndarray, places: np.ndarray) -> None:
        scores = np.rint(self.q[queries] @ self.c[places].T).astype(np.int64)
        keys = scores * self.places + (self.places - 1 - places)
        keys[self.own[queries][:, None] == places] = NONE
        both = np.concatenate([self.keys[queries], keys], axis=1)
        best = np.partition(both, both.shape[1] - self.k, axis=1)[:, -self.k :]
        self.keys[queries] = best
        least = best.min(axis=1)
        self.worst[queries] = np.where(least == NONE, -math.inf, least // self.places)


def _numbers(vectors: pd.Series, scale: float) -> np.ndarray:
    return np.floor(np.stack(vectors.to_list()).astype(np.float64) * scale)


def top_k(vectors: DataFrame, is_query, k: int = 20, scale: float = 64.0) -> DataFrame:
    """`query_id`, `rank`, `vec_id` and `score`: for each query id its `k` vectors with the highest inner product.

    `vectors` has `vec_id` and `embedding`; its components count as floor(scale * x), in whole numbers and without
    rounding. `is_query` (a condition) picks the queries, whose own id is no candidate. Ties go to the smaller id, a null
    id last; rows that repeat an id are candidates of their own. An id has one list: queries that share it are all
    searched, equal ones once, and the `k` best of what they find are ranked together, as the SQL for DuckDB does. Vectors
    that are null or empty or hold a null or non-finite component take no part, and vectors of other lengths than a
    query's are not compared with it. Products of 2**53 or more are an error, as they might not be exact.
    Fewer than `k` candidates are all returned; without queries or vectors there are no rows.
    """
    sound = (
        "embedding is not null and size(embedding) > 0"
        " and not exists(embedding, x -> x is null or isnan(x) or abs(x) = double('inf'))"
    )
    rows = vectors.where(sound).select(
        F.coalesce("vec_id", F.lit(NO_ID)).alias("vec_id"),
        "embedding",
        F.size("embedding").alias("dim"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.xxhash64("vec_id", F.monotonically_increasing_id()).alias("deal"),
    )
    n, asking = rows.agg(F.count(F.lit(1)), F.sum(F.col("asks").cast("bigint"))).first()
    across, down = max(1, math.ceil(n / VECTORS)), max(1, math.ceil((asking or 0) / QUERIES))
    queries = rows.where("asks").select("vec_id", "embedding", "dim").distinct()
    queries = queries.withColumn("down", F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(down)))
    queries = queries.withColumn("across", F.explode(F.sequence(F.lit(0), F.lit(across - 1)).cast("array<bigint>")))
    rows = rows.withColumn("across", F.pmod("deal", F.lit(across)))
    rows = rows.withColumn("down", F.explode(F.sequence(F.lit(0), F.lit(down - 1)).cast("array<bigint>")))

    def search(asked: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        if asked.empty or known.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        known = known.sort_values("vec_id", kind="stable").reset_index(drop=True)
        q, c = _numbers(asked["embedding"], scale), _numbers(known["embedding"], scale)
        most = np.abs(q).max() * np.abs(c).max() * q.shape[1]
        if most >= 1 << 53 or most * len(c) >= 1 << 62:
            raise ValueError("products of these vectors are not exact")
        ids = known["vec_id"].to_numpy()
        # a query's own id is one place, or several if rows repeat it
        first = np.searchsorted(ids, asked["vec_id"].to_numpy())
        last = np.searchsorted(ids, asked["vec_id"].to_numpy(), "right")
        repeats = int((last - first).max())
        own = np.where(last > first, first, -1)
        keys = Search(q, c, own, k + max(0, repeats - 1)).run()
        who, at = np.nonzero(keys != NONE)
        keys = keys[who, at]
        places = len(c) - 1 - keys % len(c)
        other = ids[places] != asked["vec_id"].to_numpy()[who]
        asker = asked["vec_id"].to_numpy()[who[other]]
        return pd.DataFrame({"query_id": asker, "vec_id": ids[places[other]], "score": keys[other] // len(c)})

    local = (
        queries.groupBy("dim", "down", "across")
        .cogroup(rows.select("vec_id", "embedding", "dim", "down", "across").groupBy("dim", "down", "across"))
        .applyInPandas(search, "query_id bigint, vec_id bigint, score bigint")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = local.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.expr(f"nullif(vec_id, {NO_ID})").alias("vec_id"), "score")
