"""Connected components by alternating large-star and small-star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemill.llm.common import passed


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node that it is linked with, of `edges` (longs `a`, `b`).

    Nodes that only link with themselves do not appear. Each round hangs the neighbours of every node on the smallest
    one; edges only shrink, and the number of rounds grows with the logarithm of the longest path. Only counts reach
    the driver. Null ends count as no edge; an empty frame gives an empty one.
    """
    tree = passed(
        edges.where("a <> b").select(F.greatest("a", "b").alias("child"), F.least("a", "b").alias("parent")).distinct()
    )
    state = _state(tree)
    while state[0]:
        both = tree.select(F.col("child").alias("u"), F.col("parent").alias("v")).union(tree.select("parent", "child"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("child"), F.col("m").alias("parent"))
        large = large.distinct()
        least = large.groupBy("child").agg(F.min("parent").alias("m"))
        small = large.join(least, "child")
        tree = passed(
            small.select("child", F.col("m").alias("parent"))
            .union(small.select("parent", "m").where("parent <> m"))
            .distinct()
        )
        before, state = state, _state(tree)
        if before == state:
            break
    return tree.select(F.col("child").alias("node"), F.col("parent").alias("component")).union(
        tree.select("parent", "parent").distinct()
    )


def _state(tree: DataFrame) -> tuple:
    mark = F.xxhash64("child", "parent")
    return tuple(tree.agg(F.count(F.lit(1)), F.bit_xor(mark), F.sum(mark % (1 << 31))).first())
