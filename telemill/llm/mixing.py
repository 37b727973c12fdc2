"""Mixing sources to target weights by weighted sampling without replacement (Efraimidis and Spirakis)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm.common import WORD, cut

#: The targets: weights by rank of the source, and how often a source may be repeated.
WEIGHTS, REPEATS = (1, 2, 3), 3

#: Documents of a source that are ordered in one task, on average.
RUN = 20_000


def quality(text: Column) -> Column:
    """A weight in (0, 1]: the share of plain words among words and runs of odd marks."""
    words = F.regexp_count(text, F.lit(WORD))
    odd = F.regexp_count(text, F.lit(r"[^\p{L}\p{N}\s.,;:!?'\"()-]+"))
    return F.coalesce((words + 1) / (words + odd + 1), F.lit(1.0))


def so_far(column: str, rows) -> Column:
    return F.coalesce(F.sum(column).over(rows), F.lit(0))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """`target` for each row of `sources` (`source`, `source_size`), as a double.

    Sources by code point, null last, weigh as `weights`, over and over, and share the sum of all sizes; none gets more
    than `repeats` times its size, and what is left over goes to the others by weight. The level at which that ends
    comes from one ordered pass: sources stop in the order of size per weight. There is a row per source, not per
    document; this is the only step that sees all sources in one task.
    """
    everything = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sources.withColumn("place", F.row_number().over(everything) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1).cast("bigint")
    ranked = ranked.withColumn("weight", weight)
    whole = Window.partitionBy()
    by_stop = Window.orderBy(F.col("source_size") / F.col("weight"), "place")
    before = by_stop.rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranked.select(
        "*",
        (F.sum("source_size").over(whole) - repeats * so_far("source_size", before)).alias("open"),
        (F.sum("weight").over(whole) - so_far("weight", before)).alias("open_weight"),
    )
    # the level if this source and all later ones are open; the first source that stays below its bound sets it
    stays = F.col("weight") * F.col("open") <= repeats * F.col("source_size") * F.col("open_weight")
    setter = F.struct(F.col("source_size") / F.col("weight"), "place", "open", "open_weight")
    ranked = ranked.withColumn("first", F.min(F.when(stays, setter)).over(whole))
    level = F.col("weight") * F.col("first.open") / F.col("first.open_weight")
    bound = (repeats * F.col("source_size")).cast("double")
    return ranked.withColumn("target", F.coalesce(F.least(level, bound), bound)).drop(
        "place", "weight", "open", "open_weight", "first"
    )


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    seed: int = 0,
    weigh=quality,
) -> DataFrame:
    """How many words of each of `docs` (`doc_id`, `text`, `source`) a mix takes: one row per row.

    Returns `doc_id`, `source`, `digest` (xxhash64 of the text), `size`, `source_size`, `target` and `taken`. A source gives its whole
    epochs (the target divided by its size) and, for the rest, the documents with the smallest exponential keys,
    -ln(u) / weight with a u that is a hash of id, text and seed, up to the budget: those whose words begin before it
    and end nearer to it than they begin. So reruns agree, and the sum is off by half a document at most.

    Null and empty texts have size 0 and nothing is taken of them; a null source is a source, the last. Rows that repeat
    id, text and source have equal keys and follow each other in no order that could be told apart. A source without
    words has target 0. An empty frame gives an empty frame; other columns are ignored.

    No source is gathered: its documents are cut into runs by key (a hot source has many), ordered in their run, and
    what earlier runs hold is added to the sums.
    """
    sized = docs.select(
        "doc_id",
        "source",
        F.xxhash64("text").alias("digest"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        weigh(F.col("text")).alias("weight"),
        F.xxhash64("doc_id", "text", F.lit(seed)).alias("draw"),
    )
    u = (F.pmod(F.col("draw"), F.lit(1 << 52)).cast("double") + 0.5) / (1 << 52)
    keyed = sized.select("doc_id", "source", "digest", "size", "draw", (-F.ln(u) / F.col("weight")).alias("key"))
    return taken(cut(keyed), weights, repeats)


def taken(keyed: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """`mix` after the keys are drawn."""
    sources = keyed.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("documents"))
    sources = targets(sources, weights, repeats)
    # runs of about RUN documents: 1 - exp(-key) is monotone and spread over 0 to 1 for weights near 1
    runs = F.ceil(F.col("documents") / RUN)
    named = keyed.join(sources, keyed.source.eqNullSafe(sources.source), "left").drop(sources.source)
    named = named.withColumn("run", F.floor((1 - F.exp(-F.col("key"))) * runs))
    in_run = Window.partitionBy("source", "run").orderBy("key", "draw", "digest", "doc_id")
    in_run = in_run.rowsBetween(Window.unboundedPreceding, 0)
    summed = named.withColumn("within", F.sum("size").over(in_run))
    totals = named.groupBy("source", "run").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("source").alias("s"), F.col("run").alias("r"), so_far("words", before).alias("before")
    )
    placed = summed.join(totals, summed.source.eqNullSafe(totals.s) & (summed.run == totals.r))
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    budget = F.col("target") - F.col("source_size") * epochs
    middle = F.col("before") + F.col("within") - F.col("size") / 2
    chosen = (middle <= budget).cast("bigint")
    taken = (F.col("size") * (epochs + chosen)).cast("bigint").alias("taken")
    return placed.select("doc_id", "source", "digest", "size", "source_size", "target", taken)
