"""A distributed positional inverted index, and exact phrase and proximity search in it; DataFrame functions only.

`build_index` stores a posting (`term`, `row`, `pos`) for every word of every text. The index is divided by documents: each
partition sorts the postings of its own texts by term, so building needs no shuffle and a frequent term is spread over
all partitions. A posting without a term closes each text; its `pos` is the text's number of words.

`search` orders the terms of each phrase by how many postings they have. It takes the postings of the rarest term, keeps
those with the second rarest at the right distance, and only then looks up all others. Phrases that share their two
rarest terms and the distance share this work. Lists of terms are written before they are joined, so Spark knows their size
and broadcasts them only below its threshold; beyond it, it shuffles by term, place and text, which no hot term can fill.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemill.llm.common import stored

_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: What ends a word: all ASCII characters but digits and letters.
_ENDS = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def words_of(text: Column | str) -> Column:
    """The words of a text, `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`, with A-Z lower-cased; null has none.

    Ends of words become blanks, at which `split` cuts without a regular expression: a third of the time that matching takes.
    """
    text = F.col(text) if isinstance(text, str) else text
    filled = F.coalesce(text.cast("string"), F.lit(""))
    plain = F.translate(filled, _CAPITALS + _ENDS, _CAPITALS.lower() + " " * len(_ENDS))
    return F.array_remove(F.split(plain, " "), "")


def build_index(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The stored postings of `docs`: `term`, `row`, `pos`, and `key` where the term is null (see above).

    Every row of `docs` is a text of its own, whatever its key; null and empty texts only have their closing posting.
    Other columns are not read.
    """
    texts = docs.select(F.col(f"`{key}`").alias("key"), words_of(F.col(f"`{text}`")).alias("words"))
    texts = texts.withColumn("row", F.monotonically_increasing_id())
    closed = F.concat("words", F.array(F.lit(None).cast("string")))
    postings = texts.select("row", "key", F.posexplode(closed).alias("pos", "term"))
    postings = postings.select("term", "row", "pos", F.when(F.col("term").isNull(), F.col("key")).alias("key"))
    return stored(postings.sortWithinPartitions("term", "row", "pos"), "postings")


def texts_in(index: DataFrame) -> DataFrame:
    """`row`, `key` and `n_words` of every indexed text."""
    return index.where("term is null").select("row", "key", F.col("pos").alias("n_words"))


def search(index: DataFrame, phrases: DataFrame, slop: int = 0) -> DataFrame:
    """`row`, `phrase` and `start` for every place where a phrase occurs.

    phrases  `phrase`, a unique name, and `terms`, its words in order; without terms it occurs nowhere
    slop     how many places a term may be away from where the phrase has it, counted from the phrase's rarest term
             (the first of them if several are equally rare); 0 finds the phrase itself

    `start` is where the phrase begins as its rarest term has it, which with a slop may lie before the text.
    """
    postings = index.where("term is not null").select("term", "row", "pos")
    listed = phrases.select("phrase", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "term"))
    vocabulary = stored(listed.select("term").distinct(), "terms")
    counts = postings.select("term").join(vocabulary, "term").groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    ranked = listed.join(counts, "term").groupBy("phrase", "len")
    ranked = ranked.agg(F.array_sort(F.collect_list(F.struct("n", "off", "term"))).alias("t")).where("size(t) = len")
    plans = ranked.selectExpr(
        "phrase", "len", "t[0].term as t1", "t[0].off as o1", "get(t, 1).term as t2", "get(t, 1).off - t[0].off as d2",
        "if(len > 2, slice(t, 3, len - 2), array()) as rest",
    )
    plans = stored(plans, "plans")

    single = plans.where("len = 1")
    found = postings.join(single, F.expr("term = t1")).selectExpr("row", "phrase", "pos as start")

    pairs = plans.where("len > 1").select("t1", "t2", "d2").distinct()
    rarest = postings.join(stored(pairs, "pairs"), F.expr("term = t1"))
    rarest = rarest.selectExpr("row", "pos as p1", "t1", "t2", "d2", _around("pos + d2", slop))
    second = postings.join(stored(pairs.selectExpr("t2 as term").distinct(), "terms"), "term")
    met = rarest.join(second.selectExpr("row", "term as t2", "pos as place"), ["row", "t2", "place"])
    met = met.select("row", "p1", "t1", "t2", "d2").distinct() if slop else met.select("row", "p1", "t1", "t2", "d2")
    begun = stored(met, "met").join(plans, ["t1", "t2", "d2"]).selectExpr("row", "phrase", "p1 - o1 as start", "len", "rest")
    found = found.union(begun.where("len = 2").select("row", "phrase", "start"))

    begun = stored(begun.where("len > 2"), "begun")
    wanted = begun.select("row", "phrase", "start", "len", F.explode("rest").alias("x"))
    wanted = wanted.selectExpr("row", "phrase", "start", "len", "x.off as off", "x.term as term", _around("start + x.off", slop))
    near = postings.join(stored(begun.select("row").distinct(), "rows"), "row", "left_semi")
    near = near.join(vocabulary, "term", "left_semi").withColumnRenamed("pos", "place")
    hits = wanted.join(near, ["row", "term", "place"]).groupBy("row", "phrase", "start", "len")
    hits = hits.agg((F.count_distinct("off") if slop else F.count("off")).alias("n")).where("n = len - 2")
    return found.union(hits.select("row", "phrase", "start"))


def _around(place: str, slop: int) -> str:
    """The places at most `slop` away, a row for each."""
    return f"explode(sequence({place} - {slop}, {place} + {slop})) as place" if slop else f"{place} as place"


def windows(items: DataFrame, size: int, text: str = "text", key: str = "item_id") -> tuple[DataFrame, DataFrame]:
    """The distinct windows of `size` words in the texts of `items` (`phrase`, `terms`), and their items (`phrase`, `item`).

    A text of fewer words, but not none, is one window. Items are told apart by their key as a string; null is ''.
    """
    item = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("item")
    worded = items.select(item, words_of(F.col(f"`{text}`")).alias("words")).where("size(words) > 0")
    cut = F.expr(f"explode(transform(sequence(1, greatest(size(words) - {size - 1}, 1)), i -> slice(words, i, {size})))")
    cuts = stored(worded.select("item", cut.alias("terms")).distinct(), "windows")
    named = stored(cuts.select("terms").distinct().withColumn("phrase", F.monotonically_increasing_id()), "windows")
    return named, stored(cuts.join(named, "terms").select("phrase", "item"), "windows")


def contamination(docs: DataFrame, items: DataFrame, size: int = 10) -> DataFrame:
    """For every document, what it shares with the `items` of a benchmark.

    `doc_id`, `n_words`, `n_hit` (words inside any occurrence of a window, counted once), `n_items` (items with a window that
    occurs in the document), `items_sha256` (their ids, sorted as strings and joined by commas) and `contaminated`.

    Documents without words hit nothing; rows that repeat are judged one by one; without items nothing is hit.
    """
    index = build_index(docs)
    named, owners = windows(items, size)
    matches = stored(search(index, named), "matches")
    spans = matches.join(named.select("phrase", F.size("terms").alias("len")), "phrase")
    spans = spans.selectExpr("row", "start", "start + len as stop").distinct()
    order = Window.partitionBy("row").orderBy("start", "stop")
    before = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.lit(0), F.col("stop") - F.greatest("start", F.coalesce(before, F.col("start"))))
    hit = spans.select("row", fresh.alias("fresh")).groupBy("row").agg(F.sum("fresh").alias("n_hit"))
    held = matches.select("row", "phrase").distinct().join(owners, "phrase").select("row", "item").distinct()
    held = held.groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    joined = texts_in(index).join(hit, "row", "left").join(held, "row", "left")
    listed = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        F.col("key").alias("doc_id"),
        F.col("n_words").cast("bigint").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.size(listed).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )
