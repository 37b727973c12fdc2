import re
from collections import defaultdict
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from telemill.llm import mixing


def wanted(sizes):
    """Targets by sharing out, stopping and sharing out again."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    left, out, open_ = Fraction(sum(sizes.values())), {}, set(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        stopped = {s for s in open_ if unit * weight[s] > 3 * sizes[s]}
        if not stopped:
            return out | {s: unit * weight[s] for s in open_}
        for s in stopped:
            out[s] = Fraction(3 * sizes[s])
            left -= out[s]
        open_ -= stopped
    return out


@pytest.mark.parametrize(
    "sizes",
    [{"a": 10}, {"a": 1, "b": 1000, None: 5}, {"a": 0, "b": 0}, {"b": 3, "c": 1, "d": 1, "e": 900, "é": 2}, {"a": 7, "b": 7, "c": 7}],
)
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    for source, target in wanted(sizes).items():
        assert got[source] == pytest.approx(float(target))


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, texts):
    """`texts`: id, text and source of the input."""
    sizes, largest, taken = defaultdict(int), defaultdict(int), defaultdict(int)
    for _, text, source in texts:
        sizes[source] += words(text)
        largest[source] = max(largest[source], words(text))
    targets = wanted(sizes)
    assert sorted(((r.doc_id, r.size, r.source) for r in rows), key=str) == sorted(
        ((i, words(t), s) for i, t, s in texts), key=str
    )
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(targets[r.source]))
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 3 * r.size
        epochs = int(targets[r.source] // sizes[r.source]) if sizes[r.source] else 0
        assert r.taken in (r.size * epochs, r.size * (epochs + 1))  # whole epochs first
        taken[r.source] += r.taken
    for source in sizes:
        assert abs(taken[source] - targets[source]) <= largest[source] / 2 + 1e-6


def test_odd_documents(documents):
    from odd import ODD

    docs = documents().withColumn("source", F.expr("case when doc_id < 6 then 'a' when doc_id < 10 then 'b' end"))
    texts = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert len(texts) == len(ODD)
    mixed = mixing.mix(docs)
    check(mixed.collect(), texts)
    assert sorted(mixed.collect(), key=str) == sorted(mixing.mix(docs.repartition(7)).collect(), key=str)
    assert mixing.mix(documents([])).collect() == []


def test_runs_add_up_to_the_order_by_key(spark, monkeypatch):
    """A source cut into many runs takes what it takes in one."""
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), F.expr("repeat('w ', cast(1 + id % 17 as int))").alias("text"),
        F.expr("if(id % 3 = 0, 'hot', 's' || id % 7)").alias("source"),
    )
    whole = sorted(mixing.mix(docs).collect(), key=str)
    monkeypatch.setattr(mixing, "RUN", 13)
    assert sorted(mixing.mix(docs).collect(), key=str) == whole
    check(whole, [tuple(r) for r in docs.collect()])


def test_better_documents_are_taken_more_often(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.expr("if(id % 2 = 0, 'word word', '%% word && ##')").alias("text"),
        F.expr("if(id < 3000, 'a', 'b')").alias("source"),
    )
    got = mixing.mix(docs).where("source = 'a'").groupBy((F.col("doc_id") % 2).alias("odd")).agg(F.avg(F.col("taken") / F.col("size")))
    share = dict(map(tuple, got.collect()))
    assert share[0] > share[1]


def test_query(run, table):
    texts = [tuple(r) for r in table("documents").select("doc_id", "text", "source").collect()]
    check(run("op6_source_mixing"), texts)


def test_no_python_on_the_main_path(table):
    plan = mixing.mix(table("documents"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
