import random
import tracemalloc
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from telemill.llm import phrases
from telemill.llm.queries import COLLOCATIONS_SQL

PARAMETERS = {"least": 3, "longest": 4, "cover": 80, "top": 40}


def by_sql(rows, **parameters):
    duck = duckdb.connect()
    duck.register("frame", pd.DataFrame(rows, columns=["text", "lang"]))
    duck.execute("create view documents as select nullif(text, 'none') as text, nullif(lang, 'none') as lang from frame")
    return sorted(duck.execute(COLLOCATIONS_SQL.format(**parameters)).fetchall())


def frame(spark, rows, parts=5):
    clean = [tuple(None if x == "none" else x for x in r) for r in rows]
    schema = "text string, lang string, id string, a int, p int, n int, rank int, slice int"
    return spark.createDataFrame([(*r, "id", 1, 2, 3, 4, 5) for r in clean], schema).repartition(parts)


def texts(seed=1, n=300):
    rng = random.Random(seed)
    words = ["The", "the", "cat", "sat", "on", "mat", "é", "漢字", "x\u00a0y", "<t>", "a", "b"]
    breaks = [" ", " ", " ", " ", "  ", "\t", ". ", "\n", ",", "?!", "\r\n", ";"]
    out = []
    for _ in range(n):
        out.append("".join(rng.choice(words) + rng.choice(breaks) for _ in range(rng.choice([0, 1, 3, 12, 60]))))
    return out


@pytest.mark.parametrize("parameters", [PARAMETERS, {"least": 2, "longest": 5, "cover": 100, "top": 2000}, {"least": 9, "longest": 2, "cover": 100, "top": 3}])
def test_equals_sql(spark, parameters):
    rng = random.Random(2)
    rows = [(t, rng.choice(["en", "en", "de", "none", "und", ""])) for t in texts()]
    rows += [("none", "en"), ("", "de"), (" \n ", "en"), ("word", "en"), ("again and again " * 2000, "en")] + [("hot copy of a row", "en")] * 300
    got = sorted(tuple(r) for r in phrases.collocations(frame(spark, rows), **parameters).collect())
    assert got == by_sql(rows, **parameters) and got


def test_empty_and_wordless(spark):
    for rows in ([], [("none", "none")], [(" . \n", "en")], [("one two", "en")]):
        made = phrases.collocations(frame(spark, rows) if rows else spark.createDataFrame([], "text string, lang string"))
        assert made.collect() == []
        assert made.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_large_products_are_exact(spark):
    """A score whose numerator passes 64 bits."""
    from pyspark.sql import functions as F

    a, n, l, r = 3 * 10**11 + 7, 9 * 10**13 + 1, 4 * 10**11 + 3, 5 * 10**11 + 9
    row = spark.createDataFrame([(a, n, [l], [r])], "a bigint, n bigint, heads array<bigint>, tails array<bigint>")
    assert row.select(F.expr(phrases._SCORED).alias("s")).first().s.score == 1000 * a * n // (l * r)


def test_tiles_are_summed_like_single_pairs():
    rng = np.random.default_rng(3)
    full = rng.integers(0, 200, (60_000, 2))  # one dense tile
    sparse = rng.integers(0, 1 << 22, (5_000, 2))
    repeated = sparse[rng.integers(0, 50, 5_000)]
    pairs = np.concatenate([full, sparse, repeated])
    n = rng.integers(1, 1 << 40, len(pairs))
    want = Counter()
    for (p, q), k in zip(pairs.tolist(), n.tolist()):
        want[p, q] += k
    p, q, total = phrases.tiled_sum(pairs[:, 0], pairs[:, 1], n)
    assert dict(zip(zip(p.tolist(), q.tolist()), total.tolist())) == want and len(p) == len(want)
    assert len(phrases.tiled_sum(*np.zeros((3, 0), np.int64))[0]) == 0


def test_messages_in_several_salts_and_slices(spark):
    """Adding in two steps gives what adding at once gives."""
    rng = np.random.default_rng(4)
    sent = [
        {"group": int(g), "salt": int(s), "p": p, "q": p + 1, "n": np.ones(40, np.int64)}
        for g in range(3) for s in range(4) for p in rng.integers(0, 3000, (5, 40))
    ]
    packed = [{k: v.tobytes() if isinstance(v, np.ndarray) else v for k, v in r.items()} for r in sent]
    parts = [x for s in range(4) for x in phrases._added(1)(iter([r for r in packed if r["salt"] == s]))]
    parts = [{k: v.tobytes() if isinstance(v, np.ndarray) else v for k, v in r.items()} for r in parts]
    sums = list(phrases._added(2)(iter(sorted(parts, key=lambda r: r["group"]))))
    want = Counter((r["group"], x) for r in sent for x in r["p"].tolist())
    got = {(r["group"], p): n for r in sums for p, n in zip(r["p"].tolist(), r["n"].tolist())}
    assert got == {k: n for k, n in want.items() if n >= 2}


def test_adding_many_distinct_pairs_takes_little_room(monkeypatch):
    """With all tiles added at once, and again with every message, this took 130 bytes a distinct pair."""
    monkeypatch.setattr(phrases, "HELD", 1 << 14)
    monkeypatch.setattr(phrases, "PART", 1 << 12, raising=False)
    rng = np.random.default_rng(5)
    pairs = rng.integers(0, 1 << 17, (400_000, 2))
    pairs[::4] = pairs[0] % 50  # one hot pair
    rows = [{"group": 1} | {c: x.tobytes() for c, x in zip("pqn", (*np.ascontiguousarray(some.T), np.ones(len(some), np.int64)))}
            for some in np.array_split(pairs, 40)]
    tracemalloc.start()
    try:
        made = list(phrases._added(2)(iter(rows))) + list(phrases._added(1)(iter(rows)))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    expected, counts = np.unique(pairs, axis=0, return_counts=True)
    for (least, row) in ((2, made[0]), (1, made[1])):
        order = np.lexsort((row["q"], row["p"]))
        assert np.array_equal(np.stack([row["p"], row["q"]], 1)[order], expected[counts >= least])
        assert np.array_equal(row["n"][order], counts[counts >= least])
    assert peak < 110 * len(expected)


def test_batches_for_python_are_small_meanwhile(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen, real = spark.conf.get(key), [], phrases.map_rows
    monkeypatch.setattr(phrases, "map_rows", lambda *a: (seen.append(spark.conf.get(key)), real(*a))[1])
    rows = [(t, "en") for t in texts()]
    phrases.collocations(frame(spark, rows), **PARAMETERS).collect()
    assert set(seen) == {str(phrases.BATCH_BYTES)} and spark.conf.get(key) == before


def test_packed_numbers_and_texts_come_back():
    rng = np.random.default_rng(6)
    for values in ([], [0], [5, 0, 2**62, 7], rng.integers(0, 300, 1000), rng.integers(0, 2**40, 99)):
        values = np.array(values, np.int64)
        assert np.array_equal(phrases._unpacked(phrases._packed(values)), values)
        assert np.array_equal(phrases._unpacked(phrases._packed(np.sort(values), True), True), np.sort(values))
    for keys in ([], ["a"], ["é x", "漢字 und", "a ", "b  c"]):
        assert phrases._heard(phrases._told(pa.array(keys, pa.string()))).to_pylist() == keys


def test_languages_with_blanks_and_few_groups(spark):
    """A word travels with its language as one key."""
    rng = random.Random(7)
    rows = [(t, rng.choice(["", " ", "a b", "b", " b", "\n", "a", "none"])) for t in texts(8)]
    got = sorted(tuple(r) for r in phrases.collocations(frame(spark, rows), **PARAMETERS).collect())
    assert got == by_sql(rows, **PARAMETERS) and got


def test_slices_and_salts_of_the_whole_job(spark, monkeypatch):
    """Many slices, several messages to a group, and answers by place, against the same texts in one slice."""
    rows = [(t, lang) for t in texts(9) for lang in ("en", "de")]
    monkeypatch.setattr(phrases, "HELD", 8)
    monkeypatch.setattr(phrases, "FAN_IN", 3)
    monkeypatch.setattr(phrases, "SLICE", 500)
    got = sorted(tuple(r) for r in phrases.collocations(frame(spark, rows), **PARAMETERS).collect())
    assert got == by_sql(rows, **PARAMETERS) and got


def test_messages_are_small():
    """A pair of a slice was told by 28 bytes, and a word by a row of its own."""
    rng = np.random.default_rng(10)
    codes = np.minimum(rng.zipf(1.3, 200_000), 20_000).astype(np.int64)
    row = {"slice": 3, "codes": phrases._packed(codes), "ids": phrases._packed(np.arange(20_000), True)}
    sent = list(phrases._messages(32, 1)(iter([row])))
    pairs = Counter(zip((codes[:-1] - 1).tolist(), (codes[1:] - 1).tolist()))
    assert sum(len(r[c]) for r in sent for c in "pqn") < 8 * len(pairs)
    assert sum(phrases._unpacked(r["n"]).sum() for r in sent) == len(codes) - 1
    words = pa.array([f"word{i * 7919 % 10_007} en" for i in range(10_000)])
    row = {"slice": 3, "counts": phrases._packed(np.ones(10_000)), **phrases._told(words)}
    sent = list(phrases._word_messages(32, 1, True)(iter([row])))
    assert sum(len(r["data"]) + len(r["sizes"]) + len(r["n"]) for r in sent) < 8 * len(words)
    assert sorted(x for r in sent for x in phrases._heard(r).to_pylist()) == sorted(words.to_pylist())


def test_words_are_not_joined_row_by_row_and_shuffles_end_with_their_step(spark, monkeypatch):
    """Words of slices met the frequent words in a join: a row for each word of each slice."""
    plans, seen, real = [], [], phrases.stored

    def stored(df, name):
        plans.append(df._jdf.queryExecution().toString())
        seen.append(spark.conf.get(phrases.CLEANUP))
        return real(df, name)

    monkeypatch.setattr(phrases, "stored", stored)
    before = spark.conf.get(phrases.CLEANUP)
    phrases.collocations(frame(spark, [(t, "en") for t in texts()]), **PARAMETERS).collect()
    joins = [line for plan in plans for line in plan.splitlines() if "Join" in line]
    assert joins and not [line for line in joins if "word" in line]
    assert set(seen) == {"true"} and spark.conf.get(phrases.CLEANUP) == before
