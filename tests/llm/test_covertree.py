import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from telemill.llm import covertree, queries


def points_of(node):
    yield node
    for child in node.children:
        yield from points_of(child)


def test_trees_cover_and_separate():
    rng = np.random.default_rng(1)
    x = np.concatenate([c + rng.normal(size=(300, 5)) * 0.1 for c in rng.normal(size=(6, 5)) * 10])
    root = covertree.build(x)
    assert root.children
    for node in points_of(root):
        apart = np.linalg.norm(x[node.points] - x[node.centre], axis=1)
        assert apart.max() <= node.radius + 1e-9
        if node.children:
            assert sorted(np.concatenate([c.points for c in node.children])) == sorted(node.points)
            centres = x[[c.centre for c in node.children]]
            far = np.linalg.norm(centres[:, None] - centres[None], axis=2)[np.triu_indices(len(centres), 1)]
            assert (far > node.radius / covertree.SHRINK).all()


def expected(rows, k):
    kept = [
        (i, [math.floor(64 * x) for x in v]) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = set()
    for q, v in kept:
        if q is None or q % 20:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), i) for i, w in kept if i != q and len(w) == len(v)]
        scored.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out |= {(q, n + 1, i, s) for n, (s, i) in enumerate(scored[:k])}
    return out


def searched(spark, rows, k=20):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumn("score", F.lit("x"))
    return [tuple(r) for r in covertree.top_k(df, F.col("vec_id") % 20 == 0, k).collect()]


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.5, -0.25 * (i % 3), 1.0]) for i in range(60)]  # many ties
    rows += [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [nan, 1.0, 1.0]), (120, [inf, 1.0, 1.0])]
    rows += [(140, [1.0, 2.0]), (141, [3.0, 4.0]), (None, [9.0, 9.0, 9.0]), (160, [0.0, 0.0, 0.0])]
    got = searched(spark, rows)
    assert set(got) == expected(rows, 20) and len(got) == len(set(got))
    assert searched(spark, []) == []
    assert searched(spark, [(1, [1.0])]) == []
    with pytest.raises(Exception, match="not exact"):
        searched(spark, [(0, [1e30]), (1, [1e30])])


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_pruned_search_is_exact(spark, monkeypatch, spread):
    monkeypatch.setattr(covertree, "VECTORS", 300)
    monkeypatch.setattr(covertree, "QUERIES", 30)
    monkeypatch.setattr(covertree, "LEAF", 8)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(8, 6)) * 4
    rows = [(i, (centres[i % 8] + rng.normal(size=6) * spread).tolist()) for i in range(1500)]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    assert set(searched(spark, rows, 7)) == expected(rows, 7)


def test_pruning_leaves_out_most_of_clustered_vectors():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 8)) * 100
    c = np.floor(np.repeat(centres, 200, axis=0) + rng.normal(size=(4000, 8)))
    q = np.floor(np.repeat(centres[:5], 40, axis=0) + rng.normal(size=(200, 8)))
    search = covertree.Search(q, c, np.full(200, -1), 10)
    scored = []
    whole = search.score
    search.score = lambda a, b: (scored.append(len(a) * len(b)), whole(a, b))
    search.run()
    assert sum(scored) < 0.6 * len(q) * len(c)


def test_queries_that_share_an_id_have_one_list(spark):
    rows = [(i, [float(i), 1.0]) for i in range(1, 31)] + [(40, [1.0, 50.0]), (40, [-2.0, 0.5])]
    duck = duckdb.connect()
    duck.execute("create table embeddings (vec_id bigint, embedding float[])")
    duck.executemany("insert into embeddings values (?, ?)", rows)
    want = duck.execute(queries.ORACLE_SQL["op8_exact_top_k"]).fetchall()
    assert sorted(searched(spark, rows)) == sorted(want)
    assert sorted(r[1] for r in want if r[0] == 40) == list(range(1, 21))


def test_query(run, table):
    rows = [(r.vec_id, r.embedding) for r in table("embeddings").collect()]
    got = {tuple(r) for r in run("op8_exact_top_k")}
    assert got == expected(rows, 20)
    duck = duckdb.connect()
    from odd import SF_DIR

    duck.execute(f"create view embeddings as select * from '{SF_DIR}/embeddings.parquet'")
    assert set(duck.execute(queries.ORACLE_SQL["op8_exact_top_k"]).fetchall()) == got
