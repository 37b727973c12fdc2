import itertools
import zlib

import numpy as np

from telemill.llm import crf


def test_marginals_equal_those_of_all_labelings():
    rng = np.random.default_rng(1)
    chain = crf.Chain(np.zeros(1), np.ones(1), 0.5)
    chain.move, chain.first = rng.normal(size=(2, 2)), rng.normal(size=2)
    places = np.array([0, 4, 4, 5, 8])
    emissions = rng.normal(size=8)
    forward, backward, good = chain.marginals(emissions, places)
    inner = np.ones(8, bool)
    inner[[0, 4, 5]] = False
    pairs = np.zeros((2, 2))
    for a, b in zip(places, places[1:]):
        total, sums, seen = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for labels in itertools.product((0, 1), repeat=b - a) if b > a else ():
            score = chain.first[labels[0]] + sum(emissions[a + i] * y for i, y in enumerate(labels))
            score += sum(chain.move[x, y] for x, y in zip(labels, labels[1:]))
            w = np.exp(score)
            total += w
            sums += w * np.array(labels)
            for x, y in zip(labels, labels[1:]):
                seen[x, y] += w
        if b > a:
            assert np.allclose(good[a:b], sums / total)
            pairs += seen / total
    assert np.allclose(chain.pairs(emissions, forward, backward, inner), pairs.ravel())


def test_neighbouring_lines_are_features():
    data = b"first line here\n\nsecond | line |\n"
    features, lengths, places = crf.line_features(np.frombuffer(data, np.uint8), np.array([0, len(data), len(data)]))
    assert features.shape == (2, 3 * crf.OWN) and places.tolist() == [0, 2, 2]
    assert (features[0, 2 * crf.OWN :] == features[1, : crf.OWN]).all()
    assert (features[1, crf.OWN : 2 * crf.OWN] == features[0, : crf.OWN]).all()
    assert (features[0, crf.OWN : 2 * crf.OWN] == 0).all() and lengths.tolist() == [16, 16]


def test_odd_documents(spark, documents, table):
    labels = table("labels")
    chain = crf.learn(table("documents"), labels)
    docs = documents()
    scored = crf.score(docs, chain)
    assert sorted(scored.columns) == sorted(docs.columns) and scored.count() == docs.count()
    assert all(0 <= r.score <= 1 for r in scored.collect())
    blank = {r.score for r in scored.where("doc_id <= 3").collect()}
    assert blank == {chain.prior}
    assert crf.score(documents([]), chain).collect() == []
    untaught = crf.learn(documents([]), labels.limit(0))
    assert {r.score for r in crf.score(documents([(1, "a b")]), untaught).collect()} == {0.5}
    odd_labels = spark.createDataFrame([(4, 1), (4, None), (None, 0), (5, 0), (5, 0), (99, 1)], "doc_id bigint, quality int")
    assert 0 <= crf.score(documents(), crf.learn(documents(), odd_labels)).first().score <= 1


def test_held_out_documents(spark):
    from telemill.llm import queries

    sf_dir = "/root/testdata/sf0.01"
    rows = queries.op4_line_crf_quality(spark, sf_dir).collect()
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, quality[r.doc_id]) for r in rows if r.held_out and r.doc_id in quality]
    assert sum(a == b for a, b in held) / len(held) > 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in rows)
