import zlib

import pytest

from telemill.llm import language


def test_odd_documents(documents, table):
    dictionaries = language.learn(table("documents"))
    assert set(dictionaries) == {"de", "en", "es", "fr"}
    assert all(len(d) <= language.DICTIONARY_BYTES + language.SAMPLE_DOCS for d in dictionaries.values())
    docs = documents().withColumnRenamed("key", "rejected")
    found = language.identify(docs, dictionaries)
    assert len(found.columns) == len(docs.columns) + 1
    rows = found.collect()
    assert len(rows) == docs.count()
    for r in rows:
        assert 0 <= r.score <= 1
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in dictionaries
    assert language.identify(documents([]), dictionaries).collect() == []


def test_nothing_to_learn_from(documents):
    assert language.learn(documents([])) == {}
    assert language.learn(documents(lang=None)) == {}
    assert {r.lang_pred for r in language.identify(documents(), {}).collect()} == {"und"}


def test_one_language_and_ties(documents):
    one = language.learn(documents([(1, "some words"), (1, "some words"), (2, None)]))
    (row,) = language.identify(documents([(1, "more words")]), one).collect()
    assert (row.lang_pred, row.rejected) == ("en", False)
    same = {"b": b"words", "a": b"words"}
    (row,) = language.identify(documents([(1, "words")]), same).collect()
    assert (row.lang_pred, row.rejected) == ("a", True)


def test_too_many_languages(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    docs = spark.createDataFrame([(i, "text", f"l{i}") for i in range(6)], "doc_id bigint, text string, lang string")
    with pytest.raises(ValueError):
        language.learn(docs)


def test_held_out_documents(spark):
    from telemill.llm import queries

    sf_dir = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op7_language_id(spark, sf_dir).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r.lang_pred == lang[r.doc_id] for r in rows if r.held_out]
    assert sum(held) / len(held) > 0.97
    assert sum(r.rejected for r in rows) < 0.02 * len(rows)
