import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from telemill.llm import language, mixing, pseudonyms
from telemill.llm.common import fold

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage was given and gave."""
    from odd import SF_DIR

    docs, out = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF_DIR).write.parquet(path)
        made = spark.read.parquet(path)
        out[name] = docs, made
        docs = made
    return out


def test_order_and_columns(stages):
    assert list(stages) == ["language_id", "near_duplicates", "pii", "mixing_sources", "best_fit_packing"]
    assert all(made.columns == COLUMNS for name, (_, made) in stages.items() if name != "best_fit_packing")
    assert all(made.count() > 0 for _, made in stages.values())


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_language_stage(stages):
    docs, made = stages["language_id"]
    classifier = language.Classifier(language.learn(docs.where(fold() != 0)))
    want = [r for r in docs.collect() if not classifier.classify(r.text)[2]]
    assert rows_of(made) == sorted(map(str, want))


def test_near_duplicate_stage(stages):
    from test_jaccard import expected

    docs, made = stages["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    first = {i for i, n, c in expected(rows, 5, "0.8") if i == c or not n}
    assert rows_of(made) == sorted(str(r) for r in docs.collect() if r.doc_id in first)
    assert made.count() < docs.count()


def test_pii_stage(stages):
    docs, made = stages["pii"]
    tool = pseudonyms.Pseudonymizer(b"telemill")
    assert {r.doc_id: r.text for r in made.collect()} == {r.doc_id: tool.replace(r.text)[0] for r in docs.collect()}


def test_mixing_stage(stages):
    docs, made = stages["mixing_sources"]
    want = {r.doc_id: r.taken // r["size"] for r in mixing.mix(docs).collect() if r.taken}
    assert {r.doc_id: r["count"] for r in made.groupBy("doc_id").count().collect()} == want


def test_packing_stage(stages):
    from test_packing import check

    docs, made = stages["best_fit_packing"]
    check(made.collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_documents(spark, documents, name):
    from odd import ODD

    stage = dict(corpus_pipeline.STAGES)[name]
    extra = ["lang_pred", "score", "rejected", "d1", "n", "id", "buckets", "pii_kinds", "col", "copies"]
    docs = documents(ODD).select(*COLUMNS, *[F.lit(c).alias(c) for c in extra])
    made = stage(spark, docs, "")
    assert stage(spark, docs.limit(0), "").collect() == []
    assert name == "best_fit_packing" or made.columns == docs.columns
    assert name == "best_fit_packing" or all(r[c] == c for r in made.collect() for c in extra)
    if name == "near_duplicates":
        kept = sorted(((r.doc_id, r.text) for r in made.collect()), key=str)
        rows = list(dict.fromkeys(r for r in ODD if (r[1] or "").split())) + [r for r in ODD if not (r[1] or "").split()]
        assert kept == sorted(rows, key=str)
    elif name == "pii":
        assert made.count() == len(ODD)
    elif name == "mixing_sources":
        assert {r.doc_id for r in made.collect()} <= {i for i, _ in ODD}
    made.collect()


def test_entry_without_the_subpackage(tmp_path):
    """The entry file and all other queries do without it."""
    import subprocess
    import sys

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    for name in os.listdir(root):
        if name in ("__spark_entry__.py", "checks"):
            os.symlink(f"{root}/{name}", tmp_path / name)
    os.mkdir(tmp_path / "telemill")
    for name in os.listdir(f"{root}/telemill"):
        if name != "llm":
            os.symlink(f"{root}/telemill/{name}", tmp_path / "telemill" / name)
    # a copy, as the entry file looks for its package beside itself
    os.unlink(tmp_path / "__spark_entry__.py")
    (tmp_path / "__spark_entry__.py").write_text(open(f"{root}/__spark_entry__.py").read())
    code = "import __spark_entry__ as e; q = e.queries(); assert len(q) > 60 and not any(x.startswith('op') for x in q); assert q.keys() >= e.oracle_sql().keys()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True, timeout=120)
