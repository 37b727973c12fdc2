import pytest
from odd import ODD, SF_DIR


@pytest.fixture
def documents(spark):
    """A frame of documents with the columns of the table and some whose names operators use themselves."""

    def make(rows=ODD, lang="en", source="s"):
        full = [(i, t, lang, source, None if t is None else len(t), 1.5, "mine", 7) for i, t in rows]
        return spark.createDataFrame(
            full,
            "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, key string, node int",
        )

    return make


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")


@pytest.fixture(scope="session")
def run(spark):
    """Rows of a registered query over the smallest tables."""
    from telemill.llm import queries

    made = {}

    def rows(name):
        if name not in made:
            made[name] = queries.QUERIES[name](spark, SF_DIR).collect()
        return made[name]

    return rows
