"""From documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir), works on all rows of `docs` and returns the columns of documents; the last
returns the pieces of packed sequences. `run` writes each stage's rows as Parquet and reads them again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telemill.llm import jaccard, language, mixing, packing, pseudonyms
from telemill.llm.common import fold
from telemill.llm.queries import KEY
from telemill.session import scratch_dir


def aside(docs: DataFrame, *taken: str) -> DataFrame:
    """`docs` with its columns that have names which a stage uses itself renamed."""
    return docs.withColumnsRenamed({c: f"{c} kept" for c in docs.columns if c.lower() in taken})


def restored(made: DataFrame, docs: DataFrame, *taken: str) -> DataFrame:
    """The columns of `docs` again, after `aside`."""
    return made.select(*[F.col(f"`{c} kept`").alias(c) if c.lower() in taken else F.col(f"`{c}`") for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents whose language cannot be told: null, empty and letterless texts, and narrow margins."""
    dictionaries = language.learn(docs.where(fold() != 0))
    taken = ("lang_pred", "score", "rejected")
    return restored(language.identify(aside(docs, *taken), dictionaries).where("not rejected"), docs, *taken)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group: that with the smallest id, and of repeated rows one.

    Two documents link at a similarity of 0.8 or more between their sets of five-word shingles. Documents without words
    link with nothing and stay, repeated ones too.
    """
    grouped = jaccard.near_duplicates(docs.select("doc_id", "text"), width=5, similarity="0.8")
    stands = F.min(F.struct(F.coalesce("doc_id", F.lit(jaccard.NO_ID)).alias("id"), "digest")).alias("stands")
    chosen = grouped.where("n_shingles > 0").groupBy("component").agg(stands)
    chosen = chosen.selectExpr("stands.id as id", "stands.digest[0] as c1", "stands.digest[1] as c2")
    taken = ("n_shingles", "d1", "d2", "buckets", "id", "c1", "c2", "n")
    marked = jaccard.sketches(aside(docs, *taken), 5, keep_text=True)
    same = F.expr(f"coalesce(doc_id, {jaccard.NO_ID}) = id and d1 = c1 and d2 = c2")
    worded = marked.where("n_shingles > 0").join(chosen, same, "left_semi")
    # rows of one id with equal sets: one stays
    once = Window.partitionBy("doc_id", "d1", "d2").orderBy(F.xxhash64("text", "lang", "source"), "text")
    worded = worded.withColumn("n", F.row_number().over(once)).where("n = 1")
    return restored(worded, docs, *taken).unionByName(restored(marked.where("n_shingles = 0"), docs, *taken))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by pseudonyms; `n_chars` stays right, as formats do."""
    return restored(pseudonyms.pseudonymize(aside(docs, "pii_kinds"), KEY), docs, "pii_kinds")


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and leaves out documents as the mix takes them; a document appears as often as it is taken.

    Rows that repeat id, source and text share evenly in what the mix takes of them, in whole copies rounded up.
    """
    mixed = mixing.mix(docs).where("taken > 0")
    copies = mixed.groupBy("doc_id", "source", "digest").agg(
        F.ceil(F.sum(F.expr("taken div size")) / F.count(F.lit(1))).cast("int").alias("copies")
    )
    copies = copies.select(*[F.col(c).alias(f"mixed_{c}") for c in copies.columns])
    same = F.expr("doc_id <=> mixed_doc_id and source <=> mixed_source and xxhash64(text) = mixed_digest")
    copy = F.explode(F.expr("sequence(1, mixed_copies)")).alias("mixed_copy")
    return docs.join(copies, same).select(*[F.col(f"`{c}`") for c in docs.columns], copy).drop("mixed_copy")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the documents into sequences of at most 2048 tokens; a row per piece."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("pii", pii),
    ("mixing_sources", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Compression, component search and tokenization cannot be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
