"""What must hold for the plans if they are to work on far more data."""

import re

import pytest
from checks.recipes import TYPES
from pyspark.sql import functions as F
from shared import GOLDEN

import telemill as tm
from telemill.operators.report import observe_batch
from telemill.sinks.landing import landing_rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "messages")
    framed = spark.range(4).select(
        F.array(F.lit("a"), F.lit("b")).alias("lines"), F.lit("t").alias("topic"), F.lit(0).alias("partition"),
        F.col("id").alias("offset"), F.current_timestamp().alias("timestamp"),
    )
    tm.encode_segments(framed).withColumn("key", F.lit(None).cast("binary")).write.parquet(path)
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def generated_sizes(df):
    text = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "codegen")
    return [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]


def frames(spark, folder, log_type):
    messages = tm.read_segment_files(spark, folder)
    classified = tm.classify_messages(messages, log_type)
    return {
        "classify": classified,
        "drop": tm.accepted(classified, log_type),
        "failfast": tm.accepted(classified, log_type, "failfast"),
        "quarantine": tm.rejected(classified),
        "landing": landing_rows(classified, log_type),
        "observed landing": landing_rows(observe_batch(classified, log_type, "m"), log_type),
    }


@pytest.mark.parametrize("log_type", TYPES)
def test_one_pass(spark, folder, log_type):
    cutter = "regexp_extract_all(" if log_type == "proxy" else "split("
    for name, df in frames(spark, folder, log_type).items():
        text = plan(df)
        assert "Exchange" not in text, name
        assert text.count("ArrowEvalPython [") == 1, name
        assert text.count(cutter) == 1, name


@pytest.mark.parametrize("log_type", TYPES)
def test_generated_methods_are_small_enough_for_the_jvm_to_compile(spark, folder, log_type):
    for name, df in frames(spark, folder, log_type).items():
        sizes = generated_sizes(df)
        assert sizes and max(sizes) < 8000, (name, sizes)


def test_scan_reads_what_is_used(spark, folder):
    rows = tm.normalize(tm.explode_lines(tm.decode_segments(tm.read_segment_files(spark, folder))), "flow")
    assert "ReadSchema: struct<value:binary>" in plan(rows)
    some = tm.decode_segments(tm.assigned(tm.read_segment_files(spark, folder), [0]))
    assert "PushedFilters: [IsNotNull(partition), EqualTo(partition,0)]" in plan(some)


def test_landing_reads_prune(spark, tmp_path):
    path = str(tmp_path / "landing")
    df = spark.createDataFrame([(GOLDEN["proxy"],), ("x y",)], "line string")
    tm.write_landing(tm.classify(df, "proxy"), "proxy", path)
    rows = tm.read_accepted(spark, path, "proxy").where("h = '00'").select("host")
    text = plan(rows)
    assert re.search(r"PartitionFilters: \[.*status.* = ok.*h#\d+ = 00", text)
    assert "ReadSchema: struct<host:string>" in text
    assert rows.count() == 1


def test_packing_shuffles_once(spark):
    df = spark.range(1000).select("id", F.col("id").cast("string").alias("line"))
    assert plan(tm.pack_segments(df, 50, pos="id")).count("Exchange hashpartitioning") == 1
