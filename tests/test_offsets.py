import json

import pytest
from pyspark.sql import functions as F

import telemill as tm
from telemill.sources import offsets
from telemill.sources.offsets import RANGES


def ranges(spark, *rows):
    return spark.createDataFrame([("t", *r) for r in rows], RANGES)


def listed(df):
    return sorted((r.partition, r.first, r.last) for r in df.collect())


def test_ranges_across_chunks_and_repeats(spark):
    chunk = offsets.CHUNK
    values = [*range(chunk - 3, chunk + 3), chunk + 5, chunk + 5, 2 * chunk, 0, None]
    df = spark.createDataFrame([("t", 0, v) for v in values], "topic string, partition int, offset bigint")
    assert listed(tm.offset_ranges(df)) == [(0, 0, 0), (0, chunk - 3, chunk + 2), (0, chunk + 5, chunk + 5), (0, 2 * chunk, 2 * chunk)]
    assert listed(tm.offset_ranges(df.where("false"))) == []


def test_merge_and_missing(spark):
    covered = ranges(spark, (0, 5, 9), (0, 8, 12), (0, 13, 13), (0, 20, 30), (0, 22, 25), (1, 0, 3), (3, 0, 9))
    assert listed(tm.merge_ranges(covered)) == [(0, 5, 13), (0, 20, 30), (1, 0, 3), (3, 0, 9)]
    wanted = ranges(spark, (0, 0, 40), (1, 1, 2), (2, 7, 8))
    assert listed(tm.missing_offsets(covered, wanted)) == [(0, 0, 4), (0, 14, 19), (0, 31, 40), (2, 7, 8)]
    assert listed(tm.missing_offsets(covered.where("false"), wanted)) == listed(wanted)


def test_missing_equals_brute_force(spark):
    import random

    rng = random.Random(5)
    rows = [(p, a, a + rng.randrange(6)) for p in range(3) for a in rng.sample(range(60), 8)]
    wanted = [(p, 3, 55) for p in range(3)]
    held = {(p, o) for p, a, b in rows for o in range(a, b + 1)}
    want = {(p, o) for p, a, b in wanted for o in range(a, b + 1)} - held
    found = listed(tm.missing_offsets(ranges(spark, *rows), ranges(spark, *wanted)))
    assert {(p, o) for p, a, b in found for o in range(a, b + 1)} == want
    assert all((p, b + 1) not in want for p, _, b in found)


def test_options_take_each_range_once(spark):
    reads = tm.offset_options(ranges(spark, (0, 0, 4), (0, 9, 9), (2, 7, 8)))
    assert [json.loads(r["startingOffsets"]) for r in reads] == [{"t": {"0": 0, "2": 7}}, {"t": {"0": 9}}]
    assert [json.loads(r["endingOffsets"]) for r in reads] == [{"t": {"0": 5, "2": 9}}, {"t": {"0": 10}}]
    assert [json.loads(r["assign"]) for r in reads] == [{"t": [0, 2]}, {"t": [0]}]
    with pytest.raises(ValueError):
        tm.offset_options(ranges(spark, (0, 0, 1)).union(spark.createDataFrame([("u", 0, 0, 1)], RANGES)))


def test_planned_ranges_are_even_and_whole(spark):
    df = spark.range(5000).select(
        F.lit("t").alias("topic"), F.expr("cast(if(id % 10 = 0, 0, 1) as int)").alias("partition"), F.col("id").alias("offset"),
        F.expr("cast(repeat('x', cast(id % 97 as int)) as binary)").alias("value"),
    )
    planned = tm.plan_offsets(df, 25).collect()
    mean = sum(r.bytes for r in planned) / 25
    assert max(r.bytes for r in planned) <= 1.5 * mean and len(planned) <= 27
    assert sum(r.messages for r in planned) == 5000
    for p in (0, 1):
        own = sorted((r.first, r.last) for r in planned if r.partition == p)
        assert all(a[1] < b[0] for a, b in zip(own, own[1:]))
    assert tm.plan_offsets(df.where("false"), 5).collect() == []
