import pytest
from pyspark.sql import functions as F

import telemill as tm
from telemill.sinks.topic import COLUMNS, kafka_sink_options


@pytest.fixture
def sources(spark):
    """900 lines of `hot`, 50 each of `a` and of no source, in messages of five."""
    rows = [("hot", i) for i in range(900)] + [(s, i) for s in ("a", None) for i in range(50)]
    lines = spark.createDataFrame(rows, "source string, pos int").withColumn("line", F.format_string("%s %04d", "source", "pos"))
    return lines, tm.pack_segments(lines, 5, pos="pos", by=["source"])


def read_back(messages):
    found = tm.explode_lines(tm.decode_segments(messages))
    return sorted(r.line for r in found.select("line").collect())


def test_wide_sources(sources):
    _, packed = sources
    widths = {r.source: r.width for r in tm.topic_widths(packed, ["source"], 8).collect()}
    assert widths.keys() == {'{"source":"hot"}'} and widths['{"source":"hot"}'] in (7, 8)
    assert tm.topic_widths(packed, ["source"], 1).isEmpty()
    assert tm.topic_widths(packed.where("false"), ["source"], 8).isEmpty()


def test_sources_and_partitions(sources):
    lines, packed = sources
    sent = tm.to_topic(packed, "t", 8, by=["source"], bucket="bucket")
    assert sent.columns == list(COLUMNS) and dict(sent.dtypes)["partition"] == "int"
    key = F.col("key").cast("string").alias("key")
    places = {r.key: (r.n, r.low, r.high, r.most) for r in sent.groupBy(key, "partition").count().groupBy("key").agg(
        F.count("*").alias("n"), F.min("partition").alias("low"), F.max("partition").alias("high"), F.max("count").alias("most")
    ).collect()}
    assert {k: v[0] > 1 for k, v in places.items()} == {'{"source":"hot"}': True, '{"source":"a"}': False, '{"source":null}': False}
    assert all(0 <= low and high < 8 for _, low, high, _ in places.values())
    assert places['{"source":"hot"}'][3] <= 180 / 7 + 1  # dealt in turns
    assert read_back(sent) == sorted(r.line for r in lines.collect() if r.line is not None)
    again = tm.to_topic(packed.repartition(5), "t", 8, by=["source"], bucket="bucket")
    assert sorted(map(str, again.collect())) == sorted(map(str, sent.collect()))


def test_without_source_or_bucket(sources):
    _, packed = sources
    dealt = tm.to_topic(packed, "t", 4, bucket="bucket")
    assert dealt.where("key is not null").isEmpty()
    assert [r["count"] for r in dealt.groupBy("partition").count().orderBy("partition").collect()] == [51, 51, 49, 49]  # 180, 10 and 10 dealt in turns of four
    hashed = tm.to_topic(packed, "t", 4, by=["source"])
    assert hashed.select("partition").distinct().count() == 4
    assert tm.to_topic(packed.where("false"), "t", 4, by=["source"]).isEmpty()
    with pytest.raises(ValueError):
        tm.to_topic(packed, "t", 0)


def test_widths_are_broadcast(sources):
    _, packed = sources
    plan = tm.to_topic(packed, "t", 8, by=["source"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_files_batch_and_stream(spark, sources, tmp_path):
    lines, packed = sources
    wanted = sorted(r.line for r in lines.collect() if r.line is not None)
    sent = tm.to_topic(packed, "t", 8, by=["source"], bucket="bucket")
    path, again, check = (str(tmp_path / n) for n in ("topic", "again", "check"))
    for _ in range(2):
        tm.write_segment_files(sent, path, run="r")
    assert read_back(tm.read_segment_files(spark, path)) == wanted

    def forward():
        stream = tm.read_segment_files(spark, path, streaming=True, max_files_per_trigger=2)
        source = stream.select(F.get_json_object(F.col("key").cast("string"), "$.source").alias("source"), "value")
        widths = tm.topic_widths(packed, ["source"], 8)
        keyed = tm.to_topic(source, "u", 8, by=["source"], widths=widths)
        tm.write_segment_files(keyed, again, check).awaitTermination()

    forward()
    forward()
    copied = tm.read_segment_files(spark, again)
    assert read_back(copied) == wanted
    assert {r.topic for r in copied.select("topic").distinct().collect()} == {"u"}
    assert copied.where("key = cast('{\"source\":\"hot\"}' as binary)").select("partition").distinct().count() > 1
    with pytest.raises(ValueError):
        tm.write_segment_files(tm.read_segment_files(spark, path, streaming=True), again)


def test_options():
    assert kafka_sink_options(["a:1", "b:2"], **{"kafka.acks": 1, "includeHeaders": "false"}) == {
        "kafka.bootstrap.servers": "a:1,b:2", "kafka.acks": "1", "kafka.enable.idempotence": "true", "includeHeaders": "false",
    }
