import logging
import os

import pytest
from pyspark.sql import functions as F
from shared import GOLDEN, fields_of

import telemill as tm
from telemill.session import scratch_dir


@pytest.fixture
def topic(spark, messages, tmp_path):
    """A folder that plays the topic: every call publishes one more file."""
    folder = str(tmp_path / "topic")

    def publish(*segments, minute=0):
        df = spark.createDataFrame([(i, list(s)) for i, s in enumerate(segments)], "i int, lines array<string>")
        values = [bytes(r.value) for r in tm.encode_segments(df).orderBy("i").collect()]
        messages(*values, minute=minute).coalesce(1).write.mode("append").parquet(folder)

    publish.folder = folder
    publish.stream = lambda: tm.read_segment_files(spark, folder, streaming=True, max_files_per_trigger=1)
    publish.batch = lambda: tm.read_segment_files(spark, folder)
    return publish


def finish(query):
    query.awaitTermination()
    return query


def as_set(df):
    return sorted(map(str, df.collect()))


FLOW = [GOLDEN["flow"], fields_of("flow", f4="7"), "x", fields_of("flow", f0="x")]


def test_stream_equals_batch_and_restart_adds_nothing(spark, topic, tmp_path):
    topic(FLOW[:2], FLOW[2:])
    topic([GOLDEN["flow"]] * 3)
    out, check = str(tmp_path / "out"), str(tmp_path / "check")

    def run():
        return finish(tm.ingest_stream(topic.stream(), "flow", check, path=out, interval=None, name="flows"))

    run()
    report = tm.read_reports(spark, check).orderBy("batch_id").collect()
    assert [r.rows + r.bad_rows for r in report] in ([4, 3], [3, 4])
    classified = tm.classify_messages(topic.batch(), "flow")
    assert as_set(tm.read_accepted(spark, out, "flow")) == as_set(tm.accepted(classified, "flow"))
    assert as_set(tm.read_rejected(spark, out, "flow").drop("y", "m", "d")) == as_set(tm.rejected(classified))

    run()
    assert tm.read_accepted(spark, out, "flow").count() == 5
    topic([GOLDEN["flow"]])
    run()
    assert tm.read_accepted(spark, out, "flow").count() == 6


def test_drop_mode_with_rebalance(spark, topic, tmp_path):
    topic([GOLDEN["proxy"], "", "a b"])
    out = str(tmp_path / "out")
    finish(tm.ingest_stream(topic.stream(), "proxy", str(tmp_path / "check"), path=out, mode="drop", interval=None, rebalance=True))
    rows = tm.read_rows(spark, out, "proxy")
    assert [(r.m, r.h) for r in rows.collect()] == [("01", "00")]


def test_failfast_ends_the_query(topic, tmp_path):
    topic(["x"])
    query = tm.ingest_stream(topic.stream(), "dns", str(tmp_path / "c"), path=str(tmp_path / "o"), mode="failfast", interval=None)
    with pytest.raises(Exception, match="SHORT_ROW"):
        query.awaitTermination()


def test_tables_are_not_filled_twice(spark, topic, tmp_path):
    place = scratch_dir(spark, "stream")
    table, bad = f"rows_{place[-32:]}", f"bad_{place[-32:]}"
    tm.create_table(spark, table, "flow", f"{place}/rows")
    tm.create_quarantine(spark, bad, f"{place}/bad")
    topic(FLOW)
    check = str(tmp_path / "check")

    def run():
        finish(tm.ingest_stream(topic.stream(), "flow", check, table=table, quarantine=bad, interval=None))
        for name in (table, bad):  # the stream has a session of its own
            spark.catalog.refreshTable(name)

    run()
    assert (spark.table(table).count(), spark.table(bad).count()) == (2, 2)
    report = tm.read_reports(spark, check).collect()
    assert [(r.batch_id, r.log_type, r.rows, r.bad_rows) for r in report] == [(0, "flow", 2, 2)]

    # A crash after the writes, before Spark noted the batch: it comes again.
    (tmp_path / "check" / "commits" / "0").unlink()
    (tmp_path / "check" / "commits" / ".0.crc").unlink()
    run()
    assert (spark.table(table).count(), spark.table(bad).count()) == (2, 2)
    topic([GOLDEN["flow"]])
    run()
    assert (spark.table(table).count(), spark.table(bad).count()) == (3, 2)
    topic(["x"])  # a batch without a single row
    run()
    assert (spark.table(table).count(), spark.table(bad).count()) == (3, 3)
    assert tm.read_reports(spark, check).where("min_label is null").count() == 1


def test_archive_stream(spark, topic, tmp_path):
    topic(["a", "b"], ["c"], ["d"])
    topic(["e"], minute=5)
    out = str(tmp_path / "out")
    some = tm.assigned(topic.stream(), [0, 2])
    finish(tm.archive_stream(some, out, str(tmp_path / "check"), interval=None))
    assert sorted((r.segment, r.line) for r in tm.read_archive(spark, out).collect()) == [
        ("202401010000", "a"), ("202401010000", "b"), ("202401010000", "d"), ("202401010005", "e"),
    ]


def test_archive_stream_with_few_files(topic, tmp_path):
    lines = [f"{i:03}" for i in range(500)]
    topic(lines[:300], lines[300:])
    out = tmp_path / "out"
    finish(tm.archive_stream(topic.stream(), str(out), str(tmp_path / "check"), interval=None, rebalance=True))
    (file,) = out.glob("writer=*/segment=202401010000/part*")
    assert sorted(file.read_text().split()) == lines


def test_late_lines_join_their_old_hour(spark, topic, tmp_path):
    out, check = str(tmp_path / "out"), str(tmp_path / "check")
    for day in ("02", "01"):
        topic([fields_of("proxy", f0=f"2024-01-{day}")])
        finish(tm.ingest_stream(topic.stream(), "proxy", check, path=out, mode="drop", interval=None))
    rows = tm.read_rows(spark, out, "proxy").groupBy("d").agg(F.count("*").alias("n"))
    assert {r.d: r.n for r in rows.collect()} == {"01": 1, "02": 1}


def test_batch_logger(spark, topic, tmp_path, caplog):
    listener = tm.BatchLogger("mine")
    spark.streams.addListener(listener)
    try:
        topic(FLOW)
        with caplog.at_level(logging.INFO, "telemill.streaming"):
            for name in ("mine", "other"):
                place = str(tmp_path / name)
                finish(tm.ingest_stream(topic.stream(), "flow", f"{place}/c", path=f"{place}/o", interval=None, name=name))
            spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
            for _ in range(50):
                if "mine: ended" in caplog.text:
                    break
                import time

                time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert "mine: batch 0, netflow segments: 2 rows" in caplog.text and "other: batch 0" in caplog.text
    assert "mine: started" in caplog.text and "mine: ended" in caplog.text
    assert "other: started" not in caplog.text and "other: ended" not in caplog.text


def test_a_renewed_checkpoint_hides_no_row(spark, topic, tmp_path):
    topic(FLOW)
    out = str(tmp_path / "out")
    for i in range(2):
        finish(tm.ingest_stream(topic.stream(), "flow", str(tmp_path / f"check{i}"), path=out, interval=None))
    tm.ingest_batch(topic.batch(), "flow", path=out)
    assert (tm.read_accepted(spark, out, "flow").count(), tm.read_rejected(spark, out, "flow").count()) == (6, 6)


def test_a_batch_that_comes_again_counts_once(spark, topic, tmp_path):
    import shutil

    topic(FLOW)
    out, check = str(tmp_path / "out"), tmp_path / "check"
    for _ in range(2):
        finish(tm.ingest_stream(topic.stream(), "flow", str(check), path=out, interval=None))
        assert tm.read_accepted(spark, out, "flow").count() == 2
        # broken off after the write: neither noted by Spark nor reported
        shutil.rmtree(check / "reports")
        (check / "commits" / "0").unlink()
        (check / "commits" / ".0.crc").unlink()


def test_empty_batches_are_reported(spark, topic, tmp_path, caplog):
    topic([], [])
    check = str(tmp_path / "check")
    with caplog.at_level(logging.INFO, "telemill.streaming"):
        finish(tm.ingest_stream(topic.stream(), "flow", check, path=str(tmp_path / "out"), interval=None, name="empty"))
    assert [(r.rows, r.bad_rows) for r in tm.read_reports(spark, check).collect()] == [(0, 0)]
    assert "empty: batch 0: no new segments" in caplog.text
    assert tm.read_reports(spark, str(tmp_path / "none")).collect() == []


def test_a_batch_from_one_file_is_dealt_over_all_cores_by_time(spark, tmp_path):
    """One task decoded and wrote the whole batch, minute after minute."""
    stamp = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 20).alias("timestamp")
    framed = spark.range(0, 400, numPartitions=1).select(
        F.array(F.concat(F.lit("line "), F.col("id").cast("string"))).alias("lines"), F.lit("t").alias("topic"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"), stamp, F.lit(None).cast("binary").alias("key"),
    )
    tm.encode_segments(framed).write.parquet(f"{tmp_path}/messages")
    stream = tm.read_segment_files(spark, f"{tmp_path}/messages", streaming=True)
    tm.archive_stream(stream, f"{tmp_path}/lines", f"{tmp_path}/check", interval=None).awaitTermination()
    lines = tm.read_archive(spark, f"{tmp_path}/lines")
    assert sorted(r.line for r in lines.collect()) == sorted(f"line {i}" for i in range(400))
    files = [f for _, _, names in os.walk(f"{tmp_path}/lines") for f in names if f.startswith("part-")]
    cores = spark.sparkContext.defaultParallelism
    minutes = lines.select("segment").distinct().count()
    tasks = {f.split("-")[1] for f in files}
    assert min(2, cores) <= len(tasks) <= cores and minutes <= len(files) < minutes + cores
