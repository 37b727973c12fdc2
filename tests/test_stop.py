"""Streams that are asked to stop."""

import logging
import time

import pytest
from shared import GOLDEN, fields_of

import telemill as tm
from telemill.streaming import stop

FILES = 5


@pytest.fixture
def topic(spark, messages, tmp_path):
    folder = str(tmp_path / "topic")

    def publish(n):
        for _ in range(n):
            df = spark.createDataFrame([([GOLDEN["flow"], fields_of("flow", f4="7"), "x"],)], "lines array<string>")
            messages(bytes(tm.encode_segments(df).first().value)).coalesce(1).write.mode("append").parquet(folder)

    publish(FILES)
    publish.more = publish
    publish.folder = folder
    return publish


def run(spark, topic, tmp_path, interval=None, **into):
    stream = tm.read_segment_files(spark, topic.folder, streaming=True, max_files_per_trigger=1)
    into = into or {"path": str(tmp_path / "out")}
    return tm.ingest_stream(stream, "flow", str(tmp_path / "check"), interval=interval, name="drained", **into)


def reports(spark, tmp_path):
    return [r.batch_id for r in tm.read_reports(spark, str(tmp_path / "check")).orderBy("batch_id").collect()]


def counts(spark, tmp_path):
    out = str(tmp_path / "out")
    return tm.read_accepted(spark, out, "flow").count(), tm.read_rejected(spark, out, "flow").count()


def wait_for(condition, seconds=60):
    end = time.time() + seconds
    while not condition() and time.time() < end:
        time.sleep(0.05)
    assert condition()


def test_stopped_half_way_and_started_again(spark, topic, tmp_path, monkeypatch, caplog):
    """The request is there when the second batch ends; the third never begins."""
    mark, write = tmp_path / "check" / stop.MARK, tm.streaming.jobs.write_landing

    def asking(rows, spec, path, rebalance, writer):
        write(rows, spec, path, rebalance, writer)
        if writer.endswith("-000000001"):
            mark.touch()  # as another process would

    monkeypatch.setattr(tm.streaming.jobs, "write_landing", asking)
    with caplog.at_level(logging.INFO, "telemill.streaming"):
        query = run(spark, topic, tmp_path)
        query.awaitTermination()
    assert query.exception() is None and "drained: asked to stop" in caplog.text
    assert reports(spark, tmp_path) == [0, 1] and counts(spark, tmp_path) == (4, 2)
    wait_for(lambda: not mark.exists())
    monkeypatch.undo()

    run(spark, topic, tmp_path).awaitTermination()
    assert reports(spark, tmp_path) == list(range(FILES)) and counts(spark, tmp_path) == (2 * FILES, FILES)


def test_a_waiting_query_is_stopped(spark, topic, tmp_path, monkeypatch):
    monkeypatch.setattr(stop, "POLL_SECONDS", 0.2)
    query = run(spark, topic, tmp_path, interval="1 second")
    wait_for(lambda: len(reports(spark, tmp_path)) == FILES)
    assert query.isActive
    tm.request_stop(spark, str(tmp_path / "check"))
    assert query.awaitTermination(30) and query.exception() is None
    topic.more(1)
    run(spark, topic, tmp_path).awaitTermination()
    assert counts(spark, tmp_path) == (2 * FILES + 2, FILES + 1)


def test_an_old_request_does_not_stop_a_new_start(spark, topic, tmp_path):
    tm.request_stop(spark, str(tmp_path / "check"))
    run(spark, topic, tmp_path).awaitTermination()
    assert counts(spark, tmp_path) == (2 * FILES, FILES)


def test_requests_at_any_time(spark, topic, tmp_path, monkeypatch):
    """Asked again and again: every start ends without an error and in the end every line counts once."""
    monkeypatch.setattr(stop, "POLL_SECONDS", 0.1)
    for delay in (0.3, 0.6, 0.9, 1.2):
        query = run(spark, topic, tmp_path)
        time.sleep(delay)
        tm.request_stop(spark, str(tmp_path / "check"))
        assert query.awaitTermination(60) and query.exception() is None
    run(spark, topic, tmp_path).awaitTermination()
    assert reports(spark, tmp_path) == list(range(FILES)) and counts(spark, tmp_path) == (2 * FILES, FILES)


def test_an_archive_is_stopped(spark, topic, tmp_path, monkeypatch):
    monkeypatch.setattr(stop, "POLL_SECONDS", 0.2)
    stream = tm.read_segment_files(spark, topic.folder, streaming=True, max_files_per_trigger=1)
    check, out = str(tmp_path / "check"), str(tmp_path / "lines")
    query = tm.archive_stream(stream, out, check, interval="1 second")
    wait_for(lambda: (tmp_path / "check" / "commits" / str(FILES - 1)).exists())
    tm.request_stop(spark, check)
    assert query.awaitTermination(30) and query.exception() is None
    assert tm.read_archive(spark, out).count() == 3 * FILES
