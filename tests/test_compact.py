from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from shared import GOLDEN, fields_of

import telemill as tm
from telemill.llm.common import setting
from telemill.sinks import compact


@pytest.fixture
def landing(spark, lines, tmp_path):
    path = str(tmp_path / "landing")
    for i in range(4):
        day = [fields_of("flow", f0=f"2024-01-0{d} 00:03:5{i}", f3=str(d)) for d in (1, 2)] + ["x"]
        rows = tm.classify(lines(*day), "flow").withColumn("timestamp", F.timestamp_seconds(F.lit(1704067200)))
        tm.write_landing(rows, "flow", path, writer=f"batch-{i}")
    return path


def rows_of(spark, path):
    good, bad = tm.read_accepted(spark, path, "flow"), tm.read_rejected(spark, path, "flow")
    return sorted(map(str, good.collect())), sorted(map(str, bad.collect()))


def files(spark, path):
    return tm.read_accepted(spark, path, "flow").select("_metadata.file_path").distinct().count()


def test_closed_days_have_one_file_an_hour(spark, landing):
    before = rows_of(spark, landing)
    days = {r.d: (r.open, r.files, r.files_after) for r in tm.compact_days(spark, landing, "flow").collect()}
    assert days == {1: (False, 8, 2), 2: (False, 4, 1)}
    assert rows_of(spark, landing) == before and files(spark, landing) == 2
    again = tm.compact_days(spark, landing, "flow").collect()
    assert all(r.files == r.files_after for r in again) and rows_of(spark, landing) == before


def test_files_are_gathered_up_to_the_target(spark, landing):
    size = tm.read_accepted(spark, landing, "flow").agg(F.max("_metadata.file_size")).first()[0]
    tm.compact_days(spark, landing, "flow", target_bytes=2 * size - 10)
    assert files(spark, landing) == 4


def test_days_of_unfinished_batches_stay(spark, landing, lines, tmp_path):
    late = tm.classify(lines(fields_of("flow", f0="2024-01-02 00:00:01", f3="2")), "flow")
    tm.write_landing(late, "flow", landing, writer=f"stream-{'0' * 32}-000000007")
    days = {r.d: r.open for r in tm.compact_days(spark, landing, "flow").collect()}
    assert days == {1: False, 2: True} and files(spark, landing) == 1 + 5


@pytest.mark.parametrize("broken", ["write", "remove", "rename", "clear"])
def test_a_compaction_that_broke_off_is_finished(spark, landing, monkeypatch, broken):
    before = rows_of(spark, landing)
    folder = compact._Folder

    def fail(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched:
        if broken == "write":
            read = compact._read
            patched.setattr(compact, "_read", lambda s, p, t: fail() if compact.STAGED in p else read(s, p, t))
        if broken == "remove":
            kept, real = [], folder.remove_file
            patched.setattr(folder, "remove_file", lambda self, uri: fail() if len(kept) > 2 else (kept.append(1), real(self, uri)))
        if broken == "rename":
            patched.setattr(folder, "rename", fail)
        if broken == "clear":
            patched.setattr(folder, "remove", fail)
        with pytest.raises(KeyboardInterrupt):
            tm.compact_days(spark, landing, "flow")
    tm.finish_compaction(spark, landing)
    assert rows_of(spark, landing) == before
    tm.compact_days(spark, landing, "flow")
    assert rows_of(spark, landing) == before and files(spark, landing) == 2
    assert not compact._Folder(spark, landing).names("_compact-*")


def test_replay_writes_one_file_an_hour(spark, messages, tmp_path):
    path = str(tmp_path / "landing")
    rows = [(["x"],) for _ in range(64)]
    values = [bytes(r.value) for r in tm.encode_segments(spark.createDataFrame(rows, "lines array<string>")).collect()]
    tm.ingest_batch(messages(*values), "flow", path=path, rebalance=True)
    spec = tm.resolve("flow")
    lax = replace(spec, min_fields=0, outputs=tuple(
        replace(o, rule=f"cast(null as {o.type})", checked=False) if o.name not in "ymdh" else replace(o, rule="'1'") for o in spec.outputs
    ), clock=lambda r: F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    before = files(spark, path)
    with setting(spark, "spark.sql.adaptive.coalescePartitions.enabled", "false"):  # as if every task had many rows
        assert tm.replay_quarantine(spark, path, lax) == 64
    assert files(spark, path) == before + 1


def test_nothing_to_shuffle_is_counted_too(spark, messages, tmp_path):
    report = tm.ingest_batch(messages(b"").where("false"), "flow", path=str(tmp_path / "landing"), rebalance=True)
    assert set(report.values()) <= {"flow", 0, None}


def test_replay_promotes_each_line_once(spark, messages, tmp_path):
    path = str(tmp_path / "landing")
    df = spark.createDataFrame([([fields_of("flow", f4="7"), GOLDEN["flow"], "x", fields_of("flow", f4="7")],)], "lines array<string>")
    topic = messages(bytes(tm.encode_segments(df).first().value), b"\x00\x02")
    for _ in range(2):  # a renewed checkpoint rejects the same lines again
        tm.ingest_batch(topic, "flow", path=path)
    pending = tm.pending_rejects(spark, path, "flow").count()
    assert pending == 1  # `x`, and not the message that could not be decoded
    assert tm.replay_quarantine(spark, path, "flow") == 0  # the rule has not changed
    lax = replace(tm.resolve("flow"), min_fields=0, outputs=tuple(
        replace(o, rule=f"cast(null as {o.type})", checked=False) if o.name not in "ymdh" else replace(o, rule="'1'") for o in tm.resolve("flow").outputs
    ), clock=lambda r: F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    before = tm.read_accepted(spark, path, "flow").count()
    assert tm.replay_quarantine(spark, path, lax) == pending
    assert tm.replay_quarantine(spark, path, lax) == 0
    assert tm.read_accepted(spark, path, "flow").count() == before + pending
    assert tm.pending_rejects(spark, path, "flow").count() == 0
