import glob

import pytest
from pyspark.sql import functions as F
from shared import GOLDEN, fields_of

import telemill as tm
from telemill.session import scratch_dir
from telemill.sinks.files import stream_writer


@pytest.fixture
def segment_of(spark, messages):
    def make(*segments, **options):
        df = spark.createDataFrame([(i, list(s)) for i, s in enumerate(segments)], "i int, lines array<string>")
        values = [bytes(r.value) for r in tm.encode_segments(df).orderBy("i").collect()]
        return messages(*values, **options)

    return make


@pytest.fixture
def tables(spark):
    made = []

    def make(log_type):
        place = scratch_dir(spark, log_type)
        names = f"rows_{place[-32:]}", f"bad_{place[-32:]}"
        tm.create_table(spark, names[0], log_type, f"{place}/rows")
        tm.create_quarantine(spark, names[1], f"{place}/bad")
        made.extend(names)
        return names

    yield make
    for name in made:
        spark.sql(f"DROP TABLE {name}")


def test_insert_goes_by_position(spark, lines, tables):
    table, _ = tables("flow")
    tm.create_table(spark, table, "flow")  # already there: nothing happens
    rows = tm.normalize(lines(GOLDEN["flow"]), "flow")
    tm.write_table(rows.select(*reversed(rows.columns)), table, "flow")
    tm.write_table(rows, table, "flow", rebalance=True)
    assert [tuple(r) for r in spark.table(table).collect()] == [tuple(rows.first())] * 2
    assert spark.sql(f"SHOW PARTITIONS {table}").first()[0] == "y=2024/m=1/d=1/h=0"


def test_batch_to_tables(spark, segment_of, tables):
    table, bad = tables("ids_packet")
    df = segment_of([GOLDEN["ids_packet"], "x"], [GOLDEN["ids_packet"]])
    report = tm.ingest_batch(df, "ids_packet", table=table, quarantine=bad)
    assert report == {"log_type": "ids_packet", "rows": 2, "bad_rows": 1, "dropped_rows": 0,
                      "min_label": 1704067456.0, "max_label": 1704067456.0}
    assert spark.table(table).count() == 2
    rejects = spark.table(bad).withColumn("day", F.col("day").cast("string")).drop("timestamp").collect()
    assert [tuple(r) for r in rejects] == [("x", "SHORT_ROW", "t", 0, 0, 1, "2024-01-01")]
    assert spark.table(bad).where("timestamp is null").count() == 0


def test_batch_to_landing(spark, segment_of, tmp_path):
    path = str(tmp_path / "landing")
    df = segment_of([GOLDEN["proxy"], "", fields_of("proxy", f2="x")], [fields_of("proxy", f0="2024-07-01", f1="01:02:03")])
    report = tm.ingest_batch(df, "proxy", path=path)
    assert (report["rows"], report["bad_rows"], report["dropped_rows"]) == (2, 1, 1)
    rows = tm.read_accepted(spark, path, "proxy").orderBy("p_date").collect()
    assert [(r.y, r.m, r.d, r.h) for r in rows] == [("2024", "01", "01", "00"), ("2024", "07", "01", "01")]
    assert tm.read_accepted(spark, path, "proxy").schema == tm.resolve("proxy").schema
    bad = tm.read_rejected(spark, path, "proxy").collect()
    assert [(r.reason, r.topic, r.offset, r.pos) for r in bad] == [("BAD_VALUE:duration", "t", 0, 2)]


def test_batch_modes(spark, segment_of, tmp_path):
    df = segment_of([GOLDEN["dns"], "x"])
    report = tm.ingest_batch(df, "dns", path=str(tmp_path / "rows"), mode="drop", rebalance=True)
    assert (report["rows"], report["bad_rows"]) == (1, 1)
    assert tm.read_rows(spark, str(tmp_path / "rows"), "dns").count() == 1
    with pytest.raises(Exception, match="SHORT_ROW at t 0 0 1"):
        tm.ingest_batch(df, "dns", path=str(tmp_path / "strict"), mode="failfast")


@pytest.mark.parametrize(
    "target",
    [{}, {"path": "p", "table": "t"}, {"table": "t"}, {"table": "t", "mode": "drop", "quarantine": "q"},
     {"path": "p", "quarantine": "q"}, {"path": "p", "mode": "ignore"}],
)
def test_unclear_targets(segment_of, target):
    with pytest.raises(ValueError):
        tm.ingest_batch(segment_of([GOLDEN["dns"]]), "dns", **target)


def test_archive_adds_up_and_keeps_order(spark, segment_of, messages, tmp_path):
    path = str(tmp_path / "archive")
    tm.archive_segments(segment_of(["b", "a"], ["c", "", "a"]).coalesce(1), path)
    tm.archive_segments(segment_of(["z"]).unionByName(messages(b"\x00\x02", bytes.fromhex("02"))), path)
    tm.archive_segments(segment_of(["later"], minute=1), path)
    out = tm.read_archive(spark, path)
    assert sorted((r.segment, r.line) for r in out.collect()) == sorted(
        [("202401010000", x) for x in ["b", "a", "c", "", "a", "z"]] + [("202401010001", "later")]
    )
    contents = [open(f).read() for f in glob.glob(f"{path}/writer=*/segment=202401010000/part*")]
    assert "b\na\nc\n\na\n" in contents

    together = str(tmp_path / "together")
    both = segment_of(["b", "a"], ["c", "", "a"]).unionByName(segment_of(["later"], minute=1)).repartition(4)
    tm.archive_segments(both, together, rebalance=True)
    (file,) = glob.glob(f"{together}/writer=*/segment=202401010000/part*")
    assert open(file).read() == "b\na\nc\n\na\n"


def test_hot_hour_is_split(spark, tmp_path):
    path = tmp_path / "hot"
    hot = spark.range(0, 4000, numPartitions=16).select(F.concat(F.lit(GOLDEN["flow"] + ","), F.sha2(F.col("id").cast("string"), 256)).alias("line"))
    rows = tm.classify(hot.withColumn("line", F.regexp_replace("line", "0.0.0.0,", "")), "flow")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20000")
    try:
        tm.write_landing(rows, "flow", str(path), rebalance=True)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list(path.glob("writer=*/**/h=0/*.parquet"))) > 4  # pieces of 20,000 bytes, however many cores there are
    assert tm.read_accepted(spark, str(path), "flow").count() == 4000


def test_single_line_messages_with_carriage_returns(spark, segment_of, tmp_path):
    path = str(tmp_path / "returns")
    lines = [f"a\r{i}\r" for i in range(20)]
    tm.archive_segments(segment_of(*[[x] for x in lines]), path, rebalance=True)
    assert sorted(r.line for r in tm.read_archive(spark, path).collect()) == sorted(lines)


def test_a_named_job_that_died_is_replaced_by_its_rerun(spark, segment_of, tmp_path):
    path = tmp_path / "landing"
    df = segment_of([GOLDEN["flow"], fields_of("flow", f4="7"), "x"])
    tm.ingest_batch(df, "flow", path=str(path), run="other")
    tm.ingest_batch(df, "flow", path=str(path), run="july")
    # killed in its commit: one folder was moved into place, the mark of success was not written
    folder = path / "writer=batch-july"
    (folder / "_SUCCESS").unlink()
    for file in folder.glob("status=bad/**/*.parquet"):
        file.unlink()
    assert tm.read_rejected(spark, str(path), "flow").count() == 1
    for _ in range(2):
        tm.ingest_batch(df, "flow", path=str(path), run="july")
        assert tm.read_accepted(spark, str(path), "flow").count() == 4
        assert tm.read_rejected(spark, str(path), "flow").count() == 2
    with pytest.raises(ValueError):
        tm.ingest_batch(df, "flow", table="t", mode="drop", run="july")


def test_reads_prune_below_the_writers(spark, segment_of, tmp_path):
    path = str(tmp_path / "landing")
    for hour in ("00", "01", "02"):
        tm.ingest_batch(segment_of([fields_of("proxy", f1=f"{hour}:00:00")]), "proxy", path=path)
    one = tm.read_accepted(spark, path, "proxy").where("h = '01'")
    assert len(one.inputFiles()) >= 1 and one.count() == 1
    one.collect()
    scan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "h#" in scan.split("PartitionFilters: [")[1].split("]")[0]
    assert one.select("_metadata.file_path").collect()[0][0].count("/h=01/") == 1


def test_a_broken_first_write_of_the_writers_id(spark, tmp_path):
    (tmp_path / "telemill").mkdir()
    first = stream_writer(spark, str(tmp_path))
    assert first.startswith("stream-") and stream_writer(spark, str(tmp_path)) == first
