import random
import tracemalloc

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException, SparkRuntimeException
from pyspark.sql import functions as F

import telemill as tm
from telemill.functions import avro
from telemill.functions.avro import decode_batch, segment_lines
from telemill.operators import envelope
from telemill.operators.rank import running_rank

GOLDEN = [
    (["ab", "é", ""], "00 06 04 6162 04 c3a9 00 00"),
    ([], "00 00"),
    (None, "02"),
    (["x" * 70], "00 02 8c01" + "78" * 70 + "00"),
]

BROKEN = {
    "null value": None,
    "empty value": b"",
    "cut in a line": bytes.fromhex("00020661"),
    "no end": bytes.fromhex("00020261"),
    "bad utf-8": bytes.fromhex("000202ff00"),
    "branch 5": bytes.fromhex("0a00"),
    "negative length": bytes.fromhex("00020100"),
    "endless number": b"\x00" + b"\xff" * 12,
}

UNUSUAL = {
    "count with byte size": ("0001 04 0261 00", ["a"]),
    "several blocks": ("00 02 0261 04 0262 0263 00", ["a", "b", "c"]),
    "trailing bytes": ("00 02 0261 00 ffff", ["a"]),
}


def test_encode_golden_bytes(spark):
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(GOLDEN)], "i int, lines array<string>")
    out = {r.i: bytes(r.value) for r in tm.encode_segments(df).collect()}
    assert out == {i: bytes.fromhex(h) for i, (_, h) in enumerate(GOLDEN)}


def test_null_line_has_no_encoding(spark):
    df = spark.createDataFrame([(["a", None],)], "lines array<string>")
    assert tm.encode_segments(df).first().value is None


def test_decode_golden_and_unusual(messages):
    cases = [(x, bytes.fromhex(h)) for x, h in GOLDEN] + [(x, bytes.fromhex(h)) for h, x in UNUSUAL.values()]
    out = tm.decode_segments(messages(*[v for _, v in cases])).orderBy("offset").collect()
    assert [r.lines for r in out] == [x for x, _ in cases]
    assert [r.envelope for r in out] == [None if x is not None else "NULL_ENVELOPE" for x, _ in cases]


def test_decode_broken(messages):
    out = tm.decode_segments(messages(*BROKEN.values(), bytes.fromhex("0002026100"))).orderBy("offset").collect()
    assert [r.envelope for r in out] == ["BAD_ENVELOPE"] * len(BROKEN) + [None]
    assert out[-1].lines == ["a"]
    assert [r.raw for r in out[:-1]] == [v.hex().upper() if v is not None else None for v in BROKEN.values()]


def test_on_error(messages):
    df = messages(b"\x00\x02", bytes.fromhex("02"), bytes.fromhex("0002026100"))
    assert [r.line for r in tm.explode_lines(tm.decode_segments(df, on_error="drop")).collect()] == ["a"]
    with pytest.raises((SparkRuntimeException, PythonException)):
        tm.explode_lines(tm.decode_segments(df, on_error="fail")).collect()
    with pytest.raises(ValueError):
        tm.decode_segments(df, on_error="ignore")


def test_codec_of_the_connector(messages, monkeypatch):
    """With a stand-in for the connector, which is not installed here."""
    import json

    from pyspark.sql.avro import functions as connector

    def from_avro(value, schema, options):
        assert json.loads(schema)["fields"][0]["name"] == "list" and options == {"mode": "PERMISSIVE"}
        lines = F.when(F.substring(value, 1, 1) == F.unhex(F.lit("00")), F.array(F.substring(value, 4, 1).cast("string")))
        return F.struct(lines.alias("list"))

    monkeypatch.setattr(connector, "from_avro", from_avro)
    values = [bytes.fromhex(x) for x in ("0002026100", "000202ff00", "02", "0a00")]
    out = tm.decode_segments(messages(*values), codec="spark-avro").orderBy("offset").collect()
    assert [r.lines for r in out] == [["a"], None, None, None]
    assert [r.envelope for r in out] == [None, "BAD_ENVELOPE", "NULL_ENVELOPE", "BAD_ENVELOPE"]
    with pytest.raises(ValueError):
        tm.decode_segments(messages(*values), codec="other")


def test_explode_keeps_lost_messages(messages):
    df = messages(bytes.fromhex("000402610262 00"), b"\x00\x02", bytes.fromhex("02"), bytes.fromhex("0000"))
    out = tm.explode_lines(tm.decode_segments(df)).orderBy("offset", "pos").collect()
    assert [(r.offset, r.pos, r.line, r.envelope) for r in out] == [
        (0, 0, "a", None), (0, 1, "b", None), (1, 0, "0002", "BAD_ENVELOPE"), (2, 0, None, "NULL_ENVELOPE"),
    ]


def test_roundtrip_of_random_segments(spark):
    rng = random.Random(7)
    alphabet = "ab,é€😀 \t\n\"\0"
    lengths = [0, 1, 63, 64, 8191, 8192, 20000, 1100000]
    rows = [
        (i, ["".join(rng.choice(alphabet) for _ in range(rng.choice([0, 1, 5, 63, 64, 200]))) for _ in range(rng.choice([0, 1, 2, 63, 64, 300]))])
        for i in range(60)
    ] + [(100 + i, ["x" * n]) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "offset bigint, lines array<string>")
    out = {r.offset: r.lines for r in tm.decode_segments(tm.encode_segments(df)).collect()}
    assert out == dict(rows)


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=60))
def test_decoder_takes_any_bytes(data):
    lines = segment_lines(data)
    assert lines is None or all(isinstance(x, bytes) for x in lines)


def one_by_one(data):
    lines = segment_lines(data)
    try:
        return None if lines is None else [x.decode() for x in lines]
    except UnicodeDecodeError:
        return None


def segment_bytes(lines, blocks, sized):
    """The bytes of a message whose lines are spread over several blocks, with or without their sizes."""

    def number(n):
        n, out = (n << 1) ^ (n >> 63), []
        while n > 127:
            out.append(n & 127 | 128)
            n >>= 7
        return bytes([*out, n])

    step, out = max(1, len(lines) // blocks), b"\0"
    for i in range(0, len(lines), step):
        part = lines[i : i + step]
        body = b"".join(number(len(x)) + x for x in part)
        out += (number(-len(part)) + number(len(body)) if sized else number(len(part))) + body
    return out + b"\0"


MESSAGES = st.builds(
    segment_bytes, st.lists(st.binary(max_size=3) | st.text(max_size=200).map(str.encode), max_size=8), st.integers(1, 3), st.booleans()
)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.binary(max_size=20) | MESSAGES | MESSAGES.map(lambda m: m[:-2]), max_size=60), st.integers(0, 5))
def test_decoding_in_lock_step_equals_decoding_one_by_one(values, skipped):
    array = pa.array(values, pa.binary()).slice(skipped)
    assert decode_batch(array).to_pylist() == [one_by_one(v) for v in values[skipped:]]


def test_messages_of_very_unequal_length():
    values = [segment_bytes([b"x"] * n, 2, False) for n in [1] * 40 + [20_000, 0, 3]]
    assert [len(x) for x in decode_batch(pa.array(values)).to_pylist()] == [1] * 40 + [20_000, 0, 3]
    huge = b"\0" + b"\xff" * 9 + b"\x01"  # a block of 2**62 lines
    assert decode_batch(pa.array([huge, *values, huge + b"\x02a"])).to_pylist()[::44] == [None, None]


def test_pack_by_place(spark):
    df = spark.range(130).select(F.col("id"), F.concat(F.lit("l"), "id").alias("line")).repartition(7)
    packed = tm.pack_segments(df, 50, pos="id").withColumnRenamed("bucket", "offset")
    out = {r.offset: r.lines for r in tm.decode_segments(packed).collect()}
    assert out == {b: [f"l{i}" for i in range(b * 50, min(130, b * 50 + 50))] for b in range(3)}


def test_pack_by_source_and_repeating_places(spark):
    rows = [("busy", 0, f"b{i:03}") for i in range(120)] + [("calm", i, f"c{i}") for i in range(3)]
    df = spark.createDataFrame(rows, "host string, at int, line string")
    packed = tm.pack_segments(df, 50, pos="at", by=["host"]).withColumnRenamed("host", "topic")
    out = tm.decode_segments(packed).collect()
    assert sorted(len(r.lines) for r in out) == [3, 20, 50, 50]
    assert sorted(x for r in out for x in r.lines) == sorted(x for _, _, x in rows)


def test_pack_in_place_needs_no_shuffle(spark):
    df = spark.range(0, 1000, numPartitions=3).select(F.col("id").cast("string").alias("line"))
    packed = tm.pack_segments(df, 50)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    out = tm.decode_segments(packed).collect()
    assert all(0 < len(r.lines) <= 50 for r in out)
    assert sorted(int(x) for r in out for x in r.lines) == list(range(1000))
    with pytest.raises(ValueError):
        tm.pack_segments(df, 50, by=["line"])


def test_pack_stamp(spark):
    df = spark.range(4).select("id", F.col("id").cast("string").alias("line"), F.timestamp_seconds(F.col("id") + 60).alias("ts"))
    packed = tm.pack_segments(df, 2, pos="id", stamp="ts")
    assert sorted(r.s for r in packed.select(F.unix_seconds("timestamp").alias("s")).collect()) == [60, 62]


@pytest.mark.parametrize("place", ["7", "cast(null as int)", "if(id % 3 = 0, null, id % 2)"])
def test_a_bucket_of_most_rows_is_cut_without_being_gathered(spark, place):
    same = "if(id % 2 = 0, 'same line', cast(id as string))"
    df = spark.range(0, 5000, numPartitions=8).selectExpr("'h' as host", f"{place} as at", f"{same} as line")
    calm = spark.range(120).selectExpr("'c' as host", "cast(id as int) as at", "cast(id as string) as line")
    packed = tm.pack_segments(df.union(calm), 50, pos="at", by=["host"])
    plan = packed._jdf.queryExecution().executedPlan().toString()
    assert "bucket" not in "".join(x for x in plan.splitlines() if "Window" in x)
    out = tm.decode_segments(packed.withColumnRenamed("host", "topic").withColumnRenamed("bucket", "offset")).collect()
    assert sorted(x for r in out for x in r.lines) == sorted(r.line for r in df.union(calm).collect())
    assert sorted(len(r.lines) for r in out if r.topic == "c") == [20, 50, 50]
    busy = [len(r.lines) for r in out if r.topic == "h"]
    assert max(busy) == 50 and len(busy) <= 5000 / 50 + 2


def test_running_rank(spark):
    df = spark.range(0, 3000, numPartitions=7).selectExpr("id", "0 as hot", "id % 5 as warm")
    ranked = running_rank(df, ["hot", "warm", "id"]).orderBy("warm", "id").collect()
    assert [r.rank for r in ranked] == list(range(3000))
    assert running_rank(df.where("id < 0"), ["hot", "id"]).collect() == []


@pytest.mark.parametrize("most", [1, 7, 40, 1 << 20])
def test_slices_of_a_batch_give_what_whole_messages_give(monkeypatch, most):
    values = [bytes.fromhex(h) for h, _ in UNUSUAL.values()] + list(BROKEN.values()) + [b"\x02"]
    values += [segment_bytes([b"a" * n, "é".encode(), b""][: n % 4], 1, n % 2) for n in range(40)]
    random.Random(3).shuffle(values)
    monkeypatch.setattr(avro, "SLICE", most)
    batch = pa.array([b"in front", *values, None], pa.binary())[1:]
    assert decode_batch(batch).to_pylist() == [one_by_one(v) for v in [*values, None]]


def test_memory_of_a_batch_of_short_lines(monkeypatch):
    """The places of all lines at once took 23 times the bytes of the messages."""
    batch = pa.array([segment_bytes([b"ab"] * 50, 1, False)] * 40_000, pa.binary())
    monkeypatch.setattr(avro, "SLICE", 1 << 16)
    tracemalloc.start()
    try:
        decode_batch(batch)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 6 * batch.nbytes


def test_no_task_gets_all_lines_of_a_busy_bucket(spark, monkeypatch):
    """Joined by its key, the one bucket of all lines came to one task, which then packed it, too."""
    monkeypatch.setattr(envelope, "BUSY", 1000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(0, 5000, numPartitions=8).selectExpr("7 as at", "cast(id as string) as line")
        some = spark.range(300).selectExpr("cast(if(id < 120, 60, 100 + id) as int) as at", "'s' || id as line")
        packed = tm.pack_segments(df, 50, pos="at")
        plan = packed._jdf.queryExecution().executedPlan().toString()
        mixed = tm.pack_segments(df.union(some), 50, pos="at").withColumnRenamed("bucket", "offset")
        out = tm.decode_segments(mixed).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert sorted(x for r in out for x in r.lines) == sorted(r.line for r in df.union(some).collect())
    assert sorted(len(r.lines) for r in out if r.offset == 1) == [20, 50, 50]
    assert max(len(r.lines) for r in out) == 50 and len([r for r in out if r.offset == 0]) == 100
