import math
import random
import shlex
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

import pytest
from pyspark.sql import functions as F

from telemill.functions import clock, numbers, text


def python_tokens(line):
    lexer = shlex.shlex(line)
    lexer.quotes, lexer.whitespace_split, lexer.commenters = '"', True, ""
    try:
        return list(lexer)
    except ValueError:
        return None


def column_of(spark, values, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r.out for r in df.select("i", build(F.col("x")).alias("out")).orderBy("i").collect()]


def test_split(spark):
    cut = lambda sep: lambda x: text.split_fields(x, sep)
    assert column_of(spark, ["a,b,,", "", ",", "a"], cut(",")) == [["a", "b", "", ""], [""], ["", ""], ["a"]]
    assert column_of(spark, ["a|b|", "|"], cut("|")) == [["a", "b", ""], ["", ""]]
    assert column_of(spark, ["a\tb.c"], cut("\t")) == [["a", "b.c"]]


def test_tokens_equal_the_standard_lexer(spark):
    rng = random.Random(3)
    samples = ['a"b c"', '"a"b', '""', '"abc', '"', ' a ""b " c " "', "", "\t\r\n", "a#b 'c d'"]
    samples += ["".join(rng.choice('ab" "\t#\'\\,') for _ in range(rng.randrange(0, 24))) for _ in range(4000)]
    got = column_of(
        spark, samples, lambda x: F.struct(text.tokenize_quoted(x).alias("t"), text.has_open_quote(text.tokenize_quoted(x)).alias("o"))
    )
    for sample, out in zip(samples, got):
        want = python_tokens(sample)
        assert out.o == (want is None), sample
        assert want is None or out.t == want, sample


def test_full_uri(spark):
    df = spark.createDataFrame([("h", "/", "-"), ("h", "/p", "?q"), ("h", "", "?q")], "h string, p string, q string")
    out = [r[0] for r in df.select(text.full_uri(F.col("h"), F.col("p"), F.col("q"))).collect()]
    assert out == ["h", "h/p?q", "h?q"]


def python_int(x, bits):
    try:
        value = int(x) if "_" not in x else None
    except ValueError:
        return None
    return value if value is not None and -(2 ** (bits - 1)) <= value < 2 ** (bits - 1) else None


def test_integers_equal_python(spark):
    rng = random.Random(5)
    samples = [" 12 ", "+7", "-7", "12.5", "", "1e3", "0x1", "9999999999", "32767", "32768", "-32768", "-32769", "007",
               "2147483647", "2147483648", "9223372036854775807", "9223372036854775808", "+", "-", "1 2", "None"]
    samples += ["".join(rng.choice("0123456789+-. e") for _ in range(rng.randrange(0, 12))) for _ in range(3000)]
    controls = "".join(map(chr, [*range(32), 127]))
    samples += ["".join(rng.choice("012" + controls) for _ in range(rng.randrange(0, 4))) for _ in range(3000)]
    for width, bits in (("smallint", 16), ("int", 32), ("bigint", 64)):
        got = column_of(spark, samples, lambda x: numbers.integer(x, width))
        assert got == [python_int(x, bits) for x in samples]


def python_float(x):
    try:
        return float(x) if "_" not in x else None
    except ValueError:
        return None


def same(a, b):
    return a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))


def test_floats_equal_python(spark):
    rng = random.Random(6)
    samples = ["nan", "inf", "-inf", "Infinity", "1e3", " 1.5 ", "1.0d", "1f", "0x1p3", "", ".", "1.", ".5", "+nan", "-NaN", "1e400", "--1"]
    samples += ["".join(rng.choice("0123456789.eE+-dfx nai") for _ in range(rng.randrange(0, 8))) for _ in range(6000)]
    for sample, got in zip(samples, column_of(spark, samples, numbers.float64)):
        assert same(got, python_float(sample)), sample


def python_clock(x):
    try:
        return datetime.strptime(x, "%Y-%m-%d %H:%M:%S")
    except ValueError:
        return None


def test_wall_clock_equals_strptime(spark):
    rng = random.Random(8)
    samples = ["2018-7-1 1:2:3", "2018-02-30 00:00:00", "18-7-1 1:2:3", "2018-002-01 0:0:0", "2018-07-01 01:02:60",
               "0000-01-01 00:00:00", "2024-02-29 23:59:59", "2018-07-01 24:00:00", "2018-07-01T00:00:00", "9999-12-31 23:59:59",
               "2018-07-01 01:02:03\n", " 2018-07-01 01:02:03", "2018-10-21 00:30:00", "2018-11-04 00:30:00", "x", ""]
    samples += [
        f"{rng.choice(['2018', '1999', '18', '0001'])}-{rng.randrange(0, 14):0{rng.choice([1, 2])}}-{rng.randrange(0, 33)} "
        f"{rng.randrange(0, 26)}:{rng.randrange(0, 62):02}:{rng.randrange(0, 62)}"
        for _ in range(4000)
    ]
    got = column_of(spark, samples, clock.wall_clock)
    assert got == [python_clock(x) for x in samples]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "Europe/Athens", "America/Sao_Paulo"])
def test_epoch_parts_equal_python(spark, zone):
    rng = random.Random(9)
    samples = [0.0, -0.5, 1530403199.9999996, 1530403199.123, 4102444800.25, 1540094400.0, 1541296800.0]
    samples += [round(rng.uniform(-1e9, 4e9), 6) for _ in range(2000)]
    parts = lambda x: F.struct(*[getattr(F, call)(clock.epoch_clock(x, zone)).alias(p) for p, call in clock.PARTS.items()])
    got = column_of(spark, samples, parts, "double")
    for sample, out in zip(samples, got):
        want = datetime.fromtimestamp(sample, ZoneInfo(zone))
        assert tuple(out) == (want.year, want.month, want.day, want.hour), sample


def test_epoch_range(spark):
    samples = [float("nan"), float("inf"), 1e18, 253402300800.0, -62135596801.0, 253402300799.0, -62135596800.0]
    got = column_of(spark, samples, lambda x: F.year(clock.epoch_clock(x)), "double")
    assert got == [None] * 5 + [9999, 1]


def test_epoch_of_wall_clock(spark):
    got = column_of(spark, ["2018-07-01 01:02:03", "2018-01-01 00:00:00"], lambda x: clock.epoch_of(clock.wall_clock(x), "Europe/Athens"))
    assert got == [1530396123, int(datetime(2017, 12, 31, 22, tzinfo=timezone.utc).timestamp())]


def test_minute_label(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 9, 7, 5, 59, 999999, timezone.utc),)], "t timestamp")
    assert df.select(clock.minute_label(F.col("t"))).first()[0] == "202403090705"
