import pytest
from pyspark.sql.types import StructType

import telemill as tm
from telemill.functions.clock import wall_clock
from telemill.plans.logtype import LogType, clock_parts, padded_clock_parts, real, text, whole
from telemill.session import scratch_dir
from telemill.sinks.evolve import WIDER, folder_columns


def version(*outputs, parts=clock_parts):
    return LogType(name="app", min_fields=4, label="user", clock=lambda r: wall_clock(r[0]), outputs=(*outputs, *parts()))


V1 = version(*text("user", 1), *whole("int", "size", 2), real("load", 3))
ADDED = version(*V1.outputs[:3], *text("host", 4))
WIDENED = version(*text("user", 1), *text("host", 4), *whole("bigint", "size", 2), *whole("smallint", "load2", 5), real("load", 3))

OLD = ["2024-01-01 00:00:00,u1,7,0.5", "2024-01-02 00:00:00,u2,8,1.5", "x"]
NEW = "2024-01-02 00:00:00,u3,5000000000,2.5,h,6"


@pytest.fixture
def topic(spark, messages):
    def make(*lines, topic="t"):
        df = spark.createDataFrame([(list(lines),)], "lines array<string>")
        return messages(bytes(tm.encode_segments(df).first().value), topic=topic)

    return make


def ddl(text):
    return f"{text}, y smallint, m smallint, d smallint, h smallint"


def test_reconcile(spark):
    assert not tm.reconcile(V1.schema, V1)
    changes = tm.reconcile(V1.schema, WIDENED)
    assert changes.added == ("host", "load2") and changes.widened == {"size": ("int", "bigint")}
    assert tm.reconcile(StructType.fromDDL(ddl("USER string, size int, load float")), V1) == tm.Changes((), {})


@pytest.mark.parametrize("existing", [
    ddl("user string, size int, load float, gone string"),
    ddl("user string, size bigint, load float"),
    ddl("user string, size float, load float"),
    ddl("user int, size int, load float"),
    "user string, size int, load float, y string, m string, d string, h string",
    "user string, size int, load float, y smallint, m smallint, d smallint",
])
def test_refused(spark, existing):
    with pytest.raises(ValueError, match="app does not fit"):
        tm.reconcile(StructType.fromDDL(existing), V1)


def test_all_wider_types_are_read(spark, tmp_path):
    for old, wider in WIDER.items():
        path = str(tmp_path / old)
        spark.sql(f"select cast(v as {old}) as v from values (1), (-32768), (null) as t(v)").write.parquet(path)
        for new in wider:
            read = spark.read.schema(f"v {new}").parquet(path)
            assert sorted((r.v for r in read.collect()), key=str) == [-32768, 1, None], (old, new)


def test_table_with_added_columns(spark, topic):
    place = scratch_dir(spark, "evolve")
    table = f"app_{place[-32:]}"
    tm.create_table(spark, table, V1)
    tm.ingest_batch(topic(*OLD), V1, table=table, mode="drop")
    assert tm.evolve_table(spark, table, ADDED) == tm.Changes(("host",), {})
    assert not tm.evolve_table(spark, table, ADDED)
    tm.ingest_batch(topic(NEW.replace("5000000000", "9")), ADDED, table=table, mode="drop")
    rows = spark.table(table).select("user", "size", "load", "host", "d")
    assert sorted(map(tuple, rows.collect())) == [("u1", 7, 0.5, None, 1), ("u2", 8, 1.5, None, 2), ("u3", 9, 2.5, "h", 2)]
    with pytest.raises(ValueError, match="location"):
        tm.evolve_table(spark, table, WIDENED)
    with pytest.raises(ValueError, match="host is missing"):
        tm.evolve_table(spark, table, V1)
    assert spark.table(table).count() == 3
    spark.sql(f"drop table {table}")


def test_table_with_wider_columns(spark, topic):
    place = scratch_dir(spark, "evolve")
    table = f"app_{place[-32:]}"
    tm.create_table(spark, table, V1, f"{place}/rows")
    tm.ingest_batch(topic(*OLD), V1, table=table, mode="drop")
    assert tm.evolve_table(spark, table, WIDENED).widened == {"size": ("int", "bigint")}
    assert spark.table(table).schema.simpleString() == WIDENED.schema.simpleString()
    tm.ingest_batch(topic(NEW), WIDENED, table=table, mode="drop")
    rows = spark.table(table).select("user", "host", "size", "load2", "load", "d")
    assert sorted(map(tuple, rows.collect())) == [
        ("u1", None, 7, None, 0.5, 1), ("u2", None, 8, None, 1.5, 2), ("u3", "h", 5000000000, 6, 2.5, 2),
    ]
    assert spark.table(table).where("d = 1").count() == 1
    spark.sql(f"drop table {table}")


def test_landing_folder(spark, topic, tmp_path):
    path = str(tmp_path / "landing")
    assert folder_columns(spark, path, V1) is None
    tm.ingest_batch(topic(*OLD), V1, path=path)
    assert [f.name for f in folder_columns(spark, path, V1)] == list(V1.columns)
    changes = tm.evolve_landing(spark, path, WIDENED)
    assert set(changes.added) == {"host", "load2"} and changes.widened == {"size": ("int", "bigint")}
    tm.ingest_batch(topic(NEW, "y"), WIDENED, path=path)
    tm.ingest_batch(topic(OLD[0], topic="late"), V1, path=path)  # a job that has not been renewed
    rows = tm.read_accepted(spark, path, WIDENED).select("user", "host", "size")
    assert sorted(map(str, rows.collect())) == sorted([
        *["Row(user='u1', host=None, size=7)"] * 2, "Row(user='u2', host=None, size=8)", "Row(user='u3', host='h', size=5000000000)",
    ])
    assert sorted(r.line for r in tm.read_rejected(spark, path, WIDENED).collect()) == ["x", "y"]
    assert not tm.evolve_landing(spark, path, WIDENED)
    with pytest.raises(ValueError, match="missing"):
        tm.evolve_landing(spark, path, V1)
    with pytest.raises(ValueError, match="partition key"):
        tm.evolve_landing(spark, path, version(*WIDENED.outputs[:5], parts=padded_clock_parts))


def test_new_folder(spark, tmp_path):
    path = str(tmp_path / "none")
    assert tm.evolve_landing(spark, path, V1).added == V1.columns
    assert not tm.evolve_landing(spark, path, V1)
