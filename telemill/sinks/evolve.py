"""Give an existing table or landing folder the columns of a newer version of its log type.

A newer version may have more columns and wider numbers. Old files stay as they are: what they lack is read as NULL, and
Spark widens what they have. Anything else (a column that went, a narrower or another type, other partition keys) is
refused before something is changed, as old rows could not be read any more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from telemill.operators.classify import QUARANTINE
from telemill.plans.logtype import PARTITIONS, LogType, resolve
from telemill.sinks.files import WRITER
from telemill.sinks.landing import LAYOUT
from telemill.sinks.tables import create_table

#: Types and the wider ones that hold all their values and that Spark reads from Parquet files of the narrower one.
WIDER = {
    "smallint": ("int", "bigint", "double"),
    "int": ("bigint", "double"),
    "float": ("double",),
}

#: Below a landing folder: the columns as they were when the folder was last evolved. Readers skip the name.
NOTE = "_columns"


@dataclass(frozen=True)
class Changes:
    """What a newer version has: columns `added`, and those `widened` with the type before and after."""

    added: tuple[str, ...]
    widened: dict[str, tuple[str, str]]

    def __bool__(self) -> bool:
        return bool(self.added or self.widened)


def reconcile(existing: StructType, log_type: str | LogType) -> Changes:
    """What has to change so that `existing` rows read as the log type; ValueError when they cannot."""
    spec = resolve(log_type)
    before = {f.name.lower(): f.dataType.simpleString() for f in existing}
    after = {f.name.lower(): f.dataType.simpleString() for f in spec.schema}
    problems, widened = [f"{c} is missing" for c in before if c not in after], {}
    for column, old in before.items():
        new = after.get(column, old)
        if new == old:
            continue
        if column in PARTITIONS:
            problems.append(f"partition key {column} is {old} and would be {new}")
        elif new in WIDER.get(old, ()):
            widened[column] = (old, new)
        else:
            problems.append(f"{column} is {old} and would be {new}")
    problems += [f"partition key {c} is new" for c in PARTITIONS if c not in before]
    if problems:
        raise ValueError(f"{spec.name} does not fit what is there: {'; '.join(problems)}")
    return Changes(tuple(c for c in spec.columns if c.lower() not in before), widened)


def evolve_table(spark: SparkSession, table: str, log_type: str | LogType) -> Changes:
    """Make a table that `create_table` made for an older version fit this one; returns what changed.

    Columns that are only added, after the old ones, are added to the table. For wider types, or columns in between, the
    table is defined anew over its files and its partitions are found again. That is possible only for a table with a
    location of its own (`create_table(..., location)`); one whose files Spark would drop with it is refused. Broken off in
    between, the table is missing and its files are whole: create it again over its location and `MSCK REPAIR TABLE` it.
    Nobody should write meanwhile.
    """
    spec = resolve(log_type)
    existing = spark.table(table).schema
    changes = reconcile(existing, spec)
    kept = [f.name.lower() for f in existing if f.name.lower() not in PARTITIONS]
    wanted = [c.lower() for c in spec.columns if c not in PARTITIONS]
    if not changes and wanted == kept:
        return changes
    if not changes.widened and wanted[: len(kept)] == kept:
        types = {o.name: o.type for o in spec.outputs}
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{c}` {types[c]}' for c in changes.added)})")
        return changes
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    if told.get("Type") != "EXTERNAL":
        raise ValueError(f"{table} has no location of its own; only columns after its own can be added")
    spark.sql(f"DROP TABLE {table}")
    create_table(spark, table, spec, told["Location"])
    spark.sql(f"MSCK REPAIR TABLE {table}")
    return changes


def _note(spark: SparkSession, path: str, spec: LogType) -> None:
    place = f"{path.rstrip('/')}/{NOTE}"
    spark.createDataFrame([(spec.ddl,)], "value string").coalesce(1).write.mode("overwrite").text(place)


def folder_columns(spark: SparkSession, path: str, log_type: str | LogType) -> StructType | None:
    """The log type's columns in a landing folder: as last noted, else as the files have them; None for no rows.

    Files are asked by a Spark job that reads their footers; they do not tell the types of partition keys, which are text
    in folder names.
    """
    spec = resolve(log_type)
    try:
        noted = spark.read.schema("value string").text(f"{path.rstrip('/')}/{NOTE}").first()
    except AnalysisException:
        noted = None
    if noted is not None:
        return StructType.fromDDL(noted[0])
    try:
        stored = spark.read.option("mergeSchema", "true").parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
    beside = {c.lower() for c in (*QUARANTINE, *LAYOUT, WRITER)}
    own = [f for f in stored if f.name.lower() not in beside]
    return StructType([*own, *[f for f in spec.schema if f.name in PARTITIONS]])


def evolve_landing(spark: SparkSession, path: str, log_type: str | LogType) -> Changes:
    """Check that a landing folder of an older version reads as this one, and note the new columns; returns what changed.

    Nothing is rewritten. Jobs that still write the older version may go on until they are renewed.
    """
    spec = resolve(log_type)
    stored = folder_columns(spark, path, spec)
    changes = Changes(spec.columns, {}) if stored is None else reconcile(stored, spec)
    _note(spark, path, spec)
    return changes
