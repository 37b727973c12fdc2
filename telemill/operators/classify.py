"""From lines to typed rows, with a verdict on every line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemill.functions.numbers import float64, strict_fields
from telemill.plans.logtype import LogType, Record, resolve

OK, DROPPED, BAD = "ok", "dropped", "bad"
UNCLOSED_QUOTE = "UNCLOSED_QUOTE"
SHORT_LINE = "SHORT_LINE"
SHORT_ROW = "SHORT_ROW"
BAD_TIME = "BAD_TIME"
BAD_VALUE = "BAD_VALUE"

LINE_COLUMNS = {
    "line": "string",
    "topic": "string",
    "partition": "int",
    "offset": "bigint",
    "timestamp": "timestamp",
    "pos": "int",
}
QUARANTINE = ("line", "reason", "topic", "partition", "offset", "timestamp", "pos")


def classify(df: DataFrame, log_type: str | LogType, tz: str = "UTC") -> DataFrame:
    """Table columns, `status`, `reason` and the line with its lineage, for every line.

    status  `ok`; `dropped` for lines that the type skips; `bad`
    reason  NULL for ok, else the first check that failed, in this order:
            envelope, tokens, skipped lines, field count, time, then the
            values in column order (`BAD_VALUE:<column>`)

    A pure projection: no shuffle, and the same for batch and stream.
    """
    spec = resolve(log_type)
    present = set(df.columns)
    line_columns = [f"`{c}`" for c in LINE_COLUMNS]
    carried = [f"`{c}`" if c in present else f"cast(null as {t}) as `{c}`" for c, t in LINE_COLUMNS.items()]
    envelope = "envelope" if "envelope" in present else "cast(null as string) as envelope"
    record = Record(tz)
    epoch = F.lit(None).cast("double") if spec.epoch is None else float64(record[spec.epoch])
    timed = (
        df.selectExpr(*carried, envelope)
        .withColumn("_fields", spec.tokenize(F.col("line")))
        .withColumn("_numbers", strict_fields(F.col("line"), F.col("_fields")))
        .withColumn("_epoch", epoch)
        .withColumn("_clock", spec.clock(record))
    )
    typed = timed.withColumn("_typed", F.struct(*[o.column(record) for o in spec.outputs]))
    judged = typed.withColumn("_judged", F.struct(F.col("_typed").alias("_row"), _first_failure(spec).alias("reason")))
    # A generator, because filters on its output stay above it. Over plain
    # projections the optimizer pushes `status = 'ok'` down and spells out the
    # tokenizer once for every field, and again below: ten times the work.
    # The structs are made in projections of their own: written inside the
    # generator, the generated method grows past what the JVM will compile.
    rows = judged.selectExpr(*line_columns, "inline(array(_judged))")
    status = f"case when reason is null then '{OK}' when reason = '{SHORT_LINE}' then '{DROPPED}' else '{BAD}' end"
    return rows.selectExpr("_row.*", f"{status} as status", "reason", *line_columns)


def _first_failure(spec: LogType) -> Column:
    fields = F.col("_fields")
    reason = F.when(F.col("envelope").isNotNull(), F.col("envelope"))
    if spec.broken is not None:
        reason = reason.when(spec.broken(fields), UNCLOSED_QUOTE)
    if spec.skip is not None:
        reason = reason.when(spec.skip(fields), SHORT_LINE)
    # A NULL line has no fields at all.
    rest = [
        f"when coalesce(size(_fields), -1) < {spec.min_fields} then '{SHORT_ROW}'",
        f"when _clock is null then '{BAD_TIME}'",
        *[f"when _typed.`{o.name}` is null then '{BAD_VALUE}:{o.name}'" for o in spec.outputs if o.checked],
    ]
    return reason.otherwise(F.expr(f"case {' '.join(rest)} end"))


def normalize(df: DataFrame, log_type: str | LogType, tz: str = "UTC", mode: str = "drop") -> DataFrame:
    """The table's rows, columns in table order.

    mode  `drop` leaves bad lines out (see `quarantined` for them);
          `failfast` ends the job at the first bad line.
    """
    return accepted(classify(df, log_type, tz), log_type, mode)


def accepted(classified: DataFrame, log_type: str | LogType, mode: str = "drop") -> DataFrame:
    spec = resolve(log_type)
    good = F.col("status") == OK
    if mode == "failfast":
        where = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in ("topic", "partition", "offset", "pos")]
        message = F.concat_ws(" ", F.col("reason"), F.lit("at"), *where)
        skipped = F.col("status") == DROPPED
        good = F.when(good, True).when(skipped, False).otherwise(F.raise_error(message).cast("boolean"))
    elif mode != "drop":
        raise ValueError(f"mode must be drop or failfast, not {mode!r}")
    return classified.where(good).select(*spec.columns)


def quarantined(df: DataFrame, log_type: str | LogType, tz: str = "UTC") -> DataFrame:
    """The bad lines, each with its reason and where it came from."""
    return rejected(classify(df, log_type, tz))


def rejected(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("status") == BAD).select(*QUARANTINE)


def account(df: DataFrame, log_type: str | LogType, tz: str = "UTC") -> DataFrame:
    """Lines by `status` and `reason`; together they are all lines that came in."""
    return classify(df, log_type, tz).groupBy("status", "reason").agg(F.count(F.lit(1)).alias("lines"))
