"""Queries over the test tables, and the SQL that DuckDB checks them with.

Every query turns the whole `events` table into log lines, hands them to the
package the way a deployment would, and returns what comes out.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from dataclasses import replace

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import Column, DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import telemill as tm  # noqa: E402
from checks import expected, recipes  # noqa: E402
from checks.recipes import DUCK, SPARK, TYPES  # noqa: E402
from telemill.functions import clock as clocks  # noqa: E402
from telemill.functions.clock import minute_label  # noqa: E402
from telemill.plans.logtype import LogType, clock_parts, derived, text, whole  # noqa: E402
from telemill.session import scratch_dir  # noqa: E402

try:
    from telemill.llm import queries as llm  # noqa: E402
except ModuleNotFoundError as error:  # the subpackage may have been left out; nothing else may be missing
    if not (error.name or "").startswith("telemill.llm"):
        raise
    llm = None

try:
    import corpus_pipeline  # noqa: E402
except ModuleNotFoundError as error:  # goes with the subpackage
    if error.name != "corpus_pipeline" and not (error.name or "").startswith("telemill.llm"):
        raise
    corpus_pipeline = None

Query = Callable[[SparkSession, str], DataFrame]

LINES_PER_MESSAGE = 50
TOKYO = "Asia/Tokyo"


# ---------------------------------------------------------------- inputs


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def sound_lines(spark: SparkSession, sf_dir: str, log_type: str) -> DataFrame:
    """One line per event."""
    return events(spark, sf_dir).select(F.expr(recipes.line(log_type, SPARK)).alias("line"))


def damaged_lines(spark: SparkSession, sf_dir: str, log_type: str) -> DataFrame:
    """One line per event, some of them damaged, with the lineage of a message per line."""
    damaged = events(spark, sf_dir).withColumn("damage", F.expr(recipes.damage(log_type)))
    return damaged.select(
        F.lit(f"ingest-{log_type}").alias("topic"),
        F.expr("cast(event_id % 3 as int)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.lit(0).alias("pos"),
        F.expr(recipes.damaged_line(log_type, SPARK)).alias("line"),
    )


def encoded(source: DataFrame, log_type: str, lines: Column) -> DataFrame:
    """Kafka-shaped messages, one per event."""
    framed = source.select(
        lines.alias("lines"),
        F.lit(f"ingest-{log_type}").alias("topic"),
        F.expr("cast(event_id % 3 as int)").alias("partition"),
        F.col("event_id").alias("offset"),
        F.expr(f"timestamp_micros({SPARK.micros})").alias("timestamp"),
    )
    return tm.encode_segments(framed)


def three_line_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = [F.expr(recipes.line(t, SPARK)) for t in ("dns", "flow", "ids_packet")]
    return encoded(events(spark, sf_dir), "mixed", F.array(*lines))


def messages(spark: SparkSession, sf_dir: str, log_type: str, damaged: bool = True) -> DataFrame:
    """A topic's messages: 50 lines each, at the time of their first line."""
    source = events(spark, sf_dir).withColumn("damage", F.expr(recipes.damage(log_type)))
    line = recipes.damaged_line if damaged else recipes.line
    lines = source.select(
        "event_id",
        F.expr(f"timestamp_micros({SPARK.micros})").alias("ts"),
        F.expr(line(log_type, SPARK)).alias("line"),
    )
    packed = tm.pack_segments(lines, LINES_PER_MESSAGE, pos="event_id", stamp="ts")
    topic = packed.select(
        F.lit(None).cast("binary").alias("key"),
        "value",
        F.lit(f"ingest-{log_type}").alias("topic"),
        F.expr("cast(bucket % 3 as int)").alias("partition"),
        F.col("bucket").alias("offset"),
        "timestamp",
    )
    # in runs of offsets, as a topic's partitions are read
    return topic.repartitionByRange(spark.sparkContext.defaultParallelism, "offset")


def message_stream(spark: SparkSession, sf_dir: str, log_type: str, damaged: bool = True) -> tuple[DataFrame, str]:
    """The messages as a stream of files, and the scratch folder that they are in."""
    scratch = scratch_dir(spark, f"stream-{log_type}")
    messages(spark, sf_dir, log_type, damaged).write.parquet(f"{scratch}/messages")
    return tm.read_segment_files(spark, f"{scratch}/messages", streaming=True, max_files_per_trigger=3), scratch


def stamped(rejects: DataFrame) -> DataFrame:
    """Rejected lines with the time of their message in microseconds."""
    return rejects.select("line", "reason", "topic", "partition", "offset", "pos", F.unix_micros("timestamp").alias("stamp_us"))


# Where a line of `events` sits in the messages above.
MESSAGE_OFFSET = f"event_id // {LINES_PER_MESSAGE}"
MESSAGE_POS = f"cast(row_number() over (partition by {MESSAGE_OFFSET} order by event_id) - 1 as integer)"
MESSAGE_STAMP = f"epoch_us(min(ts) over (partition by {MESSAGE_OFFSET}))"
MESSAGE_MINUTE = f"strftime(min(ts) over (partition by {MESSAGE_OFFSET}), '%Y%m%d%H%M')"


# ---------------------------------------------------------------- envelope


def envelope_roundtrip(spark, sf_dir):
    decoded = tm.explode_lines(tm.decode_segments(three_line_messages(spark, sf_dir)))
    return decoded.select("offset", "pos", "line")


ENVELOPE_ROUNDTRIP = " union all ".join(
    f"select event_id as \"offset\", {i} as pos, {recipes.line(t, DUCK)} as line from events"
    for i, t in enumerate(("dns", "flow", "ids_packet"))
)


def envelope_encoded_hex(spark, sf_dir):
    host = F.expr("'host' || cast(event_id % 97 as string) || '.example.com'")
    lines = F.array(host, F.expr(recipes.line("flow", SPARK)))
    return encoded(events(spark, sf_dir), "hex", lines).select("offset", F.hex("value").alias("bytes"))


ENVELOPE_ENCODED_HEX = f"""
    with t as (select event_id, 'host' || cast(event_id % 97 as varchar) || '.example.com' as a,
                      {recipes.line('flow', DUCK)} as b from events)
    select event_id as "offset", '0004' || lpad(hex(2 * strlen(a)), 2, '0') || hex(a)
        || lpad(hex(2 * strlen(b) % 128 + 128), 2, '0') || lpad(hex(2 * strlen(b) // 128), 2, '0') || hex(b)
        || '00' as bytes
    from t"""


def envelope_errors(spark, sf_dir):
    sound = three_line_messages(spark, sf_dir)
    value = (
        F.when(F.col("offset") % 5 == 0, F.unhex(F.lit("02")))
        .when(F.col("offset") % 7 == 0, F.expr("substring(value, 1, octet_length(value) - 1)"))
        .when(F.col("offset") % 11 == 0, F.unhex(F.lit("")))
        .when(F.col("offset") % 13 == 0, F.unhex(F.lit("0000")))
        .when(F.col("offset") % 17 == 0, F.concat("value", F.unhex(F.lit("FF"))))
        .otherwise(F.col("value"))
    )
    decoded = tm.decode_segments(sound.withColumn("value", value))
    return decoded.select("offset", "envelope", F.size("lines").alias("n_lines"))


ENVELOPE_ERRORS = """
    select event_id as "offset",
        case when event_id % 5 = 0 then 'NULL_ENVELOPE'
             when event_id % 7 = 0 or event_id % 11 = 0 then 'BAD_ENVELOPE' end as envelope,
        cast(case when event_id % 5 = 0 or event_id % 7 = 0 or event_id % 11 = 0 then null
             when event_id % 13 = 0 then 0 else 3 end as integer) as n_lines
    from events"""


def pack_segments(spark, sf_dir):
    source = events(spark, sf_dir).select("event_id", F.expr(recipes.line("dns", SPARK)).alias("line"))
    packed = tm.pack_segments(source, LINES_PER_MESSAGE, pos="event_id")
    decoded = tm.decode_segments(packed.withColumnRenamed("bucket", "offset"))
    return decoded.select("offset", F.size("lines").alias("n_lines"), F.array_join("lines", "\n").alias("text"))


PACK_SEGMENTS = f"""
    select event_id // {LINES_PER_MESSAGE} as "offset", cast(count(*) as integer) as n_lines,
        string_agg({recipes.line('dns', DUCK)}, chr(10) order by event_id) as text
    from events group by 1"""


def pack_in_place(spark, sf_dir):
    packed = tm.pack_segments(sound_lines(spark, sf_dir, "flow"), LINES_PER_MESSAGE)
    decoded = tm.decode_segments(packed)
    small = (F.size("lines") > 0) & (F.size("lines") <= LINES_PER_MESSAGE)
    return decoded.select(F.explode("lines").alias("line"), small.alias("within_size"))


PACK_IN_PLACE = f"select {recipes.line('flow', DUCK)} as line, true as within_size from events"


def pack_null_lines(spark, sf_dir):
    """Every third line is NULL: the others reach their messages."""
    line = F.expr(f"if(event_id % 3 = 0, null, {recipes.line('flow', SPARK)})").alias("line")
    source = events(spark, sf_dir).select("event_id", line)
    by_place = tm.decode_segments(tm.pack_segments(source, LINES_PER_MESSAGE, pos="event_id"))
    in_place = tm.decode_segments(tm.pack_segments(source, LINES_PER_MESSAGE))
    lines = lambda df, how: df.select(F.explode("lines").alias("line"), F.lit(how).alias("packed"))
    return lines(by_place, "by place").union(lines(in_place, "in place"))


PACK_NULL_LINES = f"""
    select {recipes.line('flow', DUCK)} as line, packed from events, (values ('by place'), ('in place')) as p(packed)
    where event_id % 3 <> 0"""


def pack_large_places(spark, sf_dir):
    """Places that doubles cannot tell apart, on both sides of 0."""
    place = F.expr("if(event_id % 2 = 0, 9007199254740993L + event_id, -9007199254740993L - event_id)")
    source = events(spark, sf_dir).select(place.alias("place"), F.expr(recipes.line("dns", SPARK)).alias("line"))
    packed = tm.pack_segments(source, LINES_PER_MESSAGE, pos="place").withColumnRenamed("bucket", "offset")
    return tm.decode_segments(packed).select("offset", F.size("lines").alias("n_lines"))


PACK_LARGE_PLACES = f"""
    with p as (select case when event_id % 2 = 0 then 9007199254740993 + event_id else -9007199254740993 - event_id end as place
        from events)
    select (place - ((place % {LINES_PER_MESSAGE}) + {LINES_PER_MESSAGE}) % {LINES_PER_MESSAGE}) // {LINES_PER_MESSAGE} as "offset",
        cast(count(*) as integer) as n_lines
    from p group by 1"""


def pack_repeating_places(spark, sf_dir):
    """All lines have one place: still no message is too large, and no line is lost."""
    source = events(spark, sf_dir).select(F.lit(7).alias("place"), F.expr(recipes.line("flow", SPARK)).alias("line"))
    decoded = tm.decode_segments(tm.pack_segments(source, LINES_PER_MESSAGE, pos="place"))
    within = (F.size("lines") <= LINES_PER_MESSAGE).alias("within_size")
    return decoded.select(F.explode("lines").alias("line"), within)


def assigned_partitions(spark, sf_dir):
    line = F.array(F.expr(recipes.line("flow", SPARK)))
    some = tm.assigned(encoded(events(spark, sf_dir), "flow", line), [0, 2])
    return tm.decode_segments(some).select(
        "topic", "partition", "offset", minute_label(F.col("timestamp")).alias("minute"), F.size("lines").alias("n_lines")
    )


ASSIGNED_PARTITIONS = """
    select 'ingest-flow' as topic, cast(event_id % 3 as integer) as partition, event_id as "offset",
        strftime(ts, '%Y%m%d%H%M') as minute, cast(1 as integer) as n_lines
    from events where event_id % 3 in (0, 2)"""


# ---------------------------------------------------------------- fields


def split_fields(spark, sf_dir):
    fields = tm.split_fields(sound_lines(spark, sf_dir, "dns"))
    return fields.select(F.size("fields").alias("n_fields"), F.array_join("fields", "\x1f").alias("joined"))


SPLIT_FIELDS = f"""
    with f as (select string_split({recipes.line('dns', DUCK)}, ',') as fields from events)
    select cast(len(fields) as integer) as n_fields, array_to_string(fields, chr(31)) as joined from f"""


def tokenize_quoted(spark, sf_dir):
    tokens = tm.tokenize_quoted(damaged_lines(spark, sf_dir, "proxy"))
    return tokens.select(F.size("fields").alias("n_fields"), F.array_join("fields", "\x1f").alias("joined"), "open_quote")


TOKENIZE_QUOTED = rf"""
    with d as (select *, {recipes.damage('proxy')} as damage from events),
    f as (select regexp_extract_all({recipes.damaged_line('proxy', DUCK)},
            '"[^"]*"?|[^ \t\r\n"][^ \t\r\n]*') as fields, damage = 'quote' as open_quote from d)
    select cast(len(fields) as integer) as n_fields, array_to_string(fields, chr(31)) as joined, open_quote from f"""


# ---------------------------------------------------------------- rows


def normalize(log_type: str) -> Query:
    return lambda spark, sf_dir: tm.normalize(sound_lines(spark, sf_dir, log_type), log_type)


def local_zone(log_type: str) -> Query:
    return lambda spark, sf_dir: tm.normalize(sound_lines(spark, sf_dir, log_type), log_type, tz=TOKYO)


def dns_guard_defaults(spark, sf_dir):
    rows = tm.normalize(damaged_lines(spark, sf_dir, "dns"), "dns")
    return rows.select("frame_time", "dns_qry_name", "dns_qry_class", "dns_qry_type", "dns_qry_rcode")


DNS_KEPT = "not coalesce(damage in ('cut', 'fraction', 'overflow', 'time', 'no_rcode'), false)"
DNS_CLASS = "case when damage = 'no_class' or event_id % 7 = 0 then '' else '0x00000001' end"
DNS_RCODE = "cast(case when damage = 'no_class' or event_id % 7 = 0 then 0 else event_id % 4 end as integer)"


def _damaged(log_type: str) -> str:
    return f"(select *, {recipes.damage(log_type)} as damage from events)"


DNS_GUARD_DEFAULTS = f"""
    select frame_time, dns_qry_name, dns_qry_class, dns_qry_type, dns_qry_rcode from ({expected.rows(
        'dns', source=_damaged('dns'), where=DNS_KEPT, dns_qry_class=DNS_CLASS, dns_qry_rcode=DNS_RCODE)})"""


def dns_strict_rcode(spark, sf_dir):
    strict = tm.dns_log(strict_rcode_guard=True)
    return tm.normalize(damaged_lines(spark, sf_dir, "dns"), strict)


DNS_STRICT_RCODE = expected.rows(
    "dns",
    source=_damaged("dns"),
    where="damage in ('none', 'extra', 'no_rcode', 'no_class')",
    dns_qry_class="case when damage = 'no_rcode' then '0x00000001' when damage = 'no_class' or event_id % 7 = 0"
    " then '' else '0x00000001' end",
    dns_qry_rcode="cast(case when damage = 'no_rcode' then 0 when damage = 'no_class' then 3"
    " when event_id % 7 = 0 then 0 else event_id % 4 end as integer)",
)


def ids_vlan_default(spark, sf_dir):
    rows = tm.normalize(sound_lines(spark, sf_dir, "ids_event"), "ids_event")
    return rows.select("event_id", "vlan_id")


IDS_VLAN_DEFAULT = """
    select cast(event_id as integer) as event_id,
        cast(case when event_id % 4 = 0 then 0 else event_id % 4096 end as integer) as vlan_id from events"""


def ids_exact_epoch(spark, sf_dir):
    exact = tm.ids_packet_log(exact_epoch=True)
    return tm.normalize(sound_lines(spark, sf_dir, "ids_packet"), exact)


IDS_EXACT_EPOCH = expected.rows("ids_packet", unix_tstamp_d=expected.SECONDS)


def proxy_full_uri(spark, sf_dir):
    rows = tm.normalize(sound_lines(spark, sf_dir, "proxy"), "proxy")
    return rows.select("uripath", "uriquery", "fulluri")


PROXY_FULL_URI = f"select uripath, uriquery, fulluri from ({expected.rows('proxy')})"


def proxy_short_lines(spark, sf_dir):
    classified = tm.classify(damaged_lines(spark, sf_dir, "proxy"), "proxy")
    return classified.where(F.col("status") == "dropped").select("offset", "line", "reason")


PROXY_SHORT_LINES = f"""
    select event_id as "offset", case when event_id % 2 = 0 then '' else '#' end as line, 'SHORT_LINE' as reason
    from {_damaged('proxy')} where damage = 'blank'"""


def kept(log_type: str) -> str:
    """SQL condition on `damage` for lines that give a row."""
    return f"({recipes.reason(log_type)}) is null"


def kept_rows(log_type: str, extra: str = "") -> str:
    changed = {}
    if log_type == "dns":
        changed = {"dns_qry_class": DNS_CLASS, "dns_qry_rcode": DNS_RCODE}
    return expected.rows(log_type, source=_damaged(log_type), where=kept(log_type) + extra, **changed)


def drop_mode(log_type: str) -> Query:
    return lambda spark, sf_dir: tm.normalize(damaged_lines(spark, sf_dir, log_type), log_type, mode="drop")


def failfast_mode(spark, sf_dir):
    return tm.normalize(sound_lines(spark, sf_dir, "ids_event"), "ids_event", mode="failfast")


def quarantine(log_type: str) -> Query:
    return lambda spark, sf_dir: stamped(tm.quarantined(damaged_lines(spark, sf_dir, log_type), log_type))


def quarantine_sql(log_type: str) -> str:
    return f"""
        select {recipes.damaged_line(log_type, DUCK)} as line, {recipes.reason(log_type)} as reason,
            'ingest-{log_type}' as topic, cast(event_id % 3 as integer) as partition, event_id as "offset",
            cast(0 as integer) as pos, cast(null as bigint) as stamp_us
        from {_damaged(log_type)}
        where not {kept(log_type)} and damage <> 'blank'"""


def message_quarantine_sql(log_type: str) -> str:
    """The same lines with their places in `messages`."""
    return f"""
        select {recipes.damaged_line(log_type, DUCK)} as line, {recipes.reason(log_type)} as reason,
            'ingest-{log_type}' as topic, cast({MESSAGE_OFFSET} % 3 as integer) as partition,
            {MESSAGE_OFFSET} as "offset", pos, stamp_us
        from (select *, {MESSAGE_POS} as pos, {MESSAGE_STAMP} as stamp_us from {_damaged(log_type)})
        where not {kept(log_type)} and damage <> 'blank'"""


def control_characters(log_type: str) -> Query:
    """Numbers with control characters beside them are not numbers."""

    def query(spark, sf_dir):
        lines = events(spark, sf_dir).withColumn("damage", F.lit("fraction"))
        line = recipes.damaged_line(log_type, SPARK).replace("'12.5'", "'12' || char(1 + event_id % 8)")
        return tm.quarantined(lines.select(F.expr(line).alias("line")), log_type).groupBy("reason").agg(
            F.count(F.lit(1)).alias("lines")
        )

    return query


def control_characters_sql(log_type: str) -> str:
    return f"select 'BAD_VALUE:{recipes.FRACTIONS[log_type][1]}' as reason, count(*) as lines from events"


def accounting(log_type: str) -> Query:
    return lambda spark, sf_dir: tm.account(damaged_lines(spark, sf_dir, log_type), log_type)


def accounting_sql(log_type: str) -> str:
    return f"""
        select case when reason is null then 'ok' when reason = 'SHORT_LINE' then 'dropped' else 'bad' end as status,
            reason, count(*) as lines
        from (select {recipes.reason(log_type)} as reason from {_damaged(log_type)}) group by all"""


def batch_report(log_type: str) -> Query:
    return lambda spark, sf_dir: tm.batch_report(damaged_lines(spark, sf_dir, log_type), log_type)


def batch_report_sql(log_type: str) -> str:
    spec = tm.resolve(log_type)
    label = expected.columns(log_type)[spec.label]
    return f"""
        select '{log_type}' as log_type, '{spec.segment_label}' as segment_label,
            count(*) filter (reason is null) as rows,
            count(*) filter (reason is not null and reason <> 'SHORT_LINE') as bad_rows,
            count(*) filter (reason = 'SHORT_LINE') as dropped_rows,
            min(label) filter (reason is null) as min_label, max(label) filter (reason is null) as max_label
        from (select {recipes.reason(log_type)} as reason, {label} as label from {_damaged(log_type)})"""


def user_log() -> LogType:
    """A log type of the user's own: `time|id|user|kind`."""
    from telemill.functions.text import split_fields as cut

    return LogType(
        name="app_event",
        segment_label="application segments",
        tokenize=lambda line: cut(line, "|"),
        min_fields=4,
        label="kind",
        clock=lambda r: clocks.wall_clock(r[0]),
        outputs=(
            *whole("bigint", "id user_id", 1, 2),
            *text("kind", 3),
            derived("seconds", "bigint", lambda r: clocks.epoch_of(r.clock, r.tz)),
            *clock_parts(),
        ),
    )


def registered_log_type(spark, sf_dir):
    tm.register(user_log(), replace=True)
    line = F.expr("concat_ws('|', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), event_id, user_id, event_type)")
    return tm.normalize(events(spark, sf_dir).select(line.alias("line")), "app_event")


REGISTERED_LOG_TYPE = """
    select event_id as id, user_id, event_type as kind, epoch_us(ts) // 1000000 as seconds,
        cast(year(ts) as smallint) as y, cast(month(ts) as smallint) as m, cast(day(ts) as smallint) as d,
        cast(hour(ts) as smallint) as h
    from events"""


# ---------------------------------------------------------------- sinks


def _table(spark, log_type: str) -> str:
    place = scratch_dir(spark, log_type)
    name = f"{log_type}_{place[-32:]}"
    tm.create_table(spark, name, log_type, f"{place}/table")
    return name


def table_append(spark, sf_dir):
    table = _table(spark, "flow")
    source = messages(spark, sf_dir, "flow")
    tm.ingest_batch(tm.assigned(source, [0]), "flow", table=table, mode="drop")
    tm.ingest_batch(tm.assigned(source, [1, 2]), "flow", table=table, mode="drop", rebalance=True)
    return spark.table(table)


def partition_pruned_read(spark, sf_dir):
    table = _table(spark, "proxy")
    tm.write_table(tm.normalize(sound_lines(spark, sf_dir, "proxy"), "proxy"), table, "proxy")
    return spark.table(table).where("y = '2024' and m = '01' and d = '07'").select("fulluri", "d", "h")


PARTITION_PRUNED_READ = f"select fulluri, d, h from ({expected.rows('proxy')}) where d = '07'"


def quarantine_table(spark, sf_dir):
    table, bad = _table(spark, "ids_event"), f"bad_{scratch_dir(spark, 'bad')[-32:]}"
    tm.create_quarantine(spark, bad, f"{scratch_dir(spark, 'bad')}/table")
    tm.ingest_batch(messages(spark, sf_dir, "ids_event"), "ids_event", table=table, quarantine=bad)
    return stamped(spark.table(bad))


def table_and_quarantine(spark, sf_dir):
    """What one call stored in both tables: rows as a count, rejects line by line."""
    table, bad = _table(spark, "flow"), f"bad_{scratch_dir(spark, 'bad')[-32:]}"
    tm.create_quarantine(spark, bad, f"{scratch_dir(spark, 'bad')}/table")
    report = tm.ingest_batch(messages(spark, sf_dir, "flow"), "flow", table=table, quarantine=bad)
    rows = spark.table(table).select(F.lit(None).cast("string").alias("reason"), F.lit(report["rows"]).cast("bigint").alias("reported"))
    return rows.union(spark.table(bad).select("reason", F.lit(report["bad_rows"]).cast("bigint"))).groupBy("reason", "reported").agg(
        F.count(F.lit(1)).alias("lines")
    )


TABLE_AND_QUARANTINE = f"""
    select reason, lines, sum(lines) over (partition by reason is null)::bigint as reported
    from ({accounting_sql('flow')})"""


def quarantine_pruned_read(spark, sf_dir):
    """One day's rejects: other days' folders are not read."""
    path = f"{scratch_dir(spark, 'landing')}/flow"
    tm.ingest_batch(messages(spark, sf_dir, "flow"), "flow", path=path)
    day = tm.read_rejected(spark, path, "flow").where("y = 2024 and m = 1 and d = 7")
    return stamped(day)


QUARANTINE_PRUNED_READ = f"""
    select * from ({message_quarantine_sql('flow')})
    where strftime(make_timestamp(stamp_us), '%Y-%m-%d') = '2024-01-07'"""


def landing_rows(log_type: str) -> Query:
    def query(spark, sf_dir):
        path = f"{scratch_dir(spark, 'landing')}/{log_type}"
        tm.ingest_batch(messages(spark, sf_dir, log_type), log_type, path=path)
        return tm.read_accepted(spark, path, log_type)

    return query


def landing_rejects(spark, sf_dir):
    path = f"{scratch_dir(spark, 'landing')}/proxy"
    tm.ingest_batch(messages(spark, sf_dir, "proxy"), "proxy", path=path, rebalance=True)
    return stamped(tm.read_rejected(spark, path, "proxy"))


def archive_segments(spark, sf_dir):
    path = f"{scratch_dir(spark, 'archive')}/lines"
    tm.archive_segments(messages(spark, sf_dir, "dns", damaged=False), path)
    return tm.read_archive(spark, path)


ARCHIVE_SEGMENTS = f"select {MESSAGE_MINUTE} as segment, {recipes.line('dns', DUCK)} as line from events"


# ---------------------------------------------------------------- streams


def stream_ingest(log_type: str) -> Query:
    """Rows that a stream wrote."""

    def query(spark, sf_dir):
        stream, scratch = message_stream(spark, sf_dir, log_type)
        job = tm.ingest_stream(
            stream, log_type, f"{scratch}/checkpoint", path=f"{scratch}/rows", mode="drop", interval=None
        )
        job.awaitTermination()
        return tm.read_rows(spark, f"{scratch}/rows", log_type)

    return query


def stream_landing(spark, sf_dir):
    """Lines that a stream rejected, from the folder it shares with the rows."""
    stream, scratch = message_stream(spark, sf_dir, "flow")
    job = tm.ingest_stream(stream, "flow", f"{scratch}/checkpoint", path=f"{scratch}/landing", interval=None)
    job.awaitTermination()
    return stamped(tm.read_rejected(spark, f"{scratch}/landing", "flow"))


def backfill_beside_stream(spark, sf_dir):
    """Batch, stream and batch again, each with a third of the topic, into one landing folder."""
    scratch = scratch_dir(spark, "beside")
    messages(spark, sf_dir, "ids_event").write.parquet(f"{scratch}/messages")
    batch = tm.read_segment_files(spark, f"{scratch}/messages")
    stream = tm.read_segment_files(spark, f"{scratch}/messages", streaming=True)
    tm.ingest_batch(tm.assigned(batch, [0]), "ids_event", path=f"{scratch}/landing")
    tm.ingest_stream(
        tm.assigned(stream, [1]), "ids_event", f"{scratch}/checkpoint", path=f"{scratch}/landing", interval=None
    ).awaitTermination()
    tm.ingest_batch(tm.assigned(batch, [2]), "ids_event", path=f"{scratch}/landing")
    return tm.read_accepted(spark, f"{scratch}/landing", "ids_event")


def two_streams_one_folder(spark, sf_dir):
    """Two streams with checkpoints of their own fill one folder of rows."""
    scratch = scratch_dir(spark, "two")
    messages(spark, sf_dir, "ids_packet").write.parquet(f"{scratch}/messages")
    jobs = []
    for i, some in enumerate(([0, 1], [2])):
        stream = tm.assigned(tm.read_segment_files(spark, f"{scratch}/messages", streaming=True), some)
        jobs.append(
            tm.ingest_stream(stream, "ids_packet", f"{scratch}/check{i}", path=f"{scratch}/rows", mode="drop", interval=None)
        )
    for job in jobs:
        job.awaitTermination()
    return tm.read_rows(spark, f"{scratch}/rows", "ids_packet")


def archive_beside_stream(spark, sf_dir):
    """A stream and a batch job archive parts of one topic."""
    stream, scratch = message_stream(spark, sf_dir, "flow", damaged=False)
    batch = tm.read_segment_files(spark, f"{scratch}/messages")
    tm.archive_segments(tm.assigned(batch, [0]), f"{scratch}/lines", rebalance=True)
    job = tm.archive_stream(tm.assigned(stream, [1, 2]), f"{scratch}/lines", f"{scratch}/checkpoint", interval=None, rebalance=True)
    job.awaitTermination()
    return tm.read_archive(spark, f"{scratch}/lines")


ARCHIVE_BESIDE_STREAM = f"select {MESSAGE_MINUTE} as segment, {recipes.line('flow', DUCK)} as line from events"


def archive_carriage_returns(spark, sf_dir):
    """Lines with carriage returns inside and at the end come back whole."""
    line = F.expr(f"replace({recipes.line('dns', SPARK)}, ',10.', ',\\r10.') || '\\r'")
    path = f"{scratch_dir(spark, 'archive')}/lines"
    lines = events(spark, sf_dir).select("event_id", F.expr(f"timestamp_micros({SPARK.micros})").alias("ts"), line.alias("line"))
    packed = tm.pack_segments(lines, LINES_PER_MESSAGE, pos="event_id", stamp="ts")
    topic = packed.select("value", F.lit("cr").alias("topic"), F.lit(0).alias("partition"), F.col("bucket").alias("offset"), "timestamp")
    tm.archive_segments(topic, path, rebalance=True)
    return tm.read_archive(spark, path).select("segment", F.hex("line").alias("bytes"))


ARCHIVE_CARRIAGE_RETURNS = f"""
    select {MESSAGE_MINUTE} as segment,
        hex(replace({recipes.line('dns', DUCK)}, ',10.', ',' || chr(13) || '10.') || chr(13)) as bytes
    from events"""


def stream_table(spark, sf_dir):
    """Rows that a stream appended to a catalog table."""
    stream, scratch = message_stream(spark, sf_dir, "ids_packet")
    table, bad = _table(spark, "ids_packet"), f"bad_{scratch[-32:]}"
    tm.create_quarantine(spark, bad, f"{scratch}/bad")
    job = tm.ingest_stream(
        stream, "ids_packet", f"{scratch}/checkpoint", table=table, quarantine=bad, interval=None
    )
    job.awaitTermination()
    return spark.table(table)


def stream_reports(spark, sf_dir):
    """What the finished batches of a table-filling stream add up to."""
    stream, scratch = message_stream(spark, sf_dir, "proxy")
    table, bad = _table(spark, "proxy"), f"bad_{scratch[-32:]}"
    tm.create_quarantine(spark, bad, f"{scratch}/bad")
    tm.ingest_stream(
        stream, "proxy", f"{scratch}/checkpoint", table=table, quarantine=bad, interval=None, rebalance=True
    ).awaitTermination()
    return (
        tm.read_reports(spark, f"{scratch}/checkpoint")
        .groupBy("log_type")
        .agg(
            *[F.sum(c).alias(c) for c in ("rows", "bad_rows", "dropped_rows")],
            F.min("min_label").alias("min_label"),
            F.max("max_label").alias("max_label"),
        )
    )


STREAM_REPORTS = f"""
    select log_type, cast(rows as bigint) as rows, cast(bad_rows as bigint) as bad_rows,
        cast(dropped_rows as bigint) as dropped_rows, min_label, max_label
    from ({batch_report_sql('proxy')})"""


def stream_reports_files(spark, sf_dir):
    """The same for a stream that writes files, summed over its batches."""
    stream, scratch = message_stream(spark, sf_dir, "proxy")
    tm.ingest_stream(stream, "proxy", f"{scratch}/checkpoint", path=f"{scratch}/landing", interval=None).awaitTermination()
    reports = tm.read_reports(spark, f"{scratch}/checkpoint").groupBy("log_type")
    return reports.agg(
        *[F.sum(c).alias(c) for c in ("rows", "bad_rows", "dropped_rows")],
        F.min("min_label").alias("min_label"),
        F.max("max_label").alias("max_label"),
    )


def stream_archive(spark, sf_dir):
    """Lines of two of the topic's partitions, archived by a stream."""
    stream, scratch = message_stream(spark, sf_dir, "dns", damaged=False)
    job = tm.archive_stream(tm.assigned(stream, [0, 1]), f"{scratch}/lines", f"{scratch}/checkpoint", interval=None)
    job.awaitTermination()
    return tm.read_archive(spark, f"{scratch}/lines")


STREAM_ARCHIVE = f"""
    select segment, line from (
        select {MESSAGE_OFFSET} as bucket, {MESSAGE_MINUTE} as segment, {recipes.line('dns', DUCK)} as line from events)
    where bucket % 3 in (0, 1)"""


def stream_reports_empty_batches(spark, sf_dir):
    """Messages without lines: their batches are reported, with no rows and no labels."""
    scratch = scratch_dir(spark, "empty")
    nothing = encoded(events(spark, sf_dir), "flow", F.array().cast("array<string>"))
    nothing.select(F.lit(None).cast("binary").alias("key"), "*").write.parquet(f"{scratch}/messages")
    stream = tm.read_segment_files(spark, f"{scratch}/messages", streaming=True, max_files_per_trigger=1)
    tm.ingest_stream(stream, "flow", f"{scratch}/checkpoint", path=f"{scratch}/landing", interval=None).awaitTermination()
    reports = tm.read_reports(spark, f"{scratch}/checkpoint").groupBy("log_type")
    return reports.agg(
        *[F.sum(c).alias(c) for c in ("rows", "bad_rows", "dropped_rows")],
        F.count("min_label").alias("labels"),
        (F.count(F.lit(1)) > 0).alias("reported"),
    )


STREAM_REPORTS_EMPTY_BATCHES = """
    select 'flow' as log_type, cast(0 as bigint) as rows, cast(0 as bigint) as bad_rows, cast(0 as bigint) as dropped_rows,
        cast(0 as bigint) as labels, count(*) > 0 as reported
    from events"""

def stream_drained(spark, sf_dir):
    """A stream that is asked to stop after its first report, then started again: nothing is missing, nothing comes twice."""
    scratch = scratch_dir(spark, "drained")
    messages(spark, sf_dir, "proxy").write.parquet(f"{scratch}/messages")
    start = lambda: tm.ingest_stream(
        tm.read_segment_files(spark, f"{scratch}/messages", streaming=True, max_files_per_trigger=1),
        "proxy", f"{scratch}/checkpoint", path=f"{scratch}/landing", interval=None,
    )
    first = start()
    while first.isActive and tm.read_reports(spark, f"{scratch}/checkpoint").isEmpty():
        first.awaitTermination(0.2)
    tm.request_stop(spark, f"{scratch}/checkpoint")
    first.awaitTermination()
    start().awaitTermination()
    return tm.read_accepted(spark, f"{scratch}/landing", "proxy")


#: Messages up to this one come by a stream whose checkpoint the compaction knows, the later ones by another.
KNOWN = "(select max(event_id) * 2 // 3 from events)"


def compact_days(spark, sf_dir):
    """Closed days come out in one file an hour, with the same rows; days that an unknown stream writes stay."""
    scratch = scratch_dir(spark, "compact")
    topic = messages(spark, sf_dir, "flow")
    border = events(spark, sf_dir).agg(F.expr("max(event_id) * 2 div 3")).first()[0]
    early = F.col("offset") * LINES_PER_MESSAGE <= border
    topic.where(early).write.parquet(f"{scratch}/early")
    topic.where(~early).write.parquet(f"{scratch}/late")
    path = f"{scratch}/landing"
    for part in ("early", "late"):
        stream = tm.read_segment_files(spark, f"{scratch}/{part}", streaming=True, max_files_per_trigger=3)
        tm.ingest_stream(stream, "flow", f"{scratch}/checkpoint-{part}", path=path, interval=None).awaitTermination()
    days = tm.compact_days(spark, path, "flow", [f"{scratch}/checkpoint-early"])
    days = days.select(*[F.col(c).alias(f"day_{c}") for c in "ymd"], "open", (F.col("files") >= F.col("files_after")).alias("fewer"))
    rows = tm.read_accepted(spark, path, "flow").select("y", "m", "d", "h", F.col("_metadata.file_path").alias("file"))
    hours = rows.groupBy("y", "m", "d", "h").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("file").alias("files"))
    hours = hours.groupBy("y", "m", "d").agg(F.sum("rows").alias("rows"), F.max("files").alias("most"))
    joined = hours.join(days, F.expr("y = day_y and m = day_m and d = day_d"))
    return joined.select("d", "rows", "open", "fewer", (F.col("open") | (F.col("most") == 1)).alias("one_file_an_hour"))


COMPACT_DAYS = f"""
    with late as (
        select distinct strftime(ts, '%Y-%m-%d') as day from events where {MESSAGE_OFFSET} * {LINES_PER_MESSAGE} > {KNOWN}),
    kept as (select d, strftime(make_date(y, m, d), '%Y-%m-%d') as day from ({kept_rows('flow')}))
    select d, count(*) as rows, day in (select day from late) as open, true as fewer, true as one_file_an_hour
    from kept group by d, day"""


def covered_offsets(spark, sf_dir):
    """A stream takes one Kafka partition, a job the early offsets; a backfill takes what both left: no line twice."""
    scratch = scratch_dir(spark, "covered")
    messages(spark, sf_dir, "ids_event").write.parquet(f"{scratch}/messages")
    batch = tm.read_segment_files(spark, f"{scratch}/messages")
    stream = tm.read_segment_files(spark, f"{scratch}/messages", streaming=True, max_files_per_trigger=3)
    into = {"path": f"{scratch}/landing", "coverage": f"{scratch}/coverage"}
    tm.ingest_stream(tm.assigned(stream, [1]), "ids_event", f"{scratch}/checkpoint", interval=None, **into).awaitTermination()
    border = batch.agg(F.expr("max(offset) div 2")).first()[0]
    early = tm.uncovered(batch.where(F.col("offset") <= border), tm.covered_offsets(spark, into["coverage"]))
    tm.ingest_batch(early, "ids_event", **into)
    tm.ingest_batch(tm.uncovered(batch, tm.covered_offsets(spark, into["coverage"])), "ids_event", **into)
    return tm.read_accepted(spark, into["path"], "ids_event")


def offset_gaps(spark, sf_dir):
    """What is stored of a topic, and what is not, when every seventh message and all from 3,000 to 3,999 were left out."""
    whole = encoded(events(spark, sf_dir), "flow", F.array(F.lit("x"))).withColumn("partition", F.lit(0))
    stored = whole.where("offset % 7 <> 0 and offset not between 3000 and 3999")
    covered, wanted = tm.offset_ranges(stored), tm.offset_ranges(whole)
    missing = tm.missing_offsets(covered, wanted)
    return covered.withColumn("stored", F.lit(True)).union(missing.withColumn("stored", F.lit(False)))


OFFSET_GAPS = """
    with marked as (select event_id as o, event_id % 7 <> 0 and event_id not between 3000 and 3999 as stored from events),
    numbered as (select *, o - row_number() over (partition by stored order by o) as island from marked)
    select 'ingest-flow' as topic, cast(0 as integer) as partition, min(o) as first, max(o) as last, stored
    from numbered group by stored, island"""


def plan_offsets(spark, sf_dir):
    """Nine tenths of the messages are in one Kafka partition: it is cut into most of the ranges, all of about one size."""
    line = F.expr(recipes.line("flow", SPARK))
    topic = encoded(events(spark, sf_dir), "flow", F.array(line)).withColumn("partition", F.expr("if(offset % 10 = 0, offset % 3, 3)"))
    planned = tm.plan_offsets(topic.withColumn("partition", F.col("partition").cast("int")), 40)
    whole = planned.groupBy("partition").agg(
        F.sum("messages").alias("messages"), F.min("first").alias("first"), F.max("last").alias("last"), F.max("bytes").alias("most")
    )
    mean = planned.agg((F.sum("bytes") / 40).alias("mean"))
    even = (F.col("most") <= 1.5 * F.col("mean")).alias("even")
    return whole.crossJoin(mean).select("partition", "messages", "first", "last", even)


PLAN_OFFSETS = """
    select cast(case when event_id % 10 = 0 then event_id % 3 else 3 end as integer) as partition, count(*) as messages,
        min(event_id) as first, max(event_id) as last, true as even
    from events group by 1"""


def app_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with the lines of `user_log`."""
    line = F.expr("concat_ws('|', date_format(ts, 'yyyy-MM-dd HH:mm:ss'), event_id, user_id, event_type)")
    stamp = F.expr(f"timestamp_micros({SPARK.micros})").alias("ts")
    lines = events(spark, sf_dir).select("event_id", stamp, line.alias("line"))
    packed = tm.pack_segments(lines, LINES_PER_MESSAGE, pos="event_id", stamp="ts")
    return packed.select("value", F.lit("app").alias("topic"), F.lit(0).alias("partition"), F.col("bucket").alias("offset"), "timestamp")


def replay_quarantine(spark, sf_dir):
    """A rule rejected every seventh id; after the change, and two replays, the rows are those of a fresh ingest."""
    path = f"{scratch_dir(spark, 'replay')}/landing"
    topic = app_messages(spark, sf_dir)
    strict = replace(user_log(), name="app_replay", outputs=(
        derived("id", "bigint", "if(try_cast({1} as bigint) % 7 = 0, null, try_cast({1} as bigint))"), *user_log().outputs[1:]
    ))
    tm.register(strict, replace=True)
    tm.ingest_batch(topic, "app_replay", path=path, rebalance=True)  # packed by a shuffle, so every task has all hours
    tm.register(replace(user_log(), name="app_replay"), replace=True)
    for _ in range(2):
        tm.replay_quarantine(spark, path, "app_replay")
    return tm.read_accepted(spark, path, "app_replay")


#: Seven tenths of the events come from one source.
SOURCE = "case when event_id % 10 < 7 then 0 else user_id end"


def publish_segments(spark, sf_dir):
    """Messages by source in a topic's columns, read back: a hot source is in many partitions, any other in one."""
    path = f"{scratch_dir(spark, 'publish')}/topic"
    line = F.expr(recipes.line("flow", SPARK)).alias("line")
    lines = events(spark, sf_dir).select("event_id", F.expr(SOURCE).alias("source"), line)
    packed = tm.pack_segments(lines, 10, pos="event_id", by=["source"])
    tm.write_segment_files(tm.to_topic(packed, "flows", 8, by=["source"], bucket="bucket"), path)
    topic = tm.read_segment_files(spark, path).withColumn("source", F.get_json_object(F.col("key").cast("string"), "$.source"))
    places = topic.groupBy("source").agg(F.count_distinct("partition").alias("places"))
    found = tm.explode_lines(tm.decode_segments(topic.select("value", F.col("source").cast("bigint").alias("offset"))))
    joined = found.join(places.select(F.col("source").cast("bigint").alias("source"), "places"), F.col("offset") == F.col("source"))
    return joined.select("source", "line", (F.col("places") > 1).alias("wide"))


PUBLISH_SEGMENTS = f"""
    select {SOURCE} as source, {recipes.line('flow', DUCK)} as line, {SOURCE} = 0 as wide from events"""


def republish_stream(spark, sf_dir):
    """A stream gives messages their times as keys and sends them on; read back, the lines of each time are the same."""
    stream, scratch = message_stream(spark, sf_dir, "dns", damaged=False)
    keyed = lambda topic: topic.select(F.unix_micros("timestamp").alias("stamp_us"), "value")
    widths = tm.topic_widths(keyed(tm.read_segment_files(spark, f"{scratch}/messages")), ["stamp_us"], 6)
    sent = tm.to_topic(keyed(stream), "dns-by-stamp", 6, by=["stamp_us"], widths=widths)
    tm.write_segment_files(sent, f"{scratch}/sent", f"{scratch}/checkpoint").awaitTermination()
    back = tm.read_segment_files(spark, f"{scratch}/sent")
    back = back.withColumn("offset", F.get_json_object(F.col("key").cast("string"), "$.stamp_us").cast("bigint"))
    return tm.explode_lines(tm.decode_segments(back)).select("topic", F.col("offset").alias("stamp_us"), "line")


REPUBLISH_STREAM = f"""
    select 'dns-by-stamp' as topic, {MESSAGE_STAMP} as stamp_us, {recipes.line('dns', DUCK)} as line from events"""


def _two_versions(spark, sf_dir) -> tuple[LogType, DataFrame, LogType, DataFrame]:
    """An older version of `user_log`, with narrow ids and no seconds, and the new one, each with half of the messages."""
    new = user_log()
    old = replace(new, outputs=(*whole("int", "id user_id", 1, 2), *text("kind", 3), *clock_parts()))
    topic = app_messages(spark, sf_dir)
    half = events(spark, sf_dir).agg(F.expr(f"max(event_id) div {2 * LINES_PER_MESSAGE}")).first()[0]
    return old, topic.where(F.col("offset") < half), new, topic.where(F.col("offset") >= half)


def evolve_table(spark, sf_dir):
    """A table gets wider ids and a new column between its own; rows of both versions are read as one."""
    old, early, new, late = _two_versions(spark, sf_dir)
    place = scratch_dir(spark, "evolve")
    table = f"app_{place[-32:]}"
    tm.create_table(spark, table, old, f"{place}/table")
    tm.ingest_batch(early, old, table=table, mode="drop")
    tm.evolve_table(spark, table, new)
    tm.ingest_batch(late, new, table=table, mode="drop")
    return spark.table(table)


def evolve_landing(spark, sf_dir):
    """The same for a landing folder: a batch job of the old version, then a stream of the new one."""
    old, early, new, late = _two_versions(spark, sf_dir)
    place = scratch_dir(spark, "evolve")
    path = f"{place}/landing"
    tm.ingest_batch(early, old, path=path)
    tm.evolve_landing(spark, path, new)
    late.withColumn("key", F.lit(None).cast("binary")).write.parquet(f"{place}/late")
    stream = tm.read_segment_files(spark, f"{place}/late", streaming=True)
    tm.ingest_stream(stream, new, f"{place}/checkpoint", path=path, interval=None).awaitTermination()
    return tm.read_accepted(spark, path, new)


EVOLVED = REGISTERED_LOG_TYPE.replace(
    "epoch_us(ts) // 1000000",
    f"case when {MESSAGE_OFFSET} >= (select max(event_id) // {2 * LINES_PER_MESSAGE} from events) then epoch_us(ts) // 1000000 end",
)


# ---------------------------------------------------------------- contract


def _catalog() -> dict[str, tuple[Query, str]]:
    catalog: dict[str, tuple[Query, str]] = {
        "envelope_roundtrip": (envelope_roundtrip, ENVELOPE_ROUNDTRIP),
        "envelope_encoded_hex": (envelope_encoded_hex, ENVELOPE_ENCODED_HEX),
        "envelope_errors": (envelope_errors, ENVELOPE_ERRORS),
        "pack_segments": (pack_segments, PACK_SEGMENTS),
        "pack_in_place": (pack_in_place, PACK_IN_PLACE),
        "assigned_partitions": (assigned_partitions, ASSIGNED_PARTITIONS),
        "split_fields": (split_fields, SPLIT_FIELDS),
        "tokenize_quoted": (tokenize_quoted, TOKENIZE_QUOTED),
    }
    for t in TYPES:
        catalog[f"normalize_{t}"] = (normalize(t), expected.rows(t))
        catalog[f"drop_mode_{t}"] = (drop_mode(t), kept_rows(t))
        catalog[f"quarantine_{t}"] = (quarantine(t), quarantine_sql(t))
        catalog[f"quarantine_control_characters_{t}"] = (control_characters(t), control_characters_sql(t))
        catalog[f"accounting_{t}"] = (accounting(t), accounting_sql(t))
        catalog[f"batch_report_{t}"] = (batch_report(t), batch_report_sql(t))
        catalog[f"landing_rows_{t}"] = (landing_rows(t), kept_rows(t))
        catalog[f"stream_ingest_{t}"] = (stream_ingest(t), kept_rows(t))
    catalog |= {
        "dns_local_zone": (local_zone("dns"), expected.rows("dns", shift_hours=9)),
        "flow_local_zone": (local_zone("flow"), expected.rows("flow", shift_hours=9)),
        "dns_guard_defaults": (dns_guard_defaults, DNS_GUARD_DEFAULTS),
        "dns_strict_rcode": (dns_strict_rcode, DNS_STRICT_RCODE),
        "ids_vlan_default": (ids_vlan_default, IDS_VLAN_DEFAULT),
        "ids_exact_epoch": (ids_exact_epoch, IDS_EXACT_EPOCH),
        "proxy_full_uri": (proxy_full_uri, PROXY_FULL_URI),
        "proxy_short_lines": (proxy_short_lines, PROXY_SHORT_LINES),
        "failfast_mode": (failfast_mode, expected.rows("ids_event")),
        "registered_log_type": (registered_log_type, REGISTERED_LOG_TYPE),
        "table_append": (table_append, kept_rows("flow")),
        "partition_pruned_read": (partition_pruned_read, PARTITION_PRUNED_READ),
        "quarantine_table": (quarantine_table, message_quarantine_sql("ids_event")),
        "landing_rejects": (landing_rejects, message_quarantine_sql("proxy")),
        "archive_segments": (archive_segments, ARCHIVE_SEGMENTS),
        "stream_landing": (stream_landing, message_quarantine_sql("flow")),
        "stream_table": (stream_table, kept_rows("ids_packet")),
        "stream_reports": (stream_reports, STREAM_REPORTS),
        "stream_archive": (stream_archive, STREAM_ARCHIVE),
        "pack_null_lines": (pack_null_lines, PACK_NULL_LINES),
        "pack_large_places": (pack_large_places, PACK_LARGE_PLACES),
        "pack_repeating_places": (pack_repeating_places, PACK_IN_PLACE),
        "table_and_quarantine": (table_and_quarantine, TABLE_AND_QUARANTINE),
        "quarantine_pruned_read": (quarantine_pruned_read, QUARANTINE_PRUNED_READ),
        "backfill_beside_stream": (backfill_beside_stream, kept_rows("ids_event")),
        "two_streams_one_folder": (two_streams_one_folder, kept_rows("ids_packet")),
        "archive_beside_stream": (archive_beside_stream, ARCHIVE_BESIDE_STREAM),
        "archive_carriage_returns": (archive_carriage_returns, ARCHIVE_CARRIAGE_RETURNS),
        "stream_reports_files": (stream_reports_files, STREAM_REPORTS),
        "stream_reports_empty_batches": (stream_reports_empty_batches, STREAM_REPORTS_EMPTY_BATCHES),
        "compact_days": (compact_days, COMPACT_DAYS),
        "covered_offsets": (covered_offsets, kept_rows("ids_event")),
        "offset_gaps": (offset_gaps, OFFSET_GAPS),
        "plan_offsets": (plan_offsets, PLAN_OFFSETS),
        "replay_quarantine": (replay_quarantine, REGISTERED_LOG_TYPE),
        "publish_segments": (publish_segments, PUBLISH_SEGMENTS),
        "republish_stream": (republish_stream, REPUBLISH_STREAM),
        "stream_drained": (stream_drained, kept_rows("proxy")),
        "evolve_table": (evolve_table, EVOLVED),
        "evolve_landing": (evolve_landing, EVOLVED),
    }
    return catalog


def entry(spark: SparkSession) -> DataFrame:
    """Flow messages of 50 lines, decoded and normalised."""
    packed = tm.pack_segments(sound_lines(spark, "/root/testdata/sf0.001", "flow"), LINES_PER_MESSAGE)
    return tm.normalize(tm.explode_lines(tm.decode_segments(packed)), "flow")


def queries() -> dict[str, Query]:
    found = {name: query for name, (query, _) in _catalog().items()}
    if llm:
        found |= llm.QUERIES
    if corpus_pipeline:
        found["pipeline"] = corpus_pipeline.run
    return found


def oracle_sql() -> dict[str, str]:
    found = {name: sql for name, (_, sql) in _catalog().items()}
    if llm:
        found |= llm.ORACLE_SQL
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        found["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found
