"""The five built-in log types.

Column names, types and order, field positions, placeholders and labels are
fixed values: tables and collectors that exist already rely on them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from telemill.functions import clock as clocks
from telemill.functions.text import full_uri, has_open_quote, tokenize_quoted
from telemill.plans.logtype import (
    LogType,
    Output,
    clock_parts,
    derived,
    padded_clock_parts,
    real,
    register,
    text,
    whole,
)


def dns_log(strict_rcode_guard: bool = False, name: str = "dns") -> LogType:
    """DNS captures.

    The answer code defaults to 0 when the query *class* is empty;
    `strict_rcode_guard` looks at the answer code's own field instead.
    """
    guard = 9 if strict_rcode_guard else 8
    return LogType(
        name=name,
        segment_label="pcap segments",
        min_fields=11,
        label="frame_time",
        epoch=2,
        clock=lambda r: clocks.epoch_clock(r.epoch, r.tz),
        outputs=(
            # The time text itself holds a comma, so it arrives as two fields.
            Output("frame_time", "string", "concat({0}, ', ', {1})", checked=False),
            derived("unix_tstamp", "bigint", lambda r: clocks.whole_seconds(r.epoch)),
            *whole("int", "frame_len", 3),
            *text("ip_dst ip_src dns_qry_name dns_qry_class", 5, 4, 6, 8),
            derived("dns_qry_type", "int", "if({7} = '', 0, try_cast({7:n} as int))"),
            derived("dns_qry_rcode", "int", f"if({{{guard}}} = '', 0, try_cast({{9:n}} as int))"),
            *text("dns_a", 10),
            *clock_parts(),
        ),
    )


def flow_log(name: str = "flow") -> LogType:
    """Network flows. The partition keys are the wire's own date fields."""
    return LogType(
        name=name,
        segment_label="netflow segments",
        min_fields=27,
        label="treceived",
        clock=lambda r: clocks.wall_clock(r[0]),
        outputs=(
            *text("treceived", 0),
            derived("unix_tstamp", "bigint", lambda r: clocks.epoch_of(r.clock, r.tz)),
            *whole("int", "tryear trmonth trday trhour trminute trsecond", 1, 2, 3, 4, 5, 6),
            real("tdur", 7),
            *text("sip dip", 8, 9),
            *whole("int", "sport dport", 10, 11),
            *text("proto flag", 12, 13),
            *whole("int", "fwd stos", 14, 15),
            *whole("bigint", "ipkt ibyt opkt obyt", 16, 17, 18, 19),
            *whole("int", "input output sas das dtos dir", 20, 21, 22, 23, 24, 25),
            *text("rip", 26),
            *whole("smallint", "y m d h", 1, 2, 3, 4),
        ),
    )


def _exact_epoch(wanted: bool) -> list[Output]:
    return [derived("unix_tstamp_d", "double", lambda r: r.epoch)] if wanted else []


def ids_event_log(exact_epoch: bool = False, name: str = "ids_event") -> LogType:
    """Intrusion-detection events.

    `unix_tstamp` is a 32-bit float and so off by up to a minute;
    `exact_epoch` adds `unix_tstamp_d` with all 64 bits.
    """
    return LogType(
        name=name,
        segment_label="ids event segments",
        min_fields=19,
        label="unix_tstamp",
        epoch=18,
        clock=lambda r: clocks.epoch_clock(r.epoch),
        outputs=(
            *whole("smallint", "blocked", 1),
            *text("classification", 2),
            *whole("int", "classification_id", 3),
            *text("destination_ip", 4),
            *whole("int", "dport_icode event_id generator_id impact", 5, 6, 7, 8),
            *whole("smallint", "impact_flag", 9),
            *whole("int", "priority protocol sensor_id", 10, 11, 12),
            *whole("bigint", "signature_id", 13),
            *whole("int", "signature_revision", 14),
            *whole("bigint", "sport_itype", 15),
            *text("source_ip", 16),
            derived("vlan_id", "int", "if({17} = 'None', 0, try_cast({17:n} as int))"),
            derived("unix_tstamp", "float", lambda r: r.epoch),
            *_exact_epoch(exact_epoch),
            *clock_parts(),
        ),
    )


def ids_packet_log(exact_epoch: bool = False, name: str = "ids_packet") -> LogType:
    """Packets that belong to intrusion-detection events."""
    return LogType(
        name=name,
        segment_label="ids packet segments",
        min_fields=8,
        label="unix_tstamp",
        epoch=7,
        clock=lambda r: clocks.epoch_clock(r.epoch),
        outputs=(
            *text("data", 1),
            *whole("int", "event_id event_second length", 2, 3, 4),
            *whole("smallint", "linktype", 5),
            *whole("int", "sensor_id", 6),
            derived("unix_tstamp", "float", lambda r: r.epoch),
            *_exact_epoch(exact_epoch),
            *clock_parts(),
        ),
    )


def proxy_log(name: str = "proxy") -> LogType:
    """Web-proxy logs; lines of at most one token are skipped."""
    return LogType(
        name=name,
        segment_label="proxy-log segments",
        min_fields=27,
        label="p_date",
        tokenize=tokenize_quoted,
        broken=has_open_quote,
        skip=lambda tokens: tokens.isNotNull() & (F.size(tokens) <= 1),
        clock=lambda r: clocks.wall_clock(F.concat_ws(" ", r[0], r[1])),
        outputs=(
            *text("p_date p_time clientip host reqmethod useragent resconttype", 0, 1, 3, 15, 12, 20, 13),
            *whole("bigint", "duration", 2),
            *text("username authgroup exceptionid filterresult webcat referer respcode action",
                  4, 5, 6, 7, 8, 9, 10, 11),
            *text("urischeme uriport uripath uriquery uriextension serverip", 14, 16, 17, 18, 19, 21),
            *whole("int", "scbytes csbytes", 22, 23),
            *text("virusid bcappname bcappoper", 24, 25, 26),
            Output("fulluri", "string", lambda r: full_uri(r[15], r[17], r[18]), checked=False),
            *padded_clock_parts(),
        ),
    )


BUILTIN = tuple(register(make()) for make in (dns_log, flow_log, ids_event_log, ids_packet_log, proxy_log))
