"""Lines made from the `events` table, as SQL text for Spark and for DuckDB.

Both dialects give the same bytes, so DuckDB can check what Spark makes of them.
"""

from __future__ import annotations

from dataclasses import dataclass

TYPES = ("dns", "flow", "ids_event", "ids_packet", "proxy")
SEPARATORS = {"proxy": " "}


@dataclass(frozen=True)
class Dialect:
    micros: str
    quotient: str
    text_type: str
    format_call: str
    spark_patterns: bool

    def div(self, a: str, b: int) -> str:
        return f"({a} {self.quotient} {b})"

    def text(self, expr: str) -> str:
        return f"cast({expr} as {self.text_type})"

    def time(self, spark: str, duck: str) -> str:
        return f"{self.format_call}(ts, '{spark if self.spark_patterns else duck}')"

    @property
    def seconds(self) -> str:
        """Epoch seconds with six decimals, as text."""
        fraction = f"lpad({self.text(f'{self.micros} % 1000000')}, 6, '0')"
        return f"{self.text(self.div(self.micros, 1000000))} || '.' || {fraction}"


# Not `unix_micros(cast(ts as timestamp))`: `ts` has no zone and the session's must not matter.
SPARK_MICROS = """(unix_date(cast(ts as date)) * 86400000000L + (hour(ts) * 3600 + minute(ts) * 60) * 1000000L
    + cast(extract(second from ts) * 1000000 as bigint))"""

SPARK = Dialect(SPARK_MICROS, "div", "string", "date_format", True)
DUCK = Dialect("epoch_us(ts)", "//", "varchar", "strftime", False)



def fields(log_type: str, d: Dialect) -> list[str]:
    """SQL text of every field of a line, in wire order."""
    n = d.text
    lit = "'{}'".format
    sip = f"'10.0.' || {n('user_id % 256')} || '.' || {n('event_id % 256')}"
    dip = f"'192.168.1.' || {n('event_id % 8')}"
    if log_type == "dns":
        return [
            d.time("MMM dd", "%b %d"), d.time(" yyyy HH:mm:ss", " %Y %H:%M:%S"), d.seconds,
            n("60 + event_id % 1400"), sip, dip, f"'host' || {n('event_id % 97')} || '.example.com'",
            f"case when event_id % 10 = 0 then '' else {n('1 + event_id % 28')} end",
            "case when event_id % 7 = 0 then '' else '0x00000001' end",
            f"case when event_id % 7 = 0 then '' else {n('event_id % 4')} end",
            f"'93.184.0.' || {n('event_id % 256')}",
        ]
    if log_type == "flow":
        part = lambda name: n(f"cast(extract({name} from ts) as int)")
        return [
            d.time("yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"),
            *[part(p) for p in ("year", "month", "day", "hour", "minute", "second")],
            f"{n('event_id % 1000')} || '.125'", sip, dip, n("1024 + event_id % 60000"), n("event_id % 1024"),
            "case when event_id % 2 = 0 then 'TCP' else 'UDP' end", lit(".AP.SF"), lit(0), lit(0),
            n("1 + event_id % 50"), n("40 * (1 + event_id % 50)"), n("event_id % 20"), n("40 * (event_id % 20)"),
            lit(2), lit(3), lit(0), lit(0), lit(0), n("event_id % 2"), lit("0.0.0.0"),
        ]
    if log_type == "ids_event":
        return [
            lit("ids_event"), n("event_id % 2"), "'class ' || event_type", n("event_id % 30"), dip,
            n("event_id % 1024"), n("event_id"), lit(1), n("event_id % 5"), lit(32), n("1 + event_id % 3"),
            "case when event_id % 2 = 0 then '6' else '17' end", lit(4), n("4294967296 + event_id"),
            n("event_id % 9"), n("1024 + event_id % 60000"), sip,
            f"case when event_id % 4 = 0 then 'None' else {n('event_id % 4096')} end", d.seconds,
        ]
    if log_type == "ids_packet":
        return [
            lit("ids_packet"), f"'deadbeef' || lpad({n('event_id')}, 8, '0')", n("event_id"),
            n(d.div(d.micros, 1000000)), n("60 + event_id % 1400"), lit(1), lit(4), d.seconds,
        ]
    return [
        d.time("yyyy-MM-dd", "%Y-%m-%d"), d.time("HH:mm:ss", "%H:%M:%S"), n("event_id % 5000"), sip,
        f"case when event_id % 3 = 0 then '-' else 'user' || {n('user_id')} end", lit("-"), lit("-"),
        lit("OBSERVED"), "'\"Web Ads/' || event_type || '\"'", lit("-"), lit(200), lit("TCP_HIT"),
        "case when event_id % 5 = 0 then 'POST' else 'GET' end", lit("text/html"), lit("http"),
        f"'www' || {n('event_id % 97')} || '.example.com'", lit(80),
        f"case when event_id % 6 = 0 then '/' else '/p/' || {n('event_id % 500')} end",
        f"case when event_id % 4 = 0 then '-' else '?q=' || {n('event_id')} end", lit("html"),
        lit('"Mozilla/5.0 (X11; Linux)"'), dip, n("event_id % 100000"), n("200 + event_id % 900"), lit("-"),
        lit("none"), lit("none"),
    ]


def join(log_type: str, parts: list[str]) -> str:
    return f"concat_ws('{SEPARATORS.get(log_type, ',')}', {', '.join(parts)})"


def line(log_type: str, d: Dialect) -> str:
    """SQL text of a sound line."""
    return join(log_type, fields(log_type, d))


# What each damage does to a line: the field it replaces, by what, and the
# reason that follows.
FRACTIONS = {
    "dns": (3, "frame_len"), "flow": (10, "sport"), "ids_event": (6, "event_id"),
    "ids_packet": (2, "event_id"), "proxy": (22, "scbytes"),
}
OVERFLOWS = {
    "dns": (3, "9999999999", "frame_len"), "flow": (1, "70000", "y"), "ids_event": (1, "32768", "blocked"),
    "ids_packet": (5, "32768", "linktype"), "proxy": (23, "2147483648", "csbytes"),
}
CLOCKS = {"dns": 2, "flow": 0, "ids_event": 18, "ids_packet": 7, "proxy": 0}
USER_AGENT = 20


def damage(log_type: str) -> str:
    """SQL text that names the damage of a row; the first rule that fits counts."""
    rules = [(101, "cut"), (103, "fraction"), (107, "overflow"), (109, "time")]
    if log_type == "proxy":
        rules += [(113, "quote"), (127, "blank")]
    rules += [(131, "extra")]
    if log_type == "dns":
        rules += [(11, "no_rcode"), (13, "no_class")]
    whens = " ".join(f"when event_id % {k} = 0 then '{name}'" for k, name in rules)
    return f"case {whens} else 'none' end"


def damaged_line(log_type: str, d: Dialect) -> str:
    """SQL text of the line after the damage in a column `damage`."""
    parts = fields(log_type, d)

    def swap(name: str, index: int, value: str) -> None:
        parts[index] = f"case when damage = '{name}' then {value} else {parts[index]} end"

    swap("fraction", FRACTIONS[log_type][0], "'12.5'")
    swap("overflow", OVERFLOWS[log_type][0], f"'{OVERFLOWS[log_type][1]}'")
    swap("time", CLOCKS[log_type], "'x'")
    if log_type == "proxy":
        swap("quote", USER_AGENT, "'\"Mozilla/5.0 (X11; Linux)'")
    if log_type == "dns":
        swap("no_rcode", 8, "'0x00000001'")
        swap("no_rcode", 9, "''")
        swap("no_class", 8, "''")
        swap("no_class", 9, "'3'")
    whole = join(log_type, parts)
    branches = [
        f"when damage = 'cut' then {join(log_type, fields(log_type, d)[:3])}",
        f"when damage = 'extra' then {join(log_type, [*parts, chr(39) + 'more' + chr(39), chr(39) + '7' + chr(39)])}",
    ]
    if log_type == "proxy":
        branches.append("when damage = 'blank' then case when event_id % 2 = 0 then '' else '#' end")
    return f"case {' '.join(branches)} else {whole} end"


def reason(log_type: str) -> str:
    """SQL text of the reason that belongs to a column `damage`."""
    return f"""case damage when 'cut' then 'SHORT_ROW'
        when 'fraction' then 'BAD_VALUE:{FRACTIONS[log_type][1]}'
        when 'overflow' then 'BAD_VALUE:{OVERFLOWS[log_type][2]}'
        when 'time' then 'BAD_TIME'
        when 'quote' then 'UNCLOSED_QUOTE'
        when 'blank' then 'SHORT_LINE'
        when 'no_rcode' then 'BAD_VALUE:dns_qry_rcode' end"""
