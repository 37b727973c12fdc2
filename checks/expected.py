"""Table rows as DuckDB SQL, computed straight from `events` and not from the lines."""

from __future__ import annotations

from checks.recipes import DUCK

SECONDS = f"cast({DUCK.seconds} as double)"


def _parts(clock: str) -> dict[str, str]:
    return {
        k: f"cast(extract({name} from {clock}) as smallint)"
        for k, name in (("y", "year"), ("m", "month"), ("d", "day"), ("h", "hour"))
    }


def columns(log_type: str, shift_hours: int = 0) -> dict[str, str]:
    """Column to SQL text. `shift_hours` is the distance of the local zone from UTC."""
    sip = "'10.0.' || cast(user_id % 256 as varchar) || '.' || cast(event_id % 256 as varchar)"
    dip = "'192.168.1.' || cast(event_id % 8 as varchar)"
    utc = _parts("ts")

    def ints(width: str, **exprs: str) -> dict[str, str]:
        return {k: f"cast({v} as {width})" for k, v in exprs.items()}

    if log_type == "dns":
        return {
            "frame_time": "strftime(ts, '%b %d') || ', ' || strftime(ts, ' %Y %H:%M:%S')",
            "unix_tstamp": "epoch_us(ts) // 1000000",
            **ints("integer", frame_len="60 + event_id % 1400"),
            "ip_dst": dip,
            "ip_src": sip,
            "dns_qry_name": "'host' || cast(event_id % 97 as varchar) || '.example.com'",
            "dns_qry_class": "case when event_id % 7 = 0 then '' else '0x00000001' end",
            **ints("integer", dns_qry_type="case when event_id % 10 = 0 then 0 else 1 + event_id % 28 end",
                   dns_qry_rcode="case when event_id % 7 = 0 then 0 else event_id % 4 end"),
            "dns_a": "'93.184.0.' || cast(event_id % 256 as varchar)",
            **_parts(f"(ts + interval {shift_hours} hour)"),
        }
    if log_type == "flow":
        wire = {f"tr{name}": f"extract({name} from ts)" for name in ("year", "month", "day", "hour", "minute", "second")}
        return {
            "treceived": "strftime(ts, '%Y-%m-%d %H:%M:%S')",
            "unix_tstamp": f"epoch_us(ts) // 1000000 - {shift_hours * 3600}",
            **ints("integer", **wire),
            "tdur": "cast(event_id % 1000 + 0.125 as float)",
            "sip": sip,
            "dip": dip,
            **ints("integer", sport="1024 + event_id % 60000", dport="event_id % 1024"),
            "proto": "case when event_id % 2 = 0 then 'TCP' else 'UDP' end",
            "flag": "'.AP.SF'",
            **ints("integer", fwd="0", stos="0"),
            **ints("bigint", ipkt="1 + event_id % 50", ibyt="40 * (1 + event_id % 50)", opkt="event_id % 20",
                   obyt="40 * (event_id % 20)"),
            **ints("integer", input="2", output="3", sas="0", das="0", dtos="0", dir="event_id % 2"),
            "rip": "'0.0.0.0'",
            **utc,
        }
    if log_type == "ids_event":
        return {
            **ints("smallint", blocked="event_id % 2"),
            "classification": "'class ' || event_type",
            **ints("integer", classification_id="event_id % 30"),
            "destination_ip": dip,
            **ints("integer", dport_icode="event_id % 1024", event_id="event_id", generator_id="1", impact="event_id % 5"),
            **ints("smallint", impact_flag="32"),
            **ints("integer", priority="1 + event_id % 3", protocol="case when event_id % 2 = 0 then 6 else 17 end",
                   sensor_id="4"),
            **ints("bigint", signature_id="4294967296 + event_id"),
            **ints("integer", signature_revision="event_id % 9"),
            **ints("bigint", sport_itype="1024 + event_id % 60000"),
            "source_ip": sip,
            **ints("integer", vlan_id="case when event_id % 4 = 0 then 0 else event_id % 4096 end"),
            "unix_tstamp": f"cast({SECONDS} as float)",
            **utc,
        }
    if log_type == "ids_packet":
        return {
            "data": "'deadbeef' || lpad(cast(event_id as varchar), 8, '0')",
            **ints("integer", event_id="event_id", event_second="epoch_us(ts) // 1000000",
                   length="60 + event_id % 1400"),
            **ints("smallint", linktype="1"),
            **ints("integer", sensor_id="4"),
            "unix_tstamp": f"cast({SECONDS} as float)",
            **utc,
        }
    host = "'www' || cast(event_id % 97 as varchar) || '.example.com'"
    path = "'/p/' || cast(event_id % 500 as varchar)"
    query = "'?q=' || cast(event_id as varchar)"
    same = {"authgroup": "-", "exceptionid": "-", "filterresult": "OBSERVED", "referer": "-", "respcode": "200",
            "action": "TCP_HIT", "urischeme": "http", "uriport": "80", "uriextension": "html", "virusid": "-",
            "bcappname": "none", "bcappoper": "none", "resconttype": "text/html",
            "useragent": '"Mozilla/5.0 (X11; Linux)"'}
    return {
        "p_date": "strftime(ts, '%Y-%m-%d')",
        "p_time": "strftime(ts, '%H:%M:%S')",
        "clientip": sip,
        "host": host,
        "reqmethod": "case when event_id % 5 = 0 then 'POST' else 'GET' end",
        **ints("bigint", duration="event_id % 5000"),
        "username": "case when event_id % 3 = 0 then '-' else 'user' || cast(user_id as varchar) end",
        "webcat": "'\"Web Ads/' || event_type || '\"'",
        "uripath": f"case when event_id % 6 = 0 then '/' else {path} end",
        "uriquery": f"case when event_id % 4 = 0 then '-' else {query} end",
        "serverip": dip,
        **ints("integer", scbytes="event_id % 100000", csbytes="200 + event_id % 900"),
        "fulluri": f"{host} || case when event_id % 6 = 0 then '' else {path} end"
                   f" || case when event_id % 4 = 0 then '' else {query} end",
        **{k: f"'{v}'" for k, v in same.items()},
        "y": "strftime(ts, '%Y')",
        "m": "strftime(ts, '%m')",
        "d": "strftime(ts, '%d')",
        "h": "strftime(ts, '%H')",
    }


def select_list(exprs: dict[str, str]) -> str:
    return ", ".join(f"{expr} as {name}" for name, expr in exprs.items())


def rows(log_type: str, shift_hours: int = 0, source: str = "events", where: str = "true", **changed: str) -> str:
    """SQL of the rows; `changed` columns are computed by other SQL text."""
    exprs = {**columns(log_type, shift_hours), **changed}
    return f"select {select_list(exprs)} from {source} where {where}"
