import math

import pytest
from shared import GOLDEN, fields_of

import telemill as tm
from checks.recipes import TYPES
from telemill.plans.logtype import LogType, clock_parts, text

# Table columns, fixed values.
SCHEMAS = {
    "dns": "frame_time string, unix_tstamp bigint, frame_len int, ip_dst string, ip_src string, dns_qry_name string, "
    "dns_qry_class string, dns_qry_type int, dns_qry_rcode int, dns_a string, "
    "y smallint, m smallint, d smallint, h smallint",
    "flow": "treceived string, unix_tstamp bigint, tryear int, trmonth int, trday int, trhour int, trminute int, "
    "trsecond int, tdur float, sip string, dip string, sport int, dport int, proto string, flag string, fwd int, "
    "stos int, ipkt bigint, ibyt bigint, opkt bigint, obyt bigint, input int, output int, sas int, das int, dtos int, "
    "dir int, rip string, y smallint, m smallint, d smallint, h smallint",
    "ids_event": "blocked smallint, classification string, classification_id int, destination_ip string, "
    "dport_icode int, event_id int, generator_id int, impact int, impact_flag smallint, priority int, protocol int, "
    "sensor_id int, signature_id bigint, signature_revision int, sport_itype bigint, source_ip string, vlan_id int, "
    "unix_tstamp float, y smallint, m smallint, d smallint, h smallint",
    "ids_packet": "data string, event_id int, event_second int, length int, linktype smallint, sensor_id int, "
    "unix_tstamp float, y smallint, m smallint, d smallint, h smallint",
    "proxy": "p_date string, p_time string, clientip string, host string, reqmethod string, useragent string, "
    "resconttype string, duration bigint, username string, authgroup string, exceptionid string, filterresult string, "
    "webcat string, referer string, respcode string, action string, urischeme string, uriport string, uripath string, "
    "uriquery string, uriextension string, serverip string, scbytes int, csbytes int, virusid string, "
    "bcappname string, bcappoper string, fulluri string, y string, m string, d string, h string",
}

ROWS = {
    "dns": ("Jan 01,  2024 00:03:52", 1704067432, 61, "192.168.1.1", "10.0.46.1", "host1.example.com",
            "0x00000001", 2, 1, "93.184.0.1", 2024, 1, 1, 0),
    "flow": ("2024-01-01 00:03:52", 1704067432, 2024, 1, 1, 0, 3, 52, 1.125, "10.0.46.1", "192.168.1.1", 1025, 1, "UDP",
             ".AP.SF", 0, 0, 2, 80, 1, 40, 2, 3, 0, 0, 0, 1, "0.0.0.0", 2024, 1, 1, 0),
    "ids_event": (1, "class click", 1, "192.168.1.1", 1, 1, 1, 1, 32, 2, 17, 4, 4294967297, 1, 1025, "10.0.46.1", 1,
                  1704067456.0, 2024, 1, 1, 0),
    "ids_packet": ("deadbeef00000001", 1, 1704067432, 61, 1, 4, 1704067456.0, 2024, 1, 1, 0),
    "proxy": ("2024-01-01", "00:03:52", "10.0.46.1", "www1.example.com", "GET", '"Mozilla/5.0 (X11; Linux)"', "text/html", 1,
              "user46", "-", "-", "OBSERVED", '"Web Ads/click"', "-", "200", "TCP_HIT", "http", "80", "/p/1", "?q=1", "html",
              "192.168.1.1", 1, 201, "-", "none", "none", "www1.example.com/p/1?q=1", "2024", "01", "01", "00"),
}


@pytest.mark.parametrize("log_type", TYPES)
def test_golden_row(lines, log_type):
    row = tm.normalize(lines(GOLDEN[log_type]), log_type).collect()
    assert [tuple(r) for r in row] == [ROWS[log_type]]


@pytest.mark.parametrize("log_type", TYPES)
def test_table_schema(lines, log_type):
    df = tm.normalize(lines(GOLDEN[log_type]), log_type)
    assert ", ".join(f"{n} {t}" for n, t in df.dtypes) == SCHEMAS[log_type]
    assert tm.resolve(log_type).schema.simpleString() == df.schema.simpleString()


def verdicts(df, log_type, **options):
    out = tm.classify(df, log_type, **options).orderBy("pos").collect()
    return [(r.status, r.reason) for r in out]


def test_first_failing_check_counts(lines):
    cases = {
        "": ("bad", "SHORT_ROW"),
        "a,b,c": ("bad", "SHORT_ROW"),
        fields_of("dns", f2="x", f3="12.5"): ("bad", "BAD_TIME"),
        fields_of("dns", f2="253402300800"): ("bad", "BAD_TIME"),
        fields_of("dns", f2="NaN"): ("bad", "BAD_TIME"),
        fields_of("dns", f3="12.5", f7="x"): ("bad", "BAD_VALUE:frame_len"),
        fields_of("dns", f7="x"): ("bad", "BAD_VALUE:dns_qry_type"),
        fields_of("dns", f9=""): ("bad", "BAD_VALUE:dns_qry_rcode"),
        fields_of("dns", f7="", f8="", f9="3"): ("ok", None),
        fields_of("dns") + ",more,answers": ("ok", None),
    }
    assert verdicts(lines(*cases), "dns") == list(cases.values())


def test_widths(lines):
    cases = {
        fields_of("flow", f1="70000"): ("bad", "BAD_VALUE:y"),
        fields_of("flow", f16="9223372036854775808"): ("bad", "BAD_VALUE:ipkt"),
        fields_of("flow", f10="2147483648"): ("bad", "BAD_VALUE:sport"),
        fields_of("flow", f7="1.0d"): ("bad", "BAD_VALUE:tdur"),
        fields_of("flow", f7="nan"): ("ok", None),
        fields_of("flow", f0="2018-02-30 00:00:00"): ("bad", "BAD_TIME"),
        fields_of("flow", f0="2018-7-1 1:2:3"): ("ok", None),
    }
    assert verdicts(lines(*cases), "flow") == list(cases.values())


def test_proxy_verdicts(lines):
    cases = {
        "": ("dropped", "SHORT_LINE"),
        "#": ("dropped", "SHORT_LINE"),
        '"#': ("bad", "UNCLOSED_QUOTE"),
        "a b": ("bad", "SHORT_ROW"),
        GOLDEN["proxy"].replace('Linux)"', "Linux)"): ("bad", "UNCLOSED_QUOTE"),
        fields_of("proxy", f1="x"): ("bad", "BAD_TIME"),
        fields_of("proxy", f2="x"): ("bad", "BAD_VALUE:duration"),
        fields_of("proxy", f22="-"): ("bad", "BAD_VALUE:scbytes"),
        fields_of("proxy"): ("ok", None),
    }
    assert verdicts(lines(*cases), "proxy") == list(cases.values())


def test_ids_defaults_and_rounding(lines):
    df = lines(
        fields_of("ids_event", f17="None"), fields_of("ids_event", f17="none"),
        fields_of("ids_event", f18="1530403199.123"), fields_of("ids_event", f18="1530403199.9999996"),
    )
    out = tm.classify(df, "ids_event").orderBy("pos").collect()
    assert [r.reason for r in out] == [None, "BAD_VALUE:vlan_id", None, None]
    assert out[0].vlan_id == 0
    assert (out[2].unix_tstamp, out[2].m, out[2].d, out[2].h) == (1530403200.0, 6, 30, 23)
    assert (out[3].unix_tstamp, out[3].m, out[3].d, out[3].h) == (1530403200.0, 7, 1, 0)


def test_switches(lines):
    strict = tm.dns_log(strict_rcode_guard=True)
    out = tm.normalize(lines(fields_of("dns", f9=""), fields_of("dns", f8="", f9="3")), strict).collect()
    assert [r.dns_qry_rcode for r in out] == [0, 3]
    exact = tm.normalize(lines(GOLDEN["ids_packet"]), tm.ids_packet_log(exact_epoch=True)).first()
    assert exact.unix_tstamp_d == 1704067432.824425 and math.isclose(exact.unix_tstamp, 1704067456.0)


def test_zones(lines):
    athens = {"tz": "Europe/Athens"}
    dns = tm.classify(lines(fields_of("dns", f2="1530396123")), "dns", **athens).first()
    assert (dns.y, dns.m, dns.d, dns.h) == (2018, 7, 1, 1)
    flow = tm.classify(lines(fields_of("flow", f0="2018-07-01 01:02:03")), "flow", **athens).first()
    assert (flow.unix_tstamp, flow.y, flow.h) == (1530396123, 2024, 0)
    ids = tm.classify(lines(fields_of("ids_packet", f7="1530396123")), "ids_packet", **athens).first()
    assert (ids.m, ids.d, ids.h) == (6, 30, 22)


def test_truncates_toward_zero(lines):
    out = tm.normalize(lines(fields_of("dns", f2="-1.9")), "dns").first()
    assert (out.unix_tstamp, out.y, out.h) == (-1, 1969, 23)


def test_modes_and_quarantine(lines):
    df = lines(GOLDEN["proxy"], "a b", "", GOLDEN["proxy"])
    assert tm.normalize(df, "proxy").count() == 2
    bad = tm.quarantined(df, "proxy").collect()
    assert [(r.line, r.reason, r.pos, r.offset) for r in bad] == [("a b", "SHORT_ROW", 1, None)]
    assert tm.normalize(lines(GOLDEN["proxy"], ""), "proxy", mode="failfast").count() == 1
    with pytest.raises(Exception, match="SHORT_ROW at - - - 1"):
        tm.normalize(df, "proxy", mode="failfast").collect()
    with pytest.raises(ValueError):
        tm.normalize(df, "proxy", mode="quarantine")


def test_accounting_is_complete(messages):
    from telemill.functions import avro

    spark = messages().sparkSession
    segments = [[GOLDEN["flow"], "x"], [], [GOLDEN["flow"]] * 3]
    df = spark.createDataFrame([(s,) for s in segments], "lines array<string>")
    values = [bytes(r.value) for r in tm.encode_segments(df).collect()] + [b"\x00", bytes.fromhex(avro.NULL_SEGMENT)]
    out = tm.account(tm.explode_lines(tm.decode_segments(messages(*values))), "flow").collect()
    assert {(r.status, r.reason): r.lines for r in out} == {
        ("ok", None): 4, ("bad", "SHORT_ROW"): 1, ("bad", "BAD_ENVELOPE"): 1, ("bad", "NULL_ENVELOPE"): 1,
    }


def test_batch_report(lines):
    report = tm.batch_report(lines(GOLDEN["proxy"], "", "a b", fields_of("proxy", f0="2024-01-02")), "proxy").first()
    assert (report.rows, report.bad_rows, report.dropped_rows) == (2, 1, 1)
    assert (report.min_label, report.max_label, report.segment_label) == ("2024-01-01", "2024-01-02", "proxy-log segments")


def minimal(name="mine", **changed):
    from telemill.functions.clock import wall_clock

    parts = dict(name=name, outputs=(*text("a", 1), *clock_parts()), min_fields=2, clock=lambda r: wall_clock(r[0]), label="a")
    return LogType(**{**parts, **changed})


def test_own_log_type(lines):
    tm.register(minimal(), replace=True)
    assert "mine" in tm.registered()
    row = tm.normalize(lines("2024-05-06 07:08:09,hello"), "mine").first()
    assert tuple(row) == ("hello", 2024, 5, 6, 7)
    with pytest.raises(ValueError):
        tm.register(minimal())
    with pytest.raises(ValueError):
        tm.resolve("unheard-of")


@pytest.mark.parametrize(
    "changed",
    [dict(outputs=tuple(clock_parts())), dict(outputs=(*text("a", 1),)), dict(outputs=(*text("a offset", 1, 1), *clock_parts())),
     dict(outputs=(*text("a A", 1, 1), *clock_parts())), dict(label="b")],
)
def test_faulty_log_types(changed):
    with pytest.raises(ValueError):
        minimal(**changed)


def test_verdicts_do_not_depend_on_ansi(spark, lines):
    df = lines(GOLDEN["proxy"], "", None, "a b", fields_of("proxy", f2="x"))
    want = verdicts(df, "proxy")
    assert want[2] == ("bad", "SHORT_ROW")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        assert verdicts(df, "proxy") == want
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_control_characters_are_no_part_of_numbers(lines):
    for bad in ("12\x00", "\x0112", "12\x7f", "1\x1b2"):
        assert verdicts(lines(fields_of("flow", f10=bad)), "flow") == [("bad", "BAD_VALUE:sport")]
        assert verdicts(lines(fields_of("dns", f7=bad)), "dns") == [("bad", "BAD_VALUE:dns_qry_type")]
        assert verdicts(lines(fields_of("ids_event", f17=bad)), "ids_event") == [("bad", "BAD_VALUE:vlan_id")]
    assert verdicts(lines(fields_of("flow", f10="\t12\x0b")), "flow") == [("ok", None)]
