"""Lines that the tests of several modules share."""

GOLDEN = {
    "dns": "Jan 01, 2024 00:03:52,1704067432.824425,61,10.0.46.1,192.168.1.1,host1.example.com,2,0x00000001,1,93.184.0.1",
    "flow": "2024-01-01 00:03:52,2024,1,1,0,3,52,1.125,10.0.46.1,192.168.1.1,1025,1,UDP,.AP.SF,0,0,2,80,1,40,2,3,0,0,0,1,0.0.0.0",
    "ids_event": "ids_event,1,class click,1,192.168.1.1,1,1,1,1,32,2,17,4,4294967297,1,1025,10.0.46.1,1,1704067432.824425",
    "ids_packet": "ids_packet,deadbeef00000001,1,1704067432,61,1,4,1704067432.824425",
    "proxy": '2024-01-01 00:03:52 1 10.0.46.1 user46 - - OBSERVED "Web Ads/click" - 200 TCP_HIT GET text/html http '
    'www1.example.com 80 /p/1 ?q=1 html "Mozilla/5.0 (X11; Linux)" 192.168.1.1 1 201 - none none',
}


def fields_of(log_type, **changed):
    """The golden line with some fields (`f3='x'`) replaced."""
    sep = " " if log_type == "proxy" else ","
    if log_type == "proxy":
        import shlex

        lexer = shlex.shlex(GOLDEN["proxy"])
        lexer.quotes, lexer.whitespace_split, lexer.commenters = '"', True, ""
        parts = list(lexer)
    else:
        parts = GOLDEN[log_type].split(",")
    for name, value in changed.items():
        parts[int(name[1:])] = value
    return sep.join(parts)
