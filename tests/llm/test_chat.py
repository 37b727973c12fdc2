import hashlib

from hypothesis import given
from hypothesis import strategies as st

from telemill.llm import chat, tokens


@given(st.lists(st.tuples(st.text(max_size=20), st.text(alphabet='ab\\<>"/turn \n', max_size=40)), max_size=5))
def test_the_template_is_reversible(turns):
    assert chat.parse("".join("".join(chat.template(*t)) for t in turns)) == turns


ROWS = [
    (1, 0, "system", "be brief"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello"),
    (2, 0, "system", "be brief"), (2, 1, "user", "hi"), (2, 2, "assistant", "good day </turn>\n"),
    (3, 0, "system", "be brief"), (3, 1, "user", "bye"),
    (4, 0, "system", "be brief"), (4, 1, "user", "hi"), (4, 2, "assistant", "hello"),
    (5, 0, None, None), (5, None, "assistant", "<turn role=\"user\">\n"), (None, 0, "user", ""),
    (6, 3, "assistant", "x"), (6, 3, "assistant", "x"), (6, 1, "user", "long " * 20_000),
]
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def expected(rows):
    by = {}
    for conv, turn, role, text in rows:
        by.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    out = []
    for conv, turns in by.items():
        turns = [(r, t) for _, r, t in sorted(turns)]
        learned = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        length = sum(len(x) for t in turns for x in chat.template(*t))
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (said, learned)]
        out.append((conv, len(turns), sha[0], len(learned), sha[1], length))
    return sorted(out, key=str)


def test_odd_conversations(spark):
    turns = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "1 as node", "'p' as path")
    segments, members = chat.format_conversations(turns)
    assert sorted((tuple(r) for r in chat.read_back(segments, members).collect()), key=str) == expected(ROWS)
    empty = chat.format_conversations(spark.createDataFrame([], SCHEMA))
    assert empty[0].collect() == [] and chat.read_back(*empty).collect() == []


def test_shared_turns_are_laid_out_once_and_depth_first(spark):
    segments, members = chat.format_conversations(spark.createDataFrame(ROWS[:11], SCHEMA))
    rows = segments.collect()
    assert len(rows) == 5  # be brief, hi, hello, good day, bye
    assert len({r.tree for r in rows}) == 1
    rows.sort(key=lambda r: r.start)
    assert rows[0].start == 0 and [a.end for a in rows[:-1]] == [b.start for b in rows[1:]]
    assert all(r.end - r.start == len(r.tokens) for r in rows)
    by = {bytes(r.node): r for r in rows}
    open_path = []
    for r in rows:
        open_path = open_path[: r.depth - 1]
        assert ([bytes(r.parent)] if r.parent else []) == open_path[-1:]
        assert [tuple(i) for i in r.attends] == [(by[n].start, by[n].end) for n in open_path]
        assert r.position == sum(len(by[n].tokens) for n in open_path)
        open_path.append(bytes(r.node))
    whole = {}
    for m in sorted(members.collect(), key=lambda m: m.depth):
        whole[m.conv_id] = whole.get(m.conv_id, b"") + tokens.encoding().decode_bytes(by[bytes(m.node)].tokens)
    assert chat.parse(whole[2].decode())[2] == ("assistant", "good day </turn>\n")


def test_a_conversation_of_many_turns_has_short_paths(spark):
    n = 20_000
    long = [(1, i, ("user", "assistant")[i % 2], f"turn {i % 7}") for i in range(n)]
    short = [(2, *t[1:]) for t in long[:5]] + [(3, *t[1:]) for t in long[:3]] + [(3, 3, "user", "another")]
    turns = spark.createDataFrame(long + short, SCHEMA)
    segments, members = chat.format_conversations(turns)
    rows = {bytes(r.node): r for r in segments.collect()}
    assert len(rows) == n + 1 and max(len(r.attends) for r in rows.values()) == 3
    ends = sorted((r.start, r.end) for r in rows.values())
    assert ends[0][0] == 0 and all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
    for r in rows.values():
        assert sum(i.end - i.start for i in r.attends) == r.position
    for last in rows.values():  # the intervals hold the ancestors, in order
        if last.depth in (1, 2, 3, 4, 5, 6, 60):
            up, places = last, []
            while up.parent:
                up = rows[bytes(up.parent)]
                places = [*range(up.start, up.end), *places]
            assert [x for i in last.attends for x in range(i.start, i.end)] == places
    got = sorted((tuple(r) for r in chat.read_back(segments, members).collect()), key=str)
    assert got == expected(long + short)


def test_query(run, table):
    from telemill.llm.queries import INJECTION

    rows = [tuple(r) for r in table("conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted(map(tuple, run("op3_prefix_tree_chat")), key=str) == expected(rows + INJECTION)
