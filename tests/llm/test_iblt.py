import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from telemill.llm import iblt


def digests(text):
    data = text.encode()
    found, _ = iblt.paragraph_digests(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    return set(found.tolist())


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sets(st.integers(1, 200), max_size=80), min_size=2, max_size=5))
def test_differences_are_exact(sets):
    tables = []
    for s in sets:
        values = np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        tables.append((values, len(values)))
    places = np.concatenate([[0], np.cumsum([n for _, n in tables])])
    made = iblt.fingerprints(np.concatenate([v for v, _ in tables]).astype(np.uint64), places)
    left, right = np.arange(len(sets) - 1), np.arange(1, len(sets))
    only_a, only_b = iblt.differences(made, made, left, right)
    for i in left:
        assert (only_a[i], only_b[i]) == (len(sets[i] - sets[i + 1]), len(sets[i + 1] - sets[i]))
    again = iblt.Tables.read(made.texts())
    assert again.texts() == made.texts()
    assert (iblt.likeness(again, made, left, left) == 1).all()


def test_a_small_table_fails_and_a_larger_one_is_tried():
    values = iblt.mix(np.arange(200, dtype=np.uint64))
    small = iblt.Tables.of(np.array([12]))
    small.add(np.zeros(200, int), values)
    *_, done = small.peel()
    assert not done[0]
    assert iblt.fingerprints(values, np.array([0, 200])).cells[0] > 200


def test_a_change_at_one_place_leaves_the_rest():
    text = "\n".join(f"paragraph {i} has a few words of its own and {i * 7} more" for i in range(60))
    a, b = digests(text), digests(text.replace("paragraph 30", "chapter 30"))
    assert 0.9 < jaccard(a, b) < 1


def expected(rows):
    rows = [(i, t or "") for i, t in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode()))
    out = []
    for n, (i, text) in enumerate(rows):
        following = rows[(n + 1) % len(rows)][1]
        changed = iblt.edited(text, following)
        likeness = [round(jaccard(digests(text), digests(x)), 9) for x in (changed, following)]
        out.append((i, len(text), hashlib.sha256(changed.encode()).hexdigest(), *likeness))
    return out


def shown(df):
    return [(r[0], r[1], r[2], round(r[5], 9), round(r[6], 9)) for r in df]


def in_order(rows):
    return sorted(rows, key=str)


def test_odd_documents(documents):
    from odd import ODD

    df = iblt.fingerprint_edits(documents())
    assert in_order(shown(df.collect())) == in_order(expected(ODD))
    assert iblt.fingerprint_edits(documents([])).collect() == []
    (alone,) = iblt.fingerprint_edits(documents([(3, "abcdef")])).collect()
    assert alone.near_next == 1 and alone.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()


def test_query(run, table):
    rows = [tuple(r) for r in table("documents").select("doc_id", "text").collect()]
    got = run("op1_bloom_fingerprints")
    assert in_order(shown(got)) == in_order(expected(rows))
    by_text = {}
    for r in got:
        by_text.setdefault(dict(rows)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in by_text.values())
