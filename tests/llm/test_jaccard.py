import random
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from telemill.llm import jaccard
from telemill.llm.components import components


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if 0 < len(words) < width:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def expected(rows, width, similarity):
    """Rows of id, set size and smallest linked id; rows with the same id are documents of their own."""
    similarity = Fraction(similarity)
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and len(a & b) >= similarity * len(a | b):
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[find(i)].append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        known = [x for x in ids[find(i)] if x is not None]
        out.append((doc_id, len(sets[i]), (min(known) if known else None) if sets[i] else doc_id))
    return sorted(out, key=str)


def grouped(docs, width, similarity):
    rows = jaccard.near_duplicates(docs, width, similarity).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def test_similar_sets_share_a_signature():
    rng = random.Random(1)
    for similarity in (Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)):
        for _ in range(150):
            shared = rng.randrange(1, 300)
            most = int(shared / similarity) - shared  # elements that only one of them may have
            left = rng.randint(0, most)
            values = np.array(rng.sample(range(1 << 62), shared + most), np.uint64)
            a = np.sort(np.concatenate([values[:shared], values[shared : shared + left]]))
            b = np.sort(np.concatenate([values[:shared], values[shared + left :]]))
            places = np.array([0, len(a), len(a) + len(b)])
            x, y = jaccard.signatures(np.concatenate([a, b]), places, similarity)
            assert set(x.tolist()) & set(y.tolist()) or (left == 0 and most == left), (similarity, shared, left, most)


def edited_copies(seed, n=160):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    bases = [[rng.choice(words) for _ in range(rng.choice([4, 12, 40, 120]))] for _ in range(6)]
    rows = []
    for i in range(n):
        text = list(bases[i % 6])
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            at = rng.randrange(len(text))
            text[at : at + rng.randrange(2)] = [rng.choice(words)] * rng.randrange(2)
        rows.append((rng.randrange(10_000), " ".join(text)))
    return rows


@pytest.mark.parametrize(("width", "similarity", "block"), [(3, "0.9", 512), (5, "0.8", 4)])
def test_brute_force(spark, monkeypatch, width, similarity, block):
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = edited_copies(width)
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert grouped(docs, width, similarity) == expected(rows, width, similarity)


def test_odd_documents(documents):
    from odd import ODD

    rows = ODD + [(30, "TWO  Words"), (31, "a b c d e f g"), (32, "a b c d e f g")]
    assert grouped(documents(rows), 3, "0.9") == expected(rows, 3, "0.9")
    assert grouped(documents([]), 3, "0.9") == []


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (None, 3)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    df = spark.createDataFrame([(b, a) for a, b in edges], "a bigint, b bigint")
    assert {r.node: r.component for r in components(df).collect()} == {x: find(x) for x in list(parent)}
    assert components(df.limit(0)).collect() == []


def test_query(run, table):
    rows = [tuple(r) for r in table("documents").select("doc_id", "text").collect()]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in run("op9_ngram_jaccard_join")), key=str)
    assert got == expected(rows, 3, "0.9")


def test_near_unlinked_sets_are_not_compared(spark, monkeypatch):
    """Of texts that share three quarters with one another, only those that share rare words too are dealt to blocks."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**9)}"
    base = [word() for _ in range(100)]
    own = lambda n: base + [word() for _ in range(n)]
    texts = [own(17) for _ in range(150)]
    texts += [t[:-2] + [word(), word()] for t in texts[:10]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    dealt, whole = [], jaccard._in_blocks
    monkeypatch.setattr(jaccard, "_in_blocks", lambda rows, s: (dealt.append(rows.count()), whole(rows, s))[1])
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    assert grouped(spark.createDataFrame(rows, "doc_id bigint, text string"), 1, "0.8") == expected(rows, 1, "0.8")
    assert dealt and dealt[0] <= 40


def test_rounds_deal_every_pair_once(spark):
    rows = spark.range(500).selectExpr("id as node", "id % 3 as leader", "cast(1 + id % 3 * 7 as int) as blocks")
    columns = ["leader", "i", "j", "node"]
    rounds = [jaccard._dealt(rows, i, 4).select(columns).collect() for i in range(4)]
    assert sorted(r for part in rounds for r in part) == sorted(jaccard._dealt(rows).select(columns).collect())
    pairs = [{(r.leader, r.i, r.j) for r in part} for part in rounds]
    assert not any(a & b for i, a in enumerate(pairs) for b in pairs[:i])


def test_undecided_are_told_by_names(spark, monkeypatch):
    """The elements of the sets are in no step before it is known whose are needed."""
    schema = "leader bigint, node bigint, size bigint, delta array<bigint>, added int"
    rows = [
        (1, 2, 10, [100, 101, 7], 2), (1, 3, 10, [100, 102, 8], 2),  # not linked yet, with a rare element in common
        (1, 4, 10, [103, 104, 9], 2),  # with none
        (5, 6, 10, [105, 106], 2), (5, 7, 10, [105, 107], 2),  # linked
    ]
    links = spark.createDataFrame([(6, 7)], "a bigint, b bigint")
    seen, real = [], jaccard.passed
    monkeypatch.setattr(jaccard, "passed", lambda df: (seen.append(df.columns), real(df))[1])
    found = jaccard._undecided(spark.createDataFrame(rows, schema), links, Fraction("0.8")).collect()
    assert sorted((r.leader, r.node, r.size, r.delta) for r in found) == [(2, 2, 10, rows[0][3]), (2, 3, 10, rows[1][3])]
    assert seen and not any("delta" in columns for columns in seen)


@pytest.mark.parametrize("seed", range(3))
def test_rarest_elements_leave_out_no_link(spark, seed):
    """Elements of one node alone are counted, not ranked; every two linked nodes of a leader stay connected."""
    rng = random.Random(seed)
    sets = {i: frozenset(rng.sample(range(40), rng.randrange(8, 14))) for i in range(2, 60)}
    sets |= {i + 100: frozenset([*sorted(s)[1:], 1000 + i]) for i, s in list(sets.items())[:30]}
    first = frozenset(range(12))
    rows = [(1, i, len(s), [*sorted(s - first), *sorted(first - s)], len(s - first)) for i, s in sets.items()]
    df = spark.createDataFrame(rows, "leader bigint, node bigint, size bigint, delta array<bigint>, added int")
    label = {r.node: r.component for r in components(jaccard._sharing(df, Fraction("0.8"))).collect()}
    linked = [(a, b) for a in sets for b in sets if a < b and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])]
    assert linked and all(label[a] == label[b] for a, b in linked)


LINE = "this line stands in every one of the texts".split()


def with_line(rng, n, size):
    word = lambda: f"w{rng.randrange(10**9)}"
    return [[word() for _ in range(size)] + LINE + [word() for _ in range(size)] for _ in range(n)]


def test_common_lines_do_not_make_texts_meet(spark, monkeypatch):
    """Of texts that have one line in common, only those that are linked meet, but for a few."""
    monkeypatch.setattr(jaccard, "COMMON", 8, raising=False)
    rng = random.Random(4)
    texts = [t for size in (100, 130, 170, 220) for t in with_line(rng, 800, size)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(5000 + i, " ".join(t[1:])) for i, t in enumerate(texts[:40])]
    met = jaccard._met(spark.createDataFrame(rows, "doc_id bigint, text string"), 3, Fraction("0.8")).where("node <> leader")
    largest = max(r["count"] for r in met.groupBy("leader").count().collect())
    assert 40 <= met.count() < 300 and largest < 20


@pytest.mark.parametrize(("common", "seed"), [(1, 5), (3, 6), (20, 7)])
def test_leaving_out_common_signatures_loses_no_link(spark, monkeypatch, common, seed):
    monkeypatch.setattr(jaccard, "COMMON", common, raising=False)
    rng = random.Random(seed)
    rows = [(20_000 + i, t) for i, t in edited_copies(seed, 60)]
    for i, text in enumerate(with_line(rng, 40, 8) + with_line(rng, 40, 30) + with_line(rng, 30, 90)):
        rows.append((i, " ".join(text)))
        for _ in range(rng.randrange(3)):
            near = list(text)
            for _ in range(rng.randrange(1, 1 + len(near) // 18)):
                near[rng.randrange(len(near))] = f"x{rng.randrange(10**9)}"
            rows.append((1000 + i, " ".join(near)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert grouped(docs, 3, "0.8") == expected(rows, 3, "0.8")


@pytest.mark.parametrize("similarity", [Fraction(9, 10), Fraction(4, 5), Fraction(1, 2)])
def test_more_signatures_are_shared_than_may_be_left_out(similarity):
    """Similar sets still share one if both leave out any that are in few enough parts, the same ones in both."""
    rng = random.Random(6)
    common = np.uint64(3)
    for _ in range(200):
        shared = rng.randrange(20, 400)
        most = int(shared / similarity) - shared
        left = rng.randint(0, most)
        values = np.array(rng.sample(range(1 << 62), shared + most), np.uint64)
        a, b = np.append(values[:shared], values[shared : shared + left]), np.append(values[:shared], values[shared + left :])
        if len(a) == len(b) == shared:
            continue
        kept = []
        for made in jaccard.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]), similarity):
            place = made & np.uint64(jaccard.PLACE)
            band = (place >> np.uint64(jaccard.PART_BITS)).astype(int)
            out = jaccard.mix(made) % np.uint64(16) < common
            for i in np.unique(band):
                top = int(jaccard.bands(similarity, 10**6)[i])
                if len(np.unique(place[out & (band == i)])) > jaccard._may_lack(jaccard.differing(similarity, top) // 2 + 1):
                    out &= band != i
            kept.append(set(made[~out].tolist()))
        assert kept[0] & kept[1]
