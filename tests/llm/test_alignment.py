import hashlib
import random
import weakref
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from odd import ODD
from tokenizers import Tokenizer

from telemill.llm import alignment, tokens


def token_bytes():
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in printable)}
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def of(text):
        a, b = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        pieces = [second.id_to_piece(i) for i in b]
        return a, b, [bytes(letters[c] for c in first.id_to_token(i)) for i in a], [
            bytes([int(p[3:-1], 16)]) if second.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in zip(b, pieces)
        ]

    return of


def brute_force(texts):
    of, counts, found = token_bytes(), Counter(), []
    for text in texts:
        a, b, bytes_a, bytes_b = of(text) if text else ([], [], [], [])
        if not text or not (b"".join(bytes_a) == b"".join(bytes_b) == b" " + text.encode()):
            found.append(None)
            continue
        ends_a, ends_b = [0], [0]
        for x in bytes_a:
            ends_a.append(ends_a[-1] + len(x))
        for x in bytes_b:
            ends_b.append(ends_b[-1] + len(x))
        links, j = [], 0
        for i in range(len(a)):
            while ends_b[j + 1] <= ends_a[i]:
                j += 1
            k = j
            while k < len(b) and ends_b[k] < ends_a[i + 1]:
                links.append((a[i], b[k]))
                k += 1
        groups, i, j = [], 0, 0
        for end in sorted(set(ends_a[1:]) & set(ends_b[1:])):
            i2, j2 = ends_a.index(end, i), ends_b.index(end, j)
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        found.append((len(a), len(b), groups, links))
        counts.update(set(links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links), digest))
    return out


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


TRICKY = ["\u2581", "a\u2581b", "<s> </s> <unk> <0x41>", "<|endoftext|>", "e\u0301 \ufb01 \u3000", "\x00\x01", "  two  blanks  ", "tab\tand\r\n", "😀👩‍👩‍👧", "1 2 3 " * 200]


def test_equals_brute_force(spark, documents):
    rows = [r for r in ODD if r[0] != 8] + [(100 + i, t) for i, t in enumerate(TRICKY)] + [(8, "x" * 5000)] + [(7, "one hot row")] * 100
    got = alignment.align(documents(rows).repartition(5)).collect()
    want = [(r[0], *x) for r, x in zip(rows, brute_force([r[1] for r in rows]))]
    assert ordered(got) == ordered(want)


def test_real_texts(spark, table):
    docs = table("documents")
    rows = docs.select("doc_id", "text").collect()
    want = [(r.doc_id, *x) for r, x in zip(rows, brute_force([r.text for r in rows]))]
    assert ordered(alignment.align(docs).collect()) == ordered(want)


def test_empty_table(documents):
    assert alignment.align(documents().where("false")).collect() == []
    assert [tuple(r)[1:] for r in alignment.align(documents([(1, None), (2, "")])).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 2


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 1 << 50, n).astype(np.uint64))
    table = alignment.PerfectHash.unpacked(alignment.PerfectHash.of(keys).packed())
    assert sorted(table.slots(keys).tolist()) == list(range(len(keys))) and table.size == len(keys)
    assert sum(map(len, table.packed())) <= len(keys) * 0.6 + 200
    others = table.slots(np.setdiff1d(rng.integers(0, 1 << 50, 1000).astype(np.uint64), keys))
    assert ((others >= -1) & (others < max(1, len(keys)))).all()


def test_a_table_refuses_pairs_that_it_does_not_hold():
    pairs = np.arange(100, dtype=np.uint64) * np.uint64(7)
    made = next(alignment._hashed(iter([{"shard": 3, "pairs": pairs.tobytes()}])))
    table = alignment.Table({"shard": 3, "levels": made["levels"], "pairs": made["pairs"].tobytes()})
    assert np.array_equal(table.pairs[table.slots(pairs)], pairs)
    with pytest.raises(ValueError):
        table.slots(np.array([5], np.uint64))


@pytest.mark.parametrize("unit", [" ", "\n", "1 ", " \n\t", "x"])
def test_two_million_blanks(unit):
    text = "word" + unit * (2_000_000 // len(unit)) + "word <|endoftext|>"
    plain, own = tokens.tokenizer(), tokens.tokenizer(special=True)
    assert tokens.plain_ids(text) == plain.encode(text, add_special_tokens=False).ids
    assert tokens.ids(text).tolist() == own.encode(text, add_special_tokens=False).ids


def test_one_slice_at_a_time(monkeypatch):
    """A task lets go of a slice's arrays before it makes those of the next."""
    alive = []

    class Watched(alignment.Aligned):
        def __init__(self, *args):
            assert all(x() is None for x in alive)
            super().__init__(*args)
            alive.append(weakref.ref(self))

    monkeypatch.setattr(alignment, "Aligned", Watched)
    names = "byte_bpe_50k.json", "piece_bpe_32k.model"
    rows = []
    for i in range(3):
        ids = alignment.tokens_of(f"some words of slice {i}", *alignment.tokenizers_of(*names))
        n_a, n_b = (np.array([len(x)], np.int64).tobytes() for x in ids)
        rows.append({"slice": i, "keys": [i], "a": ids[0].tobytes(), "b": ids[1].tobytes(), "n_a": n_a, "n_b": n_b})
    messages = list(alignment._told(*names, 1)(iter(rows)))
    assert {m["slice"] for m in messages} == {0, 1, 2} and len(alive) == 3
    for row in rows:
        own = [m for m in messages if m["slice"] == row["slice"]]
        row["told"] = [m | {"counts": m["counts"].tobytes(), "best": np.ones(len(m["pairs"]), bool).tobytes()} for m in own]
    made = list(alignment._looked_up(*names)(iter(rows)))
    assert [m["keys"] for m in made] == [[0], [1], [2]] and all(m["n_best"] == m["n_links"] for m in made)


def test_small_batches(spark, documents, monkeypatch):
    """All Python runs with small Arrow batches, whatever the caller's session has, which stays as it was."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before, seen, real = spark.conf.get(key), [], alignment.stored

    def stored(df, name):
        seen.append(int(spark.conf.get(key).rstrip("b")))
        return real(df, name)

    monkeypatch.setattr(alignment, "stored", stored)
    made = alignment.align(documents())
    assert max(seen) <= 8 << 20 and spark.conf.get(key) == before
    assert "MapInArrow" not in made._jdf.queryExecution().toString()
