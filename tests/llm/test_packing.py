import binascii
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from telemill.llm import packing, tokens


TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_those_of_tokenizers(text):
    assert tokens.ids(text).tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=14))
def test_bounds_hold_and_bins_do_not_overflow(lengths):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    bins = packing.best_fit_decreasing(lengths, 20)
    used = len(set(bins.tolist()))
    assert packing.lower_bound(lengths, 20) <= used
    assert all(v <= 20 for v in np.bincount(bins, lengths)) if len(bins) else used == 0
    # a bound must hold for the best packing as well
    best = [used]

    def place(i, rooms):
        if len(rooms) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[i] and rooms[j] not in rooms[:j]:
                place(i + 1, [*rooms[:j], rooms[j] - lengths[i], *rooms[j + 1 :]])
        place(i + 1, [*rooms, 20 - lengths[i]])

    if len(lengths) <= 9:
        place(0, [])
        assert packing.lower_bound(lengths, 20) <= best[0]


def check(rows, texts, capacity=2048):
    """Pieces hold all ids of all documents, and sequences are gapless and not too long."""
    want = defaultdict(int)
    for doc_id, text in texts:
        ids = np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % capacity or capacity
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        for n, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc_id, n, a, b - a, binascii.crc32(ids[a:b].tobytes())] += 1
    got, sequences = defaultdict(int), defaultdict(list)
    for r in rows:
        got[r.doc_id, r.piece, r.start, r.length, r.ids_crc32] += 1
        sequences[r.sequence_id].append((r.offset, r.length))
    assert got == want
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_odd_documents(documents):
    from odd import ODD

    check(packing.pack_documents(documents()).collect(), ODD)
    assert packing.pack_documents(documents([])).collect() == []


def test_query(run, table):
    texts = [tuple(r) for r in table("documents").select("doc_id", "text").collect()]
    rows = run("op2_best_fit_packing")
    used = check(rows, texts)
    assert used <= 1.01 * packing.lower_bound(np.array([r.length for r in rows]), 2048) + 1


def test_partitions_with_gaps_exchange_pieces(spark):
    rng = random.Random(2)
    rows = [(i, 0, 0, rng.choice([700, 900, 1100, rng.randrange(1, 2048)]), i) for i in range(3000)]
    rows += [(i, 1, 5, 2048, 0) for i in range(20)]
    pieces = spark.createDataFrame(rows, packing.PIECES)
    packed, proof = packing.pack(pieces, partition=100)
    rows_out = packed.collect()
    sums = defaultdict(int)
    for r in rows_out:
        sums[r.sequence_id] += r.length
    assert len(rows_out) == len(rows) and max(sums.values()) <= 2048
    assert {r["round"] for r in rows_out} > {-1, 0}
    proofs = proof.collect()
    assert all(r.bins >= r.bound for r in proofs) and {r["round"] for r in proofs} > {0}
    first = sum(r.bins for r in proofs if r["round"] == 0)
    assert len(sums) - 20 <= first
    assert sorted(map(tuple, packed.collect())) == sorted(map(tuple, rows_out))


def test_rows_that_repeat_a_piece_are_spread_over_parts(spark):
    rows = [(None, 0, 0, 700, 1)] * 3000 + [(7, 0, 0, 900, 2)] * 1000
    packed, proof = packing.pack(spark.createDataFrame(rows, packing.PIECES), partition=100)
    assert sorted(tuple(r)[:5] for r in packed.where("doc_id = 7").collect()) == rows[3000:]
    assert [tuple(r)[:5] for r in packed.where("doc_id is null").collect()] == rows[:3000]
    bins = [r.bins for r in proof.collect() if r["round"] == 0]
    assert len(bins) == 40 and max(bins) <= 100  # two pieces in a bin, about 100 in a part
