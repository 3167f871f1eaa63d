"""Bit-parallel distances, deletion keys and the search for spacers against plain versions a string at a time."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tallywright.functions import matching
from tallywright.functions.sequences import edit_distance_of


def word(rnd, n, letters="ACGTN"):
    return "".join(rnd.choice(letters) for _ in range(n))


def test_distances():
    rnd = random.Random(1)
    a, b = [word(rnd, rnd.randint(0, 64)) for _ in range(800)], [word(rnd, rnd.randint(0, 90)) for _ in range(800)]
    a[:2], b[:2] = ["ACé", ""], ["ACGT", ""]
    assert matching.pair_distances(a, b).tolist() == [edit_distance_of(x, y) for x, y in zip(a, b)]
    assert matching.pair_distances([], []).tolist() == []
    with pytest.raises(ValueError, match="over 64"):
        matching.pair_distances(["A" * 65], ["C" * 65])


@pytest.mark.parametrize("k", [0, 2, 5])
def test_near_pairs(k):
    rnd = random.Random(k)
    texts, patterns = [word(rnd, rnd.randint(0, 12)) for _ in range(200)], [word(rnd, rnd.randint(0, 10)) for _ in range(50)]
    found = [x.tolist() for x in matching.near_pairs(texts, patterns, k)]
    want = [(i, j, d) for i, x in enumerate(texts) for j, y in enumerate(patterns) if (d := edit_distance_of(x, y)) <= k]
    assert sorted(zip(*found)) == want
    assert all(len(x) == 0 for x in matching.near_pairs([], patterns, k)) and all(len(x) == 0 for x in matching.near_pairs(texts, [], k))


def test_near_strings_share_a_deletion_key():
    rnd = random.Random(5)
    for _ in range(300):
        a, k = word(rnd, 10), rnd.randint(0, 3)
        b = a
        for _ in range(k):
            at = rnd.randrange(len(b))
            b = rnd.choice([b[:at] + b[at + 1 :], b[:at] + word(rnd, 1) + b[at:], b[:at] + word(rnd, 1) + b[at + 1 :]])
        size = max(len(a), len(b)) - k
        keys = [set(matching.deletion_keys([x], {len(x): [size]})[1].tolist()) for x in (a, b)]
        assert keys[0] & keys[1]
    owners, keys, sizes = matching.deletion_keys(["AAAA", "ACGT"], {4: [3, 2]})
    assert [(owners == 0).sum(), (owners == 1).sum()] == [2, 4 + 6] and len(set(keys.tolist())) == len(keys) and set(np.unique(sizes)) == {2, 3}


def spacer_place(seq, spacer, max_edits, search, shortest, longest, after):
    if len(seq) < shortest + len(spacer) + after:
        return -1, -1, "short"
    outcome, at = "ok", seq.find(spacer)
    if at < 0:
        outcome = "modified"
        latest = longest + len(spacer) + max_edits - search
        earliest = max(0, shortest + len(spacer) - search - max_edits)
        tail = seq.rfind(spacer[-search:], 0, latest + search)
        at = tail - len(spacer) + search
        if tail < earliest or at < 0:
            at = seq.find(spacer[:search], shortest)
            if at < 0 or at > longest:
                return -1, -1, "no_spacer"
        if edit_distance_of(spacer, seq[at : at + len(spacer)]) > max_edits:
            return -1, -1, "no_spacer"
    end = at + len(spacer)
    return (at, end, outcome) if len(seq) >= end + after else (-1, -1, "short")


@pytest.mark.parametrize("limits", [(2, 3, 4, 8, 5), (1, 2, 0, 6, 0), (0, 6, 3, 3, 3), (3, 4, 8, 11, 14)])
def test_spacers(limits):
    rnd, spacer = random.Random(7), "ACGTTA"
    around = [spacer, "ACGTTC", "CGTTA", "ACGGTTA", "NCGTTA", "ANNTTA"]
    seqs = [None, ""] + [word(rnd, rnd.randint(0, 12), "ACGT") + rnd.choice(around) + word(rnd, rnd.randint(0, 14)) for _ in range(3000)]
    got = matching.spacer_places(pa.array(seqs, pa.string()), spacer, *limits).to_pylist()
    assert got == [None if s is None else dict(zip(("start", "end", "outcome"), spacer_place(s, spacer, *limits))) for s in seqs]
    assert len(matching.spacer_places(pa.array([], pa.string()), spacer, *limits)) == 0
