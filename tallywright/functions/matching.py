"""Edit distances of many short strings at once: bit-parallel columns in numpy; and keys by which near strings meet. N stands for any base."""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations, product
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Longest pattern, a bit a place.
WORD = 64
#: Cells of a matrix of distances that are worked on together.
CELLS = 1 << 15
PAD = 0


def characters(strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points, a row a string, padded with PAD; lengths)."""
    lengths = np.array([len(s) for s in strings], np.int64)
    out = np.zeros((len(strings), int(lengths.max(initial=0))), np.uint32)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out, lengths


def coded(*sets: np.ndarray) -> tuple[list[np.ndarray], int | None]:
    """Code points as small numbers, the same for all sets, and that of N."""
    alphabet = np.unique(np.concatenate([[PAD, ord("N")], *(s.ravel() for s in sets)]))
    return [np.searchsorted(alphabet, s) for s in sets], int(np.searchsorted(alphabet, ord("N")))


def masks(patterns: np.ndarray, lengths: np.ndarray, letters: int, n: int) -> np.ndarray:
    """For each pattern and letter the places, as bits, that equal it; N does on either side."""
    inside = np.arange(patterns.shape[1]) < lengths[:, None]
    bits = np.where(inside, np.uint64(1) << np.arange(patterns.shape[1], dtype=np.uint64), np.uint64(0))
    wild = np.where(patterns == n, bits, np.uint64(0)).sum(axis=1, dtype=np.uint64)
    found = np.stack([np.where(patterns == c, bits, np.uint64(0)).sum(axis=1, dtype=np.uint64) | wild for c in range(letters)], axis=1)
    found[:, n] = bits.sum(axis=1, dtype=np.uint64)
    return found


class Columns:
    """The dynamic programme's column for many pairs, differences of its cells as bits, a step for each letter of the texts."""

    def __init__(self, shape: tuple[int, ...], lengths: np.ndarray) -> None:
        self.up, self.down = np.full(shape, ~np.uint64(0)), np.zeros(shape, np.uint64)
        self.score = np.broadcast_to(lengths, shape).astype(np.int64)
        self.top = np.where(lengths > 0, np.uint64(1) << np.maximum(lengths - 1, 0).astype(np.uint64), np.uint64(0))

    def step(self, equal: np.ndarray, on: np.ndarray) -> None:
        """Take one letter of each text that still has one (`on`)."""
        vertical = equal | self.down
        flat = ((equal & self.up) + self.up ^ self.up) | equal
        plus, minus = self.down | ~(flat | self.up), self.up & flat
        self.score += on * ((plus & self.top) != 0).astype(np.int64) - on * ((minus & self.top) != 0)
        plus, minus = plus << np.uint64(1) | np.uint64(1), minus << np.uint64(1)
        self.up = np.where(on, minus | ~(vertical | plus), self.up)
        self.down = np.where(on, plus & vertical, self.down)


def pair_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Edit distance of each a to the b beside it; the shorter of a pair has at most WORD letters."""
    short = [x if len(x) <= len(y) else y for x, y in zip(a, b, strict=True)]
    texts = [y if len(x) <= len(y) else x for x, y in zip(a, b, strict=True)]
    (p, np_), (t, nt) = characters(short), characters(texts)
    if np_.max(initial=0) > WORD:
        raise ValueError(f"strings of over {WORD} letters on both sides")
    (p, t), n = coded(p, t)
    found = masks(p, np_, int(max(p.max(initial=0), t.max(initial=0), n)) + 1, n)
    columns, rows = Columns((len(a),), np_), np.arange(len(a))
    for j in range(t.shape[1]):
        columns.step(found[rows, t[:, j]], j < nt)
    return np.where(np_ == 0, nt, columns.score)


def near_pairs(texts: list[str], patterns: list[str], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, pattern, distance) for those at most k apart, by numbers; patterns have at most WORD letters."""
    (t, nt), (p, np_) = characters(texts), characters(patterns)
    if np_.max(initial=0) > WORD:
        raise ValueError(f"patterns of over {WORD} letters")
    (t, p), n = coded(t, p)
    found = masks(p, np_, int(max(p.max(initial=0), t.max(initial=0), n)) + 1, n)
    out = []
    size = max(1, CELLS // max(1, len(patterns)))
    for start in range(0, len(texts), size):
        part, length = t[start : start + size], nt[start : start + size]
        columns = Columns((len(part), len(patterns)), np_)
        for j in range(int(length.max(initial=0))):
            columns.step(found[:, part[:, j]].T, (j < length)[:, None])
        score = np.where(np_ == 0, length[:, None], columns.score)
        i, m = np.nonzero(score <= k)
        out.append((i + start, m, score[i, m]))
    return tuple(np.concatenate(x) if out else np.zeros(0, np.int64) for x in (zip(*out) if out else ([], [], [])))


@lru_cache(maxsize=256)
def kept_places(n: int, deleted: int) -> np.ndarray:
    """Places that stay for each way to delete so many of n letters."""
    return np.array(list(combinations(range(n), n - deleted)), np.int64).reshape(comb(n, deleted), n - deleted)


def deletion_keys(strings: list[str], sizes: dict[int, list[int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string's number, key, length of what the key is of): hashes of all subsequences of the lengths that `sizes` names for a
    string's length, each once for a spelling. N is spelled out as each base, so a string of m of them has up to 4 ** m times as many keys."""
    spelled, owners = [], []
    for i, s in enumerate(strings):
        for filled in product(*("ACGT" if c == "N" else c for c in s)) if "N" in s else (s,):
            spelled.append("".join(filled))
            owners.append(i)
    chars, lengths = characters(spelled)
    owners, out = np.array(owners, np.int64), []
    for n in np.unique(lengths).tolist():
        here = np.flatnonzero(lengths == n)
        letters = (chars[here, :n].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        for size in sizes.get(n, []):
            places = kept_places(n, n - size)
            keys = np.full((len(here), len(places)), (size + 1) * 0xD1B54A32D192ED03 & 2**64 - 1, np.uint64)
            for j in range(size):
                keys = (keys ^ letters[:, places[:, j]]) * np.uint64(0xBF58476D1CE4E5B9)
                keys ^= keys >> np.uint64(29)
            keys.sort(axis=1)
            once = np.ones(keys.shape, bool)
            once[:, 1:] = keys[:, 1:] != keys[:, :-1]
            row, _ = np.nonzero(once)
            out.append((owners[here][row], keys[once].view(np.int64), np.full(len(row), size, np.int64)))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def spacer_places(seqs: pa.Array, spacer: str, max_edits: int, search: int, shortest: int, longest: int, after: int) -> pa.StructArray:
    """struct(start, end, outcome) of a spacer between two barcodes in each sequence; -1 where there is none; null for null.

    An exact spacer counts wherever it stands. Else its last `search` bases are sought from the right, then its first
    ones from the left, in the places that the first barcode's lengths allow, and the edits may not exceed max_edits.
    """
    size, n = len(spacer), len(seqs)
    number = lambda x: pc.fill_null(x, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    length = number(pc.utf8_length(seqs))
    exact = number(pc.find_substring(seqs, spacer))
    latest, earliest = longest + size + max_edits - search, max(0, shortest + size - search - max_edits)
    head = pc.utf8_slice_codeunits(seqs, 0, max(0, latest + search))
    back = number(pc.find_substring(pc.utf8_reverse(head), spacer[::-1][:search]))
    tail = np.where(back < 0, -1, np.minimum(length, max(0, latest + search)) - back - search)
    by_tail = tail - size + search
    ahead = number(pc.find_substring(pc.utf8_slice_codeunits(seqs, shortest, None), spacer[:search]))
    by_head = np.where(ahead < 0, -1, ahead + shortest)
    from_head = (tail < earliest) | (by_tail < 0)
    at = np.where(from_head, by_head, by_tail)
    lost = from_head & ((at < 0) | (at > longest))
    asked = np.flatnonzero((exact < 0) & ~lost & (length >= shortest + size + after))
    if len(asked):
        starts = at[asked]
        chars, _ = characters(seqs.take(pa.array(asked)).to_pylist())
        width = np.minimum(size, length[asked] - starts)
        rows = np.take_along_axis(chars, np.minimum(starts[:, None] + np.arange(size), chars.shape[1] - 1), axis=1)
        lost[asked] = window_distances(spacer, rows, width) > max_edits
    start = np.where(exact >= 0, exact, at)
    bad = np.where(length < shortest + size + after, "short", np.where((exact < 0) & lost, "no_spacer", np.where(length < start + size + after, "short", "")))
    found = bad == ""
    outcome = np.where(found, np.where(exact >= 0, "ok", "modified"), bad)
    columns = [pa.array(np.where(found, start, -1), pa.int32()), pa.array(np.where(found, start + size, -1), pa.int32()), pa.array(outcome.tolist(), pa.string())]
    return pa.StructArray.from_arrays(columns, ["start", "end", "outcome"], mask=seqs.is_null()) if n else pa.array([], pa.struct([("start", pa.int32()), ("end", pa.int32()), ("outcome", pa.string())]))


def window_distances(pattern: str, rows: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Edit distance of a pattern to the first `width` letters of each row of code points."""
    p, n_p = characters([pattern])
    (p, t), n = coded(p, rows)
    found = masks(p, n_p, int(max(p.max(initial=0), t.max(initial=0), n)) + 1, n)[0]
    columns = Columns((len(rows),), np.full(len(rows), len(pattern)))
    for j in range(rows.shape[1]):
        columns.step(found[t[:, j]], j < width)
    return columns.score
