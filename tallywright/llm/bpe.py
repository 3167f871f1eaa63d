"""Byte-level BPE encoding and decoding by a file of ranks: pieces of similar length are merged together in numpy matrices."""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: No merge, no token; both greater than any rank.
NONE = np.int64(1) << 62
#: Widths of the matrices; longer pieces are merged one by one with a heap. Cells of a matrix.
WIDTHS = (4, 8, 16, 32, 64, 128, 256)
WIDTH_OF = [next(w for w in WIDTHS if w >= n) for n in range(WIDTHS[-1] + 1)]
CELLS = 1 << 20
#: Pieces kept with their ids from batch to batch, and the longest of them, in characters.
KEPT, KEPT_LONG = 400_000, 64
#: Characters of text encoded together, pieces of a long text at a time, bytes in a batch of results.
TOGETHER, SLICE, BATCH = 1 << 21, 1 << 18, 1 << 25
#: A file of ranks is sent to all executors: at most so many bytes.
MOST_BYTES = 64 << 20


@dataclass(frozen=True)
class Vocabulary:
    """Lines of a token in base64 and its rank, and the pattern that cuts a text into pieces (all of it)."""

    lines: bytes
    pattern: str


def read_vocabulary(path: str, pattern: str) -> Vocabulary:
    """The file is read on the driver; its size is checked, as executors get it by broadcast."""
    with open(path, "rb") as f:
        lines = f.read(MOST_BYTES + 1)
    if len(lines) > MOST_BYTES:
        raise ValueError(f"{path} has over {MOST_BYTES} bytes")
    return Vocabulary(lines, pattern)


class Pairs:
    """Hashed lookup of (left id, right id) -> merged id: open addressing, a step at a time for all that are asked."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        self.bits = max(4, (2 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.values = np.full(1 << self.bits, NONE, np.int64)
        asked = np.array(list(pairs), np.int64).reshape(-1, 2)
        keys, values = asked[:, 0] << 32 | asked[:, 1], np.array(list(pairs.values()), np.int64)
        at = self.slots(keys)
        while len(keys):
            _, first = np.unique(at, return_index=True)
            first = first[self.keys[at[first]] == -1]
            self.keys[at[first]], self.values[at[first]] = keys[first], values[first]
            left = np.ones(len(keys), bool)
            left[first] = False
            keys, values, at = keys[left], values[left], at[left] + 1 & len(self.keys) - 1

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """NONE where a pair does not merge or one of the ids is negative (padding)."""
        keys = left << 32 | right
        found = np.full(keys.shape, NONE, np.int64)
        open_ = np.flatnonzero((left >= 0) & (right >= 0))
        keys, flat, at = keys.ravel()[open_], found.ravel(), self.slots(keys.ravel()[open_])
        while len(open_):
            there = self.keys[at]
            hit = there == keys
            flat[open_[hit]] = self.values[at[hit]]
            on = ~hit & (there != -1)
            open_, keys, at = open_[on], keys[on], at[on] + 1 & len(self.keys) - 1
        return flat.reshape(found.shape)


class Codec:
    """The tables that a worker makes of a vocabulary, and what it has encoded lately."""

    def __init__(self, lines: bytes, pattern: str):
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines.splitlines()) if token}
        self.pattern = regex.compile(pattern)
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"the vocabulary has no token for the bytes {missing}")
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        get, pairs = self.ranks.get, {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = get(token[:cut]), get(token[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = rank
        self.pair_ids = pairs
        self.pairs = Pairs(pairs)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.lengths = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(tokens), np.uint8)
        self.known: dict[str, bytes] = {}

    def merged(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Packed ids of pieces of at most `width` bytes. In a round every row merges its leftmost pair of least rank: the left cell gets the
        merged id, the right one is cut out, so the matrix is a column narrower. Rows without a pair leave."""
        n = np.array([len(p) for p in pieces])
        tok = np.full((len(pieces), width), -1, np.int64)
        tok[np.arange(width) < n[:, None]] = self.single[np.frombuffer(b"".join(pieces), np.uint8)]
        rank = self.pairs.find(tok[:, :-1], tok[:, 1:])
        out = [b""] * len(pieces)
        rows = np.arange(len(pieces))
        while len(rows):
            here = np.arange(len(rows))
            j = rank.argmin(axis=1) if rank.shape[1] else None
            best = rank[here, j] if j is not None else np.full(len(rows), NONE)
            done = best == NONE
            if done.any():
                left = tok[done]
                held = left >= 0
                flat, ends = left[held].astype("<u4").tobytes(), (4 * np.cumsum(held.sum(axis=1))).tolist()
                for row, start, end in zip(rows[done].tolist(), [0, *ends], ends):
                    out[row] = flat[start:end]
                rows, tok, rank = rows[~done], tok[~done], rank[~done]
                if not len(rows):
                    break
                here, j, best = np.arange(len(rows)), j[~done], best[~done]
            tok[here, j] = best
            stays = np.ones(tok.shape, bool)
            stays[here, j + 1] = False
            tok = tok[stays].reshape(len(rows), -1)
            stays = np.ones(rank.shape, bool)
            stays[here, j] = False
            rank = rank[stays].reshape(len(rows), -1)
            before, after = np.flatnonzero(j > 0), np.flatnonzero(j < rank.shape[1])
            rank[before, j[before] - 1] = self.pairs.find(tok[before, j[before] - 1], tok[before, j[before]])
            rank[after, j[after]] = self.pairs.find(tok[after, j[after]], tok[after, j[after] + 1])
        return out

    def merged_long(self, piece: bytes) -> bytes:
        """Packed ids of one long piece, in n log n steps: a heap of pairs by (rank, place) over a linked list."""
        ids = self.single[np.frombuffer(piece, np.uint8)].tolist()
        end = len(ids)
        ahead, back, pairs = list(range(1, end + 1)), list(range(-1, end - 1)), self.pair_ids
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(end - 1) if (r := pairs.get((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, left, right = heapq.heappop(heap)
            k = ahead[i] if ids[i] == left else end
            if k >= end or ids[k] != right:
                continue
            ids[i], ids[k], ahead[i] = r, -1, ahead[k]
            if ahead[i] < end:
                back[ahead[i]] = i
            for a, b in ((back[i], i), (i, ahead[i])):
                if a >= 0 and b < end and (found := pairs.get((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (found, a, ids[a], ids[b]))
        done = np.array(ids, np.int64)
        return done[done >= 0].astype("<u4").tobytes()

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Packed ids of distinct pieces. A piece that is a token is that token, whatever its merges give."""
        raw = [p.encode() for p in pieces]
        found = [b""] * len(raw)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(raw):
            rank = self.ranks.get(p)
            if rank is not None:
                found[i] = rank.to_bytes(4, "little")
            elif len(p) > WIDTHS[-1]:
                found[i] = self.merged_long(p)
            else:
                buckets.setdefault(WIDTH_OF[len(p)], []).append(i)
        for width, members in buckets.items():
            for k in range(0, len(members), CELLS // width):
                part = members[k : k + CELLS // width]
                for i, ids in zip(part, self.merged([raw[i] for i in part], width)):
                    found[i] = ids
        return found

    def packed(self, lists: list[list[str]]) -> list[bytes]:
        """Packed ids of lists of pieces; pieces not met lately are encoded together."""
        asked = set().union(*lists)
        new = asked.difference(self.known)
        if len(self.known) + len(new) > KEPT:
            self.known, new = {}, asked
        new = list(new)
        found = dict(zip(new, self.encode_pieces(new)))
        self.known.update((p, ids) for p, ids in found.items() if len(p) <= KEPT_LONG)
        get = self.known.__getitem__ if all(len(p) <= KEPT_LONG for p in new) else lambda p: self.known[p] if p in self.known else found[p]
        return [b"".join(map(get, pieces)) for pieces in lists]

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Packed ids of each text; texts together have about TOGETHER characters, or one is longer and is cut at piece ends."""
        if len(texts) == 1 and len(texts[0]) > TOGETHER:
            pieces = (m[0] for m in self.pattern.finditer(texts[0]))
            yield b"".join(self.packed([part])[0] for part in iter(lambda: list(islice(pieces, SLICE)), []))
        else:
            yield from self.packed([self.pattern.findall(t) for t in texts])

    def decode(self, packed: bytes) -> bytes:
        """The bytes of packed ids; ValueError for an id that the vocabulary lacks."""
        out = []
        ids = np.frombuffer(packed, "<u4")
        for k in range(0, len(ids), SLICE):
            part = ids[k : k + SLICE].astype(np.int64)
            if part.max() >= len(self.lengths) or not (n := self.lengths[part]).all():
                raise ValueError("an id is not in the vocabulary")
            ends = np.cumsum(n)
            out.append(self.flat[np.repeat(self.starts[part] - ends + n, n) + np.arange(ends[-1])].tobytes())
        return b"".join(out)


@lru_cache(maxsize=2)
def codec(lines: bytes, pattern: str) -> Codec:
    return Codec(lines, pattern)


def in_parts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges (from, to) of rows of about `most` together; a larger row is alone."""
    start, total = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and total + n > most:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids), one row for each row of docs; ids: little-endian unsigned 32-bit integers, packed, as in token files.

    Every piece that the pattern finds is encoded by itself: a piece that is a token is that token; else its bytes merge,
    the leftmost pair of least rank first. There are no special tokens: their strings are text. Null and empty texts have no
    token. Rows that repeat an id or a text get a row each; an empty table gives none; other columns take no part. Nothing is
    shuffled; a worker's memory follows the longest text (its ids), not the rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary.lines, vocabulary.pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(*shared.value)
        for batch in batches:
            sizes = np.diff(np.frombuffer(batch.column(1).buffers()[1], np.int32, len(batch) + 1, batch.column(1).offset * 4)) if len(batch) else np.zeros(0)
            for start, end in in_parts(sizes, TOGETHER):
                texts = [t or "" for t in batch.column(1).slice(start, end - start).to_pylist()]
                ids = list(made.encode(texts))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(start, end - start), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])

    id_type = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, f"id {id_type}, n_tokens bigint, ids binary")


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """encode()'s columns, and decoded: the bytes that the ids stand for (null: none). Fails at an id that the vocabulary lacks."""
    shared = encoded.sparkSession.sparkContext.broadcast((vocabulary.lines, vocabulary.pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = codec(*shared.value)
        for batch in batches:
            lengths = [len(x.as_buffer()) if x.is_valid else 0 for x in batch.column(2)]
            for start, end in in_parts(np.array(lengths, np.int64), BATCH):
                part = batch.slice(start, end - start)
                texts = [made.decode(x.as_py() or b"") for x in part.column(2)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], [*part.schema.names, "decoded"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in encoded.schema)
    return encoded.mapInArrow(run, f"{fields}, decoded binary")
