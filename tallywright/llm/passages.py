"""Repeated windows of a corpus, found through sampled positions: shared by phrase and byte-string deduplication.

A window is `window` consecutive units (words or bytes) of one document. Each window is represented by the position of
the smallest hash among its grams of `gram` units (its anchor), which depends on the window's content alone: equal windows
have equal anchors at the same place. So

1. anchors are counted over the corpus, with partial sums; windows whose anchor does not recur cannot recur;
2. each occurrence of a recurring anchor stands with the windows that it represents (its context, less than two windows
   long); contexts are counted by their digests first: where an anchor has one context only, that count is the verdict.
   The texts of the others are cut out, equal ones as one row with a count, meet in one task and are judged there;
3. verdicts go back to the occurrences by an equi-join, and those of a document to its text.

Which anchors recur is first asked of a bitmap (a prefilter: it has no false negatives, and what passes it wrongly is
judged unique in step 2). Its size follows the counted anchors up to a bound; beyond that there is none, all anchors are
counted by their digests, and the texts to cut are found by joins. So all that is broadcast or collected has a bound.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from .common import broadcast_if, materialize

#: A prefilter has 32 bits or more for each anchor, at least 2 ** LEAST_BITS, at most 2 ** MOST_BITS (64 MB, where there are fewer). More anchors than
#: MOST_FILTERED would fill it by two fifths, and there is none. Spark's bitmaps hold BUCKET bits each.
LEAST_BITS, MOST_BITS, MOST_FILTERED, BUCKET = 18, 29, 1 << 28, 32768
#: Bytes of text hashed at once; a longer text is cut, between words where these are the units, with an overlap of a window.
PIECE = 1 << 20
MULTIPLIER = 0x9E3779B97F4A7C15
_TABLE = np.array([xxhash.xxh64_intdigest(bytes([b]), 7) for b in range(256)], np.uint64)


BETWEEN = re.compile(rb"[ \t-\r]+")


@dataclass(frozen=True)
class Units:
    """What windows are made of: words or bytes."""

    window: int
    gram: int
    words: bool

    @property
    def grams(self) -> int:
        return self.window - self.gram + 1

    def text(self, raw: bytes | None) -> bytes:
        raw = raw or b""
        if not self.words:
            return raw
        return b" ".join(raw.split()) if len(raw) < PIECE else BETWEEN.sub(b" ", raw).strip(b" ")


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def run_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of the `length` values that start at each place, built by doubling."""
    power, block, have, done = MULTIPLIER, values, 1, None
    reach = 0
    while have <= length:
        if length & have:
            if done is None:
                done, reach = block, have
            else:  # what is done stands first, this block after it
                n = len(block) - reach
                done = done[:n] + block[reach:] * np.uint64(pow(MULTIPLIER, reach, 1 << 64))
                reach += have
        have *= 2
        if have <= length:
            block = block[: len(block) - have // 2] + block[have // 2 :] * np.uint64(power)
            power = power * power % (1 << 64)
    return scrambled(done)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if have < width else x


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def word_values(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first byte and end of each word of a text whose words are parted by single spaces."""
    size = 1 << max(16, (len(text) + 1).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        base = np.full(size, MULTIPLIER, np.uint64)
        inverse = np.full(size, pow(MULTIPLIER, -1, 1 << 64), np.uint64)
        base[0] = inverse[0] = 1
        _POWERS[size] = np.cumprod(base), np.cumprod(inverse)
    up, down = _POWERS[size]
    raw = np.frombuffer(text, np.uint8)
    ends = np.append(np.flatnonzero(raw == 32), len(raw))
    starts = np.concatenate(([0], ends[:-1] + 1))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_TABLE[raw] * up[: len(raw)], dtype=np.uint64)))
    return scrambled((total[ends] - total[starts]) * down[starts]), starts, ends


def anchors(values: np.ndarray, units: Units) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, place, first window, last window) of each anchor of a sequence; ties in a window go to the leftmost."""
    none = np.empty(0, np.int64)
    if len(values) < units.window:
        return np.empty(0, np.uint64), none, none, none
    h = run_hashes(values, units.gram)
    low = sliding_min(h, units.grams)
    first = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    last = np.append(first[1:], len(low)) - 1
    place = np.empty(len(first), np.int64)
    for a in range(0, len(first), 4096):
        some = first[a : a + 4096]
        place[a : a + 4096] = some + h[some[:, None] + np.arange(units.grams)].argmin(axis=1)
    again = np.flatnonzero(last > place)  # the smallest gram recurs within reach: later windows have a later leftmost one
    if again.size:
        more = []
        for i in again.tolist():
            end = int(last[i])
            at = first[i] + np.flatnonzero(h[first[i] : end + units.grams] == low[first[i]])
            at = at[: np.searchsorted(at, end) + 1]
            opens = np.concatenate(([first[i]], at[:-1] + 1))
            more.append(np.stack((at, opens, np.minimum(at, end))))
        keep = np.ones(len(first), bool)
        keep[again] = False
        place, first, last = (np.concatenate((x[keep], y)) for x, y in zip((place, first, last), np.concatenate(more, axis=1), strict=True))
    return low[first], place, first, last


def cut(text: bytes, units: Units) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Of each piece of a normalised text: its first unit, its units' first bytes and ends in the text, and its anchors."""
    if not text:
        return
    if not units.words:
        for at in range(0, max(1, len(text) - units.window + 1), PIECE):
            upto = min(len(text), at + PIECE + units.window - 1)
            yield at, None, None, *anchors(_TABLE[np.frombuffer(text, np.uint8, upto - at, at)], units)
        return
    at = unit = 0
    while at < len(text):
        end = text.find(b" ", at + PIECE) if at + PIECE < len(text) else -1
        end = len(text) if end < 0 else end
        upto = end
        for _ in range(units.window - 1):  # the words that windows from before `end` reach into
            if upto < len(text):
                upto = text.find(b" ", upto + 1)
                upto = len(text) if upto < 0 else upto
        values, starts, ends = word_values(text[at:upto])
        yield unit, starts + at, ends + at, *anchors(values, units)
        unit += int(np.searchsorted(starts + at, end))
        at = end + 1


def passing(h: np.ndarray, bits: bytes | None) -> np.ndarray:
    """Which anchors the prefilter lets pass: all where there is none."""
    if bits is None:
        return np.ones(len(h), bool)
    key = (h & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return ((np.frombuffer(bits, np.uint8)[key >> 3] >> (key & 7).astype(np.uint8)) & 1).astype(bool)


def listed(h: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which anchors are among sorted values."""
    if not len(values):
        return np.zeros(len(h), bool)
    signed_h = h.view(np.int64)
    return values[np.minimum(np.searchsorted(values, signed_h), len(values) - 1)] == signed_h


def contexts(text: bytes, units: Units, wanted: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(hash, anchor's place in the context, first unit, windows, context) of each occurrence of a wanted anchor."""
    for at, starts, ends, h, place, first, last in cut(text, units):
        ok = np.flatnonzero(wanted(h))
        begin, end = first[ok], last[ok] + units.window
        a, b = (starts[begin], ends[end - 1]) if units.words else (begin + at, end + at)
        off = place[ok] - begin
        count = end - begin - units.window + 1
        begin = begin + at
        for hv, o, u, n, x, y in zip(h[ok].view(np.int64).tolist(), off.tolist(), begin.tolist(), count.tolist(), a.tolist(), b.tolist(), strict=True):
            yield hv, o, u, n, text[x:y]


#: An anchor of more occurrences, or of more different contexts, than this is judged window by window, in Spark, and not in one task.
HOT, WIDE = 200_000, 20_000
#: At most so many anchors (8 MB) are listed as such: where there are more, the limits double until they fit.
MOST_LISTED = 1_000_000
#: Hashes of at most so many texts (4 MB) are broadcast, to cut only those again that hold a wide anchor.
MOST_TEXTS = 500_000


def recurring(source: DataFrame, units: Units, in_other_documents: bool) -> DataFrame:
    """(h, n): the anchors that occur in two documents at least, or just twice, and how often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in range(0, b.num_rows, 256):
                part = b.slice(rows, 256)
                found = [np.concatenate([x[3] for x in cut(units.text(t.as_py()), units)] or [np.empty(0, np.uint64)]) for t in part.column(1)]
                h = np.concatenate(found).view(np.int64)
                if in_other_documents:
                    who = np.repeat(part.column(0).to_numpy(zero_copy_only=False), [len(x) for x in found])
                else:
                    h, who = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(who.astype(np.int64))], ["h", "who"])

    seen = source.select("rank", "raw").mapInArrow(run, "h bigint, who bigint").groupBy("h")
    if in_other_documents:
        return seen.agg(F.min("who").alias("a"), F.max("who").alias("b"), F.count("*").alias("n")).filter("a < b").select("h", "n")
    return seen.agg(F.sum("who").alias("n")).filter("n > 1")


def bitmap(anchors_: DataFrame, most: int) -> bytes | None:
    """The prefilter of a stored table of anchors (h), or None where there are more than `most`."""
    n = anchors_.count()
    if n > most:
        return None
    size = min(MOST_BITS, max(LEAST_BITS, (32 * n - 1).bit_length()))
    bit = F.col("h").bitwiseAND(F.lit((1 << size) - 1).cast("long"))  # the low bits: an anchor is a smallest hash, its high bits are mostly 0
    maps = anchors_.groupBy(F.floor(bit / BUCKET).alias("bucket")).agg(F.bitmap_construct_agg((bit % BUCKET).cast("long")).alias("bits"))
    whole = bytearray((1 << size) // 8)
    for row in maps.toLocalIterator():  # at most 16,384 rows of 4 KB
        at = row["bucket"] * BUCKET // 8
        whole[at : at + BUCKET // 8] = row["bits"]
    return bytes(whole)


def above(anchors_: DataFrame, count: str, limit: int) -> np.ndarray:
    """The sorted anchors whose count is over the limit, or over the least doubling of it that MOST_LISTED anchors pass."""
    over = anchors_.filter(F.col(count) > limit)
    level = F.floor(F.log2(F.greatest(F.col(count) - 1, F.lit(1)) / max(limit, 1)))
    sizes = {r["level"]: r["k"] for r in over.groupBy(level.cast("int").alias("level")).agg(F.count("*").alias("k")).collect()}
    least = next(x for x in range(65) if sum(k for level, k in sizes.items() if level >= x) <= MOST_LISTED)
    rows = over.filter(level >= least).select("h").collect() if sizes else []
    return np.sort(np.array([r["h"] for r in rows], np.int64))


#: One context of a group: (place of the anchor, bytes, smallest rank that has it, occurrences).
Context = tuple[int, bytes, int, int]
#: Verdicts of the contexts of several groups: an array of numbers each, or None where nothing is removed. For words, the
#: smallest rank of each window, or one number for all; for bytes, runs (first, length) of windows, (0, -1) for all.
Judge = Callable[[list[list[Context]]], list[list[list[int] | None]]]


def verdicts(source: DataFrame, units: Units, in_other_documents: bool, judge: Judge, hot: int = HOT, wide: int = WIDE, filtered: int = MOST_FILTERED) -> DataFrame:
    """(id, th, found): for each text with a repeated window, the list of (first unit, windows, verdict) of its contexts.

    source: id, th (hash of the text), rank (of the document in its order), raw (bytes).
    """
    share = source.sparkSession.sparkContext.broadcast
    again = materialize(recurring(source, units, in_other_documents), "recurring-anchors")
    bits, often = share(bitmap(again, filtered)), share(hot_ones := above(again, "n", hot))

    def located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = lambda h: passing(h, bits.value) & ~listed(h, often.value)
        for b in batches:
            for rows in range(0, b.num_rows, 256):
                part = b.slice(rows, 256)
                row, h, x, unit, windows = [], [], [], [], []
                for i, raw in enumerate(part.column(2)):
                    for hv, o, u, n, context in contexts(units.text(raw.as_py()), units, wanted):
                        row.append(i), h.append(hv), x.append(signed(xxhash.xxh3_64_intdigest(context, o))), unit.append(u), windows.append(n)
                take = pa.array(row, pa.int64())
                numbers = [pa.array(h, pa.int64()), pa.array(x, pa.int64()), pa.array(unit, pa.int64()), pa.array(windows, pa.int32())]
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(take) for c in (0, 1, 3)), *numbers], ["id", "th", "rank", "h", "x", "unit", "windows"])

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = lambda h: passing(h, bits.value) & ~listed(h, often.value)
        for b in batches:
            seen: dict[tuple[int, int], list[int]] = {}
            for rank, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for h, off, _, _, context in contexts(units.text(raw.as_py()), units, wanted):
                    key = h, signed(xxhash.xxh3_64_intdigest(context, off))
                    if (x := seen.get(key)) is None:
                        seen[key] = [rank, 1]
                    else:
                        x[0], x[1] = min(x[0], rank), x[1] + 1
            columns = [*zip(*seen, strict=True), *zip(*seen.values(), strict=True)] if seen else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["h", "x", "low", "n"])

    id_type = source.schema["id"].dataType.simpleString()
    occurrences = source.select("id", "th", "raw", "rank").mapInArrow(located, f"id {id_type}, th bigint, rank bigint, h bigint, x bigint, unit bigint, windows int")
    if bits.value is not None:  # few pass: found once, counted and met with their verdicts later
        occurrences = materialize(occurrences, "anchor-occurrences")
        counted = occurrences.groupBy("h", "x").agg(F.min("rank").alias("low"), F.count("*").alias("n")).repartition("h")
    else:
        counted = source.select("rank", "raw").mapInArrow(digests, "h bigint, x bigint, low bigint, n bigint").repartition("h")
    each = counted.groupBy("h", "x").agg(F.min("low").alias("low"), F.sum("n").alias("n"))
    each = each.groupBy("h").agg(F.count("*").alias("kinds"), F.max("x").alias("x"), F.min("low").alias("low"), F.sum("n").alias("n"))
    each = materialize(each.filter("n > 1"), "anchor-contexts")
    whole = F.array("low") if in_other_documents else F.array(F.lit(0).cast("long"), F.lit(-1).cast("long"))
    alone = each.filter("kinds = 1").select("h", "x", whole.alias("verdict"))
    unclear = each.filter("kinds > 1")
    several, many = share(bitmap(unclear, filtered)), share(wide_ones := np.union1d(hot_ones, above(each, "kinds", wide)))
    wide_texts = None  # the texts that hold such an anchor, where they are known and few: others need not be cut again
    if len(wide_ones) and not len(hot_ones) and bits.value is not None:
        names = each.filter(F.col("kinds") > wide).select("h")
        wide_texts = materialize(occurrences.join(broadcast_if(names, MOST_LISTED), "h", "left_semi").select("th").distinct(), "wide-texts")
        wide_texts = wide_texts if wide_texts.count() <= MOST_TEXTS else None

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: dict[tuple[int, int, bytes], list[int]] = {}
            for rank, raw, asked in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
                if asked.is_valid:
                    named = np.sort(asked.values.to_numpy(zero_copy_only=False))
                    wanted = lambda h: listed(h, named) & ~listed(h, many.value)  # noqa: B023, E731
                else:
                    wanted = lambda h: passing(h, several.value) & ~listed(h, many.value)
                for h, off, _, _, context in contexts(units.text(raw.as_py()), units, wanted):
                    if (x := seen.get((h, off, context))) is None:
                        seen[h, off, context] = [rank, 1]
                    else:
                        x[0], x[1] = min(x[0], rank), x[1] + 1
                if len(seen) > 200_000:
                    yield packed(seen)
                    seen = {}
            yield packed(seen)

    def packed(seen: dict) -> pa.RecordBatch:
        h, off, context = zip(*seen, strict=True) if seen else ((), (), ())
        low, n = zip(*seen.values(), strict=True) if seen else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(h, pa.int64()), pa.array(off, pa.int32()), pa.array(context, pa.binary()), pa.array(low, pa.int64()), pa.array(n, pa.int64())],
            ["h", "off", "context", "low", "n"],
        )

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups: list[list[Context]] = []
        names: list[int] = []
        held = 0

        def close() -> Iterator[pa.RecordBatch]:
            h, x, v = [], [], []
            for name, group, said in zip(names, groups, judge(groups), strict=True):
                for (o, context, _, _), verdict in zip(group, said, strict=True):
                    if verdict is not None:
                        h.append(name), x.append(signed(xxhash.xxh3_64_intdigest(context, o))), v.append(verdict)
            yield pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(x, pa.int64()), pa.array(v, pa.list_(pa.int64()))], ["h", "x", "verdict"])

        for b in batches:
            for h, off, context, low, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not names or names[-1] != h:
                    if held > 4000:
                        yield from close()
                        groups, names, held = [], [], 0
                    names.append(h)
                    groups.append([])
                group = groups[-1]
                if group and group[-1][:2] == (off, context):
                    group[-1] = (off, context, min(group[-1][2], low), group[-1][3] + n)
                else:
                    group.append((off, context, low, n))
                    held += 1
        yield from close()

    def windows_of(raw: bytes | None) -> Iterator[tuple[int, int, int]]:
        """First unit and digest of each window of the listed anchors of a text."""
        for _, _, u, n, context in contexts(units.text(raw), units, lambda h: listed(h, many.value)):
            for i, w in enumerate(split(context, n, units)):
                d = xxhash.xxh3_128_intdigest(w)
                yield u + i, signed(d >> 64), signed(d & ((1 << 64) - 1))

    def windows_located(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in range(0, b.num_rows, 256):
                part = b.slice(rows, 256)
                found = [(i, *w) for i, raw in enumerate(part.column(3)) for w in windows_of(raw.as_py())]
                row, *numbers = zip(*found, strict=True) if found else [()] * 4
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(take) for c in range(3)), *(pa.array(c, pa.int64()) for c in numbers)], ["id", "th", "rank", "unit", "w1", "w2"])

    if several.value is not None:
        asked = source.select("rank", "raw", F.lit(None).cast("array<bigint>").alias("asked"))
    else:
        names = occurrences.join(unclear.select("h"), "h", "left_semi").groupBy(F.col("id").alias("aid"), F.col("th").alias("ath")).agg(F.collect_set("h").alias("asked"))
        asked = source.join(names, F.col("id").eqNullSafe(F.col("aid")) & (F.col("th") == F.col("ath"))).select("rank", "raw", "asked")
    gathered = asked.mapInArrow(gather, "h bigint, off int, context binary, low bigint, n bigint")
    said = gathered.repartition("h").sortWithinPartitions("h", "off", "context").mapInArrow(judged, "h bigint, x bigint, verdict array<bigint>")
    met = occurrences.join(said.unionByName(alone), ["h", "x"]).select("id", "th", "unit", "windows", "verdict")
    if len(wide_ones):
        held = source.select("id", "th", "rank", "raw")
        if wide_texts is not None:
            held = held.join(F.broadcast(wide_texts), "th", "left_semi").select("id", "th", "rank", "raw")  # the join puts th first
        each = materialize(held.mapInArrow(windows_located, f"id {id_type}, th bigint, rank bigint, unit bigint, w1 bigint, w2 bigint"), "anchor-windows")
        counted = each.groupBy("w1", "w2").agg(F.min("rank").alias("low"), F.count("*").alias("n"))
        verdict = F.array("low") if in_other_documents else F.array(F.lit(0).cast("long"), F.lit(1).cast("long"))
        counted = counted.filter("n > 1").select("w1", "w2", verdict.alias("verdict"))
        met = met.unionByName(each.join(counted, ["w1", "w2"]).select("id", "th", "unit", F.lit(1).alias("windows"), "verdict"))
    # a set: rows that repeat id and text find the same, and it is said once for all of them
    return met.groupBy("id", "th").agg(F.collect_set(F.struct("unit", "windows", "verdict")).alias("found"))


def split(context: bytes, windows: int, units: Units) -> list[bytes]:
    """The windows of a context."""
    if not units.words:
        return [context[i : i + units.window] for i in range(windows)]
    ends = np.append(np.flatnonzero(np.frombuffer(context, np.uint8) == 32), len(context)).tolist()
    starts = [0, *(e + 1 for e in ends[:-1])]
    return [context[starts[i] : ends[i + units.window - 1]] for i in range(windows)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def judged_texts(docs: DataFrame, id_col: str, text_col: str, units: Units, in_other_documents: bool, judge: Judge, **limits: int) -> DataFrame:
    """id, rank, raw, found for each row of docs; found is null where no window repeats. Where documents are compared by their ids,
    these are whole numbers; else ids may be of any type that compares equal."""
    if in_other_documents and not isinstance(docs.schema[id_col].dataType, IntegralType):
        raise TypeError(f"{id_col} must be of a whole-number type, as the smaller id keeps a passage")
    rank = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)) if in_other_documents else F.lit(0).cast("long")
    raw = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    source = docs.select(F.col(id_col).alias("id"), F.xxhash64(raw).alias("th"), rank.alias("rank"), raw.alias("raw"))
    said = verdicts(source, units, in_other_documents, judge, **limits).select(F.col("id").alias("fid"), F.col("th").alias("fth"), "found")
    return source.join(said, F.col("id").eqNullSafe(F.col("fid")) & (F.col("th") == F.col("fth")), "left").select("id", "rank", "raw", "found")
