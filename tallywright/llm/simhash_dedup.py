"""Near-duplicate documents by SimHash, with pigeonring filtering of fingerprint pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import apart, broadcast_if, materialize
from .graph import components

BITS = 64
#: What is added to a hash before it is scrambled for the next fingerprint.
STEP = 0x9E3779B97F4A7C15
#: Pairs of a group that are compared at once.
CELLS = 1 << 19
#: Shingles hashed at once, so that memory does not follow the length of a text.
PIECE = 1 << 16
#: Groups beyond this size are compared by their second segment, not each with all.
LARGE_GROUP = 1 << 12
#: A fingerprint of more links than this in a group is of a dense class; so many places are looked at to find one.
DENSE, SAMPLED = 256, 64


def fingerprints(text: bytes | None, shingle: int = 4, seed: int = 42, count: int = 1) -> np.ndarray:
    """SimHashes of a whole text, as signed 64-bit integers: bit i is set where over half the shingle hashes set it.

    Words are runs of anything but ASCII white space, A-Z lower-cased; repeats count. Fewer words than a shingle: the
    whole sequence is one; no word: 0. Fingerprints after the first are of scrambled hashes.
    """
    found = (text or b"").lower().split()
    if not found:
        return np.zeros(count, np.int64)
    line = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    starts = np.cumsum(sizes + 1) - sizes - 1
    last = max(1, len(found) - shingle + 1)
    starts, ends = starts[:last], (starts + sizes)[min(shingle, len(found)) - 1 :]
    votes, digest = np.zeros((count, BITS), np.int64), xxhash.xxh64_intdigest
    for at in range(0, last, PIECE):
        span = zip(starts[at : at + PIECE].tolist(), ends[at : at + PIECE].tolist(), strict=True)
        hashes = np.array([digest(line[s:e], seed) for s, e in span], "<u8")
        for k in range(count):
            mixed = scrambled(hashes + np.uint64(k * STEP % (1 << BITS))) if k else hashes
            votes[k] += np.unpackbits(mixed.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return np.packbits(2 * votes > last, axis=1, bitorder="little").view("<i8")[:, 0]


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, more: list[str] | None = None, count: int = 1) -> DataFrame:
    """(id, fp, fps, *more), one row for each row of docs; fps: `count` fingerprints, fp: the only one, or their hash."""
    more = more or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            each = np.array([fingerprints(t.as_py(), shingle, count=count) for t in b.column(1)], np.int64).reshape(-1, count)
            fps = pa.ListArray.from_arrays(pa.array(np.arange(len(each) + 1) * count, pa.int32()), pa.array(each.ravel()))
            names = each[:, 0] if count == 1 else np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in each], np.uint64).view(np.int64)
            rest = [b.column(i + 2) for i in range(len(more))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.int64()), fps, *rest], ["id", "fp", "fps", *more])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"), *more)
    rest = "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in more)
    return rows.mapInArrow(run, f"id {docs.schema[id_col].dataType.simpleString()}, fp bigint, fps array<bigint>{rest}")


def ring(radius: int) -> list[tuple[int, int]]:
    """(first bit, width) of radius + 1 segments around the fingerprint."""
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(edges, edges[1:], strict=False)]


#: Standard deviations from the mean distance of texts as similar as asked for, within which the shingles decide.
DEVIATIONS = 1.65, 2.5


def bit_bounds(least: float, count: int) -> tuple[int, int]:
    """(most, sure): texts of Jaccard similarity `least` seldom differ in more than `most` of the bits of `count` fingerprints,
    and in `sure` or fewer hardly ever."""
    share = math.acos(2 * least / (1 + least)) / math.pi
    mean, spread = BITS * count * share, math.sqrt(BITS * count * share * (1 - share))
    return int(mean + DEVIATIONS[0] * spread), int(mean - DEVIATIONS[1] * spread)


def pairs(
    fps: np.ndarray, start: int, segments: list[tuple[int, int]], every: np.ndarray | None = None, most: int | None = None, sure: int | None = None
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links among fingerprints that agree in segment `start`, as places (a, b) and their distance: all of them, but a spanning star
    in place of a class found to be dense, whose pairs would be too many; with `sure`, a tree in which links of more bits only
    join what those of at most so many leave apart.

    A pair is compared in full only if the chain of segments that starts there stays within its proportional budget at
    each length: l segments may differ in at most floor(l * radius / (radius + 1)) = l - 1 bits. With `most`, the rows of
    `every` (all fingerprints of each) must differ in at most so many bits too.
    """
    count = len(segments)
    masks, upto = [], 0
    for l in range(count):
        first, width = segments[(start + l) % count]
        upto |= ((1 << width) - 1) << first
        masks.append(np.uint64(upto))
    at, width = segments[(start + 1) % count]
    key = (fps >> np.uint64(at)) & np.uint64((1 << width) - 1)
    order = np.argsort(key, kind="stable")
    fps, key = fps[order], key[order]
    every = every[order] if every is not None else None

    def linked(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs (a, b) link, and in how many bits of all (without `most`: 0) they differ; a may be one place."""
        diff = fps[a] ^ fps[b]
        ok = np.flatnonzero(np.bitwise_count(diff & masks[1]) <= 1)
        for l in range(2, count):
            if not ok.size:
                break
            ok = ok[np.bitwise_count(diff[ok] & masks[l]) <= l]
        if most is None or not ok.size:
            return ok, np.zeros(len(ok), np.int64)
        bits = np.bitwise_count(every[a if a.size == 1 else a[ok]] ^ every[b[ok]]).sum(axis=1)
        return ok[bits <= most], bits[bits <= most]

    def reach(i: int) -> np.ndarray:
        """Places that have the second segment of place i, or one bit of it changed."""
        values = key[i] ^ np.array([0, *(1 << k for k in range(width))], np.uint64)
        spans = zip(np.searchsorted(key, values, "left").tolist(), np.searchsorted(key, values, "right").tolist(), strict=True)
        return np.concatenate([np.arange(lo, hi) for lo, hi in spans])

    alive = np.ones(len(fps), bool)

    def around(j: int) -> tuple[np.ndarray, np.ndarray]:
        """Places not taken yet that link with j, and in how many bits they differ."""
        near = reach(j)
        near = near[alive[near]]
        ok, bits = linked(np.array([j]), near)
        return near[ok], bits

    def walk(i: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Takes the class of place i."""
        todo, members = [i], [i]
        while todo or members and sure is not None:
            if todo:  # all that is linked, or surely linked
                j = todo.pop()
                near, bits = around(j)
                if sure is not None:
                    near, bits = near[bits <= sure], bits[bits <= sure]
                hub = i if sure is None else j
            else:  # the nearest of what else is linked with a member, one at a time
                j = hub = members[-1]
                near, bits = around(j)
                if not near.size:
                    members.pop()
                    continue
                nearest = bits.argmin()
                near, bits = near[nearest : nearest + 1], bits[nearest : nearest + 1]
            if near.size:
                alive[near] = False
                todo.extend(near.tolist())
                members.extend(near.tolist())
                yield np.full(len(near), order[hub]), order[near], bits

    dense = len(fps) > DENSE
    while dense:  # stars of classes that many places belong to, until a sample meets none
        left = np.flatnonzero(alive)
        dense = False
        for i in left[:: max(1, len(left) // SAMPLED)].tolist():
            if not alive[i]:
                continue
            near = reach(i)
            if len(linked(np.array([i]), near[alive[near]])[0]) <= DENSE:
                continue
            dense, alive[i] = True, False
            yield from walk(i)
    left = np.flatnonzero(alive)
    fps, key, order, every = fps[left], key[left], order[left], every[left] if every is not None else None

    def spans() -> Iterator[tuple[int, int, int, int]]:
        """Ranges of places that may link."""
        if len(fps) <= LARGE_GROUP:
            yield 0, len(fps), 0, len(fps)
            return
        values, lo = np.unique(key, return_index=True)
        known = dict(zip(values.tolist(), zip(lo.tolist(), [*lo[1:].tolist(), len(key)], strict=True), strict=True))
        for v, (a, b) in known.items():
            yield a, b, a, b
            for k in range(width):
                if v ^ 1 << k > v and v ^ 1 << k in known:
                    yield a, b, *known[v ^ 1 << k]

    for lo, hi, c, d in spans():
        step = max(1, CELLS // (d - c)) if d > c else 1
        for a in range(lo, hi, step):
            x, y = np.nonzero(np.bitwise_count((fps[a : min(a + step, hi), None] ^ fps[None, c:d]) & masks[1]) <= 1)
            x, y = x + a, y + c
            x, y = x[x < y], y[x < y]
            if x.size:
                ok, bits = linked(x, y)
                if ok.size:
                    yield order[x[ok]], order[y[ok]], bits


def smallest(root: np.ndarray, found: Iterator[tuple[np.ndarray, ...]]) -> np.ndarray:
    """The smallest place of each place's class, where root has those so far and pairs (a, b, ...) join classes."""
    for a, b, *_ in found:
        x, y = root[a], root[b]
        while (apart := x != y).any():
            low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
            np.minimum.at(root, high, low)
            while (up := root[root]).tobytes() != root.tobytes():
                root = up
            x, y = root[low], root[high]
    return root


def stars(root: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The smallest place of each class, and the others of it."""
    places = np.flatnonzero(root != np.arange(len(root)))
    return root[places], places


def spanning(root: np.ndarray, a: np.ndarray, b: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which pairs make a forest of least distances over the classes of root: each class takes its nearest link, until none is left."""
    order = np.lexsort((b, a, bits))
    a, b, taken = a[order], b[order], []
    index = np.arange(len(a))
    while True:
        x, y = root[a[index]], root[b[index]]
        index, x, y = index[x != y], x[x != y], y[x != y]
        if not index.size:
            return order[np.concatenate(taken)] if taken else order[:0]
        best = np.full(len(root), len(a))
        np.minimum.at(best, x, index)
        np.minimum.at(best, y, index)
        taken.append(np.unique(best[best < len(a)]))
        root = smallest(root.copy(), iter([(a[taken[-1]], b[taken[-1]])]))


def links(nodes: DataFrame, radius: int = 4, count: int = 1, most: int | None = None, sure: int | None = None) -> DataFrame:
    """nodes(fp, fps), distinct -> links(a, b, bits) of fp whose classes are those of all pairs that have one of their `count`
    fingerprints at most `radius` bits apart, and with `most` all of them together at most so many.

    With `sure`, bits is 0 for links that stand for ones of at most so many bits; of the others those of least bits that
    join the classes of a group are given.

    A pair within the radius agrees in some segment from which its chain keeps the budgets, so the group of that
    segment's value holds it. A group is a sorted run of numbers in one partition.
    """
    segments = ring(radius)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        at: tuple[int, int] | None = None

        def close() -> Iterator[pa.RecordBatch]:
            names, every = (np.concatenate([h[k] for h in held]) if held else np.empty((0, count), np.int64) for k in range(2))
            if len(names) > 1:
                own = every[:, at[0] // len(segments)].view(np.uint64)
                # names are sorted: a class has the same smallest one, and so the same star, in all groups that hold it whole
                found = pairs(np.ascontiguousarray(own), at[0] % len(segments), segments, every.view(np.uint64), most, sure)
                root, rest = np.arange(len(names)), []
                for a, b, bits in found:
                    few = bits <= (0 if sure is None else sure)
                    root = smallest(root, iter([(a[few], b[few])]))
                    if not few.all():
                        rest.append((a[~few], b[~few], bits[~few]))
                a, b = stars(root)
                bits = np.zeros(len(a), np.int64)
                if rest:
                    x, y, apart_ = (np.concatenate(c) for c in zip(*rest, strict=True))
                    kept = spanning(root, x, y, apart_)
                    a, b, bits = np.append(a, x[kept]), np.append(b, y[kept]), np.append(bits, apart_[kept])
                yield pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b]), pa.array(bits.astype(np.int32))], ["a", "b", "bits"])

        for b in batches:
            seg, val, names = (b.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            every = b.column(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, count)
            cuts = np.flatnonzero((np.diff(seg) != 0) | (np.diff(val) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(names)], strict=True):
                if lo == hi:
                    continue
                if at != (seg[lo], val[lo]):
                    yield from merged(close())
                    held, at = [], (int(seg[lo]), int(val[lo]))
                held.append((names[lo:hi], every[lo:hi]))
        yield from merged(close())

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if found := list(batches):
            yield from pa.Table.from_batches(found).combine_chunks().to_batches()

    value = lambda k, s, w: F.shiftrightunsigned(F.get("fps", F.lit(k)), s).bitwiseAND(F.lit((1 << w) - 1))
    each = [F.struct(F.lit(k * len(segments) + i).alias("seg"), value(k, s, w).alias("val")) for k in range(count) for i, (s, w) in enumerate(segments)]
    keyed = nodes.select("fp", "fps", F.explode(F.array(*each)).alias("e")).select("e.seg", "e.val", "fp", "fps")
    return keyed.repartition("seg", "val").sortWithinPartitions("seg", "val", "fp").mapInArrow(run, "a bigint, b bigint, bits int")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, shingle: int = 4) -> DataFrame:
    """(id, fp, component_id) for each row of docs: component_id is the smallest id that links reach, itself included.

    Fingerprints at most `radius` bits apart link; equal ones are one node, so copies are never expanded into pairs.
    Null and text without words have fingerprint 0 and link like any other; rows that repeat are rows of the same
    class; a null id keeps its row, and a class of null ids only has a null component_id. Empty tables give none.
    """
    prints = materialize(with_fingerprints(docs, id_col, text_col, shingle), "simhash")
    return prints.join(classes(prints, radius), "fp").select("id", "fp", "component_id")


def classes(prints: DataFrame, radius: int, count: int = 1) -> DataFrame:
    """prints(id, fp, fps) -> (fp, component_id, root), one row for each distinct fingerprint."""
    nodes = prints.groupBy("fp").agg(F.min("id").alias("least"), F.first("fps").alias("fps"))
    roots = components(links(nodes.select("fp", "fps"), radius, count))
    rooted = nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    rooted = materialize(rooted, "simhash-roots")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return materialize(rooted.join(least, "root").select("fp", "component_id", "root"), "simhash-named")


def shingles(text: str | None, size: int) -> set[int]:
    """Hashes of the different shingles of a text; fewer words: the whole sequence is one."""
    found = (text or "").encode().lower().split()
    digest = xxhash.xxh64_intdigest
    return {digest(b" ".join(found[i : i + size]), 42) for i in range(max(1, len(found) - size + 1))} if found else set()


def alike(asked: DataFrame, texts: DataFrame, shingle: int, least: float) -> DataFrame:
    """asked(a, b, ...) whose texts(fp, text) have a Jaccard similarity of their sets of shingles of at least `least`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3), strict=True):
                one, other = shingles(x.as_py(), shingle), shingles(y.as_py(), shingle)
                both = len(one & other)
                ok.append(both >= least * (len(one) + len(other) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda c: texts.select(F.col("fp").alias(c), F.col("text").alias(f"text_{c}"))
    return asked.select("a", "b").join(side("a"), "a").join(side("b"), "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a bigint, b bigint")


#: Texts to be compared are found by broadcast where so few are asked for, else by a join that deals out all texts.
MOST_ASKED = 500_000


def verified_classes(prints: DataFrame, rows: DataFrame, id_: str, text: str, radius: int, shingle: int, count: int, least: float) -> DataFrame:
    """prints(id, fp, fps, th) of rows -> (fp, root): classes by links of fingerprints that leave no doubt, joined where the shingles
    of the nearest texts of two of them are as similar as asked for."""
    most, sure = bit_bounds(least, count)
    nodes = prints.groupBy("fp").agg(F.first("fps").alias("fps"))
    edges = materialize(links(nodes, radius, count, most, sure).groupBy("a", "b").agg(F.min("bits").alias("bits")), "simhash-links")
    roots = components(edges.filter("bits = 0").select("a", "b"))
    named = lambda c: roots.select(F.col("node").alias(c), F.col("root").alias(f"root_{c}"))
    doubt = edges.filter("bits > 0").join(named("a"), "a", "left").join(named("b"), "b", "left")
    doubt = doubt.withColumns({"root_a": F.coalesce("root_a", "a"), "root_b": F.coalesce("root_b", "b")}).filter("root_a != root_b")
    doubt = doubt.groupBy(F.least("root_a", "root_b").alias("x"), F.greatest("root_a", "root_b").alias("y")).agg(F.min(F.struct("bits", "a", "b")).alias("e"))
    doubt = materialize(doubt.select("x", "y", "e.a", "e.b"), "simhash-doubt")
    asked = materialize(doubt.select(F.explode(F.array("a", "b")).alias("fp")).distinct(), "simhash-asked")
    place = F.struct(F.col("id").isNull(), "id", "th")
    # of a fingerprint that many rows have, partial aggregates are dealt out where few are asked for
    asked = materialize(prints.join(broadcast_if(asked, MOST_ASKED), "fp").groupBy("fp").agg(F.min(place).alias("k")).select("fp", F.col("k.id").alias("asked_id"), F.col("k.th").alias("asked_th")), "simhash-named")
    same = F.col(id_).eqNullSafe(F.col("asked_id")) & (F.xxhash64(text) == F.col("asked_th"))
    texts = materialize(rows.join(broadcast_if(asked, MOST_ASKED), same).select("fp", F.col(text).alias("text")).dropDuplicates(["fp"]), "simhash-texts")
    near = doubt.join(alike(doubt, texts, shingle, least), ["a", "b"])
    joined = components(near.select(F.col("x").alias("a"), F.col("y").alias("b")))
    own = nodes.select("fp").join(roots, nodes.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("part"))
    done = own.join(joined, own.part == joined.node, "left").select("fp", F.coalesce("root", "part").alias("root"))
    done = materialize(done, "simhash-classes")
    missed = components(left_apart(prints, rows, text, done, shingle, least))
    whole = done.withColumnRenamed("root", "part").join(missed, F.col("part") == missed.node, "left")
    return materialize(whole.select("fp", F.coalesce("root", "part").alias("root")), "simhash-classes")


#: Of the shingles one in so many, by hash, tells first which texts have too many of their own to be near another.
ONE_IN = 3
#: Parities of a set that bound its difference from another, and texts of one shingle that are compared with each other in a task.
PARITIES, BLOCK = 1024, 4096


def shingle_sets(texts: DataFrame, shingle: int, one_in: int = 1) -> DataFrame:
    """texts(th, root, text) -> (th, root, n, sd, odd, hs): hashes of the different shingles (of `one_in`, one), how many there are of
    all, a digest of them, and which of PARITIES remainders an odd number of them has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                found = [np.sort(np.fromiter(shingles(t.as_py(), shingle), np.uint64)) for t in part.column(2)]
                digests = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in found], np.uint64).view(np.int64)
                odd = [np.packbits(np.bincount((x % np.uint64(PARITIES)).astype(np.int64), minlength=PARITIES) & 1).tobytes() for x in found]
                sampled = [x[x % np.uint64(one_in) == 0] for x in found]
                ends = np.cumsum([0, *map(len, sampled)])
                hashes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sampled).view(np.int64)))
                columns = [pa.array([len(x) for x in found], pa.int64()), pa.array(digests), pa.array(odd, pa.binary()), hashes]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], ["th", "root", "n", "sd", "odd", "hs"])

    return texts.select("th", "root", "text").mapInArrow(run, "th bigint, root bigint, n bigint, sd bigint, odd binary, hs array<bigint>")


def near_sized(members: DataFrame, least: float) -> DataFrame:
    """members(h, low, high, own, th, n, root, odd), of blocks of the texts that share shingle h -> (a, b): pairs of texts of block `low`
    with ones of `high` in different classes, without those whose sizes or parities leave no similarity of `least`."""

    def near(one: tuple[np.ndarray, ...], other: tuple[np.ndarray, ...], same: bool) -> Iterator[pa.RecordBatch]:
        (th, n, root, odd), (th2, n2, root2, odd2) = one, other
        step = max(1, CELLS // max(1, len(th2)))
        for at in range(0, len(th), step):
            rows = slice(at, at + step)
            ok = (root[rows, None] != root2[None]) & (np.minimum(n[rows, None], n2[None]) >= least * np.maximum(n[rows, None], n2[None]) - 1e-9)
            x, y = np.nonzero(ok & (th[rows, None] < th2[None]) if same else ok)
            for k in range(0, len(x), CELLS // 16):
                i, j = x[k : k + CELLS // 16] + at, y[k : k + CELLS // 16]
                # each shingle that one of the two lacks changes one parity
                few = np.bitwise_count(odd[i] ^ odd2[j]).sum(axis=1) <= (1 - least) / (1 + least) * (n[i] + n2[j]) + 1e-9
                a, b = th[i[few]], th2[j[few]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple[int, ...] | None = None
        held: list[tuple[np.ndarray, ...]] = []

        def close() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            own, *rest = (np.concatenate(c) for c in zip(*held, strict=True))
            if at[1] == at[2]:
                yield from near(tuple(rest), tuple(rest), True)
            else:
                yield from near(tuple(c[own == at[1]] for c in rest), tuple(c[own == at[2]] for c in rest), False)

        for b in batches:
            h, low, high, own, th, n, root = (b.column(i).to_numpy(zero_copy_only=False) for i in range(7))
            odd = np.frombuffer(b"".join(b.column(7).to_pylist()), np.uint64).reshape(-1, PARITIES // 64)
            cuts = np.flatnonzero((np.diff(h) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)) + 1
            for i, j in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
                if i == j:
                    continue
                if at != (h[i], low[i], high[i]):
                    yield from close()
                    held, at = [], (h[i], low[i], high[i])
                held.append(tuple(c[i:j] for c in (own, th, n, root, odd)))
        yield from close()

    dealt = members.select("h", "low", "high", "own", "th", "n", "root", "odd").repartition("h", "low", "high").sortWithinPartitions("h", "low", "high")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def left_apart(prints: DataFrame, rows: DataFrame, text: str, found: DataFrame, shingle: int, least: float) -> DataFrame:
    """(a, b): roots of found(fp, root) between which some texts have a similarity of at least `least`; all such links, by prefixes.

    Two sets of at least so much in common share one of the rarest `spare` shingles of each, in any order common to all. So a text with as
    many of its own is near none: of most texts a sample of the shingles shows that, as a shingle is in it for all texts or for none. The others
    meet by the rarest shingles that they share; pairs whose sizes and parities allow it are compared in full.
    """
    spare = lambda n: F.col(n) - F.ceil(F.lit(least) * F.col(n) - F.lit(1e-9)) + 1
    named = rows.select(F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    seen = shingle_sets(named.withColumn("root", F.lit(0).cast("long")), shingle, ONE_IN).select("th", "n", F.explode("hs").alias("h")).repartition("h")
    alone = seen.groupBy("h").agg(F.min("th").alias("th"), F.max("th").alias("other"), F.min("n").alias("n")).filter("th = other")
    lone = alone.groupBy("th").agg(F.count("*").alias("own"), F.min("n").alias("n")).filter(F.col("own") >= spare("n")).select("th")
    of = prints.join(found.select("fp", "root"), "fp").groupBy("th").agg(F.min("root").alias("root"))
    left = materialize(of.join(lone, "th", "left_anti"), "simhash-left")
    sets = shingle_sets(named.join(broadcast_if(left, MOST_ASKED), "th"), shingle).filter("n > 0")
    sets = materialize(sets.dropDuplicates(["sd", "root"]), "simhash-sets")
    every = sets.select("th", F.explode("hs").alias("h"))
    often = every.groupBy("h").agg(F.count("*").alias("f")).filter("f > 1")
    shared = every.join(often, "h").groupBy("th").agg(F.sort_array(F.collect_list(F.struct("f", "h"))).alias("shared"))
    first = sets.select("th", "n", "root", "odd").join(shared, "th").withColumn("take", (spare("n") - F.col("n") + F.size("shared")).cast("int"))
    first = first.filter("take > 0").select("th", "n", "root", "odd", F.explode(F.slice("shared", F.lit(1), F.col("take"))).alias("s")).select("*", "s.*")
    parts = F.ceil(F.col("f") / BLOCK)
    first = first.withColumn("own", F.pmod(F.xxhash64("th"), parts)).withColumn("with", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    pairs_ = near_sized(first.withColumns({"low": F.least("own", "with"), "high": F.greatest("own", "with")}), least)
    asked = materialize(pairs_.distinct(), "simhash-asked")
    side = lambda c: sets.select(F.col("th").alias(c), F.col("n").alias(f"n_{c}"), F.col("root").alias(f"root_{c}"), F.col("hs").alias(f"hs_{c}"))
    both = F.size(F.array_intersect("hs_a", "hs_b"))
    met = asked.join(side("a"), "a").join(side("b"), "b").withColumn("both", both)
    return met.filter(F.col("both") >= F.lit(least) * (F.col("n_a") + F.col("n_b") - F.col("both"))).select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 8, shingle: int = 5, count: int = 5, least: float | None = 0.8) -> DataFrame:
    """The rows of docs with one of each near-duplicate class left, columns unchanged, whatever their names: the row of
    the smallest id.

    Texts have `count` fingerprints of their shingles. Two are candidates if some fingerprint is at most `radius` bits apart and
    all together differ in at most as many bits as texts of similarity `least` seldom exceed. They link if those are so
    few that the similarity is beyond doubt, or if the sets of shingles are as similar as `least`; between two classes the pair of
    fewest bits is compared first. Then classes link wherever any texts of theirs are as similar as `least`, whatever their fingerprints, so
    that no such pair is left out. With least = None fingerprints alone decide. Null ids come last; rows of one id go by the text's hash; of rows that repeat id and text the one
    whose columns come first as JSON stays. Null texts and texts without a word are of one class.
    """
    rows, (id_, text) = apart(docs, id_col, text_col)
    hashes = F.xxhash64(text)
    prints = materialize(with_fingerprints(rows.withColumn("th", hashes), id_, text, shingle, ["th"], count), "simhash")
    order = F.struct(F.col("id").isNull(), "id", "th")
    found = classes(prints, radius, count) if least is None else verified_classes(prints, rows, id_, text, radius, shingle, count, least)
    first = prints.join(found.select("fp", "root"), "fp").groupBy("root").agg(F.min(order).alias("k"))
    first = materialize(first.select(F.col("k.id").alias("kept_id"), F.col("k.th").alias("kept_th")), "simhash-kept")
    kept = rows.join(first, F.col(id_).eqNullSafe(F.col("kept_id")) & (hashes == F.col("kept_th")), "left_semi")
    repeated = prints.groupBy("id", "th").count().filter("count > 1").select(F.col("id").alias("again_id"), F.col("th").alias("again_th"))
    if not repeated.isEmpty():
        again = F.col(id_).eqNullSafe(F.col("again_id")) & (hashes == F.col("again_th"))
        place = F.row_number().over(W.partitionBy(id_, hashes).orderBy(F.to_json(F.struct(*rows.columns))))
        one = kept.join(repeated, again, "left_semi").withColumn("place", place).filter("place = 1").drop("place")
        kept = kept.join(repeated, again, "left_anti").unionByName(one)
    return kept.toDF(*docs.columns)
