"""BAM files as tables of alignments."""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .ragged import places, strings

UNMAPPED, SECONDARY = 0x4, 0x100
BASES = "=ACMGRSVTWYHKDBN"
OPERATIONS = "MIDNSHP=X"
#: Quality codes as characters.
SHIFTED = bytes(min(q + 33, 126) for q in range(256))
#: What a block of a blocked gzip file starts with.
MAGIC = b"\x1f\x8b\x08\x04"
SCHEMA = "file string, ord bigint, name string, chrom string, pos bigint, end_pos bigint, flag int, seq string, qual string, tags map<string,string>, cigar string, mapq int, next_chrom string, next_pos bigint, tlen int, kinds map<string,string>"
ARROW = pa.schema(
    [("file", pa.string()), ("ord", pa.int64()), ("name", pa.string()), ("chrom", pa.string()), ("pos", pa.int64()), ("end_pos", pa.int64()), ("flag", pa.int32())]
    + [("seq", pa.string()), ("qual", pa.string()), ("tags", pa.map_(pa.string(), pa.string()))]
    + [("cigar", pa.string()), ("mapq", pa.int32()), ("next_chrom", pa.string()), ("next_pos", pa.int64()), ("tlen", pa.int32()), ("kinds", pa.map_(pa.string(), pa.string()))]
)
_SIZES = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}


def located(uri: str) -> tuple[pa.fs.FileSystem, str]:
    """Arrow's file system of a path that Spark names, and the path in it."""
    uri = re.sub(r"^file:/(?!/)", "file:///", uri)
    return pa.fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))


def opened(uri: str) -> pa.NativeFile:
    """A file by the path that Spark lists it under, for reading at any place."""
    system, path = located(uri)
    return system.open_input_file(path)


def block_size(head: bytes) -> int | None:
    """Size of the block that starts with these bytes, from its extra field; None where no block of a known size starts."""
    if len(head) < 18 or not head.startswith(MAGIC):
        return None
    at, end = 12, 12 + struct.unpack_from("<H", head, 10)[0]
    while at + 4 <= min(end, len(head)):
        kind, size = head[at : at + 2], struct.unpack_from("<H", head, at + 2)[0]
        if kind == b"BC" and size == 2 and at + 6 <= len(head):
            return struct.unpack_from("<H", head, at + 4)[0] + 1
        at += 4 + size
    return None


def first_block(f: pa.NativeFile, at: int, size: int) -> int:
    """Place of the first block that starts at `at` or after it; the file's size where none does."""
    if at == 0:
        return 0
    window = f.read_at(min(size - at, 3 << 16), at)
    i = window.find(MAGIC)
    while i >= 0:
        own = block_size(window[i : i + 512])
        if own and (at + i + own == size or block_size(f.read_at(512, at + i + own))):
            return at + i
        i = window.find(MAGIC, i + 1)
    return size


def blocks(f: pa.NativeFile, at: int, size: int) -> Iterator[tuple[int, bytes]]:
    """(place, inflated bytes) of the blocks from `at` on, read a few megabytes at a time."""
    held, start = b"", at
    while at < size:
        if at - start + (1 << 16) > len(held):
            start, held = at, f.read_at(min(size - at, 1 << 22), at)
        own = block_size(held[at - start : at - start + 512])
        if own is None:
            raise ValueError(f"no block at {at}")
        extra = struct.unpack_from("<H", held, at - start + 10)[0]
        yield at, zlib.decompress(memoryview(held)[at - start + 12 + extra : at - start + own - 8], -15)
        at += own


def members(f: pa.NativeFile) -> Iterator[tuple[int, bytes]]:
    """The same of a file of gzip members without their sizes, which can only be read from its start."""
    size, at, rest, number = f.size(), 0, b"", 0

    def more() -> bytes:
        nonlocal at
        out = f.read_at(min(size - at, 1 << 20), at) if at < size else b""
        at += len(out)
        return out

    while rest := rest or more():
        d, out = zlib.decompressobj(31), []
        while rest and not d.eof:
            out.append(d.decompress(rest))
            rest = d.unused_data if d.eof else more()
        yield number, b"".join(out)
        number += 1


class Stream:
    """Bytes on demand from blocks, so that a file is never inflated whole."""

    def __init__(self, source: Iterator[tuple[int, bytes]]) -> None:
        self.source, self.block, self.data, self.at, self.ended = source, 0, b"", 0, False

    def place(self) -> tuple[int, int] | None:
        """Block and place in it of the next byte, None at the end."""
        while self.at >= len(self.data):
            found = next(self.source, None)
            if found is None:
                return None
            self.block, self.data, self.at = *found, 0
        return self.block, self.at

    def take(self, n: int) -> bytes:
        out = self.data[self.at : self.at + n]
        self.at += len(out)
        if len(out) == n:
            return out
        parts, n = [out], n - len(out)
        while n and self.place():
            parts.append(self.data[self.at : self.at + n])
            self.at += len(parts[-1])
            n -= len(parts[-1])
        return b"".join(parts)


def tags_of(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, pa.Array, pa.Array, pa.Array]:
    """How many optional fields each record has, and of all of them name, type and value; a character field is one character, arrays are
    comma-joined and typed as in Bi. The first fields of all records are read at once, then the second ones, and so on."""
    zeros = np.flatnonzero(raw == 0)
    row, at, step = np.flatnonzero(begin < end), begin[begin < end].astype(np.int64), 0
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, pa.Array]] = []
    while len(row):
        after, codes = at.copy(), raw[at + 2]
        for code in np.unique(codes).tolist():
            some = np.flatnonzero(codes == code)
            kind, p = chr(code), at[some] + 3
            kinds = pa.array([kind]).take(pa.array(np.zeros(len(some), np.int64)))
            if kind in "ZH":
                upto = zeros[np.searchsorted(zeros, p)]
                values, after[some] = strings(raw[places(p, upto - p)], upto - p), upto + 1
            elif kind == "A":
                values, after[some] = pa.array([chr(c) for c in raw[p].tolist()]), p + 1
            elif kind == "B":
                kinds, values = [], []
                for i, a in zip(some.tolist(), p.tolist(), strict=True):
                    number = "<" + _SIZES[chr(raw[a])]
                    n = struct.unpack_from("<i", raw, a + 1)[0]
                    kinds.append(f"B{chr(raw[a])}")
                    values.append(",".join(map(str, struct.unpack_from(f"<{n}{number[1]}", raw, a + 5))))
                    after[i] = a + 5 + n * struct.calcsize(number)
                kinds, values = pa.array(kinds), pa.array(values)
            else:
                number = np.dtype("<" + _SIZES[kind])
                x = raw[p[:, None] + np.arange(number.itemsize)].view(number)[:, 0]
                values = pa.array(list(map(str, x.astype(float).tolist()))) if kind == "f" else pa.array(x).cast(pa.string())
                after[some] = p + number.itemsize
            found.append((row[some], np.full(len(some), step), at[some], kinds, values))
        left = after < end[row]
        row, at, step = row[left], after[left], step + 1
    if not found:
        return np.zeros(len(begin), np.int64), *[pa.array([], pa.string())] * 3
    rows, steps, ats = (np.concatenate(x) for x in list(zip(*found, strict=True))[:3])
    order = np.lexsort((steps, rows))
    ats = ats[order]
    kinds, values = (pa.concat_arrays([f[k] for f in found]).take(pa.array(order)) for k in (3, 4))
    two = np.full(len(ats), 2)
    return np.bincount(rows, minlength=len(begin)), strings(raw[places(ats, two)], two), kinds, values


def header(stream: Stream, file: str) -> list[str]:
    """Names of the references; the stream stands at the first record after it."""
    if stream.take(4) != b"BAM\1":
        raise ValueError(f"not a BAM file: {file}")
    stream.take(struct.unpack("<i", stream.take(4))[0])
    chroms = []
    for _ in range(struct.unpack("<i", stream.take(4))[0]):
        chroms.append(stream.take(struct.unpack("<i", stream.take(4))[0])[:-1].decode())
        stream.take(4)
    return chroms


def starts_record(data: bytes, at: int, chroms: int) -> int | None:
    """Size of what looks like a whole record at this place, with its size field; None where none can start."""
    if len(data) < at + 36:
        return None
    size, ref, pos, n_name, _, _, n_cigar, _, n_seq, next_ref, next_pos = struct.unpack_from("<iiiBBHHHiii", data, at)
    if not (-1 <= ref < chroms and -1 <= next_ref < chroms and pos >= -1 and next_pos >= -1 and n_name > 0 and n_seq >= 0):
        return None
    if size < 32 + n_name + 4 * n_cigar + (n_seq + 1) // 2 + n_seq:
        return None
    name = data[at + 36 : at + 36 + n_name]
    if len(name) < n_name or name[-1] or any(not 33 <= c <= 126 for c in name[:-1]):
        return None
    return None if any(c & 15 > 8 for c in data[at + 36 + n_name : at + 36 + n_name + 4 * n_cigar : 4]) else size + 4


#: Records in a row that must look right where reading starts inside a file.
IN_A_ROW = 8


def first_record(f: pa.NativeFile, at: int, size: int, chroms: int) -> tuple[int, int] | None:
    """Block and place in it of the first record that starts in a block at `at` or after it.

    A place is taken if records that look right follow each other from it on, so many or up to the file's end.
    """
    data, places, upto = bytearray(), [], 0
    source = blocks(f, first_block(f, at, size), size)

    def holds(n: int) -> bool:
        while len(data) < n:
            found = next(source, None)
            if found is None:
                return False
            places.append((len(data), found[0]))
            data.extend(found[1])
        return True

    while holds(upto + 1):
        here, seen = upto, 0
        while seen < IN_A_ROW and (holds(here + 512) or here < len(data)):
            step = starts_record(data, here, chroms)
            if step is None or not holds(here + step):
                break
            here, seen = here + step, seen + 1
        if seen >= IN_A_ROW or seen and here == len(data):
            start, block = max(p for p in places if p[0] <= upto)
            return block, upto - start
        upto += 1
    return None


#: The fixed fields of a record, with its size before them.
FIELDS = np.dtype(
    [("size", "<i4"), ("ref", "<i4"), ("pos", "<i4"), ("n_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_cigar", "<u2"), ("flag", "<u2")]
    + [("n_seq", "<i4"), ("next_ref", "<i4"), ("next_pos", "<i4"), ("tlen", "<i4")]
)


def operations_of(raw: bytes) -> tuple[str, int]:
    """A cigar, and how many bases of the reference it spans."""
    found = struct.unpack(f"<{len(raw) // 4}I", raw)
    return "".join(f"{c >> 4}{OPERATIONS[c & 15]}" for c in found), sum(c >> 4 for c in found if c & 15 in (0, 2, 3, 7, 8))


def decoded(file: str, raw: np.ndarray, at: np.ndarray, ords: np.ndarray, chroms: list[str]) -> pa.RecordBatch:
    """The records that start at these places, all read at once."""
    n = len(at)
    heads = raw[at[:, None] + np.arange(FIELDS.itemsize)].view(FIELDS)[:, 0]
    field = {name: heads[name].astype(np.int64) for name in FIELDS.names}
    n_seq, upto = field["n_seq"], at + 4 + field["size"]
    ops_at = at + FIELDS.itemsize + field["n_name"]
    seq_at = ops_at + 4 * field["n_cigar"]
    qual_at = seq_at + (n_seq + 1) // 2
    if (n_seq < 0).any() or (qual_at + n_seq > upto).any():
        raise ValueError(f"{file} has a record that is shorter than its fields")
    n_name = np.maximum(field["n_name"] - 1, 0)
    whole = raw.tobytes()
    cigars = [whole[a:b] for a, b in zip(ops_at.tolist(), seq_at.tolist(), strict=True)]
    known = {c: operations_of(c) for c in set(cigars)}
    span = np.array([known[c][1] for c in cigars])
    base = places(2 * seq_at, n_seq)
    seq = np.frombuffer(BASES.encode(), np.uint8)[raw[base >> 1] >> np.where(base & 1, 0, 4).astype(np.uint8) & 15]
    n_qual = np.where(raw[np.minimum(qual_at, len(raw) - 1)] == 255, 0, n_seq)
    qual = np.frombuffer(SHIFTED, np.uint8)[raw[places(qual_at, n_qual)]]
    counts, tag, kind, value = tags_of(raw, qual_at + n_seq, upto)
    offsets = pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32())

    def reference(name: str) -> pa.Array:
        known = (field[name] >= 0) & (field[name] < len(chroms))
        return pa.array([*chroms], pa.string()).take(pa.array(field[name], mask=~known))

    columns = {
        "file": pa.array([file]).take(pa.array(np.zeros(n, np.int64))), "ord": ords, "name": strings(raw[places(at + FIELDS.itemsize, n_name)], n_name), "chrom": reference("ref"), "pos": field["pos"],
        "end_pos": field["pos"] + np.maximum(span, 1), "flag": field["flag"], "seq": strings(seq, n_seq), "qual": strings(qual, n_qual), "tags": pa.MapArray.from_arrays(offsets, tag, value),
        "cigar": pa.array([known[c][0] for c in cigars]), "mapq": field["mapq"], "next_chrom": reference("next_ref"), "next_pos": field["next_pos"], "tlen": field["tlen"],
        "kinds": pa.MapArray.from_arrays(offsets, tag, kind),
    }
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, ARROW.field(name).type) for name, c in columns.items()], schema=ARROW)


#: Records of a batch at most, and inflated bytes that are read before records are looked for.
RECORDS, CHUNK = 10_000, 1 << 20


def records(file: str, at: int, upto: int) -> Iterator[pa.RecordBatch]:
    """The records that start in the blocks from `at` up to before `upto`."""
    f = opened(file)
    size = f.size()
    blocked = block_size(f.read_at(min(size, 512), 0)) is not None
    if not blocked and at > 0:
        return
    stream = Stream(blocks(f, 0, size) if blocked else members(f))
    chroms = header(stream, file)
    place = stream.place()
    source = chain([(stream.block, stream.data)], stream.source)
    if blocked and place is not None and at > place[0]:
        place = first_record(f, at, size, len(chroms))
        source = blocks(f, place[0], size) if place is not None else None
    if place is None or blocked and place[0] >= upto:
        return
    # inflated bytes, the place in them of the next record and of the first block from `upto` on; block and first byte of each block
    held, pos, limit, starts = bytearray(), place[1], None, []
    size_at = struct.Struct("<i").unpack_from

    def more() -> bool:
        nonlocal limit
        found = next(source, None)
        if found is None:
            return False
        if blocked and limit is None and found[0] >= upto:
            limit = len(held)
        starts.append((found[0], len(held)))
        held.extend(found[1])
        return True

    def places_of(at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names, first = np.array(starts, np.int64).T
        k = np.searchsorted(first, at, "right") - 1
        return names[k], at - first[k]

    while True:
        while limit is None and len(held) - pos < CHUNK and more():
            pass
        begun = []
        while len(begun) < RECORDS and (limit is None or pos < limit) and pos + 4 <= len(held):
            n = size_at(held, pos)[0]
            if n < FIELDS.itemsize - 4:
                raise ValueError(f"{file} has a record of {n} bytes")
            if pos + 4 + n > len(held):
                break
            begun.append(pos)
            pos += 4 + n
        if begun:
            first = np.array(begun, np.int64)
            block, offset = places_of(first)
            yield decoded(file, np.frombuffer(bytes(memoryview(held)[begun[0] : pos]), np.uint8), first - begun[0], block << (16 if blocked else 40) | offset, chroms)
            if pos > CHUNK and pos > len(held) // 2:
                del held[:pos]
                starts = [(b, s - pos) for b, s in starts]
                starts = starts[max(i for i, (_, s) in enumerate(starts) if s <= 0 or i == 0) :]
                limit, pos = None if limit is None else limit - pos, 0
        elif limit is not None and pos >= limit:
            break
        elif not more():
            if pos < len(held):
                raise ValueError(f"{file} ends within a record")
            break
    while pos >= len(held) and more():
        pass
    if blocked and pos < len(held):
        block, offset = places_of(np.array([pos]))
        if first_record(f, upto, size, len(chroms)) != (int(block[0]), int(offset[0])):
            raise ValueError(f"records of {file} cannot be told apart at {upto}: read it with another split size")


def primary(flag: Column) -> Column:
    """Mapped and not secondary."""
    return flag.bitwiseAND(F.lit(UNMAPPED | SECONDARY)) == 0


def read_bam(spark: SparkSession, path: str | list[str], all_records: bool = False, split: int = 1 << 24) -> DataFrame:
    """Alignments (0-based pos, exclusive end_pos), by default those that are mapped and primary; a reference that the
    header lacks gives a null chrom. `ord` grows along a file.

    A task reads `split` bytes of a file: it looks for the first block and the first record there and reads on to the
    first record of the next range, which must be where that range's task starts; files may have any size. Files whose
    blocks lack their sizes are read by one task each. Paths are opened by Arrow's file systems.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for file, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield from records(file, at, at + split)

    files = spark.read.format("binaryFile").load(path).select("path", "length")
    ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long"))).alias("at"))
    rows = ranges.repartitionByRange(max(1, ranges.count()), "path", "at").mapInArrow(run, SCHEMA)
    return rows if all_records else rows.filter(primary(F.col("flag")))


def barcode_tags(alignments: DataFrame, cb: str = "CB", umi: str = "UB", cb_qual: str = "CQ", umi_qual: str = "UQ") -> DataFrame:
    """cb, umi and their qualities from tags; alignments without the first two go."""
    tag = lambda t: F.try_element_at("tags", F.lit(t))
    return alignments.withColumns({"cb": tag(cb), "umi": tag(umi), "cb_qual": tag(cb_qual), "umi_qual": tag(umi_qual)}).filter("cb is not null and umi is not null")
