"""Writing tables of alignments as BAM: a file a task under one header, made visible together by a commit."""

from __future__ import annotations

import json
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from .bam import BASES, FIELDS, OPERATIONS, located
from .ragged import places, rows_of

#: Bytes of a block before it is deflated, the empty block that ends a file, and references that a header may list.
BLOCK = 0xFF00
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
MOST_REFERENCES = 1_000_000
#: Four-bit codes of base letters (others: N), and quality characters to codes.
CODES = bytes(BASES.find(chr(c).upper()) if chr(c).upper() in BASES else 15 for c in range(256))
GRADES = bytes(max(c - 33, 0) for c in range(256))
_PACK = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
#: Columns that may be missing.
OPTIONAL = ("end_pos", "mapq", "cigar", "next_chrom", "next_pos", "tlen", "kinds")


def packed_tag(name: str, kind: str, value: str) -> bytes:
    head = name.encode() + kind[:1].encode()
    if kind == "A":
        return head + value[:1].encode()
    if kind in ("Z", "H"):
        return head + value.encode() + b"\0"
    if kind[0] == "B":
        number = float if kind[1] == "f" else int
        found = [number(x) for x in value.split(",")] if value else []
        return head + kind[1].encode() + struct.pack(f"<i{len(found)}{_PACK[kind[1]]}", len(found), *found)
    return head + struct.pack("<" + _PACK[kind], float(value) if kind == "f" else int(value))


def operations(cigar: str | None, span: int, bases: int) -> list[int]:
    """Operations as numbers; without any, what the span and the number of bases ask for: matches, then a deletion or a clip."""
    if cigar is None:
        both = min(span, bases) if bases else span
        found = [(both, "M"), (span - both, "D"), (bases - both, "S")]
        return [n << 4 | OPERATIONS.index(op) for n, op in found if n > 0]
    return [int(n) << 4 | OPERATIONS.index(op) for n, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]


def operation_lists(cigars: pa.Array | None, asked: np.ndarray, spans: np.ndarray, bases: np.ndarray) -> tuple[list[list[int]], np.ndarray]:
    """The different lists of operations of a batch, and which of them each row has; those not asked for have none."""
    lists, which = [[]], np.zeros(len(asked), np.int64)
    given = np.zeros(len(asked), bool) if cigars is None else cigars.is_valid().to_numpy(zero_copy_only=False)
    if given.any():
        named = cigars.dictionary_encode()
        which[given] = len(lists) + pc.drop_null(named.indices).to_numpy(zero_copy_only=False)
        lists += [operations(c, 0, 0) for c in named.dictionary.to_pylist()]
    free = asked & ~given
    within("end_pos", spans[free], np.int32)
    keys, back = np.unique(spans[free] << 32 | bases[free], return_inverse=True)
    which[free] = len(lists) + back
    lists += [operations(None, k >> 32, k & 0xFFFFFFFF) for k in keys.tolist()]
    return lists, which


def within(name: str, values: np.ndarray, kind: np.dtype) -> np.ndarray:
    """The values, which must fit the field."""
    limits = np.iinfo(kind)
    if len(values) and (values.min() < limits.min or values.max() > limits.max):
        raise ValueError(f"{name} is outside {limits.min} to {limits.max}")
    return values


def region_bins(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The smallest bin of the index that holds [start, end)."""
    levels = ((14, 4681), (17, 585), (20, 73), (23, 9), (26, 1))
    return np.select([start >> shift == end - 1 >> shift for shift, _ in levels], [first + (start >> shift) for shift, first in levels], 0)


def tag_rows(tags: pa.MapArray, kinds: pa.MapArray | None) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of the tags of all rows, one after the other, and each row's size."""
    if kinds is not None and len(kinds.keys):
        rows = [b"".join(packed_tag(t, dict(k or ()).get(t, "Z"), v) for t, v in some or () if v is not None) for some, k in zip(tags.to_pylist(), kinds.to_pylist(), strict=True)]
        return np.frombuffer(b"".join(rows), np.uint8), np.array([len(r) for r in rows], np.int64)
    offsets = tags.offsets.to_numpy().astype(np.int64)
    counts = np.where(tags.is_valid().to_numpy(zero_copy_only=False), np.diff(offsets), 0)
    entries = places(offsets[:-1], counts)
    entries = pa.array(entries[pc.take(tags.items.is_valid(), pa.array(entries)).to_numpy(zero_copy_only=False).astype(bool)])
    (keys, key_at), (values, value_at) = rows_of(tags.keys.take(entries)), rows_of(tags.items.take(entries))
    n_key, n_value = np.diff(key_at), np.diff(value_at)
    ends = np.cumsum(n_key + n_value + 2)
    begin = ends - (n_key + n_value + 2)
    out = np.zeros(ends[-1] if len(ends) else 0, np.uint8)
    out[places(begin, n_key)] = keys[key_at[0] : key_at[-1]]
    out[begin + n_key] = ord("Z")
    out[places(begin + n_key + 1, n_value)] = values[value_at[0] : value_at[-1]]
    upto = np.concatenate(([0], ends))[np.searchsorted(entries.to_numpy(), np.concatenate((offsets[:-1], offsets[-1:])))]
    return out, np.diff(upto)


def letters(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One byte a letter of each row, and where the rows start; letters outside ASCII are one question mark each."""
    data, starts = rows_of(column)
    if (data[starts[0] : starts[-1]] > 127).any():
        data, starts = rows_of(pa.array([(s or "").encode("ascii", "replace") for s in column.to_pylist()], pa.binary()))
    return data[starts[0] : starts[-1]], starts - starts[0]


def encoded(batch: pa.RecordBatch, references: dict[str, int]) -> tuple[np.ndarray, np.ndarray]:
    """The batch's records, one after the other, and where each ends. All rows are laid out at once."""
    n = batch.num_rows
    column = dict(zip(batch.schema.names, batch.columns, strict=True))

    def number(name: str, missing: int) -> np.ndarray:
        return pc.fill_null(column[name], missing).to_numpy(zero_copy_only=False).astype(np.int64) if name in column else np.full(n, missing, np.int64)

    def reference(name: str) -> np.ndarray:
        if name not in column:
            return np.full(n, -1, np.int64)
        named = column[name].dictionary_encode()
        return np.array([*(references[x] for x in named.dictionary.to_pylist()), -1], np.int64)[pc.fill_null(named.indices, -1).to_numpy(zero_copy_only=False)]

    names = pc.fill_null(column["name"], "*")
    label, label_at = rows_of(pc.if_else(pc.equal(names, ""), "*", names))
    (seq, seq_at), (qual, qual_at) = letters(column["seq"]), letters(column["qual"])
    n_label, bases, graded = np.diff(label_at), np.diff(seq_at), np.diff(qual_at)
    if (wrong := np.flatnonzero((graded > 0) & (graded != bases))).size:
        raise ValueError(f"sequence and quality of unequal length: {column['name'][int(wrong[0])].as_py()}")
    ref, pos, flag, end = reference("chrom"), number("pos", -1), number("flag", 0), number("end_pos", -1)
    known = column["end_pos"].is_valid().to_numpy(zero_copy_only=False) if "end_pos" in column else np.zeros(n, bool)
    lists, which = operation_lists(column.get("cigar"), flag & 4 == 0, np.where(known & (ref >= 0), end - pos, 0), bases)
    ops = np.array([op for ops in lists for op in ops], np.uint32)
    n_ops = np.array([len(ops) for ops in lists])
    ops_at = (np.cumsum(n_ops) - n_ops)[which]
    span = np.array([sum(op >> 4 for op in ops if op & 15 in (0, 2, 3, 7, 8)) or 1 for ops in lists])[which]
    n_ops, half = n_ops[which], (bases + 1) // 2
    extra, n_extra = tag_rows(column["tags"], column.get("kinds"))

    sizes = FIELDS.itemsize + n_label + 1 + 4 * n_ops + half + bases + n_extra
    ends = np.cumsum(sizes)
    at = ends - sizes
    fixed = {
        "size": sizes - 4, "ref": ref, "pos": pos, "n_name": n_label + 1, "mapq": number("mapq", 255), "bin": region_bins(np.maximum(pos, 0), np.maximum(pos, 0) + span), "n_cigar": n_ops, "flag": flag,
        "n_seq": bases, "next_ref": reference("next_chrom"), "next_pos": number("next_pos", -1), "tlen": number("tlen", 0),
    }
    heads = np.empty(n, FIELDS)
    for name, values in fixed.items():
        heads[name] = within(name, values, FIELDS[name])
    out = np.full(ends[-1] if n else 0, 255, np.uint8)  # what is not written over is an absent quality
    out[at[:, None] + np.arange(FIELDS.itemsize)] = heads.view(np.uint8).reshape(n, FIELDS.itemsize)
    at = at + FIELDS.itemsize
    out[places(at, n_label)] = label[label_at[0] : label_at[-1]]
    at = at + n_label
    out[at] = 0
    at = at + 1
    out[places(at, 4 * n_ops)] = ops.view(np.uint8)[places(4 * ops_at, 4 * n_ops)]
    at = at + 4 * n_ops
    codes = np.zeros(2 * int(half.sum()), np.uint8)
    codes[places(2 * (np.cumsum(half) - half), bases)] = np.frombuffer(CODES, np.uint8)[seq]
    out[places(at, half)] = codes[::2] << 4 | codes[1::2]
    at = at + half
    out[places(at, graded)] = np.frombuffer(GRADES, np.uint8)[qual]
    out[places(at + bases, n_extra)] = extra
    return out, ends


def header(references: list[tuple[str, int]], lines: str, order: str) -> bytes:
    text = f"@HD\tVN:1.6\tSO:{order}\n" + "".join(f"@SQ\tSN:{name}\tLN:{length}\n" for name, length in references) + lines
    listed = b"".join(struct.pack("<i", len(name.encode()) + 1) + name.encode() + b"\0" + struct.pack("<i", length) for name, length in references)
    return b"BAM\1" + struct.pack("<i", len(text.encode())) + text.encode() + struct.pack("<i", len(references)) + listed


class Blocks:
    """A stream of blocks; a record starts a new one where it does not fit the last."""

    def __init__(self, sink: pa.NativeFile) -> None:
        self.sink, self.held = sink, bytearray()

    def add(self, record: bytes) -> None:
        if len(self.held) + len(record) > BLOCK:
            self.flush()
        self.held += record
        while len(self.held) > BLOCK:
            self.flush()

    def add_all(self, records: np.ndarray, ends: np.ndarray) -> None:
        """add() for each of the records that end there."""
        at, whole = 0, records.data
        while at < len(whole):
            fit = int(np.searchsorted(ends, at + BLOCK - len(self.held), "right"))
            upto = int(ends[fit - 1]) if fit else 0
            if upto <= at:
                upto = int(ends[fit])
                self.add(whole[at:upto])
            else:
                self.held += whole[at:upto]
            at = upto

    def flush(self) -> None:
        data = bytes(self.held[:BLOCK])
        del self.held[:BLOCK]
        if data:
            deflate = zlib.compressobj(6, zlib.DEFLATED, -15)
            body = deflate.compress(data) + deflate.flush()
            self.sink.write(END[:16] + struct.pack("<H", len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data)))

    def close(self) -> None:
        while self.held:
            self.flush()
        self.sink.write(END)
        self.sink.close()


@dataclass
class Written(WriterCommitMessage):
    file: str | None


class BamWriter(DataSourceArrowWriter):
    """Tasks write under `_writing-<job>`, which readers of the folder pass over; the commit moves the files that tasks reported, so a
    task that failed, was killed or ran twice leaves nothing in the result."""

    def __init__(self, options: dict[str, str]) -> None:
        self.path, self.head = options["path"].rstrip("/"), (json.loads(options["references"]), options.get("lines", ""), options.get("order", "unsorted"))
        self.job = f"{self.path}/_writing-{uuid.uuid4().hex}"

    def begun(self, name: str) -> Blocks:
        system, folder = located(self.job)
        system.create_dir(folder)
        out = Blocks(system.open_output_stream(f"{folder}/{name}"))
        out.add(header(*self.head))
        out.flush()
        return out

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        references = {name: i for i, (name, _) in enumerate(self.head[0])}
        name, out = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.bam", None
        for batch in iterator:
            if batch.num_rows:
                out = out or self.begun(name)
                out.add_all(*encoded(batch, references))
        if out:
            out.close()
        return Written(name if out else None)

    def commit(self, messages: list[Written | None]) -> None:
        system, folder = located(self.job)
        files = [m.file for m in messages if m and m.file]
        if not files:  # an empty table is a file without records
            self.begun("part-00000.bam").close()
            files = ["part-00000.bam"]
        target = located(self.path)[1]
        for file in files:
            system.move(f"{folder}/{file}", f"{target}/{file}")
        system.delete_dir(folder)
        system.open_output_stream(f"{target}/_SUCCESS").close()

    def abort(self, messages: list[Written | None]) -> None:
        system, folder = located(self.job)
        if system.get_file_info(folder).type == pa.fs.FileType.Directory:
            system.delete_dir(folder)


class BamSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "alignments_bam"

    def writer(self, schema: StructType, overwrite: bool) -> BamWriter:
        return BamWriter(dict(self.options))


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system named, as Spark itself reads it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(folder).toString()


def references_of(rows: DataFrame) -> list[tuple[str, int]]:
    """References by name with the greatest end seen; a catalogue, counted to be of bounded size."""
    end = F.coalesce("end_pos", F.col("pos") + 1) if "end_pos" in rows.columns else F.col("pos") + 1
    named = rows.select("chrom", end.alias("end"))
    if "next_chrom" in rows.columns:
        named = named.unionByName(rows.select(F.col("next_chrom").alias("chrom"), (F.col("next_pos") + 1).alias("end")))
    found = named.filter("chrom is not null").groupBy("chrom").agg(F.max("end").alias("end")).orderBy("chrom").limit(MOST_REFERENCES + 1).collect()
    if len(found) > MOST_REFERENCES:
        raise ValueError(f"over {MOST_REFERENCES} references")
    return [(r["chrom"], max(1, r["end"] or 1)) for r in found]


def write_bam(rows: DataFrame, path: str, references: list[tuple[str, int]] | None = None, lines: str = "", sort: bool = False) -> None:
    """Write alignments (name, chrom, pos, flag, seq, qual, tags and those of OPTIONAL that there are) as BAM files in a new folder.

    All files have one header: the references (default: those of the rows, by name) and `lines` after them. Tags are strings unless
    `kinds` gives their type, as read_bam() does; without a cigar, the span and the number of bases decide. Letters other than bases
    become N; a null name is *, a null reference or place is none, an empty quality is absent. sort: by reference and place, over
    the files in order of their names; rows are dealt by ranges. The folder must not exist; it has no file before the commit.
    """
    spark = rows.sparkSession
    path = qualified(spark, path)
    system, folder = located(path)
    if system.get_file_info(folder).type != pa.fs.FileType.NotFound:
        raise FileExistsError(path)
    references = references_of(rows) if references is None else references
    if sort:
        places = spark.createDataFrame([(name, i) for i, (name, _) in enumerate(references)], "chrom string, _place int")
        rows = rows.join(F.broadcast(places), "chrom", "left")  # at most MOST_REFERENCES
        ordered = [F.col("_place").asc_nulls_last(), F.col("pos"), F.col("name"), F.col("flag")]
        rows = rows.repartitionByRange(*ordered).sortWithinPartitions(*ordered)
    spark.dataSource.register(BamSink)
    named = {"references": json.dumps(references), "lines": lines, "order": "coordinate" if sort else "unsorted"}
    rows.select("name", "chrom", "pos", "flag", "seq", "qual", "tags", *[c for c in OPTIONAL if c in rows.columns]).write.format(BamSink.name()).mode("append").options(**named).save(path)
