"""FASTQ files of one run in lock-step, without a shuffle: each task reads the same records of every file, by an index of line counts."""

from __future__ import annotations

import json
import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from tallywright.operators.tables import fresh

from .bam import block_size, blocks, first_block, located, opened
from .bam_writer import qualified

#: Bytes of a file that a task counts or reads, by default; records in a batch; bytes read at a time.
SPLIT, RECORDS, CHUNK = 64 << 20, 10_000, 4 << 20
INDEX = "file int, at bigint, lines bigint, last bigint"
ENDED = "a file ended prematurely, or files differ in their numbers of records"


def kind_of(f: pa.NativeFile) -> str:
    """text; blocks: gzip in blocks of stated size, readable from any of them; members: gzip, readable from its members' starts."""
    head = f.read_at(min(f.size(), 512), 0)
    return "blocks" if block_size(head) else "members" if head.startswith(b"\x1f\x8b") else "text"


def members(f: pa.NativeFile, at: int) -> Iterator[tuple[int, bytes]]:
    """(where its member starts, inflated bytes) of gzip members from the one at `at` on, a few megabytes at a time."""
    size, start, d = f.size(), at, zlib.decompressobj(31)
    while at < size:
        raw = f.read_at(min(size - at, CHUNK), at)
        at += len(raw)
        while raw:
            yield start, d.decompress(raw)
            raw = b""
            if d.eof:
                raw = d.unused_data
                start, d = at - len(raw), zlib.decompressobj(31)


def inflated(f: pa.NativeFile, at: int) -> Iterator[tuple[int, bytes]]:
    """(a place that reading can start at, bytes from there) of a file from such a place on."""
    kind, size = kind_of(f), f.size()
    if kind == "blocks":
        yield from blocks(f, at, size)
    elif kind == "members":
        yield from members(f, at)
    else:
        for here in range(at, size, CHUNK):
            yield here, f.read_at(min(size - here, CHUNK), here)


def counted(number: int, uri: str, at: int, upto: int, split: int) -> Iterator[dict]:
    """Line ends of a file from the first place at `at` or after it up to the first at `upto` or after it: a row for each
    `split` bytes at most where the file can be read from their start. last: the last byte, -1 where none."""
    f = opened(uri)
    size, kind = f.size(), kind_of(f)
    if kind == "members" and at > 0:
        return  # the task of the file's start counts all of it
    at = first_block(f, at, size) if kind == "blocks" else at
    row = {"file": number, "at": at, "lines": 0, "last": -1}
    for place, data in inflated(f, at):
        if kind != "members" and place >= upto:
            break
        data = data[: upto - place] if kind == "text" else data
        if kind == "members" and place - row["at"] >= split:
            yield row
            row = {"file": number, "at": place, "lines": 0, "last": -1}
        row["lines"] += data.count(b"\n")
        row["last"] = data[-1] if data else row["last"]
    if at < min(upto, size):
        yield row


def write_index(spark: SparkSession, paths: list[str], split: int, folder: str) -> None:
    """INDEX rows of the files as a table in a folder, counted by many tasks: one a range of plain or blocked files, one a file of other gzip."""
    sizes = [located(p)[0].get_file_info(located(p)[1]).size for p in paths]
    if None in sizes:
        raise FileNotFoundError(str(paths))
    ranges = spark.createDataFrame(list(enumerate(zip(paths, sizes, strict=True))), "file int, f struct<path: string, size: bigint>")
    ranges = ranges.filter("f.size > 0").select("file", "f.path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("f.size") - 1, F.lit(split).cast("long"))).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.int32()), ("at", pa.int64()), ("lines", pa.int64()), ("last", pa.int64())])
        for b in batches:
            for number, path, at in zip(*(c.to_pylist() for c in b.columns), strict=True):
                yield pa.RecordBatch.from_pylist(list(counted(number, path, at, at + split, split)), schema)

    n = sum(-(-s // split) for s in sizes)
    ranges.repartitionByRange(max(1, min(n, 10_000)), "file", "at").mapInArrow(run, INDEX).write.parquet(folder)


@dataclass
class Records(InputPartition):
    """Records first..upto - 1 of a run's files; for each file a place to read from and the lines that end before it."""

    run: int
    first: int
    upto: int
    places: list[tuple[int, int]]


def planned(run: int, index: list[list[tuple[int, int, int]]]) -> list[Records]:
    """The ranges of a run's files (place, lines, last byte) as records: a task has those whose first line starts in a range of the file with the fewest ranges.

    Raises where the files differ in their numbers of records or one ends inside a record.
    """
    places, before, totals = [], [], []
    for own in map(sorted, index):
        places.append(np.array([r[0] for r in own], np.int64))
        lines = np.array([r[1] for r in own], np.int64)
        before.append(np.cumsum(lines) - lines)
        last = next((r[2] for r in reversed(own) if r[2] >= 0), 10)
        totals.append(int(lines.sum()) + (last != 10))
    if len(set(totals)) > 1 or totals[0] % 4:
        raise ValueError(ENDED)
    base = min(range(len(index)), key=lambda k: len(places[k]))
    edges = np.unique(np.append(-(-before[base] // 4), totals[0] // 4))
    found = []
    for first, upto in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        at = [max(0, int(np.searchsorted(b, 4 * first, "left")) - 1) for b in before]
        found.append(Records(run, first, upto, [(int(p[i]), int(b[i])) for p, b, i in zip(places, before, at, strict=True)]))
    return found or [Records(run, 0, 0, [])]


def lines_from(uri: str, place: tuple[int, int], line: int) -> Iterator[list[bytes]]:
    """Lists of whole lines of a file from `line` on; `place` is one before it where reading can start, and the lines that end before that."""
    skip, rest = line - place[1], b""
    for _, data in inflated(opened(uri), place[0]):
        if skip > 0:
            ends = data.count(b"\n")
            if ends < skip:
                skip -= ends
                continue
            data = data.split(b"\n", skip)[skip]
            skip = 0
        *whole, rest = (rest + data).split(b"\n")
        yield whole
    if rest:
        yield [rest]


def in_records(chunks: Iterator[list[bytes]], n: int) -> Iterator[tuple[list[bytes], list[bytes], list[bytes]]]:
    """Ids, sequences and qualities of the next n records, RECORDS at a time."""
    held: list[bytes] = []
    while n > 0:
        size = min(n, RECORDS)
        while len(held) < 4 * size:
            more = next(chunks, None)
            if more is None:
                raise ValueError(ENDED)
            held += more
        part, held = held[: 4 * size], held[4 * size :]
        if any(x.endswith(b"\r") for x in part[:4]):
            part = [x.removesuffix(b"\r") for x in part]
        ids, seqs, quals = part[0::4], part[1::4], part[3::4]
        if not all(x.startswith(b"@") for x in ids):
            raise ValueError("record does not start with @")
        if any(len(s) != len(q) for s, q in zip(seqs, quals, strict=True)):
            raise ValueError("sequence and quality of unequal length")
        yield ids, seqs, quals
        n -= size


class LockStepReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        self.runs, self.index = json.loads(options["files"]), options["index"]

    def partitions(self) -> list[Records]:
        system, folder = located(self.index)
        files = [f.path for f in system.get_file_info(pa.fs.FileSelector(folder)) if f.path.endswith(".parquet")]
        rows = [row for f in files for row in pa.parquet.read_table(f, filesystem=system).to_pylist()]
        by_file = defaultdict(list)
        for r in rows:
            by_file[r["file"]].append((r["at"], r["lines"], r["last"]))
        width = len(self.runs[0])
        return [part for k in range(len(self.runs)) for part in planned(k, [by_file[k * width + i] for i in range(width)])]

    def read(self, partition: Records) -> Iterator[pa.RecordBatch]:
        n, names = partition.upto - partition.first, ["run", "ord", "id"]
        streams = [in_records(lines_from(f, p, 4 * partition.first), n) for f, p in zip(self.runs[partition.run], partition.places)]
        names += [f"{x}{i}" for i in range(1, len(streams) + 1) for x in ("seq", "qual")]
        at = partition.first
        for parts in zip(*streams, strict=True):
            size = len(parts[-1][0])
            columns = [pa.array([partition.run] * size, pa.int32()), pa.array(range(at, at + size), pa.int64()), pa.array(parts[-1][0], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(x, pa.string()) for p in parts for x in p[1:])], names)
            at += size


class LockStep(DataSource):
    @classmethod
    def name(cls) -> str:
        return "reads_in_lock_step"

    def schema(self) -> str:
        files = range(1, len(json.loads(self.options["files"])[0]) + 1)
        return "run int, ord bigint, id string, " + ", ".join(f"seq{i} string, qual{i} string" for i in files)

    def reader(self, schema) -> LockStepReader:
        return LockStepReader(dict(self.options))


def read_lock_step(spark: SparkSession, paths: list[str] | list[list[str]], split: int = SPLIT) -> DataFrame:
    """run, ord, id (of the last file), seq1, qual1, seq2, ...: the records of a run's 1-4 files side by side, by their numbers;
    of several runs (lanes) with as many files each, run numbers them from 0.

    The files' lines are counted once, by ranges; then a task reads a range of records from each file, from the place before it
    that the index knows, so nothing is shuffled and no record waits for another task. Plain files and gzip in blocks are cut
    anywhere, other gzip at its members; a gzip of one member gives one task. Files that differ in their numbers of records,
    that end inside a record, a header without @ and a sequence and quality of unequal length raise. A missing last line end is fine.
    """
    runs = [[paths] if isinstance(paths, str) else paths] if isinstance(paths[0], str) else paths
    if len({len(run) for run in runs}) > 1:
        raise ValueError("runs differ in their numbers of files")
    named = [[qualified(spark, p) for p in run] for run in runs]
    folder = fresh(spark)
    write_index(spark, [p for run in named for p in run], split, folder)
    spark.dataSource.register(LockStep)
    return spark.read.format(LockStep.name()).option("files", json.dumps(named)).option("index", folder).load()
