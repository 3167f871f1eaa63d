"""Removal of byte strings that occur twice or more by distributed prefix doubling over all byte positions.

Each round ranks positions by a pair of ranks: that of the position and that of the one an offset behind it. Spark sorts
the pairs over ranges, equal pairs get one rank, and a position whose pair is unique is dropped, as no longer string
from it can recur. Lengths: 64 (by 128 bits of hash), 128, then the window by two ranks that overlap.

suffix_dedup gives the same rows; op9 runs that one. What this one costs is in the README.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize
from .passages import PIECE, run_hashes

TABLES = [np.array([xxhash.xxh64_intdigest(bytes([b]), seed) for b in range(256)], np.uint64) for seed in (7, 11)]
COLUMNS = "doc bigint, pos bigint, many boolean, a bigint, b bigint"


def first_pairs(texts: DataFrame, length: int, window: int) -> DataFrame:
    """texts(doc, raw, many) -> COLUMNS: each position's string of `length` bytes as two hashes, for texts of a window or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, raw, many in zip(*(batch.column(i) for i in range(3)), strict=True):
                raw = np.frombuffer(raw.as_buffer(), np.uint8)
                if len(raw) < window:
                    continue
                for at in range(0, len(raw) - length + 1, PIECE):
                    some = raw[at : at + PIECE + length - 1]
                    a, b = (run_hashes(t[some], length).view(np.int64) for t in TABLES)
                    n = len(a)
                    same = [pa.repeat(doc, n), pa.array(np.arange(at, at + n)), pa.repeat(many, n)]
                    yield pa.RecordBatch.from_arrays([*same, pa.array(a), pa.array(b)], ["doc", "pos", "many", "a", "b"])

    return texts.select("doc", "raw", "many").mapInArrow(run, COLUMNS)


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted COLUMNS of a range -> + part, local: number of the pair in the range, twice: the range has the pair again.

    Of the rows whose pair the range has once only the first and the last are needed, for what is shared with its neighbours.
    """
    part, local, held = TaskContext.get().partitionId(), 0, None

    def done(batch: pa.RecordBatch, number: np.ndarray, twice: np.ndarray, last: bool) -> pa.RecordBatch:
        keep = twice | batch.column(2).to_numpy(zero_copy_only=False)
        keep[0] |= number[0] == 1
        keep[-1] |= last
        more = [pa.repeat(pa.scalar(part, pa.int32()), len(number)), pa.array(number), pa.array(twice)]
        return pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "part", "local", "twice"]).filter(pa.array(keep))

    end = None
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = batch.column(3).to_numpy(), batch.column(4).to_numpy()
        again = np.zeros(len(a), bool)
        again[1:] = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
        again[0] = end == (a[0], b[0])
        number = local + np.cumsum(~again)
        twice = again.copy()
        twice[:-1] |= again[1:]
        if held is not None:
            held[2][-1] |= again[0]
            yield done(*held, last=False)
        held, local, end = (batch, number, twice), int(number[-1]), (a[-1], b[-1])
    if held is not None:
        yield done(*held, last=True)


def reranked(pairs: DataFrame) -> DataFrame:
    """COLUMNS -> doc, pos, many, rank: one rank for each pair (a, b), in their order, without those that occur once.

    A pair of any number of rows is dealt over ranges like the others; what neighbouring ranges share is seen from one row a range.
    """
    order = ["a", "b", "doc", "pos"]
    pair = F.struct("a", "b")
    dealt = pairs.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(numbered, f"{COLUMNS}, part int, local bigint, twice boolean")
    dealt = materialize(dealt, "pairs")
    ranges = dealt.groupBy("part").agg(F.min(pair).alias("low"), F.max(pair).alias("high"), F.max("local").alias("n"))
    by_part = W.orderBy("part")  # one row a range
    ranges = ranges.withColumns({"ahead": F.lag("high").over(by_part), "behind": F.lead("low").over(by_part)})
    ranges = ranges.withColumn("joined", F.when(F.col("ahead") == F.col("low"), 1).otherwise(0))
    earlier = F.coalesce(F.sum(F.col("n") - F.col("joined")).over(by_part.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = materialize(ranges.select("part", "ahead", "behind", (earlier - F.col("joined")).alias("offset")), "ranges")
    found = dealt.join(F.broadcast(ranges), "part")  # one row a range: bounded by the number of partitions
    shared = [F.coalesce(F.col(side) == pair, F.lit(False)) for side in ("ahead", "behind")]
    recurs = F.col("many") | F.col("twice") | shared[0] | shared[1]
    return materialize(found.filter(recurs).select("doc", "pos", "many", (F.col("offset") + F.col("local")).alias("rank")), "ranks")


def doubled(ranks: DataFrame, offset: int) -> DataFrame:
    """COLUMNS of each position and the one `offset` behind it; a position without that is unique and goes."""
    behind = ranks.select("doc", (F.col("pos") - offset).alias("pos"), F.col("rank").alias("b"))
    return ranks.withColumnRenamed("rank", "a").join(behind, ["doc", "pos"]).select("doc", "pos", "many", "a", "b")


def recurring(texts: DataFrame, window: int = 200, first: int = 64) -> DataFrame:
    """texts(doc, raw, many) -> doc, pos, many, rank of the positions whose string of `window` bytes occurs more than once."""
    length = min(first, window)
    ranks = reranked(first_pairs(texts, length, window))
    while length < window:
        offset = min(length, window - length)
        ranks = reranked(doubled(ranks, offset))
        length += offset
    return ranks


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 200, first: int = 64) -> DataFrame:
    """suffix_dedup.remove_repeats() by prefix doubling: (id, n_bytes, n_removed, n_spans, kept), one row for each row of docs.

    Strings are judged on the input and end with their document. Null and empty texts keep nothing, shorter texts all. Rows
    that repeat a text hold each of its strings twice; the text is ranked once. Ids may be null, repeat and be of any
    type. Empty tables give no rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("raw"))
    keys = [F.xxhash64("raw").alias("h"), F.xxhash64(F.lit(1), "raw").alias("h2")]
    texts = rows.select(*keys, "raw").groupBy("h", "h2").agg(F.first("raw").alias("raw"), (F.count("*") > 1).alias("many"))
    texts = materialize(texts.withColumn("doc", F.monotonically_increasing_id()), "texts")
    found = recurring(texts, window, first)

    order = W.partitionBy("doc").orderBy("pos")
    gap = F.coalesce(F.col("pos") - F.lag("pos").over(order) > window, F.lit(True))
    numbered = found.withColumn("new", gap).withColumn("run", F.sum(F.col("new").cast("int")).over(order))
    runs = numbered.groupBy("doc", "run").agg(F.min("pos").alias("start"), (F.max("pos") + window).alias("end"))
    runs = runs.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for raw, gone in zip(batch.column(2), batch.column(3).to_pylist(), strict=True):
                raw, at, kept = raw.as_py(), 0, []
                for r in gone or []:
                    kept.append(raw[at : r["start"]])
                    at = r["end"]
                kept = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(kept), len(gone or []), kept))
            numbers = [pa.array([o[i] for o in out], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *numbers, pa.array([o[3] for o in out], pa.binary())], ["h", "h2", "n_bytes", "n_removed", "n_spans", "kept"])

    judged = texts.join(runs, "doc", "left").select("h", "h2", "raw", "runs")
    judged = judged.mapInArrow(cut, "h bigint, h2 bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return rows.select("id", *keys).join(judged, ["h", "h2"]).select("id", "n_bytes", "n_removed", "n_spans", "kept")
