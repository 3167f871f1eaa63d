"""Half-open intervals by label: coalescing, disjoint segments, lookups by binned equi-joins, and genes of alignments."""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .tables import broadcast_if, stored

EXON, INTRON, NOT_ANNOTATED = 2, 4, 1
#: Positions a bin holds: an interval has a row for each bin it meets, a point looks in one.
BIN = 1 << 14
#: Points that a task looks up: of more than the set number of tasks can take, there are more tasks.
POINTS_A_TASK = 250_000


def coalesce(intervals: DataFrame, keys: list[str]) -> DataFrame:
    """Overlapping and touching intervals of a key merged: keys, start_pos, end_pos."""
    order = W.partitionBy(*keys).orderBy("start_pos", "end_pos")
    reach = F.max("end_pos").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = intervals.withColumn("_new", F.when(reach.isNull() | (F.col("start_pos") > reach), 1).otherwise(0))
    numbered = opens.withColumn("_group", F.sum("_new").over(order))
    return numbered.groupBy(*keys, "_group").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("_group")


def segments(intervals: DataFrame, label: str, group: str = "chrom", ranges: int | None = None) -> DataFrame:
    """Disjoint segments of a group with the set of labels that cover each: group, start_pos, end_pos, labels.

    A sweep over ranges of positions: breakpoints are dealt by ranges of (group, position), each of which starts at a
    breakpoint; an interval goes to every range it meets, opening there where it starts or, carried on, where the range does.
    A task sweeps its ranges in order and holds only the labels that are open, so a group of any size is spread over tasks.
    Intervals that end where they start or before cover nothing; null bounds, labels and groups too.
    """
    spark = intervals.sparkSession
    rows = intervals.select(F.col(group).alias("_g"), F.col("start_pos").cast("long").alias("a"), F.col("end_pos").cast("long").alias("b"), F.col(label).alias("_l"))
    rows = stored(rows.filter("a < b and _l is not null and _g is not null"))
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = rows.join(broadcast_if(stored(range_starts(rows, n)), 100_000), "_g")
    number = lambda x: F.size(F.filter("starts", lambda s: s <= x)) - 1
    met = met.select("_g", "a", "b", "_l", "starts", F.explode(F.sequence(number(F.col("a")), number(F.col("b") - 1))).alias("range"))
    bound = lambda k: F.get("starts", k)
    opened = F.greatest("a", bound(F.col("range"))).alias("a")
    closed = F.least("b", F.coalesce(bound(F.col("range") + 1), F.col("b"))).alias("b")
    label_type, group_type = (intervals.schema[c].dataType.simpleString() for c in (label, group))
    parts = met.select("_g", "range", opened, closed, "_l")
    ends = F.array(F.struct(F.col("a").alias("at"), F.lit(1).alias("step")), F.struct(F.col("b").alias("at"), F.lit(-1).alias("step")))
    events = parts.select("_g", "range", F.explode(ends).alias("e"), "_l").groupBy("_g", "range", "e.at", "_l").agg(F.sum("e.step").alias("step"))
    events = events.select("_g", "range", "at", "_l", "step").repartition("_g", "range").sortWithinPartitions("_g", "range", "at")
    return events.mapInArrow(swept, f"_g {group_type}, start_pos bigint, end_pos bigint, labels array<{label_type}>").withColumnRenamed("_g", group)


def range_starts(rows: DataFrame, ranges: int) -> DataFrame:
    """_g, starts: where the ranges of each group start, in order; all groups together have at most `ranges` and one more each."""
    dealt = rows.select("_g", F.col("a").alias("at")).repartitionByRange(ranges, "_g", "at")
    firsts = dealt.groupBy(F.spark_partition_id().alias("part"), "_g").agg(F.min("at").alias("first"))
    return firsts.groupBy("_g").agg(F.sort_array(F.collect_list("first")).alias("starts"))


def swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Events (group, range, position, label, step), in order -> (group, start, end, labels) of the covered segments; all
    intervals of a range open and close in it. Steps that cancel out still are breakpoints."""
    open_labels: dict = {}
    last = None
    for batch in batches:
        group, start, end, labels = [], [], [], []
        for g, r, at, label, step in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if last is not None and last[:2] == (g, r) and last[2] < at and open_labels:
                group.append(g), start.append(last[2]), end.append(at), labels.append(sorted(open_labels))
            last = g, r, at
            held = open_labels.get(label, 0) + step
            if held:
                open_labels[label] = held
            else:
                open_labels.pop(label, None)
        kind = batch.schema
        yield pa.RecordBatch.from_arrays(
            [pa.array(group, kind.field(0).type), pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(labels, pa.list_(kind.field(3).type))], ["_g", "start_pos", "end_pos", "labels"]
        )


def binned(intervals: DataFrame, start: str, end: str, width: int = BIN) -> DataFrame:
    first, last = F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width)
    return intervals.filter(F.col(end) > F.col(start)).withColumn("_bin", F.explode(F.sequence(first, last)))


def lookup(points: DataFrame, intervals: DataFrame, at: str, start: str, end: str, group: str = "chrom", width: int = BIN, how: str = "inner", also: Column | None = None) -> DataFrame:
    """Each point with the intervals of its group that hold it: an equi-join on group and bin (and what `also` equates),
    then the bounds."""
    inside = (F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))
    left = points.withColumn("_point_bin", F.floor(F.col(at) / width))
    right = binned(intervals, start, end, width).withColumnRenamed(group, "_group")
    on = (F.col(group) == F.col("_group")) & (F.col("_point_bin") == F.col("_bin")) & inside
    on = on if also is None else on & also
    return left.join(right, on, how).drop("_group", "_bin", "_point_bin")


def transcript_extents(annotation: DataFrame) -> DataFrame:
    """chrom, transcript_id, gene_name, start_pos, end_pos; a transcript of two genes raises."""
    return extents_with_introns(annotation).drop("introns")


def extents_with_introns(annotation: DataFrame) -> DataFrame:
    """transcript_extents() with `introns`: whether any are listed for the transcript."""
    extents = annotation.groupBy("chrom", "transcript_id").agg(
        F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.count_distinct("gene_name").alias("_n"), F.min("gene_name").alias("gene_name"),
        F.max(F.col("kind") == "intron").alias("introns") if "kind" in annotation.columns else F.lit(False).alias("introns"),
    )
    wrong = F.raise_error(F.concat(F.lit("transcript of two genes: "), F.col("transcript_id"))).cast("string")
    return extents.withColumn("gene_name", F.when(F.col("_n") > 1, wrong).otherwise(F.col("gene_name"))).drop("_n")


def bin_width(intervals: DataFrame, start: str, end: str) -> int:
    """A bin as wide as intervals are on average: so these have at most three rows each on average, whatever their lengths, and a bin
    holds few that a point in it misses."""
    mean = intervals.filter(F.col(end) > F.col(start)).agg(F.avg(F.col(end) - F.col(start))).first()[0]
    return max(1, math.ceil(mean or 1))


def dealt(rows: DataFrame, points: int, *keys: str) -> DataFrame:
    """rows by their keys over as many tasks as so many points ask for, where those are more than is set."""
    tasks = math.ceil(points / POINTS_A_TASK)
    return rows.repartition(tasks, *keys) if tasks > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows


def hits(points: DataFrame, annotation: DataFrame, at: str = "at") -> tuple[DataFrame, int]:
    """genes_at(), where several transcripts of a gene may give the same row, and the number of points.

    Transcripts carry their parts to the bins that they meet, so points are joined, and so dealt out, once.
    """
    listed = F.when(F.col("transcript_id").isNotNull() & (F.col("end_pos") > F.col("start_pos")), F.struct(F.col("start_pos").alias("a"), F.col("end_pos").alias("b"), "kind"))
    parts = annotation.groupBy("chrom", "transcript_id").agg(F.collect_list(listed).alias("parts"))
    extents = extents_with_introns(annotation).select("chrom", "transcript_id", "gene_name", "introns", F.col("start_pos").alias("ta"), F.col("end_pos").alias("tb"))
    whole = stored(extents.join(parts.withColumnsRenamed({"chrom": "_c", "transcript_id": "_t"}), F.col("chrom").eqNullSafe(F.col("_c")) & F.col("transcript_id").eqNullSafe(F.col("_t"))).select(*extents.columns, "parts"))
    width = bin_width(whole, "ta", "tb")
    low = F.col("_bin") * width
    near = binned(whole, "ta", "tb", width).withColumn("parts", F.filter("parts", lambda x: (x["b"] > low) & (x["a"] < low + width)))
    near = near.select(F.col("chrom").alias("_group"), "_bin", "gene_name", "introns", "ta", "tb", "parts")
    left = stored(points.select("id", "chrom", F.col(at).alias("at"), F.floor(F.col(at) / width).alias("_point_bin")))
    n = left.count()
    left = dealt(left, n, "chrom", "_point_bin")
    inside = (F.col("at") >= F.col("ta")) & (F.col("at") < F.col("tb"))
    # transcripts may be many: the planner's guess of their number is no reason to broadcast them
    held = left.hint("merge").join(near, (F.col("chrom") == F.col("_group")) & (F.col("_point_bin") == F.col("_bin")) & inside)
    code = lambda kind: F.when(kind == "intron", INTRON).when(kind.isNotNull(), EXON).when(~F.col("introns"), INTRON)
    met = F.transform(F.filter("parts", lambda x: (x["a"] <= F.col("at")) & (F.col("at") < x["b"])), lambda x: x["kind"])
    kinds = F.array_compact(F.array_distinct(F.transform(F.when(F.size(met) > 0, met).otherwise(F.array(F.lit(None).cast("string"))), code)))
    return held.select("id", F.col("gene_name").alias("gene"), F.explode(kinds).alias("kind")), n


def genes_at(points: DataFrame, annotation: DataFrame, at: str = "at") -> DataFrame:
    """id, gene, kind for each point (id, chrom, at): the genes of the transcripts that hold it, EXON or INTRON.

    A transcript that holds a point with neither an exon nor a listed intron there counts as INTRON where no introns are
    listed for it.
    """
    found, n = hits(points, annotation, at)
    return dealt(found, n, "id").distinct()


def resolve(first: Column, last: Column) -> Column:
    """struct(gene, mark) of an alignment from the sets of (gene, kind) at its first and last base.

    Both empty: no gene. One each: the gene if they agree, marks joined. One and none: the gene, partly not annotated.
    None and several: no gene. Else by exons alone: one gene with exons on each side, the same one.
    """
    n1, n2 = F.size(first), F.size(last)
    pair = lambda gene, mark: F.struct(gene.alias("gene"), mark.cast("int").alias("mark"))
    none = pair(F.lit(None).cast("string"), F.lit(0))
    a, b = F.get(first, F.lit(0)), F.get(last, F.lit(0))
    one = F.coalesce(a, b)
    exons = lambda side: F.array_distinct(F.transform(F.filter(side, lambda h: h["kind"] == EXON), lambda h: h["gene"]))
    e1, e2 = exons(first), exons(last)
    agreed = (F.size(e1) == 1) & (F.size(e2) == 1) & (F.get(e1, F.lit(0)) == F.get(e2, F.lit(0)))
    return (
        F.when((n1 == 0) & (n2 == 0), none)
        .when((n1 == 1) & (n2 == 1), F.when(a["gene"] == b["gene"], pair(a["gene"], a["kind"].bitwiseOR(b["kind"]))).otherwise(none))
        .when((n1 <= 1) & (n2 <= 1), pair(one["gene"], one["kind"].bitwiseOR(F.lit(NOT_ANNOTATED))))
        .when((n1 == 0) | (n2 == 0), none)
        .when(agreed, pair(F.get(e1, F.lit(0)), F.lit(EXON)))
        .otherwise(none)
    )


def annotate(alignments: DataFrame, annotation: DataFrame) -> DataFrame:
    """alignments(id, chrom, pos, end_pos, ...) with gene and mark; those on chromosomes without annotation are left out."""
    known = annotation.select("chrom").distinct()
    rows = alignments.join(known, "chrom", "left_semi")
    ends = rows.select("id", "chrom", F.explode(F.array(F.struct(F.lit(1).alias("side"), F.col("pos").alias("at")), F.struct(F.lit(2).alias("side"), (F.col("end_pos") - 1).alias("at")))).alias("e"))
    points = ends.select(F.struct("id", "e.side").alias("id"), "chrom", F.col("e.at").alias("at"))
    side = lambda k: F.collect_set(F.when(F.col("id.side") == k, F.struct("gene", "kind")))
    found, n = hits(points, annotation)
    found = dealt(found.withColumn("_id", F.col("id.id")), n, "_id")
    sets = found.groupBy("_id").agg(side(1).alias("s1"), side(2).alias("s2"))
    empty = F.array().cast("array<struct<gene:string,kind:int>>")
    joined = rows.join(sets, rows["id"] == sets["_id"], "left")
    found = joined.withColumn("_r", resolve(F.coalesce("s1", empty), F.coalesce("s2", empty)))
    return found.withColumns({"gene": F.col("_r.gene"), "mark": F.col("_r.mark")}).drop("_r", "_id", "s1", "s2")
