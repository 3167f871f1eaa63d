"""Operators on tables whose groups have grown: no small genes, many bins, values read once."""

import random

import pytest
from pyspark.sql import functions as F

from tallywright.operators import correction, intervals, selection


def test_correction_learns_where_no_gene_is_small(spark):
    """Every gene has a molecule and two errors of it, so none has just two identifiers."""
    rnd, rows = random.Random(3), []
    for i in range(60):
        umi = "".join(rnd.choice("ACGT") for _ in range(5))
        rows.append((f"c{i % 7}", f"g{i}", umi, 40, 2, [35] * 5))
        for at in (0, 3):
            wrong = umi[:at] + "ACGT"[("ACGT".index(umi[at]) + 1) % 4] + umi[at + 1 :]
            rows.append((f"c{i % 7}", f"g{i}", wrong, 1, 2, [12 if j == at else 35 for j in range(5)]))
    m = spark.createDataFrame(rows, "cb string, gene string, umi string, reads long, mark int, qual array<int>")
    kept = correction.correct_identifiers(m, 5, "bayesian", "reads").collect()
    assert len(kept) == 60 and {r["reads"] for r in kept} == {40}
    assert correction.error_share(m) == pytest.approx(2 / 42)
    alone = m.filter("reads = 40")
    assert correction.correct_identifiers(alone, 5, "bayesian", "reads").count() == 60


@pytest.mark.parametrize("a_task", [intervals.POINTS_A_TASK, 50])
def test_genes_at_points_against_brute_force(spark, monkeypatch, a_task):
    """Long and short transcripts, with and without introns, one of empty parts and one without a name."""
    monkeypatch.setattr(intervals, "POINTS_A_TASK", a_task)
    rnd, parts = random.Random(5), []
    for t in range(60):
        at, chrom = rnd.randrange(3000), f"chr{t % 2}"
        for i in range(rnd.randint(1, 4)):
            size = rnd.choice([0, 5, 20, 900])
            parts.append((chrom, f"G{t % 9}", None if t == 7 else f"T{t}", at, at + size, "intron" if t % 3 == 0 and i % 2 else "exon"))
            at += size + rnd.choice([0, 10])
    points = [(i, f"chr{rnd.randrange(3)}", rnd.randrange(-5, 6000)) for i in range(800)]
    annotation = spark.createDataFrame(parts, "chrom string, gene_name string, transcript_id string, start_pos long, end_pos long, kind string")
    found = intervals.genes_at(spark.createDataFrame(points, "id long, chrom string, at long"), annotation)
    want = set()
    for i, chrom, at in points:
        for c, t in {(p[0], p[2]) for p in parts}:
            own = [p for p in parts if (p[0], p[2]) == (c, t)]
            if c != chrom or not min(p[3] for p in own) <= at < max(p[4] for p in own):
                continue
            kinds = {intervals.INTRON if p[5] == "intron" else intervals.EXON for p in own if t is not None and p[3] <= at < p[4]}
            if not kinds and not any(p[5] == "intron" for p in own):
                kinds = {intervals.INTRON}
            want |= {(i, own[0][1], k) for k in kinds}
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows)) and set(rows) == want and want


def test_bins_follow_the_lengths_of_intervals(spark):
    rows = spark.createDataFrame([(10 * i, 10 * i + 8) for i in range(500)] + [(0, 4008)], "a long, b long")
    width = intervals.bin_width(rows, "a", "b")
    assert width == 16 and intervals.binned(rows, "a", "b", width).count() <= 3 * rows.count()


def test_order_statistics_read_their_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            read.add(b.num_rows)
            yield b

    rows = spark.range(10_000, numPartitions=4).select((F.col("id") * 7919 % 10_007).cast("double").alias("x")).mapInArrow(seen, "x double")
    every = sorted(i * 7919 % 10_007 for i in range(10_000))
    assert selection.quantile(rows, "x", 0.5) == (every[4999] + every[5000]) / 2
    assert read.value == 10_000
