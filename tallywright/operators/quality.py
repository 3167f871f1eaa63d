"""Cell quality: number of cells, labels, features, outliers and scores."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.functions import statistics as st

from . import selection
from .tables import numbered, stored


def ranked(sizes: DataFrame, size: str = "n_umis") -> DataFrame:
    """sizes with rank, 1 for the largest; ties by barcode."""
    found = numbered(sizes, [F.desc(size), F.asc("cb")], "rank")
    return found.withColumn("rank", F.col("rank") + 1)


def cell_number(sizes: DataFrame, size: str = "n_umis", lag: float = 0.05) -> dict[str, int]:
    """min, expected and max number of real cells, from the knee of log size over log rank.

    Only the counts of cells of each size are collected; see knee().
    """
    steps = sizes.groupBy(size).agg(F.count("*").alias("n")).orderBy(F.desc(size)).collect()
    expected, most = knee([float(r[size]) for r in steps], [r["n"] for r in steps], lag)
    return {"min": int(np.round(expected * 0.75)), "expected": expected, "max": most}


def knee(values: list[float], counts: list[int], lag: float = 0.05) -> tuple[int, int]:
    """(expected, most) of a falling curve that has each value `counts` times.

    The slope over a lag is least at the expected rank; the longest stretch of growing slope starts at the largest one.
    Between the ranks where a value changes within the lag, the slope over it only falls and its change turns from
    falling to growing at most once, so each such piece is judged by its ends: time follows the distinct values.
    """
    upto, logs = np.cumsum(counts), np.log(values)
    n = int(upto[-1])
    k = max(1, int(np.round(n * lag)))
    level = lambda i: logs[np.searchsorted(upto, i, side="right")]
    width = lambda i: math.log((i + k + 1) / (i + 1))
    slopes, changes = n - k, n - 2 * k
    if changes <= 0:
        return n, n
    edges = lambda shifts, end: np.unique(np.clip(np.concatenate([[0, end], *[upto - x for x in shifts]]), 0, end)).tolist()
    best, run, at = (0, -1), None, changes - 1  # (length, start) of the longest stretch, start of the present one
    pieces = edges((0, k, 2 * k), changes)
    for a, b in zip(pieces, pieces[1:], strict=False):
        first, second = level(a + k) - level(a), level(a + 2 * k) - level(a + k)
        grows = lambda m: second * width(m) > first * width(m + k)  # noqa: E731, B023
        lo, hi = a, b  # the first place that grows
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if grows(mid) else (mid + 1, hi)
        if run is not None and lo > a:
            best, run = max(best, (a - run, -run)), None
        if run is None and lo < b:
            run = lo
    if run is not None:
        best = max(best, (changes - run, -run))
    if best[0]:
        at = -best[1]
    most = at + 2 * k + 1
    limit = max(1, min(slopes, most - k))
    pieces = edges((0, k), limit)
    least = min((float((level(i + k) - level(i)) / width(i)), i) for a, b in zip(pieces, pieces[1:], strict=False) for i in (a, b - 1))
    return int(np.round(least[1] + k + 1 - k / 2)), most


def labels(sizes: DataFrame, number: dict[str, int] | None = None, size: str = "n_umis") -> DataFrame:
    """cb, quality: High for the `min` largest cells, Low from the `max`-th on, Unknown between."""
    return ranked(sizes, size).select("cb", quality_of(number or cell_number(sizes, size)).alias("quality"))


def quality_of(number: dict[str, int]) -> Column:
    return F.when(F.col("rank") >= number["max"], "Low").when(F.col("rank") <= number["min"], "High").otherwise("Unknown")


def features(counts: DataFrame, reads_per_umi: DataFrame, chromosomes: DataFrame, total_reads: DataFrame | None = None, mitochondrial: str | None = None) -> DataFrame:
    """cb, reads_per_umi, umi_per_gene, low_expressed_frac, intergenic_frac, not_aligned_frac, mito_frac.

    counts: cb, gene, n; chromosomes: kind, cb, chrom, n (reads); total_reads: cb, reads of the tag stage.
    """
    shape = counts.groupBy("cb").agg((F.sum("n") / F.count("*")).alias("umi_per_gene"), (F.count_if(F.col("n") == 1) / F.count("*")).alias("low_expressed_frac"))
    exonic = F.col("kind").isin("exon", "intron")
    reads = chromosomes.groupBy("cb").agg(
        F.sum("n").alias("_all"),
        F.sum(F.when(F.col("kind") == "intergenic", F.col("n")).otherwise(0)).alias("_intergenic"),
        F.sum(F.when(exonic, F.col("n")).otherwise(0)).alias("_genic"),
        F.sum(F.when(exonic & (F.col("chrom") == mitochondrial), F.col("n")).otherwise(0)).alias("_mito"),
    )
    rows = shape.join(reads_per_umi, "cb").join(reads, "cb", "left")
    share = lambda a, b: F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))
    lost = F.lit(0.0)
    if total_reads is not None:
        rows = rows.join(total_reads.select("cb", F.col("reads").alias("_tagged")), "cb", "left")
        lost = F.coalesce(F.greatest(1 - F.col("_all") / F.col("_tagged"), F.lit(0.0)), F.lit(0.0))
    return rows.select(
        "cb", "reads_per_umi", "umi_per_gene", "low_expressed_frac", share("_intergenic", "_all").alias("intergenic_frac"), lost.alias("not_aligned_frac"), share("_mito", "_genic").alias("mito_frac")
    )


def scaled(rows: DataFrame, columns: list[str], drop_constant: bool = True) -> DataFrame:
    """Columns as (x - min) / (max - min); constant ones go, or become 0. The rows are read twice, so they are stored."""
    rows = stored(rows)
    spread = rows.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("lo", F.min), ("hi", F.max))]).first()
    live = [c for c in columns if spread[f"hi_{c}"] is not None and spread[f"hi_{c}"] > spread[f"lo_{c}"]]
    made = {c: (F.col(c) - spread[f"lo_{c}"]) / (spread[f"hi_{c}"] - spread[f"lo_{c}"]) if c in live else F.lit(0.0) for c in (live if drop_constant else columns)}
    return rows.withColumns(made).drop(*([c for c in columns if c not in live] if drop_constant else []))


def high_outliers(rows: DataFrame, column: str, threshold: float | None = None, trim: float = 0.2) -> DataFrame:
    """rows with `outlier`: above the mean without the outer fifths plus 4 median absolute deviations (times 1.4826)."""
    if threshold is None:
        rows = stored(rows)  # read five times and more
        mean, middle = selection.trimmed_mean(rows, column, trim), selection.median(rows, column)
        if mean is None:
            return rows.withColumn("outlier", F.lit(False))
        threshold = mean + 4 * selection.median_deviation(rows, column, middle)
    return rows.withColumn("outlier", F.col(column) > threshold)


def geneset_fraction(counts: DataFrame, genes: DataFrame) -> DataFrame:
    """cb, fraction of the molecules that belong to the genes (gene)."""
    rows = counts.join(genes.select("gene", F.lit(True).alias("_in")).distinct(), "gene", "left")
    return rows.groupBy("cb").agg((F.sum(F.when(F.col("_in"), F.col("n")).otherwise(0)) / F.sum("n")).alias("fraction"))


def chromosome_fraction(chromosomes: DataFrame, chrom: str) -> DataFrame:
    return chromosomes.groupBy("cb").agg((F.sum(F.when(F.col("chrom") == chrom, F.col("n")).otherwise(0)) / F.sum("n")).alias("fraction"))


def chromosome_shares(chromosomes: DataFrame, least: float = 0.001) -> DataFrame:
    """chrom, kind, n, share of all reads, of the chromosomes that have more than `least` of them."""
    sums = chromosomes.groupBy("chrom", "kind").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(W.partitionBy(F.lit(0)))
    by_chrom = F.sum("n").over(W.partitionBy("chrom"))
    return sums.withColumn("share", by_chrom / total).filter(F.col("share") > least)


def size_histogram(sizes: DataFrame, size: str = "n_umis", bins: int = 20) -> DataFrame:
    """bin, cells, weight: histogram of log10 size, bars weighted by the size at their middle."""
    bounds = sizes.agg(F.min(F.log10(size)).alias("lo"), F.max(F.log10(size)).alias("hi")).first()
    if bounds["lo"] is None:
        return sizes.select(F.lit(0).alias("bin"), F.lit(0).alias("cells"), F.lit(0.0).alias("weight")).limit(0)
    width = (bounds["hi"] - bounds["lo"]) / bins or 1.0
    at = F.least(F.floor((F.log10(size) - bounds["lo"]) / width), F.lit(bins - 1)).cast("int")
    middle = F.pow(F.lit(10.0), bounds["lo"] + (F.col("bin") + 0.5) * width)
    return sizes.groupBy(at.alias("bin")).agg(F.count("*").alias("cells")).withColumn("weight", F.col("cells") * middle)


def tail_shares(counts: DataFrame, least: float = 5e-4) -> DataFrame:
    """n, share, tail: how often a gene has n molecules in a cell, and the share of larger values."""
    shares = counts.groupBy("n").agg(F.count("*").alias("_c"))
    shares = shares.withColumn("share", F.col("_c") / F.sum("_c").over(W.partitionBy(F.lit(0)))).filter(F.col("share") > least)
    return shares.select("n", "share", (1 - F.sum("share").over(W.orderBy("n"))).alias("tail"))


#: Principal components of the quality features: share of variance to explain, most components, least loading of a used feature.
EXPLAINED, MOST_PCS, LOADING = 0.98, 3, 0.075


#: Cells up to which robust spreads are worked out on the driver; those of more cells are counted by tasks.
AT_ONCE = 100_000


def principal_components(rows: DataFrame, columns: list[str], robust: bool = False) -> tuple[np.ndarray, list[str]]:
    """(weights by column and component, used features), from all cells. robust: sparse components of the greatest robust spread;
    else the classical ones, from moments that Spark sums."""
    if robust:
        if rows.count() <= AT_ONCE:
            vectors, sizes = st.sparse_components(rows.select(*columns).toPandas().to_numpy(float))
        else:
            vectors, sizes = st.sparse_directions(len(columns), selection.spreads(rows, columns))
        order = np.argsort(-sizes, kind="stable")
        vectors, values = vectors[:, order], sizes[order] ** 2
    else:
        pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
        found = rows.agg(*[F.covar_samp(a, b).alias(f"{a}__{b}") for a, b in pairs]).first()
        cov = np.zeros((len(columns), len(columns)))
        for a, b in pairs:
            i, j = columns.index(a), columns.index(b)
            cov[i, j] = cov[j, i] = found[f"{a}__{b}"] or 0.0
        values, vectors = np.linalg.eigh(cov)
        order = np.argsort(values)[::-1]
        values, vectors = np.maximum(values[order], 0), vectors[:, order]
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    n = min(int(np.searchsorted(share, EXPLAINED) + 1), MOST_PCS, len(columns))
    loads = np.abs(vectors) / np.maximum(np.abs(vectors).sum(axis=0), 1e-300)
    return vectors[:, :n], [c for c, row in zip(columns, loads[:, :n], strict=True) if (row > LOADING).any()]


def score_cells(rows: DataFrame, sizes: DataFrame, columns: list[str], number: dict[str, int] | None = None, flags: list[str] | None = None, robust: bool = False) -> DataFrame:
    """cb, score: probability of high quality by Gaussian kernel densities of the High and Low cells in the space of the
    principal components (robust: sparse ones that outliers do not turn). Cells that are outliers in a flagged feature are Low ones where the components use it, else
    they get the least score.

    Training sets are all High cells and, as in the reference, 1.5 times as many Low ones, the largest (all where there are fewer).
    Their coordinates are collected and go to all tasks; scoring runs on all cells in batches, and each meets all of the training sets.
    """
    rows = stored(rows)
    ready = scaled(rows, columns)
    live = [c for c in columns if c in ready.columns]
    weights, used = principal_components(ready, live, robust)
    names = [f"pc{i}" for i in range(weights.shape[1])]
    made = [reduce(lambda a, b: a + b, [F.col(c) * float(w) for c, w in zip(live, weights[:, i], strict=True)]).alias(name) for i, name in enumerate(names)]
    space = scaled(ready.select("cb", *made), names, drop_constant=False)
    marked = rows.select("cb")
    for flag in flags or []:
        marked = marked.join(high_outliers(rows.select("cb", flag), flag).select("cb", F.col("outlier").alias(f"_{flag}")), "cb")
    worst = lambda wanted: reduce(lambda a, b: a | b, [F.coalesce(F.col(f"_{f}"), F.lit(False)) for f in flags or [] if (f in used) == wanted], F.lit(False))
    marked = marked.select("cb", worst(True).alias("low"), worst(False).alias("least"))
    judged = ranked(sizes).join(marked, "cb").withColumn("quality", F.when(F.col("low"), "Low").otherwise(quality_of(number or cell_number(sizes))))
    ordered = space.join(judged.select("cb", "rank", "quality", "least"), "cb")
    high = ordered.filter("quality = 'High'").orderBy("rank").select(*names).toPandas()
    low = ordered.filter("quality = 'Low'").orderBy("rank").limit(max(2, round(1.5 * len(high)))).select(*names).toPandas()
    good, bad = (df.to_numpy(float) for df in (high, low))
    bands = [st.normal_bandwidth(x) + 1e-9 * np.eye(x.shape[1]) for x in (good, bad)]

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            out = []
            for a in range(0, len(df), 256):
                at = df.iloc[a : a + 256][names].to_numpy(float)
                d1, d0 = st.density(good, bands[0], at), st.density(bad, bands[1], at)
                total = (d1 + d0) / 2
                out.append(np.where(total < 1e-10, 0.5, d1 / 2 / np.maximum(total, 1e-300)))
            yield pd.DataFrame({"cb": df["cb"], "score": np.concatenate(out) if out else [], "least": df["least"]})

    scores = stored(ordered.select("cb", *names, "least").mapInPandas(score, "cb string, score double, least boolean"))
    lowest = scores.agg(F.min("score")).first()[0]
    return scores.select("cb", F.when(F.col("least"), F.lit(lowest)).otherwise(F.col("score")).alias("score"))


def saturation(info: DataFrame, sizes: DataFrame, steps: int = 100, most: float = 10.0, top: int = 1000) -> pd.DataFrame:
    """ratio, depth, estimates, lower, upper: distinct molecules expected at multiples of the present reads, for the largest cells,
    and the range of 95 % of estimates from resampled molecules."""
    cells = sizes.orderBy(F.desc("n_umis"), "cb").limit(top).select("cb")
    rows = info.join(F.broadcast(cells), "cb", "left_semi")  # at most `top` barcodes
    rows = rows.groupBy("reads").agg(F.count("*").alias("n")).collect()
    counts = {int(r["reads"]): int(r["n"]) for r in rows}
    reads = sum(k * n for k, n in counts.items())
    ratios = np.linspace(0, most, steps)
    lower, upper = st.distinct_range(counts, ratios)
    return pd.DataFrame({"ratio": ratios, "depth": ratios * reads, "estimates": st.expected_distinct(counts, ratios), "lower": lower, "upper": upper})
