"""The numbers behind the plots of a quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import selection
from .quality import ranked, size_histogram
from .tables import stored


def histogram(rows: DataFrame, column: str, bins: int = 50, log: bool = False, weight: str | None = None) -> DataFrame:
    """bin, n: counts (sums of weight) of equal bins between the least and the largest value (of its log10)."""
    value = F.log10(column) if log else F.col(column).cast("double")
    bounds = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).first()
    if bounds["lo"] is None:
        return rows.select(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("n")).limit(0)
    width = (bounds["hi"] - bounds["lo"]) / bins or 1.0
    at = F.least(F.floor((value - bounds["lo"]) / width), F.lit(bins - 1)).cast("int")
    return rows.groupBy(at.alias("bin")).agg((F.sum(weight).cast("long") if weight else F.count("*")).alias("n"))


def genes_per_cell(counts: DataFrame, bins: int = 50) -> DataFrame:
    """Histogram of log10 of the number of genes of each cell."""
    return histogram(counts.filter("n > 0").groupBy("cb").agg(F.count("*").alias("genes")), "genes", bins, log=True)


def umi_probabilities(distribution: DataFrame, trim: float = 0.99, bins: int = 50) -> DataFrame:
    """Histogram of identifier probabilities (umi, p and, where a row stands for several identifiers, times) below their `trim` quantile."""
    if "times" not in distribution.columns:
        distribution = distribution.withColumn("times", F.lit(1).cast("long"))
    # few distinct probabilities: one for each number of occurrences
    steps = distribution.groupBy("p").agg(F.sum("times").alias("times")).orderBy("p").collect()
    place, at, limit = trim * (sum(int(r["times"]) for r in steps) - 1), 0, None
    low = int(place)
    for r in steps:
        at += int(r["times"])
        if limit is None and at > low:
            limit = r["p"]
        if at > low + 1 or at > low and place == low:
            limit += (r["p"] - limit) * (place - low)
            break
    return histogram(distribution.filter(F.col("p") < limit), "p", bins, weight="times")


def reads_per_umi_by_size(cells: DataFrame) -> DataFrame:
    """cb, log_umis, reads_per_umi."""
    return cells.select("cb", F.log10("n_umis").alias("log_umis"), (F.col("n_reads") / F.col("n_umis")).alias("reads_per_umi"))


def fraction_threshold(rows: DataFrame, column: str) -> DataFrame:
    """One row: the median plus 4 median absolute deviations (times 1.4826)."""
    rows = stored(rows.select(column))
    middle = selection.median(rows, column)
    found = None if middle is None else middle + 4 * selection.median_deviation(rows, column, middle)
    return rows.sparkSession.createDataFrame([(found,)], "threshold double")


def rank_curve(cells: DataFrame, quality: DataFrame | None = None) -> DataFrame:
    """cb, rank, log_rank, log_umis and, where given, the quality label of each cell."""
    rows = ranked(cells.select("cb", "n_umis")).select("cb", "rank", F.log10("rank").alias("log_rank"), F.log10("n_umis").alias("log_umis"))
    return rows.join(quality, "cb", "left") if quality is not None else rows


def scores_by_rank(scores: DataFrame, cells: DataFrame) -> DataFrame:
    return ranked(cells.select("cb", "n_umis")).join(scores, "cb").select("rank", "score")


def saturation_points(curve: DataFrame, present_depth: float) -> DataFrame:
    """The saturation curve with `predicted` as the reference labels it: where the depth is below the present one."""
    return curve.withColumn("predicted", F.col("depth") < present_depth)


__all__ = ["fraction_threshold", "genes_per_cell", "histogram", "rank_curve", "reads_per_umi_by_size", "saturation_points", "scores_by_rank", "size_histogram", "umi_probabilities"]
