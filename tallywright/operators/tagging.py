"""From reads in lock-step to tagged reads: layout, quality filters, trimming, read ids, counts of outcomes."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import sequences as s

from .layouts import PROTOCOLS, Layout
from .tables import with_once


@dataclass(frozen=True)
class Filters:
    min_barcode_quality: int = 0
    trim_quality: int = 0
    leading_trim: int = 0
    trailing_trim: int = 0
    min_median_quality: int = 0
    max_g_fraction: float = 1.0
    min_align_length: int = 10
    poly_a: str = "AAAAAAAA"


def lock_step(files: list[DataFrame]) -> DataFrame:
    """Tables (ord, id, seq, qual) of one run, joined by record number; files of unequal length raise."""
    named = [f.select("ord", F.col("seq").alias(f"seq{i}"), F.col("qual").alias(f"qual{i}"), *([F.col("id")] if i == len(files) else [])) for i, f in enumerate(files, 1)]
    joined = reduce(lambda a, b: a.join(b, "ord", "full"), named)
    whole = reduce(lambda a, b: a & b, [F.col(f"seq{i}").isNotNull() for i in range(1, len(files) + 1)])
    return joined.withColumn("seq1", F.when(whole, F.col("seq1")).otherwise(F.raise_error(F.lit("a file ended prematurely")).cast("string")))


def judged(reads: DataFrame, f: Filters) -> DataFrame:
    """Parsed reads with poly-A and quality trimming applied and `verdict`: kept, or the first filter that drops them."""
    quality = F.concat(F.coalesce("cb_qual", F.lit("")), F.coalesce("umi_qual", F.lit("")))
    cut = s.poly_a_cut(F.col("seq"), F.coalesce("tail", F.lit("")), f.poly_a)
    rows = with_once(reads, {"_n": cut})
    rows = with_once(rows, {"seq": F.expr("substring(seq, 1, _n)"), "qual": F.expr("substring(qual, 1, _n)")}).drop("_n")
    window = s.quality_window(F.col("qual"), f.leading_trim, f.trailing_trim, f.trim_quality)
    rows = with_once(rows, {"_w": window}).withColumn("_len", F.col("_w.end") - F.col("_w.start"))
    verdict = (
        F.when(F.col("cb").isNull(), F.col("outcome"))
        .when(F.length("seq") < f.min_align_length, "short_gene")
        .when(~s.passes_gene_quality(F.col("seq"), F.col("qual"), f.min_median_quality, f.max_g_fraction), "low_quality")
        .when(F.col("_len") < f.min_align_length, "short_after_trim")
        .otherwise("kept")
    )
    trimmed = {k: F.expr(f"substring({k}, _w.start + 1, greatest(_len, 0))") for k in ("seq", "qual")}
    rows = with_once(rows, {"verdict": verdict}).withColumn("pass_quality", s.all_above(quality, f.min_barcode_quality))
    return rows.withColumns(trimmed).drop("_w", "_len")


def tag_reads(reads: DataFrame, protocol: str, layout: Layout, filters: Filters = Filters(), run: str = "r") -> DataFrame:
    """read_id, cb, umi, cb_qual, umi_qual, pass_quality, seq, qual of the reads that are kept."""
    rows = judged(PROTOCOLS[protocol](reads, layout), filters).filter("verdict = 'kept'")
    name = s.read_id(F.concat(F.lit("@" + run), F.col("ord").cast("string")), F.col("cb"), F.col("umi"))
    return rows.select(name.alias("read_id"), "cb", "umi", "cb_qual", "umi_qual", "pass_quality", "seq", "qual")


def outcome_counts(rows: DataFrame, column: str = "outcome") -> DataFrame:
    """(outcome, reads, percent)."""
    counts = rows.groupBy(F.col(column).alias("outcome")).agg(F.count("*").alias("reads"))
    total = counts.agg(F.sum("reads").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("outcome", "reads", (F.col("reads") * 100 / F.col("total")).alias("percent"))


def reads_per_barcode(tagged: DataFrame) -> DataFrame:
    return tagged.groupBy("cb").agg(F.count("*").alias("reads"))


def params_lines(tagged: DataFrame) -> Column:
    """One line a read of a params file: name cb umi cb_qual umi_qual."""
    return F.concat_ws(" ", "read_id", "cb", "umi", "cb_qual", "umi_qual")


def write_params(tagged: DataFrame, path: str) -> None:
    """params_lines() as compressed text."""
    tagged.select(params_lines(tagged).alias("value")).write.option("compression", "gzip").text(path)
