"""Tables of identifier pairs (base, target, min_rpu, max_rpu, quality): filters, order and distributions for classifiers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .identifiers import GROUP, adjacent


def classifier_pairs(molecules: DataFrame, quality: str = "quality") -> DataFrame:
    """cb, gene, base, target, min_rpu, max_rpu, quality: each identifier with the adjacent ones of at least as many reads;
    of two with equal reads the smaller one is the base."""
    rows = adjacent(molecules).filter("reads < other_reads or (reads = other_reads and umi < other)")
    graded = rows.join(molecules.select(*GROUP, "umi", F.col(quality).alias("quality")), [*GROUP, "umi"])
    return graded.select(*GROUP, F.col("umi").alias("base"), F.col("other").alias("target"), F.col("reads").alias("min_rpu"), F.col("other_reads").alias("max_rpu"), "quality")


def among(pairs: DataFrame, kept: DataFrame) -> DataFrame:
    """Pairs whose base and target are both kept (cb, gene, umi)."""
    side = lambda name: kept.select(*GROUP, F.col("umi").alias(name))
    return pairs.join(side("base"), [*GROUP, "base"], "left_semi").join(side("target"), [*GROUP, "target"], "left_semi")


def mirrored(pairs: DataFrame, keys: list[str], a: str = "base", b: str = "target", score: str = "prob", tolerance: float = 1e-5) -> DataFrame:
    """Pairs that go as (b, a) stands too: the one of the lower score, of about equal ones that of the smaller base."""
    back = pairs.select(*keys, F.col(a).alias(b), F.col(b).alias(a), F.col(score).alias("_back"))
    both = pairs.join(back, [*keys, a, b])
    gap = F.col("_back") - F.col(score)
    return both.filter((gap > tolerance) | ((F.abs(gap) <= tolerance) & (F.col(a) < F.col(b)))).drop("_back")


def cross_merged(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs whose base is the target of exactly one other pair."""
    once = pairs.groupBy(*keys, F.col("target").alias("base")).agg(F.count("*").alias("_n")).filter("_n = 1").drop("_n")
    return pairs.join(once, [*keys, "base"], "left_semi")


def running_reads(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Pairs in the classifier's order within each target, with the running sum of the smaller one's reads."""
    order = W.partitionBy(*keys, "target").orderBy("min_rpu", "quality", "base")
    return pairs.withColumns({"place": F.row_number().over(order), "min_rpu_sum": F.sum("min_rpu").over(order.rowsBetween(W.unboundedPreceding, 0))})


def ranked_predictions(pairs: DataFrame, factor: str, prob: str) -> DataFrame:
    """Pairs with their place by (factor, prob, base, target) in their gene."""
    return pairs.withColumn("place", F.row_number().over(W.partitionBy(*GROUP).orderBy(factor, prob, "base", "target")))


def mixed_distribution(first: DataFrame, second: DataFrame, column: str) -> DataFrame:
    """value, p: the mean of two samples' distributions; a value that one lacks has probability 0 there."""

    def shares(rows: DataFrame, name: str) -> DataFrame:
        counts = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
        return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("t")))).select("value", (F.col("n") / F.col("t")).alias(name))

    both = shares(first, "a").join(shares(second, "b"), "value", "full")
    return both.select("value", ((F.coalesce("a", F.lit(0.0)) + F.coalesce("b", F.lit(0.0))) / 2).alias("p"))


def quantile_borders(distribution: DataFrame, classes: int) -> DataFrame:
    """border: for each of `classes` equal shares, the first value at which the distribution (value, p) has reached it.

    Values are qualities or read numbers: few.
    """
    reached = F.sum("p").over(W.orderBy("value").rowsBetween(W.unboundedPreceding, 0))
    running = distribution.withColumn("upto", reached)
    shares = distribution.sparkSession.range(1, classes + 1).select((F.col("id") / classes - 1e-9).alias("q"))
    return shares.join(running, F.col("upto") >= F.col("q")).groupBy("q").agg(F.min("value").alias("border")).select("border").distinct()


def smoothed(values: DataFrame, column: str, smooth: float, largest: int | None = None) -> DataFrame:
    """value, p over 0 .. largest, each with `smooth` added to its count."""
    top = largest if largest is not None else int(values.agg(F.max(column)).first()[0] or 0)
    counts = values.groupBy(F.col(column).cast("long").alias("value")).agg(F.count("*").alias("n"))
    every = values.sparkSession.range(top + 1).withColumnRenamed("id", "value").join(counts, "value", "left")
    weighed = every.withColumn("n", F.coalesce("n", F.lit(0)) + F.lit(float(smooth)))
    return weighed.crossJoin(F.broadcast(weighed.agg(F.sum("n").alias("t")))).select("value", (F.col("n") / F.col("t")).alias("p"))


def added_back(tag_reads: DataFrame, cell_map: DataFrame) -> DataFrame:
    """cb, reads: reads of the tag stage, those of merged cells added to their targets; merged cells keep their own."""
    moved = tag_reads.join(cell_map.filter("cb_to is not null and cb_from != cb_to"), tag_reads["cb"] == cell_map["cb_from"]).groupBy(F.col("cb_to").alias("cb")).agg(F.sum("reads").alias("_more"))
    return tag_reads.join(moved, "cb", "left").select("cb", (F.col("reads") + F.coalesce("_more", F.lit(0))).alias("reads"))
