"""Mixing sources to target weights with hash-threshold histograms (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import apart, broadcast_if, materialize, words

#: A document's hash has 60 bits; each histogram level looks at LEVEL_BITS more of them.
HASH_BITS, LEVEL_BITS = 60, 10
#: Source-level tables are broadcast up to this number of sources, else joined by shuffle.
MAX_BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def document_hash(key: Column, salt: str) -> Column:
    digest = F.md5(F.concat(F.lit(salt), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple, share: float, max_epochs: int) -> DataFrame:
    """(source, source_size) -> + target, by water-filling: weights repeat over the sources in code-point order,
    null last; a target stops at max_epochs times its source's size and the excess is reshared by weight.

    One row per source goes through one window, so this is for catalogues of sources, not for documents.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name) - 1)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("cap", F.col("source_size") * max_epochs)
    fill = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    everyone = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.sum("source_size").over(everyone) * F.lit(float(share)) - F.col("before")) / F.col("weight_left")
    filled = (
        ranked.withColumn("before", F.coalesce(F.sum("cap").over(fill.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(fill.rowsBetween(0, W.unboundedFollowing)))
        .withColumn("level", level)
        .withColumn("full", F.col("cap") <= F.col("weight") * F.col("level"))
        .withColumn("level", F.max(F.when(~F.col("full"), F.col("level"))).over(everyone))
    )
    target = F.when(F.col("full"), F.col("cap").cast("double")).otherwise(F.col("weight") * F.col("level"))
    return filled.select("source", "source_size", target.alias("target"))


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = (5, 2, 1),
    share: float = 1.5,
    max_epochs: int = 2,
    salt: str = "mix",
) -> DataFrame:
    """doc_id, size, source_size, target, taken: how many words of each document the mix takes.

    A target is met by whole passes over the source plus the documents whose hash is at most the source's threshold.
    Thresholds come from histograms of words by source and hash bucket, refined in the boundary bucket only, so
    documents are never sorted. A larger budget only adds documents (nested thresholds), and reruns agree, as the
    hash depends on the id alone. At the threshold the nearer of the two sums is taken.

    Null or empty texts have size 0 and take 0; a null source is a source of its own, last in order; a null id hashes
    like an empty one; rows that repeat an id share its hash and enter or leave together. An empty table gives none.
    """
    slim = materialize(slim_rows(docs, id_col, text_col, source_col, salt), "mix-docs")
    plan = mix_plan(slim, weights, share, max_epochs)
    return slim.join(plan, F.col("source").eqNullSafe(F.col("plan_source"))).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies(F.col("hash"))).alias("taken")
    )


def mixed_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple = (5, 2, 1),
    share: float = 1.5,
    max_epochs: int = 2,
    salt: str = "mix",
) -> DataFrame:
    """The rows of docs that mix() takes, with a last column `copies`: how often each stands in the mix; a column of that
    name is replaced, others may have any name. Texts aren't shuffled."""
    rows, (id_, text, source) = apart(docs, id_col, text_col, source_col)
    plan = mix_plan(materialize(slim_rows(rows, id_, text, source, salt), "mix-docs"), weights, share, max_epochs)
    taken = rows.join(plan, F.col(source).eqNullSafe(F.col("plan_source"))).withColumn("copies", copies(document_hash(F.col(id_), salt))).filter("copies > 0")
    named = [F.col(new).alias(old) for new, old in zip(rows.columns, docs.columns, strict=True) if old.lower() != "copies"]
    return taken.select(*named, "copies")


def slim_rows(docs: DataFrame, id_col: str, text_col: str, source_col: str, salt: str) -> DataFrame:
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        document_hash(F.col(id_col), salt).alias("hash"),
    )


def copies(hash_: Column) -> Column:
    """Whole passes, and one more up to the threshold."""
    return F.col("plan_passes") + (hash_ <= F.coalesce(F.col("plan_threshold"), F.lit(-1))).cast("long")


def mix_plan(slim: DataFrame, weights: tuple, share: float, max_epochs: int) -> DataFrame:
    """(plan_source, source_size, target, plan_passes, plan_threshold), one row a source."""
    sizes = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, max_epochs)
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    targets = materialize(
        targets.withColumn("passes", passes).withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size")), "mix-targets"
    )
    limits = thresholds(slim, targets.select("source", "rest"))
    plan = targets.alias("t").join(limits.alias("l"), F.col("t.source").eqNullSafe(F.col("l.source")), "left")
    plan = plan.select(
        F.col("t.source").alias("plan_source"), "source_size", "target", F.col("passes").alias("plan_passes"), F.col("threshold").alias("plan_threshold")
    )
    return broadcast_if(materialize(plan, "mix-plan"), MAX_BROADCAST_SOURCES)


def thresholds(slim: DataFrame, budgets: DataFrame) -> DataFrame:
    """(source, threshold): the hash up to which a source's documents fit its budget `rest`, for each source that has one."""
    edge = budgets.select(F.col("source").alias("edge_source"), F.lit(0).cast("long").alias("prefix"), "rest")
    rows = slim.filter(F.col("size") > 0)
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift, before = HASH_BITS - level * LEVEL_BITS, HASH_BITS - (level - 1) * LEVEL_BITS
        edge = broadcast_if(edge, MAX_BROADCAST_SOURCES)
        inside = F.col("source").eqNullSafe(F.col("edge_source")) & (F.shiftright("hash", before) == F.col("prefix"))
        rows = rows.join(edge, inside).select("source", "size", "hash", "rest")
        if level == 2:  # from here on only the boundary buckets of the first level are read
            rows = materialize(rows, "mix-edge")
        histogram = rows.groupBy("source", F.shiftright("hash", shift).alias("bucket")).agg(F.sum("size").alias("words"), F.max("rest").alias("rest"))
        upto = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
        running = histogram.withColumn("upto", F.sum("words").over(upto))
        first = running.filter(F.col("upto") > F.col("rest")).groupBy("source").agg(F.min(F.struct("bucket", "upto", "words", "rest")).alias("e"))
        edge = first.select(
            F.col("source").alias("edge_source"),
            F.col("e.bucket").alias("prefix"),
            (F.col("e.rest") - (F.col("e.upto") - F.col("e.words"))).alias("rest"),
            F.col("e.words").alias("words"),
        )
        edge = materialize(edge, "mix-level")
        rows = rows.drop("rest")
        if level < HASH_BITS // LEVEL_BITS:
            edge = edge.drop("words")
    nearer = F.col("words") - F.col("rest") < F.col("rest")
    return edge.select(F.col("edge_source").alias("source"), F.when(nearer, F.col("prefix")).otherwise(F.col("prefix") - 1).alias("threshold"))
