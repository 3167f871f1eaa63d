"""From annotated reads to molecules and count matrices.

reads: cb, umi, gene (null: intergenic), chrom, mark (bits: 1 not annotated, 2 exon, 4 intron), umi_qual where wanted.
molecules: one row for each (cb, gene, umi) with reads and the bits of all its reads.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.sequences import mean_quality

#: The codes of a gene match level and the marks each stands for.
LEVELS = {"e": 2, "i": 4, "E": 3, "I": 5, "B": 6, "A": 7}
DEFAULT_LEVEL = "eEBA"
KEY = ["cb", "gene", "umi"]


def matches(level: str = DEFAULT_LEVEL) -> Column:
    """Whether a molecule's joined mark is one of the level's, exactly; to be asked after the aggregation."""
    return F.col("mark").isin([LEVELS[c] for c in level])


def molecules(reads: DataFrame) -> DataFrame:
    """cb, gene, umi, reads, mark of the reads that have a gene."""
    return reads.filter(F.col("gene").isNotNull()).groupBy(*KEY).agg(F.count("*").alias("reads"), F.expr("bit_or(mark)").alias("mark"))


#: Identifiers have at most so many bases.
LONGEST = 32


def places(value, longest: int = LONGEST) -> list[Column]:
    """A sum for each place of an identifier; value: place from 1 -> column."""
    return [F.sum(value(i)).alias(f"_{i}") for i in range(1, longest + 1)]


def molecules_with_quality(reads: DataFrame, longest: int = LONGEST) -> DataFrame:
    """molecules() with qual_sum, the sum of the ASCII codes at each place, and qual, their mean; lengths must agree and
    not exceed `longest`. One aggregation: each place is a sum of its own."""
    kept = reads.filter(F.col("gene").isNotNull())
    sums = places(lambda i: F.ascii(F.substring("umi_qual", i, 1)).cast("long"), longest)
    size = F.length("umi_qual")
    found = kept.groupBy(*KEY).agg(F.count("*").alias("reads"), F.expr("bit_or(mark)").alias("mark"), F.min(size).alias("_a"), F.max(size).alias("_b"), *sums)
    wrong = F.raise_error(F.lit("qualities of unequal length, or too long")).cast("array<bigint>")
    listed = F.slice(F.array(*[F.col(f"_{i}") for i in range(1, longest + 1)]), F.lit(1), F.coalesce("_a", F.lit(0)))
    known = F.when((F.col("_a") == F.col("_b")) & (F.col("_b") <= longest), listed).when(F.col("_b").isNotNull(), wrong)
    return found.select(*KEY, "reads", "mark", known.alias("qual_sum")).withColumn("qual", mean_quality(F.col("qual_sum"), F.col("reads")))


def merged_molecules(rows: DataFrame) -> DataFrame:
    """Molecules re-keyed by a merge, joined again: reads add up, marks join.

    Quality sums (qual_sum) don't add up: a molecule keeps its own, one that is new under its key takes that of its first
    source. `_source` orders them: own ones first, then by what they were called. qual is their mean by all reads, as it
    is known.
    """
    sums = [F.sum("reads").alias("reads"), F.expr("bit_or(mark)").alias("mark")]
    if "qual_sum" not in rows.columns:
        return rows.groupBy(*KEY).agg(*sums)
    order = F.col("_source") if "_source" in rows.columns else F.lit(0)
    merged = rows.groupBy(*KEY).agg(*sums, F.min_by("qual_sum", order).alias("qual_sum"))
    return merged.withColumn("qual", mean_quality(F.col("qual_sum"), F.col("reads")))


def cells(molecules_: DataFrame, level: str = DEFAULT_LEVEL) -> DataFrame:
    """cb, n_genes, n_umis, n_reads over all molecules, and req_genes, req_umis, req_reads over those of the level."""
    genes = molecules_.groupBy("cb", "gene").agg(
        F.count("*").alias("umis"), F.sum("reads").alias("reads"), F.count_if(matches(level)).alias("req"), F.sum(F.when(matches(level), F.col("reads")).otherwise(0)).alias("req_reads")
    )
    return genes.groupBy("cb").agg(
        F.count("*").alias("n_genes"),
        F.sum("umis").alias("n_umis"),
        F.sum("reads").alias("n_reads"),
        F.count_if(F.col("req") > 0).alias("req_genes"),
        F.sum("req").alias("req_umis"),
        F.sum("req_reads").alias("req_reads"),
    )


def real_cells(cells_: DataFrame, min_genes_before: int = 10) -> DataFrame:
    return cells_.filter(F.col("n_genes") >= min_genes_before)


def filtered_cells(cells_: DataFrame, min_genes_before: int = 10, min_genes_after: int = 10, top: int = 0) -> DataFrame:
    """Real cells of enough requested genes; of them the `top` largest, where that is above 0."""
    kept = real_cells(cells_, min_genes_before).filter(F.col("req_genes") >= max(min_genes_before, min_genes_after))
    return kept.orderBy(*[F.desc(c) for c in ("req_genes", "req_umis", "n_umis", "cb")]).limit(top) if top > 0 else kept


def counts(molecules_: DataFrame, level: str | None = DEFAULT_LEVEL, reads: bool = False) -> DataFrame:
    """cb, gene, n: molecules (or reads) of each gene in each cell; level None takes all marks; zeros are left out."""
    rows = molecules_.filter(matches(level)) if level else molecules_
    return rows.groupBy("cb", "gene").agg((F.sum("reads") if reads else F.count("*")).alias("n"))


def count_matrix(molecules_: DataFrame, chosen: DataFrame, level: str | None = DEFAULT_LEVEL, reads: bool = False) -> DataFrame:
    """counts() of the chosen cells; filtered before the sums."""
    return counts(molecules_.join(chosen.select("cb"), "cb", "left_semi"), level, reads)


def velocity_matrices(molecules_: DataFrame, chosen: DataFrame) -> DataFrame:
    """cb, gene, exon, intron, spanning in one pass."""
    kind = lambda level: F.count_if(matches(level))
    rows = molecules_.join(chosen.select("cb"), "cb", "left_semi").groupBy("cb", "gene")
    return rows.agg(kind("e").alias("exon"), kind("i").alias("intron"), kind("BA").alias("spanning")).filter("exon + intron + spanning > 0")


def reads_per_chromosome(reads: DataFrame, real: DataFrame) -> DataFrame:
    """kind, cb, chrom, n in long form: a read with exon and intron counts in both; without gene it is intergenic."""
    bit = lambda b: F.col("gene").isNotNull() & (F.col("mark").bitwiseAND(F.lit(b)) != 0)
    kinds = F.array_compact(F.array(F.when(bit(2), "exon"), F.when(bit(4), "intron"), F.when(F.col("gene").isNull(), "intergenic")))
    rows = reads.join(real.select("cb"), "cb", "left_semi").select("cb", "chrom", F.explode(kinds).alias("kind"))
    return rows.groupBy("kind", "cb", "chrom").agg(F.count("*").alias("n"))


def mean_reads_per_umi(cells_: DataFrame) -> DataFrame:
    return cells_.select("cb", (F.col("n_reads") / F.col("n_umis")).alias("reads_per_umi"))


def saturation_info(molecules_: DataFrame, real: DataFrame, level: str = DEFAULT_LEVEL) -> DataFrame:
    return molecules_.filter(matches(level)).join(real.select("cb"), "cb", "left_semi").select("cb", "gene", "umi", "reads")


def value_counts(rows: DataFrame, column: str) -> DataFrame:
    """value, n, share."""
    found = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    total = found.agg(F.sum("n").alias("_total"))
    return found.crossJoin(F.broadcast(total)).select("value", "n", (F.col("n") / F.col("_total")).alias("share"))


def reads_per_umi_per_cell(molecules_: DataFrame, chosen: DataFrame, level: str = DEFAULT_LEVEL) -> DataFrame:
    """cb, gene, umis: array of (umi, reads, qual) of the level, by umi."""
    rows = molecules_.filter(matches(level)).join(chosen.select("cb"), "cb", "left_semi")
    return rows.groupBy("cb", "gene").agg(F.array_sort(F.collect_list(F.struct("umi", "reads", "qual"))).alias("umis"))


def read_counters(reads: DataFrame) -> DataFrame:
    """One row: total, cant_parse, low_quality, intergenic, exon, intron, not_annotated reads.

    Reads without barcode or identifier can't be parsed; those whose pass_quality (where there is such a column) is false
    are of low quality; the others are counted by gene and mark.
    """
    broken = F.col("cb").isNull() | F.col("umi").isNull()
    low = ~broken & ~F.coalesce(F.col("pass_quality"), F.lit(True)) if "pass_quality" in reads.columns else F.lit(False)
    good = ~broken & ~low
    bit = lambda b: F.count_if(good & F.col("gene").isNotNull() & (F.col("mark").bitwiseAND(F.lit(b)) != 0))
    return reads.agg(
        F.count("*").alias("total"),
        F.count_if(broken).alias("cant_parse"),
        F.count_if(low).alias("low_quality"),
        F.count_if(good & F.col("gene").isNull()).alias("intergenic"),
        bit(2).alias("exon"),
        bit(4).alias("intron"),
        bit(1).alias("not_annotated"),
    )


def umi_distribution(molecules_: DataFrame, chosen: DataFrame | None = None) -> DataFrame:
    """umi, n: in how many (cell, gene) each occurs."""
    rows = molecules_.join(chosen.select("cb"), "cb", "left_semi") if chosen is not None else molecules_
    return rows.groupBy("umi").agg(F.count("*").alias("n"))


def implicit_umi_distribution(molecules_: DataFrame, length: int, smooth: float, compat: bool = True) -> DataFrame:
    """umi, p, times: probabilities over all 4 ** length identifiers, a row for each that occurs (times 1) and one without a name
    for all others together, which have one probability; compat adds the smoothing four times, as is known.

    times is a decimal: 4 ** 32 and more is no long.
    """
    seen = umi_distribution(molecules_).filter(F.col("umi").rlike(f"^[ACGT]{{{length}}}$"))
    added, every = smooth * (4 if compat else 1), 4**length
    sums = seen.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("kinds")).first()
    total = sums["n"] + added * every
    times = F.lit(1).cast("decimal(38,0)")
    rows = seen.select("umi", ((F.col("n") + added) / F.lit(float(total))).alias("p"), times.alias("times"))
    rest = molecules_.sparkSession.createDataFrame([(None, added / total, str(every - sums["kinds"]))], "umi string, p double, times string")
    return rows.unionByName(rest.withColumn("times", F.col("times").cast("decimal(38,0)")).filter("times > 0"))


def smoothed_umi_distribution(molecules_: DataFrame, length: int, smooth: float, compat: bool = True) -> DataFrame:
    """implicit_umi_distribution() with a row for each of the 4 ** length identifiers: for short ones."""
    spark = molecules_.sparkSession
    found = implicit_umi_distribution(molecules_, length, smooth, compat)
    code = F.lpad(F.conv(F.col("id").cast("string"), 10, 4), length, "0")
    every = spark.range(4**length).select(F.translate(code, "0123", "ACGT").alias("umi"))
    others = found.filter("umi is null").select(F.col("p").alias("_rest"))  # one row
    rest = (others.first() or {"_rest": None})["_rest"]
    return every.join(found.filter("umi is not null"), "umi", "left").select("umi", F.coalesce("p", F.lit(rest)).alias("p"))


def gene_totals(counts_: DataFrame) -> DataFrame:
    return counts_.groupBy("gene").agg(F.sum("n").alias("n"))


def trimmed_umis(molecules_: DataFrame, length: int, from_start: bool = True) -> DataFrame:
    """Identifiers cut to a prefix or suffix, molecules joined again; qual, where there is one (an array of numbers), is
    cut alike and becomes the mean by reads."""
    umi = F.substring("umi", 1, length) if from_start else F.right("umi", F.lit(length))
    rows = molecules_.withColumn("umi", umi)
    if "qual" not in rows.columns:
        return merged_molecules(rows.drop("qual_sum"))
    cut = F.slice("qual", F.lit(1) if from_start else F.greatest(F.size("qual") - (length - 1), F.lit(1)), F.lit(length))
    sums = places(lambda i: F.get("qual", F.lit(i - 1)) * F.col("reads"), length)
    merged = rows.withColumn("qual", cut).groupBy(*KEY).agg(F.sum("reads").alias("reads"), F.expr("bit_or(mark)").alias("mark"), *sums)
    means = F.filter(F.array(*[F.col(f"_{i}") / F.col("reads") for i in range(1, length + 1)]), lambda q: q.isNotNull())
    return merged.select(*KEY, "reads", "mark", means.alias("qual"))


def without_ambiguous_genes(counts_: DataFrame) -> DataFrame:
    """Rows whose gene names one gene."""
    return counts_.filter(~F.contains("gene", F.lit(";")))


def uniquely_mapped(reads: DataFrame) -> DataFrame:
    """Reads (name, organism, ...) whose name maps to one organism."""
    single = reads.groupBy("name").agg(F.count_distinct("organism").alias("_n")).filter("_n = 1").select("name")
    return reads.join(single, "name", "left_semi")
