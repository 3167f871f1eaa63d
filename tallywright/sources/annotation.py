"""Gene annotation (GTF, BED), read parameters and barcode whitelists as tables; configuration files."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.functions.sequences import reverse_complement


def read_gtf(spark: SparkSession, path: str) -> DataFrame:
    """chrom, gene_id, gene_name, transcript_id, start_pos, end_pos (0-based, half-open), kind: exon and intron records.

    Lines with fewer than nine columns go, as do those without attributes or with a dot for chromosome or bounds.
    """
    lines = spark.read.text(path).select(F.trim("value").alias("value")).filter("value != '' and not startswith(value, '#')")
    part = F.split("value", r"\s+")
    rows = lines.select(F.col("value"), part.alias("p")).filter(F.size("p") > 9)
    rows = rows.filter("p[2] in ('exon', 'intron') and p[0] != '.' and p[3] != '.' and p[4] != '.'")
    attribute = lambda name: F.nullif(F.regexp_extract("value", rf'(?:^|[\s;]){name}\s+"?([^";]*)"?', 1), F.lit(""))
    name, id_ = attribute("gene_name"), attribute("gene_id")
    return rows.select(
        F.col("p")[0].alias("chrom"),
        F.coalesce(id_, name).alias("gene_id"),
        F.coalesce(name, id_).alias("gene_name"),
        attribute("transcript_id").alias("transcript_id"),
        (F.col("p")[3].cast("long") - 1).alias("start_pos"),
        F.col("p")[4].cast("long").alias("end_pos"),
        F.col("p")[2].alias("kind"),
    )


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    """The same columns; every record is an exon of the transcript of its name. Fewer than four columns raise."""
    lines = spark.read.text(path).select(F.trim("value").alias("value")).filter("value != '' and not startswith(value, '#')")
    p = F.split("value", r"\s+")
    name = F.when(F.size(p) >= 4, F.get(p, F.lit(3))).otherwise(F.raise_error(F.lit("fewer than four columns")).cast("string"))
    return lines.select(
        p[0].alias("chrom"), name.alias("gene_id"), name.alias("gene_name"), name.alias("transcript_id"), p[1].cast("long").alias("start_pos"), p[2].cast("long").alias("end_pos"), F.lit("exon").alias("kind")
    )


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    kind = re.sub(r"\.gz(ip)?$", "", path)[-3:].lower()
    if kind not in ("gtf", "bed"):
        raise ValueError(f"neither GTF nor BED: {path}")
    return (read_gtf if kind == "gtf" else read_bed)(spark, path)


def trimmed_intron_name(column: str):
    """A BED name before `_intron`, whole where it lacks that."""
    return F.substring_index(column, "_intron", 1)


def read_params(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """name, cb, umi, cb_qual, umi_qual of lines parted by single spaces; malformed lines go, of a name the first stays."""
    lines = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("at"))
    p = F.split("value", " ", 5)
    rows = lines.select(p.alias("p"), "at").filter(F.size("p") == 5).select(F.regexp_replace(F.col("p")[0], "^@", "").alias("name"), *[F.col("p")[i].alias(c) for i, c in enumerate(("cb", "umi", "cb_qual", "umi_qual"), 1)], "at")
    return rows.withColumn("r", F.row_number().over(W.partitionBy("name").orderBy("at"))).filter("r = 1").drop("r", "at")


def with_params(alignments: DataFrame, params: DataFrame) -> DataFrame:
    """Alignments with their read's parameters; the first alignment of a name takes them, later ones and unknown names
    have nulls."""
    first = F.row_number().over(W.partitionBy("name").orderBy("file", "ord")) == 1
    rows = alignments.withColumn("_first", first).join(params, "name", "left")
    return rows.withColumns({c: F.when(F.col("_first"), F.col(c)) for c in ("cb", "umi", "cb_qual", "umi_qual")}).drop("_first")


def read_whitelist(spark: SparkSession, path: str, kind: str = "const") -> DataFrame:
    """part, idx, barcode: one line a part, barcodes parted by spaces. `indrop`: two lines, each reverse-complemented;
    `const`: the barcodes of a line must be of one length."""
    lines = spark.read.text(path).select(F.trim("value").alias("value"), F.monotonically_increasing_id().alias("at")).filter("value != ''")
    numbered = lines.withColumn("part", F.row_number().over(W.orderBy("at")) - 1)
    rows = numbered.select("part", F.posexplode(F.split("value", r"\s+")).alias("idx", "barcode"))
    if kind == "indrop":
        return rows.withColumn("barcode", reverse_complement(F.col("barcode")))
    equal = F.min(F.length("barcode")).over(W.partitionBy("part")) == F.max(F.length("barcode")).over(W.partitionBy("part"))
    return rows.withColumn("barcode", F.when(equal, F.col("barcode")).otherwise(F.raise_error(F.lit("barcodes of unequal length")).cast("string")))


def read_config(path: str) -> dict:
    """An XML configuration as nested dictionaries of strings."""

    def tree(node: ET.Element):
        return {c.tag: tree(c) for c in node} if len(node) else (node.text or "").strip()

    return tree(ET.parse(path).getroot())
