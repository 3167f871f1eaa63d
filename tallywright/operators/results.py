"""Writing results: sparse matrices, tables by name, tagged and filtered alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.sources.bam_writer import write_bam

from .tables import numbered, stored


def indexed(names: DataFrame, column: str) -> DataFrame:
    """Distinct names with their 1-based index in order."""
    found = numbered(names.select(column).distinct(), [F.col(column)])
    return found.withColumn("index", F.col("index") + 1)


def write_matrix_market(counts: DataFrame, path: str) -> None:
    """counts(cb, gene, n) as parts of a coordinate matrix (genes by cells) below `matrix`, its header line below
    `header`, and the names in order below `cells` and `genes`."""
    genes, cells = stored(indexed(counts, "gene")), stored(indexed(counts, "cb"))
    rows = counts.join(genes.withColumnRenamed("index", "i"), "gene").join(cells.withColumnRenamed("index", "j"), "cb")
    rows.select(F.concat_ws(" ", "i", "j", "n").alias("value")).write.text(f"{path}/matrix")
    shape = f"{genes.count()} {cells.count()} {counts.count()}"
    counts.sparkSession.createDataFrame([("%%MatrixMarket matrix coordinate integer general",), (shape,)], "value string").coalesce(1).write.text(f"{path}/header")
    genes.orderBy("index").select(F.col("gene").alias("value")).write.text(f"{path}/genes")
    cells.orderBy("index").select(F.col("cb").alias("value")).write.text(f"{path}/cells")


def write_results(tables: dict[str, DataFrame], path: str) -> None:
    for name, rows in tables.items():
        rows.write.parquet(f"{path}/{name}")


def with_tags(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """rows with these tags set where they have a value, beside the other tags that there are."""
    pairs = F.array(*[F.struct(F.lit(t).alias("key"), v.cast("string").alias("value")) for t, v in values.items()])
    if "tags" in rows.columns:
        others = F.filter(F.map_entries(F.coalesce("tags", F.create_map().cast("map<string,string>"))), lambda p: ~p["key"].isin(*values))
        pairs = F.concat(others, pairs)
    return rows.withColumn("tags", F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull())))


def tagged_alignments(reads: DataFrame) -> DataFrame:
    """Alignments with gene, barcode and read-type tags; a type where the mark is one bit."""
    kind = F.when(F.col("gene").isNull(), "INTERGENIC").when(F.col("mark") == 2, "EXONIC").when(F.col("mark") == 4, "INTRONIC")
    return with_tags(reads, {"GX": F.col("gene"), "CR": F.col("cb"), "UR": F.col("umi"), "RE": kind})


def filtered_alignments(reads: DataFrame, cell_map: DataFrame, umi_map: DataFrame, molecules: DataFrame) -> DataFrame:
    """Alignments of genes whose cell and identifier survive, under the corrected ones."""
    rows = reads.filter("gene is not null").join(cell_map, reads["cb"] == cell_map["cb_from"], "left")
    rows = rows.filter("cb_from is null or cb_to is not null").withColumn("cb", F.coalesce("cb_to", "cb")).drop("cb_from", "cb_to")
    rows = rows.join(umi_map, ["cb", "gene", "umi"], "left").withColumn("umi", F.coalesce("target", "umi")).drop("target")
    return rows.join(molecules.select("cb", "gene", "umi"), ["cb", "gene", "umi"], "left_semi")


def write_tagged(alignments: DataFrame, path: str, sort: bool = False) -> None:
    """tagged_alignments() as BAM files."""
    write_bam(tagged_alignments(alignments), path, sort=sort)


def write_filtered(alignments: DataFrame, cell_map: DataFrame, umi_map: DataFrame, molecules: DataFrame, path: str, sort: bool = False) -> None:
    """filtered_alignments() as BAM files, with the corrected cell and identifier as tags CB and UB and the gene as GX."""
    kept = stored(filtered_alignments(alignments, cell_map, umi_map, molecules))  # read for the references and for the records
    write_bam(with_tags(kept, {"CB": F.col("cb"), "UB": F.col("umi"), "GX": F.col("gene")}), path, sort=sort)
