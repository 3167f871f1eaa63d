"""FASTQ files as tables (file, ord, id, seq, qual), and back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def read_fastq(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Records numbered from 0 within each file. Compressed by extension; a missing last line end is fine.

    Lines are numbered by their place in the file's block plus the lines of the blocks before it, so plain files are
    read by many tasks and records may straddle blocks. A header without @, or a sequence and quality of unequal
    length, raises.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at")
    )
    blocks = lines.groupBy("file", "block").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = F.sum("n").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", "first", F.coalesce(before, F.lit(0)).alias("before"))
    number = F.col("before") + F.col("at") - F.col("first")
    numbered = lines.join(blocks, ["file", "block"]).select("file", "value", number.alias("line"))
    part = lambda k: F.max(F.when(F.col("line") % 4 == k, F.col("value")))
    records = numbered.groupBy("file", F.floor(F.col("line") / 4).alias("ord")).agg(part(0).alias("id"), part(1).alias("seq"), part(3).alias("qual"))
    wrong = F.when(~F.startswith("id", F.lit("@")), "record does not start with @").when(
        F.coalesce(F.length("seq"), F.lit(-1)) != F.coalesce(F.length("qual"), F.lit(-2)), "sequence and quality of unequal length, or the file ended prematurely"
    )
    checked = F.when(wrong.isNotNull(), F.raise_error(F.concat(wrong, F.lit(": "), F.col("file"))).cast("string")).otherwise(F.col("seq"))
    return records.withColumn("seq", checked)


def write_fastq(reads: DataFrame, path: str, records_per_file: int = 0, id_col: str = "read_id") -> None:
    """Compressed FASTQ parts of at most so many records (0: any number)."""
    lines = reads.select(F.concat_ws("\n", id_col, "seq", F.lit("+"), "qual").alias("value"))
    writer = lines.write.option("compression", "gzip")
    (writer.option("maxRecordsPerFile", records_per_file) if records_per_file else writer).text(path)
