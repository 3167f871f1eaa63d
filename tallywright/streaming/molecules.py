"""Molecules of a stream of annotated reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def streaming_molecules(reads: DataFrame) -> DataFrame:
    """Running molecules of a streaming table of reads, for output mode `update` or `complete`.

    Reads have no event time, so the state holds every molecule seen.
    """
    return reads.filter("gene is not null").groupBy("cb", "gene", "umi").agg(F.count("*").alias("reads"), F.expr("bit_or(mark)").alias("mark"))
