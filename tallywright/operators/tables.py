"""Small helpers on tables that the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def with_once(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """rows with these columns, each worked out once a row.

    They come out of a generator, which the optimizer neither merges with the expressions above it nor moves filters below.
    """
    kept = [c for c in rows.columns if c not in values]
    return rows.select(*kept, F.inline(F.array(F.struct(*[v.alias(k) for k, v in values.items()]))))


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; one of its own only where that is unset and all runs in one process."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: The scopes that are open in this process, innermost last: the folders written in each.
SCOPES: list[list[str]] = []


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Removes, at its end, the folders that operators have written to the shared one within it. Results that are still to be read
    must have been written elsewhere by then."""
    written: list[str] = []
    SCOPES.append(written)
    try:
        yield
    finally:
        SCOPES[:] = [s for s in SCOPES if s is not written]
        for path in written:
            folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def fresh(spark: SparkSession) -> str:
    """A new folder's path in the shared one; the innermost scope removes it."""
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    if SCOPES:
        SCOPES[-1].append(path)
    return path


def stored(rows: DataFrame) -> DataFrame:
    """A table written to the shared folder and read back, so that later steps neither repeat nor recompute it."""
    spark = rows.sparkSession
    path = fresh(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def numbered(rows: DataFrame, order: list[Column], name: str = "index") -> DataFrame:
    """rows with their place (from 0) in an order, dealt by its ranges, so that no task numbers them all."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order).withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    totals = dealt.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # one row a range
    before = F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    placed = dealt.join(F.broadcast(totals.select("_part", before.alias("_before"))), part == F.col("_part"))
    return placed.withColumn(name, F.col("_before") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))).drop("_m", "_part", "_before")


def broadcast_if(rows: DataFrame, most: int) -> DataFrame:
    """Hints a broadcast where the rows are counted to be few; else the planner chooses."""
    return F.broadcast(rows) if rows.count() <= most else rows
