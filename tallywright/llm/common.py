"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than space, tab, LF, VT, FF and CR.
SEPARATORS = r"[ \t-\r]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Words of a text, unchanged and in order; null gives an empty array."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS, -1), "")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by spark.checkpoint.dir; a temporary one only where that is unset and all runs in one process (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tallywright-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def apart(docs: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """docs with its columns named by their places, so that no helper column is named like one of them, and the new names
    of these; toDF(*docs.columns) names them back."""
    renamed = docs.toDF(*[f"column{i}_" for i in range(len(docs.columns))])
    return renamed, [renamed.columns[docs.columns.index(n)] for n in names]


#: Folders that materialize() has written and discard() has not removed.
WRITTEN: list[str] = []


def discard(spark: SparkSession, since: int, keep: int = 0) -> None:
    """Remove the folders written after the first `since`, but for the last `keep`: nothing that is still read may be among them."""
    gone = WRITTEN[since : len(WRITTEN) - keep]
    for path in gone:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
        WRITTEN.remove(path)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallywright/{tag}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    WRITTEN.append(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if(df: DataFrame, max_rows: int) -> DataFrame:
    """Hint a broadcast only where the (materialised) table is counted to be small; else leave it to the planner."""
    return F.broadcast(df) if df.count() <= max_rows else df
