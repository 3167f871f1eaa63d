"""Correcting molecular identifiers within a gene of a cell."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.functions.sequences import edit_distance_of, filled, hamming_distance, neighbours

from .molecules import KEY, merged_molecules

GROUP = ["cb", "gene"]


def apply_targets(molecules: DataFrame, targets: DataFrame) -> DataFrame:
    """molecules with identifiers replaced by targets(cb, gene, umi, target), joined again."""
    rows = molecules.join(targets, KEY, "left").withColumn("_source", F.struct(F.coalesce(F.col("target") != F.col("umi"), F.lit(False)), "umi"))
    return merged_molecules(rows.withColumn("umi", F.coalesce("target", "umi")).drop("target"))


def unknown_base_targets(molecules: DataFrame, max_distance: int = 1) -> DataFrame:
    """(cb, gene, umi, target) for identifiers with N: the nearest one without, by Hamming distance with N as wildcard,
    then of more reads, then the smaller; where none is near enough, N is filled by a hash of the keys."""
    bad = molecules.filter(F.contains("umi", F.lit("N"))).select(*KEY)
    good = molecules.filter(~F.contains("umi", F.lit("N"))).select(*GROUP, F.col("umi").alias("target"), "reads")
    pairs = bad.join(good, GROUP).filter(F.length("umi") == F.length("target")).withColumn("d", hamming_distance(F.col("umi"), F.col("target"))).filter(F.col("d") <= max_distance)
    best = pairs.withColumn("r", F.row_number().over(W.partitionBy(*KEY).orderBy("d", F.desc("reads"), "target"))).filter("r = 1")
    rows = bad.join(best.select(*KEY, "target"), KEY, "left")
    return rows.select(*KEY, F.coalesce("target", filled(F.col("umi"), F.col("cb"), F.col("gene"))).alias("target"))


def adjacent(molecules: DataFrame) -> DataFrame:
    """cb, gene, umi, reads, other, other_reads: ordered pairs of one gene at Hamming distance 1.

    Each identifier's neighbours are spelled out, which makes the similarity join an equi-join.
    """
    spelled = molecules.select(*KEY, "reads", F.explode(neighbours(F.col("umi"))).alias("other"))
    return spelled.join(molecules.select(*GROUP, F.col("umi").alias("other"), F.col("reads").alias("other_reads")), [*GROUP, "other"])


def directional_pairs(molecules: DataFrame, multiplier: float = 2.0) -> DataFrame:
    """(cb, gene, umi, target) at distance 1 without N: the adjacent identifier of most reads that has `multiplier` times
    the reads, then the smaller; one step, not followed further."""
    rows = adjacent(molecules).filter(F.col("reads") * multiplier <= F.col("other_reads"))
    best = rows.withColumn("r", F.row_number().over(W.partitionBy(*KEY).orderBy(F.desc("other_reads"), "other"))).filter("r = 1")
    return best.select(*KEY, F.col("other").alias("target"))


def followed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (cb, gene, umi, target): the targets at the ends of their chains."""
    at, chain = None, {}

    def close() -> pa.RecordBatch:
        ends = {}
        for src in chain:
            path = [src]
            while path[-1] in chain and path[-1] not in ends:
                path.append(chain[path[-1]])
            for x in path[:-1]:
                ends[x] = ends.get(path[-1], path[-1])
        columns = [[at[0]] * len(ends), [at[1]] * len(ends), list(ends), list(ends.values())]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], [*KEY, "target"])

    for b in batches:
        for cb, gene, umi, target in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (cb, gene) != at:
                if chain:
                    yield close()
                at, chain = (cb, gene), {}
            chain[umi] = target
    if chain:
        yield close()


def directional_targets(molecules: DataFrame, multiplier: float = 2.0, max_distance: int = 1) -> DataFrame:
    """(cb, gene, umi, target) of the directional rule for any distance and with N, chains followed from the top.

    At distance 1 (and a multiplier above 1), genes whose identifiers have no N and one length go by an equi-join on
    spelled-out neighbours; others are compared within their group, the identifiers of one gene in one cell.
    """
    wild, group_ = F.contains("umi", F.lit("N")), W.partitionBy(*GROUP)
    size = F.length("umi")
    flagged = molecules.select(*KEY, "reads").withColumns(
        {"_several": F.count("*").over(group_) > 1, "_plain": ~F.max(wild).over(group_) & (F.min(size).over(group_) == F.max(size).over(group_))}
    )
    plain = F.col("_plain") if max_distance == 1 and multiplier > 1 else F.lit(False)
    pairs = directional_pairs(flagged.filter(plain & F.col("_several")).select(*KEY, "reads"), multiplier)
    found = pairs.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(followed, "cb string, gene string, umi string, target string")
    rows = flagged.filter(~plain & (F.col("_several") | wild)).select(*KEY, "reads", filled(F.col("umi"), F.col("cb"), F.col("gene")).alias("fill"))

    def group(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values(["reads", "umi"], ascending=[True, False])  # of equal reads the smaller identifier comes first from the top
        umis, reads, fills = df["umi"].tolist(), df["reads"].tolist(), df["fill"].tolist()
        targets: dict[str, str] = {}
        for i, src in enumerate(umis):
            best, least = None, max_distance + 1
            for j in range(len(umis) - 1, i, -1):
                if reads[i] * multiplier > reads[j]:
                    break
                d = edit_distance_of(src, umis[j])
                if d < least:
                    best, least = umis[j], d
                    if d == 0 or d <= 1 and "N" not in src:
                        break
            if best is None and "N" in src:
                best = fills[i]
            if best is not None:
                targets[src] = best
        for src in reversed(umis):
            if src in targets and targets[src] in targets:
                targets[src] = targets[targets[src]]
        rows = [(df["cb"].iloc[0], df["gene"].iloc[0], src, dst) for src, dst in targets.items()]
        return pd.DataFrame(rows, columns=[*KEY, "target"], dtype=object)

    return found.unionByName(rows.groupBy(*GROUP).applyInPandas(group, "cb string, gene string, umi string, target string"))


def neighbour_counts(molecules: DataFrame) -> DataFrame:
    """cb, gene, umi, smaller, larger, total: adjacent identifiers of at most as many, or more, reads."""
    pairs = adjacent(molecules).groupBy(*KEY).agg(
        F.count_if(F.col("other_reads") <= F.col("reads")).alias("smaller"), F.count_if(F.col("other_reads") > F.col("reads")).alias("larger"), F.count("*").alias("total")
    )
    return molecules.select(*KEY).join(pairs, KEY, "left").fillna(0, ["smaller", "larger", "total"])


def classic_filter(molecules: DataFrame, multiplier: float = 1.0) -> DataFrame:
    """Molecules that no adjacent one outweighs `multiplier` times; of a pair that outweigh each other the smaller goes."""
    pairs = adjacent(molecules).filter(F.col("other_reads") >= F.col("reads") * multiplier - 1e-8)
    mutual = F.col("reads") >= F.col("other_reads") * multiplier - 1e-8
    lost = pairs.filter(~mutual | (F.col("reads") < F.col("other_reads")) | ((F.col("reads") == F.col("other_reads")) & (F.col("umi") > F.col("other"))))
    return molecules.join(lost.select(*KEY).distinct(), KEY, "left_anti")
