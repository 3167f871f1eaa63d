"""Merging cells that are one: candidates, targets by several rules, and the closure of targets.

cells: cb, n_genes, n_umis; molecules: cb, gene, umi. A rule gives (cb_from, cb_to), all judged before any merge; a null
target excludes the cell. Ties go by total orders, so results do not depend on partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tallywright.functions import matching
from tallywright.functions import statistics as st
from tallywright.functions.sequences import edit_distance

from .molecules import merged_molecules
from .tables import numbered, stored, with_once

#: Whitelist candidates further than this are not looked at.
MAX_WHITELIST_DISTANCE = 5


def shared_molecules(molecules: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """cb_a, cb_b, shared: (gene, umi) pairs two different cells have in common, where there are any.

    With pairs(cb_a, cb_b), only of those: the molecules of the smaller cell of a pair are looked up in the larger one by
    (cell, gene, umi), so neither a molecule of very many cells nor a large cell is a hot key. Without, all pairs of
    cells are asked for, and a (gene, umi) of m cells gives m * (m - 1) of them.
    """
    keys = ["gene", "umi"]
    rows = molecules.select(*keys, "cb").distinct()
    if pairs is None:
        a, b = rows.withColumnRenamed("cb", "cb_a"), rows.withColumnRenamed("cb", "cb_b")
        return a.join(b, keys).filter("cb_a != cb_b").groupBy("cb_a", "cb_b").agg(F.count("*").alias("shared"))
    sizes = rows.groupBy("cb").agg(F.count("*").alias("_n"))
    side = lambda x: sizes.select(F.col("cb").alias(f"cb_{x}"), F.struct("_n", "cb").alias(f"_{x}"))
    asked = pairs.select("cb_a", "cb_b").filter("cb_a != cb_b").distinct().join(side("a"), "cb_a").join(side("b"), "cb_b")
    asked = asked.select("cb_a", "cb_b", F.least("_a", "_b")["cb"].alias("_low"), F.greatest("_a", "_b")["cb"].alias("_high"))
    once = asked.select("_low", "_high").distinct()
    met = once.join(rows.withColumnRenamed("cb", "_low"), "_low").join(rows.withColumnRenamed("cb", "_high"), ["_high", *keys])
    return asked.join(met.groupBy("_low", "_high").agg(F.count("*").alias("shared")), ["_low", "_high"]).select("cb_a", "cb_b", "shared")


#: Strings that every task may be handed, to be compared with all others; unknown bases that an indexed string may have.
LISTED, MOST_UNKNOWN = 2_000, 3


def scanned(ones: DataFrame, listed: DataFrame, count: int, k: int, most: int) -> DataFrame:
    """(_a, _b, distance) of ones(_a) with all of listed(_b), compared in Arrow batches; at most about `most` of these are handed to a
    task, more go in so many turns over the others."""
    turns, found = -(-count // most), None
    for turn in range(turns):
        part = [r["_b"] for r in listed.filter(F.pmod(F.xxhash64("_b"), F.lit(turns)) == turn).collect()]

        def compare(batches: Iterator[pa.RecordBatch], part: list[str] = part) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for start in range(0, len(batch), 5_000):
                    texts = batch.column(0).slice(start, 5_000)
                    i, j, d = matching.near_pairs(texts.to_pylist(), part, k)
                    yield pa.RecordBatch.from_arrays([texts.take(pa.array(i)), pa.array(part, pa.string()).take(pa.array(j)), pa.array(d, pa.int32())], ["_a", "_b", "distance"])

        near = ones.mapInArrow(compare, "_a string, _b string, distance int")
        found = near if found is None else found.unionByName(near)
    return ones.sparkSession.createDataFrame([], "_a string, _b string, distance int") if found is None else found


def deletion_keys(strings: DataFrame, column: str, sizes: dict[int, list[int]]) -> DataFrame:
    """(column, _key, _size): a row for each different subsequence of a string of the lengths that sizes has for its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, len(batch), 1_000):
                part = batch.column(0).slice(start, 1_000)
                owner, key, size = matching.deletion_keys(part.to_pylist(), sizes)
                yield pa.RecordBatch.from_arrays([part.take(pa.array(owner)), pa.array(key), pa.array(size, pa.int32())], [column, "_key", "_size"])

    return strings.select(column).mapInArrow(run, f"{column} string, _key bigint, _size int")


def selective(n: int, m: int, k: int) -> bool:
    """Whether unrelated strings of n and m bases meet under less than one key of subsequences."""
    size = max(n, m) - k
    return size > 0 and comb(n, size) * comb(m, size) <= 4**size


def near_strings(left: DataFrame, a: str, right: DataFrame, b: str, k: int, listed: int = LISTED) -> DataFrame:
    """(a, b, distance) for the strings of two tables that are at most k edits apart; N equals anything. Nulls are near nothing.

    Strings within k edits have a common subsequence of the longer one's length less k. So where neither table is small, the
    subsequences of that length are the join keys (a symmetric index of deletions): a key belongs to the strings that k
    insertions make of it, however many strings there are, so none is hot. A table of at most `listed` strings is handed to
    all tasks instead, which compare bit-parallel; so are, in turns, strings of many unknown bases, and those so short for k
    that their subsequences tell nothing apart. Comparing takes strings of at most 64 letters on one side.
    """
    ones = stored(left.select(F.col(a).alias("_a")).filter("_a is not null").distinct())
    others = stored(right.select(F.col(b).alias("_b")).filter("_b is not null").distinct())
    shape = lambda rows, c: {(r["n"], r["rich"]): r["count"] for r in rows.groupBy(F.length(c).alias("n"), rich(c).alias("rich")).count().collect()}  # noqa: E731  (a row a length)
    rich = lambda c: F.length(F.regexp_replace(c, "[^N]", "")) > MOST_UNKNOWN
    mine, theirs = shape(ones, "_a"), shape(others, "_b")
    n_ones, n_others = sum(mine.values()), sum(theirs.values())
    turned = lambda rows, c, to: rows.select(F.col(c).alias(to))
    flipped = lambda near: near.select(F.col("_b").alias("_a"), F.col("_a").alias("_b"), "distance")
    lengths = [sorted({n for n, is_rich in side if not is_rich}) for side in (mine, theirs)]
    meeting = [(n, m) for n in lengths[0] for m in lengths[1] if abs(n - m) <= k]
    if min(n_ones, n_others) <= listed or not all(selective(n, m, k) for n, m in meeting):
        if n_others <= n_ones:
            near = scanned(ones, others, n_others, k, listed)
        else:
            near = flipped(scanned(turned(others, "_b", "_a"), turned(ones, "_a", "_b"), n_ones, k, listed))
        return near.select(F.col("_a").alias(a), F.col("_b").alias(b), "distance")
    sizes = [{n: sorted({max(n, m) - k for x, m in ((p[side], p[1 - side]) for p in meeting) if x == n}) for n in lengths[side]} for side in (0, 1)]
    plain = deletion_keys(ones.filter(~rich("_a")), "_a", sizes[0])
    # the planner takes keys to be as few as strings: no broadcast by that guess
    met = plain.hint("merge").join(deletion_keys(others.filter(~rich("_b")), "_b", sizes[1]), ["_key", "_size"])
    met = met.filter(F.col("_size") == F.greatest(F.length("_a"), F.length("_b")) - k).select("_a", "_b").distinct()
    near = with_once(met, {"distance": edit_distance(F.col("_a"), F.col("_b"))}).filter(F.col("distance") <= k)
    unknown = [sum(n for (_, is_rich), n in side.items() if is_rich) for side in (mine, theirs)]
    near = near.unionByName(scanned(ones, others.filter(rich("_b")), unknown[1], k, listed))
    near = near.unionByName(flipped(scanned(turned(others.filter(~rich("_b")), "_b", "_a"), turned(ones.filter(rich("_a")), "_a", "_b"), unknown[0], k, listed)))
    return near.select(F.col("_a").alias(a), F.col("_b").alias(b), "distance")


def neighbouring(molecules: DataFrame, cells: DataFrame, k: int) -> DataFrame:
    """cb_a, cb_b, shared: cells with molecules in common, b of no fewer genes, barcodes at most k edits apart.

    Barcodes are compared before molecules are, so a molecule that very many cells have costs no pairs of cells.
    """
    sizes = cells.select("cb", "n_genes")
    side = lambda x: sizes.select(F.col("cb").alias(f"cb_{x}"), F.col("n_genes").alias(f"_{x}"))
    near = near_strings(sizes, "cb", sizes.withColumnRenamed("cb", "_cb"), "_cb", k).select(F.col("cb").alias("cb_a"), F.col("_cb").alias("cb_b"))
    near = near.join(side("a"), "cb_a").join(side("b"), "cb_b").filter("_b >= _a and cb_a != cb_b")
    return shared_molecules(molecules, near)


def with_sizes(pairs: DataFrame, cells: DataFrame) -> DataFrame:
    side = lambda s: cells.select(F.col("cb").alias(f"cb_{s}"), F.col("n_umis").alias(f"umis_{s}"), F.col("n_genes").alias(f"genes_{s}"))
    return pairs.join(side("a"), "cb_a").join(side("b"), "cb_b")


def overlap() -> Column:
    return F.lit(0.5) * F.col("shared") * (F.lit(1.0) / F.col("umis_a") + F.lit(1.0) / F.col("umis_b"))


def best_of(pairs: DataFrame, *order: Column) -> DataFrame:
    ranked = pairs.withColumn("_r", F.row_number().over(W.partitionBy("cb_a").orderBy(*order)))
    return ranked.filter("_r = 1").drop("_r")


def simple_targets(molecules: DataFrame, cells: DataFrame, max_distance: int, min_fraction: float = 0.2) -> DataFrame:
    """Without a whitelist: among cells of as many genes that share molecules and whose barcode is nearer than
    max_distance, the one of the largest overlap, if that reaches min_fraction; else the cell itself.

    Ties go to more genes, then to the smaller barcode.
    """
    pairs = with_sizes(neighbouring(molecules, cells, max_distance - 1), cells).withColumn("fraction", overlap())
    best = best_of(pairs, F.desc(F.round("fraction", 5)), F.desc("genes_b"), F.asc("cb_b")).filter(F.col("fraction") >= min_fraction)
    return cells.select("cb").join(best.select(F.col("cb_a").alias("cb"), "cb_b"), "cb", "left").select(F.col("cb").alias("cb_from"), F.coalesce("cb_b", "cb").alias("cb_to"))


def whitelist_candidates(cells: DataFrame, whitelist: DataFrame, lengths: list[int]) -> DataFrame:
    """cb, barcode, distance: whitelist barcodes whose parts are at most MAX_WHITELIST_DISTANCE away in sum.

    Distances are taken between the distinct observed parts and the whitelist's, then joined; lengths: of all parts but
    one are fixed, None stands for the rest.
    """
    starts, parts = 1, []
    for n in lengths:
        parts.append(F.substring(F.col("cb"), F.lit(starts), F.lit(n)) if n else F.expr(f"substring(cb, {starts})"))
        starts += n or 0
    rows = cells.select("cb").withColumns({f"p{k}": p for k, p in enumerate(parts)}).withColumns({"barcode": F.lit(""), "distance": F.lit(0)})
    for k in range(len(parts)):
        mine = whitelist.filter(F.col("part") == k).select(F.col("barcode").alias("_b"))
        seen = rows.select(F.col(f"p{k}").alias("_p")).distinct()
        near = near_strings(seen, "_p", mine, "_b", MAX_WHITELIST_DISTANCE).withColumnRenamed("distance", "_d")
        rows = rows.join(near, F.col(f"p{k}") == F.col("_p")).filter(F.col("distance") + F.col("_d") <= MAX_WHITELIST_DISTANCE)
        rows = rows.withColumns({"barcode": F.concat("barcode", "_b"), "distance": F.col("distance") + F.col("_d")}).drop("_p", "_b", "_d")
    return rows.select("cb", "barcode", "distance")


def whitelist_neighbours(cells: DataFrame, candidates: DataFrame, slack: bool = False) -> DataFrame:
    """cb_a, cb_b, distance: cells on the whitelist, with as many molecules, at the least distance that has any.

    slack: up to 2 where that distance is 0, else one more.
    """
    sizes = cells.select(F.col("cb").alias("cb_b"), F.col("n_umis").alias("_b"))
    own = cells.select(F.col("cb").alias("cb_a"), F.col("n_umis").alias("_a"))
    rows = candidates.select(F.col("cb").alias("cb_a"), F.col("barcode").alias("cb_b"), "distance").join(sizes, "cb_b").join(own, "cb_a").filter("_b >= _a")
    least = F.min("distance").over(W.partitionBy("cb_a"))
    limit = F.when(least == 0, 2).otherwise(least + 1) if slack else least
    return rows.withColumn("_limit", limit).filter("distance <= _limit").select("cb_a", "cb_b", "distance")


def whitelist_targets(molecules: DataFrame, cells: DataFrame, candidates: DataFrame, min_fraction: float = 0.2) -> DataFrame:
    """With a whitelist: a cell that is on it stays; else the neighbour of the largest overlap, if that reaches
    min_fraction; else the cell is excluded (null)."""
    near = whitelist_neighbours(cells, candidates)
    shared = shared_molecules(molecules, near)
    pairs = with_sizes(near.join(shared, ["cb_a", "cb_b"], "left").fillna(0, ["shared"]), cells).withColumn("fraction", overlap())
    itself = F.col("cb_a") == F.col("cb_b")
    best = best_of(pairs, F.desc(itself), F.desc("fraction"), F.asc("cb_b")).filter(itself | (F.col("fraction") >= min_fraction))
    return cells.select(F.col("cb").alias("cb_from")).join(best.select(F.col("cb_a").alias("cb_from"), F.col("cb_b").alias("cb_to")), "cb_from", "left")


def all_targets(cells: DataFrame, max_distance: int) -> DataFrame:
    """Every larger cell near enough is a candidate: the nearest, then the largest, then the smaller barcode."""
    sizes = cells.select("cb", "n_umis")
    side = lambda x: sizes.select(F.col("cb").alias(f"cb_{x}"), F.col("n_umis").alias(f"_{x}"))
    near = near_strings(side("a"), "cb_a", side("b"), "cb_b", max_distance).join(side("a"), "cb_a").join(side("b"), "cb_b").filter("_b > _a")
    best = best_of(near, F.asc("distance"), F.desc("_b"), F.asc("cb_b"))
    return cells.select(F.col("cb").alias("cb_from")).join(best.select(F.col("cb_a").alias("cb_from"), "cb_b"), "cb_from", "left").select("cb_from", F.coalesce("cb_b", "cb_from").alias("cb_to"))


def chance_overlap(molecules: DataFrame, pairs: DataFrame) -> DataFrame:
    """pairs(cb_a, cb_b, shared) with expected and p_value: how likely two cells share so many molecules by chance.

    Identifiers are drawn by their frequency; the number of molecules behind the distinct identifiers of a gene comes
    from the collision table; expectations are worked out once for each pair of gene sizes, of which there are few. Only
    the histogram of frequencies (distinct counts) and the largest gene's size reach the driver.
    """
    histogram = molecules.groupBy("umi").agg(F.count("*").alias("n")).groupBy("n").agg(F.count("*").alias("w")).orderBy("n").collect()
    total = sum(r["n"] * r["w"] for r in histogram)
    p, w = np.array([r["n"] / total for r in histogram]), np.array([r["w"] for r in histogram])
    genes = molecules.groupBy("cb", "gene").agg(F.count("*").alias("n"))
    largest = genes.agg(F.max("n")).first()[0] or 1
    table = st.collision_table(p, w, largest) if total else [1]
    a, b = genes.select(F.col("cb").alias("cb_a"), "gene", F.col("n").alias("na")), genes.select(F.col("cb").alias("cb_b"), "gene", F.col("n").alias("nb"))
    both = pairs.filter("shared > 0").select("cb_a", "cb_b").join(a, "cb_a").join(b, ["cb_b", "gene"])
    sized = both.groupBy("cb_a", "cb_b", F.least("na", "nb").alias("x"), F.greatest("na", "nb").alias("y")).agg(F.count("*").alias("c"))

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for df in batches:
            yield df.assign(e=[st.expected_intersection(p, w, table[x - 1], table[y - 1]) for x, y in zip(df["x"], df["y"], strict=True)])

    expected = sized.select("x", "y").distinct().mapInPandas(expect, "x long, y long, e double")
    sums = sized.join(expected, ["x", "y"]).groupBy("cb_a", "cb_b").agg(F.sum(F.col("c") * F.col("e")).alias("expected"))
    found = pairs.join(sums, ["cb_a", "cb_b"], "left").fillna(0.0, ["expected"])
    return found.withColumn("p_value", F.when(F.col("shared") == 0, 1.0).otherwise(st.poisson_upper(F.col("shared"), F.col("expected"))))


def poisson_simple_targets(molecules: DataFrame, cells: DataFrame, max_distance: int, threshold: float = 1e-7) -> DataFrame:
    """Without a whitelist: the candidate whose overlap is least likely by chance, if that is at most the threshold over
    the number of candidates; else the cell itself."""
    pairs = neighbouring(molecules, cells, max_distance)
    judged = chance_overlap(molecules, pairs).withColumn("_n", F.count("*").over(W.partitionBy("cb_a")))
    best = best_of(judged, F.asc("p_value"), F.desc("shared"), F.asc("cb_b")).filter(F.col("p_value") <= threshold / F.col("_n"))
    return cells.select(F.col("cb").alias("cb_from")).join(best.select(F.col("cb_a").alias("cb_from"), "cb_b"), "cb_from", "left").select("cb_from", F.coalesce("cb_b", "cb_from").alias("cb_to"))


def poisson_whitelist_targets(molecules: DataFrame, cells: DataFrame, candidates: DataFrame, own: float = 1e-4, other: float = 1e-7) -> DataFrame:
    """With a whitelist: as whitelist_targets(), by the chance of the overlap; `own` is the threshold for cells that are
    on the whitelist themselves, which stay where no one passes, `other` for those that are not and are then excluded."""
    near = whitelist_neighbours(cells, candidates, slack=True)
    listed = near.filter("cb_a = cb_b").select("cb_a", F.lit(True).alias("_listed")).distinct()
    others = near.filter("cb_a != cb_b")
    pairs = others.join(shared_molecules(molecules, others), ["cb_a", "cb_b"], "left").fillna(0, ["shared"]).select("cb_a", "cb_b", "shared")
    judged = chance_overlap(molecules, pairs).join(listed, "cb_a", "left").withColumn("_n", F.count("*").over(W.partitionBy("cb_a")) + F.coalesce(F.col("_listed").cast("int"), F.lit(0)))
    limit = F.when(F.col("_listed"), own).otherwise(other) / F.col("_n")
    best = best_of(judged, F.asc("p_value"), F.desc("shared"), F.asc("cb_b")).filter(F.col("p_value") <= limit).select(F.col("cb_a").alias("cb"), "cb_b")
    rows = cells.select("cb").join(best, "cb", "left").join(listed.withColumnRenamed("cb_a", "cb"), "cb", "left")
    return rows.select(F.col("cb").alias("cb_from"), F.coalesce("cb_b", F.when(F.col("_listed"), F.col("cb"))).alias("cb_to"))


def closure(targets: DataFrame, ranks: DataFrame, max_rounds: int = 40) -> DataFrame:
    """cb_from, cb_to with each cell at the end of its chain of targets; a null target ends a chain (excluded).

    ranks: cb, rank, unique, in the order in which merges are applied. A cycle ends at its highest-ranked member. Chains
    halve each round: targets are followed to the targets' targets, keeping the highest rank met on a cycle.
    """
    t = targets.join(ranks.select(F.col("cb").alias("cb_from"), "rank"), "cb_from")
    moves = t.filter("cb_to is not null and cb_to != cb_from").select("cb_from", "cb_to", "rank")
    ends = t.filter("cb_to is null or cb_to = cb_from").select(F.col("cb_from").alias("cb_from"), F.col("cb_to"))
    moves, ends = stored(moves), stored(ends)
    walk = moves.select("cb_from", "cb_to", F.struct("rank", F.col("cb_from").alias("cb")).alias("top"))
    rounds = max(1, int(np.ceil(np.log2(max(2, moves.count())))) + 1)
    if rounds > max_rounds:
        raise ValueError("too many cells to chain")
    for _ in range(rounds):
        step = walk.select(F.col("cb_from").alias("_mid"), F.col("cb_to").alias("_to"), F.col("top").alias("_top"))
        joined = walk.join(step, walk["cb_to"] == step["_mid"], "left")
        moved = F.coalesce(F.col("_to") != F.col("cb_to"), F.lit(False))
        walk = stored(joined.select("cb_from", F.coalesce("_to", "cb_to").alias("cb_to"), F.greatest("top", "_top").alias("top"), moved.alias("_moved")))
        if not walk.filter("_moved").head(1):
            break
    # what still moves after so many steps is on a cycle or leads to one; a cycle's own members know its highest rank
    stuck = walk.join(moves.select(F.col("cb_from").alias("_m")), walk["cb_to"] == F.col("_m"), "left_semi")
    cycle = stuck.select(F.col("cb_to").alias("_c")).distinct().join(walk.select(F.col("cb_from").alias("_c"), F.col("top.cb").alias("_root")), "_c")
    resolved = walk.join(cycle, walk["cb_to"] == cycle["_c"], "left").select("cb_from", F.coalesce("_root", "cb_to").alias("_end"))
    final = ends.select(F.col("cb_from").alias("_end"), F.col("cb_to").alias("_final"), F.lit(True).alias("_is_end"))
    done = resolved.join(final, "_end", "left").select("cb_from", F.when(F.col("_is_end"), F.col("_final")).otherwise(F.col("_end")).alias("cb_to"))
    return done.unionByName(ends)


def merge_cells(molecules: DataFrame, cell_map: DataFrame) -> DataFrame:
    """Molecules under the barcodes of their targets, joined again; those of excluded cells go."""
    known = molecules.join(cell_map, molecules["cb"] == cell_map["cb_from"], "left")
    rows = known.filter("cb_from is null or cb_to is not null").withColumn("_source", F.struct(F.coalesce(F.col("cb_to") != F.col("cb"), F.lit(False)), "cb"))
    return merged_molecules(rows.withColumn("cb", F.coalesce("cb_to", "cb")).drop("cb_from", "cb_to"))


def counters_after_merge(cells: DataFrame, cell_map: DataFrame) -> DataFrame:
    """cb, n_umis, n_reads as counters: sums over the members, shared molecules counted again."""
    rows = cells.join(cell_map, cells["cb"] == cell_map["cb_from"], "left").filter("cb_from is null or cb_to is not null")
    return rows.groupBy(F.coalesce("cb_to", "cb").alias("cb")).agg(F.sum("n_umis").alias("n_umis"), F.sum("n_reads").alias("n_reads"))


def merge_validation(molecules: DataFrame, cells: DataFrame, pairs: int, least: int, most: int, seed: int = 48) -> DataFrame:
    """Chance overlap of randomly paired cells whose barcodes are between `least` and `most` edits apart.

    Cells are drawn by hashes of their numbers, so reruns draw the same pairs; of more pairs than asked for, those of the
    smallest hashes are taken.
    """
    cells = numbered(cells.select("cb"), [F.xxhash64("cb", F.lit(seed)), F.col("cb")], "i")
    n = cells.count()
    draw = lambda salt: F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(max(n, 1)))
    drawn = cells.sparkSession.range(2 * pairs).select(draw("a").alias("ia"), draw("b").alias("ib")).filter("ia != ib").distinct()
    named = drawn.join(cells.select(F.col("i").alias("ia"), F.col("cb").alias("cb_a")), "ia").join(cells.select(F.col("i").alias("ib"), F.col("cb").alias("cb_b")), "ib")
    near = with_once(named.select("cb_a", "cb_b"), {"distance": edit_distance(F.col("cb_a"), F.col("cb_b"))}).filter(F.col("distance").between(least, most))
    near = stored(near.orderBy(F.xxhash64("cb_a", "cb_b", F.lit(seed)), "cb_a", "cb_b").limit(pairs))
    found = near.join(shared_molecules(molecules, near), ["cb_a", "cb_b"], "left").fillna(0, ["shared"]).select("cb_a", "cb_b", "distance", "shared")
    return chance_overlap(molecules, found)
