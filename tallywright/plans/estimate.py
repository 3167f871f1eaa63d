"""The whole estimate: annotated reads to merged cells, corrected identifiers and result tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.operators import identifiers, merging
from tallywright.operators import molecules as mo


@dataclass(frozen=True)
class Settings:
    """merge: none, simple, precise (by chance overlap) or all; a whitelist (part, barcode) with the lengths of its parts
    makes the first two go by it."""

    level: str = mo.DEFAULT_LEVEL
    merge: str = "none"
    min_genes_before: int = 10
    min_genes_after: int = 10
    max_cell_distance: int = 2
    min_merge_fraction: float = 0.2
    max_merge_prob: float = 1e-4
    max_real_merge_prob: float = 1e-7
    max_umi_distance: int = 1
    umi_multiplier: float = 2.0
    directional: bool = False
    top_cells: int = 0
    part_lengths: tuple[int | None, ...] = ()


def merge_targets(molecules: DataFrame, cells: DataFrame, s: Settings, whitelist: DataFrame | None) -> DataFrame | None:
    """Targets by the settings' rule, or None where cells are not merged."""
    if s.merge == "none":
        return None
    if s.merge == "all":
        return merging.all_targets(cells, s.max_cell_distance)
    if whitelist is None:
        if s.merge == "simple":
            return merging.simple_targets(molecules, cells, s.max_cell_distance, s.min_merge_fraction)
        return merging.poisson_simple_targets(molecules, cells, s.max_cell_distance, s.max_real_merge_prob)
    candidates = merging.whitelist_candidates(cells, whitelist, list(s.part_lengths))
    if s.merge == "simple":
        return merging.whitelist_targets(molecules, cells, candidates, s.min_merge_fraction)
    return merging.poisson_whitelist_targets(molecules, cells, candidates, s.max_merge_prob, s.max_real_merge_prob)


def estimate(reads: DataFrame, s: Settings = Settings(), whitelist: DataFrame | None = None) -> dict[str, DataFrame]:
    """Tables by name: molecules, cells, cell_map, count_matrix, count_matrix_raw, velocity, reads_per_chromosome, saturation.

    Only cells of min_genes_before genes take part in merging; identifiers with N are resolved in real cells after it.
    """
    molecules = mo.molecules(reads)
    cells = mo.cells(molecules, s.level)
    big = mo.real_cells(cells, s.min_genes_before)
    targets = merge_targets(molecules.join(big.select("cb"), "cb", "left_semi"), big, s, whitelist)
    cell_map = reads.select(F.col("cb").alias("cb_from"), F.col("cb").alias("cb_to")).limit(0)
    if targets is not None:
        ranks = big.select("cb", F.struct("req_genes", "req_umis", "n_umis", "cb").alias("rank"))
        cell_map = merging.closure(targets, ranks)
        molecules = merging.merge_cells(molecules, cell_map)
    fix = identifiers.directional_targets(molecules, s.umi_multiplier, s.max_umi_distance) if s.directional else identifiers.unknown_base_targets(molecules, s.max_umi_distance)
    molecules = identifiers.apply_targets(molecules, fix)
    cells = mo.cells(molecules, s.level)
    real = mo.real_cells(cells, s.min_genes_before)
    final = mo.filtered_cells(cells, s.min_genes_before, s.min_genes_after, s.top_cells)
    return {
        "molecules": molecules,
        "cells": cells,
        "cell_map": cell_map,
        "count_matrix": mo.count_matrix(molecules, final, s.level),
        "count_matrix_raw": mo.count_matrix(molecules, real, None),
        "velocity": mo.velocity_matrices(molecules, real),
        "reads_per_chromosome": mo.reads_per_chromosome(reads, real),
        "saturation": mo.saturation_info(molecules, real, s.level),
    }
