"""Read layouts: where a protocol keeps the cell barcode, the molecular identifier and the read of the gene.

A layout takes a table of reads in lock-step (seq1, qual1, seq2, qual2, ...) and adds cb, umi, cb_qual, umi_qual,
tail (bases before the end of the identifier, for trimming), seq, qual and outcome. Reads that don't parse keep their
row with null barcodes and the reason as outcome. PROTOCOLS is open: register a function (reads, config) -> reads.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions.sequences import edit_distance, find_spacer

from .tables import with_once

OK, SHORT = "ok", "short"


@dataclass(frozen=True)
class Layout:
    """Lengths and places of a protocol; only those it uses matter."""

    barcode1: int = 8
    barcode2: int = 8
    umi: int = 6
    tail: int = 8
    spacer: str = ""
    max_spacer_edits: int = 3
    spacer_search: int = 5
    barcode1_longest: int = 11
    mask: str = ""
    mask_edits: tuple[int, ...] = ()
    barcode_parts: tuple[tuple[int, int], ...] = ()
    umi_start: int = 0
    min_gene: int = 10
    library_tag: str = ""
    max_tag_edits: int = 2
    more: dict = field(default_factory=dict)


def cut(column: str, start: Column | int, length: Column | int) -> Column:
    """Substring by 0-based start."""
    start = F.lit(start) if isinstance(start, int) else start
    length = F.lit(length) if isinstance(length, int) else length
    return F.substring(F.col(column), start + 1, length)


def parsed(reads: DataFrame, outcome: Column, gene: int, **parts: Column) -> DataFrame:
    """Adds the parts where the outcome is ok (or `modified`: a spacer with edits)."""
    fine = F.col("outcome").isin(OK, "modified")
    kept = {name: F.when(fine, value) for name, value in parts.items()}
    kept.setdefault("tail", F.lit(""))
    gene_parts = {} if "seq" in kept else {"seq": F.col(f"seq{gene}"), "qual": F.col(f"qual{gene}")}
    return with_once(with_once(reads, {"outcome": outcome}), kept | gene_parts)


def two_barcode_reads(reads: DataFrame, c: Layout) -> DataFrame:
    """Three reads: barcode 1; barcode 2 and identifier; gene."""
    need = c.barcode2 + c.umi
    outcome = F.when(F.length("seq1") < c.barcode1, "short_read1").when(F.length("seq2") < need, "short_read2").otherwise(OK)
    part = lambda k: F.concat(cut(f"{k}1", 0, c.barcode1), cut(f"{k}2", 0, c.barcode2))
    tail = min(c.tail, need)
    return parsed(
        reads, outcome, 3, cb=part("seq"), cb_qual=part("qual"), umi=cut("seq2", c.barcode2, c.umi), umi_qual=cut("qual2", c.barcode2, c.umi), tail=cut("seq2", need - tail, tail)
    )


def two_barcode_reads_with_tag(reads: DataFrame, c: Layout) -> DataFrame:
    """Four reads, the last a library tag that must be near the expected one."""
    near = edit_distance(F.col("seq4"), F.lit(c.library_tag), wildcard=False) <= c.max_tag_edits
    found = two_barcode_reads(reads, c)
    names = ["cb", "cb_qual", "umi", "umi_qual", "tail"]
    found = with_once(found, {"_near": near})
    near = F.col("_near")
    return found.withColumns({n: F.when(near, F.col(n)) for n in names} | {"outcome": F.when(near, F.col("outcome")).otherwise("other_library")}).drop("_near")


def spacer_reads(reads: DataFrame, c: Layout) -> DataFrame:
    """Two reads: barcode 1 of variable length, a spacer, barcode 2, identifier; gene."""
    after = c.barcode2 + c.umi
    found = reads.withColumn("_s", find_spacer(F.col("seq1"), c.spacer, c.max_spacer_edits, c.spacer_search, c.barcode1, c.barcode1_longest, after))
    start, end = F.col("_s.start"), F.col("_s.end")
    part = lambda k: F.concat(cut(f"{k}1", 0, start), cut(f"{k}1", end, c.barcode2))
    umi = lambda k: cut(f"{k}1", end + c.barcode2, c.umi)
    tail = cut("seq1", end + after - c.tail, c.tail)
    return parsed(found, F.col("_s.outcome"), 2, cb=part("seq"), cb_qual=part("qual"), umi=umi("seq"), umi_qual=umi("qual"), tail=tail).drop("_s")


MASK_PART = re.compile(r"\[(\d+)\]|\((\d+)\)|([ACGTN]+)")


def mask_parts(mask: str) -> list[tuple[str, int, str]]:
    """(kind, length, spacer) of [n] (barcode), (n) (identifier) and literal spacers, in order."""
    found = [("cb", int(m[1]), "") if m[1] else ("umi", int(m[2]), "") if m[2] else ("spacer", len(m[3]), m[3]) for m in MASK_PART.finditer(mask)]
    if "".join(f"[{n}]" if k == "cb" else f"({n})" if k == "umi" else s for k, n, s in found) != mask:
        raise ValueError(f"not a mask: {mask}")
    return found


def masked_reads(reads: DataFrame, c: Layout) -> DataFrame:
    """Two reads: parts at fixed places by a mask; gene. Each spacer has its own limit of edits; N is a wildcard in those
    whose limit is above 0."""
    at, spacers = 0, list(c.mask_edits)
    pieces: dict[str, list[tuple[int, int]]] = {"cb": [], "umi": []}
    outcome = None
    for kind, length, text in mask_parts(c.mask):
        if kind == "spacer":
            limit = spacers.pop(0)
            wrong = edit_distance(cut("seq1", at, length), F.lit(text), wildcard=limit > 0) > limit
            label = f"no_spacer{len(c.mask_edits) - len(spacers)}"
            outcome = F.when(wrong, label) if outcome is None else outcome.when(wrong, label)
        else:
            pieces[kind].append((at, length))
        at += length
    short = F.length("seq1") < at
    outcome = F.when(short, SHORT).otherwise(outcome.otherwise(OK) if outcome is not None else F.lit(OK))
    join = lambda k, kind: F.concat(*[cut(f"{k}1", a, n) for a, n in pieces[kind]])
    return parsed(reads, outcome, 2, cb=join("seq", "cb"), cb_qual=join("qual", "cb"), umi=join("seq", "umi"), umi_qual=join("qual", "umi"))


def inline_reads(reads: DataFrame, c: Layout) -> DataFrame:
    """One read: identifier, barcode, gene."""
    head = c.umi + c.barcode1
    outcome = F.when(F.length("seq1") > head + c.min_gene, OK).otherwise(SHORT)
    rest = lambda k: cut(f"{k}1", head, F.length("seq1"))
    return parsed(
        reads, outcome, 1, umi=cut("seq1", 0, c.umi), umi_qual=cut("qual1", 0, c.umi), cb=cut("seq1", c.umi, c.barcode1), cb_qual=cut("qual1", c.umi, c.barcode1), seq=rest("seq"), qual=rest("qual")
    )


def placed_reads(reads: DataFrame, c: Layout) -> DataFrame:
    """Two reads: barcode parts and identifier by (start, length); gene. A short barcode read is skipped."""
    need = max([c.umi_start + c.umi, *(s + n for s, n in c.barcode_parts)])
    outcome = F.when(F.length("seq1") < need, SHORT).otherwise(OK)
    part = lambda k: F.concat(*[cut(f"{k}1", s, n) for s, n in c.barcode_parts])
    umi = lambda k: cut(f"{k}1", c.umi_start, c.umi)
    return parsed(reads, outcome, 2, cb=part("seq"), cb_qual=part("qual"), umi=umi("seq"), umi_qual=umi("qual"))


PROTOCOLS: dict[str, Callable[[DataFrame, Layout], DataFrame]] = {
    "10x": two_barcode_reads,
    "indrop3": lambda reads, c: (two_barcode_reads_with_tag if c.library_tag else two_barcode_reads)(reads, c),
    "indrop": lambda reads, c: (masked_reads if c.mask else spacer_reads)(reads, c),
    "iclip": inline_reads,
    "split_seq": placed_reads,
    "drop_seq": placed_reads,
    "cel_seq2": placed_reads,
    "seq_well": placed_reads,
}
