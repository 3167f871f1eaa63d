"""Column functions on nucleotide sequences, barcodes and base qualities.

N stands for any base. Positions are 0-based where a name says `start` or `end`. Builtin functions throughout; an Arrow
UDF serves only what they cannot say: edit distance with wildcards and the search for a modified spacer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import matching

BASES = "ACGT"
#: Offset of base qualities in ASCII.
QUALITY_OFFSET = 33


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTN", "TGCAN"))


def characters(s: Column) -> Column:
    return F.when(F.length(s) > 0, F.split(s, "")).otherwise(F.array().cast("array<string>"))


def hamming_distance(a: Column, b: Column, wildcard: bool = True) -> Column:
    """Places at which two strings of one length differ; with wildcard, N equals anything. Unequal lengths raise."""

    def differs(x: Column, y: Column) -> Column:
        unequal = x != y
        return F.when(unequal & (x != "N") & (y != "N") if wildcard else unequal, 1).otherwise(0)

    found = F.aggregate(F.zip_with(characters(a), characters(b), differs), F.lit(0), lambda acc, x: acc + x)
    return F.when(F.length(a) == F.length(b), found).otherwise(F.raise_error(F.lit("strings of unequal length")).cast("int"))


def edit_distance_of(a: str, b: str) -> int:
    """Levenshtein distance in which N equals anything."""
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            same = x == y or x == "N" or y == "N"
            row.append(min(above[j - 1] + (not same), above[j] + 1, row[j - 1] + 1))
        above = row
    return above[-1]


@F.arrow_udf(T.IntegerType())
def _wild_edit_distance(a: pa.Array, b: pa.Array) -> pa.Array:
    asked = pc.and_(pc.is_valid(a), pc.is_valid(b))
    x, y = a.filter(asked).to_pylist(), b.filter(asked).to_pylist()
    long = [min(len(i), len(j)) > matching.WORD for i, j in zip(x, y, strict=True)]
    found = matching.pair_distances([i if not skip else "" for i, skip in zip(x, long)], [j if not skip else "" for j, skip in zip(y, long)])
    for k, skip in enumerate(long):  # strings of over 64 letters on both sides
        if skip:
            found[k] = edit_distance_of(x[k], y[k])
    out = np.zeros(len(a), np.int32)
    mask = asked.to_numpy(zero_copy_only=False)
    out[mask] = found
    return pa.array(out, pa.int32(), mask=~mask)


def edit_distance(a: Column, b: Column, wildcard: bool = True) -> Column:
    """Levenshtein distance; with wildcard, N equals anything. Pairs without N stay with the builtin function."""
    if not wildcard:
        return F.levenshtein(a, b)
    wild = F.contains(a, F.lit("N")) | F.contains(b, F.lit("N"))
    # the UDF sees nulls for the pairs that don't need it
    slow = _wild_edit_distance(F.when(wild, a), F.when(wild, b))
    return F.when(wild, slow).otherwise(F.levenshtein(a, b))


def phred(quality: Column) -> Column:
    """Base qualities as an array of numbers."""
    return F.transform(characters(quality), lambda c: F.ascii(c) - QUALITY_OFFSET)


def mean_quality(sums: Column, reads: Column) -> Column:
    """Mean quality of each place from sums of ASCII codes. As in the reference, the offset is taken off the sum once."""
    return F.transform(sums, lambda s: F.floor((s - QUALITY_OFFSET) / reads).cast("long"))


def all_above(quality: Column, least: int) -> Column:
    """Whether each base reaches `least`; always so where least is 0 or less."""
    return F.lit(True) if least <= 0 else F.forall(phred(quality), lambda q: q >= least)


def mostly_above(quality: Column, least: int) -> Column:
    """Whether at most half of the bases are below `least`; always so where least is 0 or less."""
    if least <= 0:
        return F.lit(True)
    low = F.size(F.filter(phred(quality), lambda q: q < least))
    return low / F.length(quality) <= 0.5


def g_fraction(seq: Column) -> Column:
    """Share of G or N."""
    return F.length(F.regexp_replace(seq, "[^GN]", "")) / F.length(seq)


def passes_gene_quality(seq: Column, quality: Column, least: int, max_g: float) -> Column:
    """mostly_above() and less G than max_g; as in the reference, the second is asked only where the first is."""
    return F.lit(True) if least <= 0 else mostly_above(quality, least) & (g_fraction(seq) < max_g)


def poly_a_cut(seq: Column, tail: Column, block: str = "AAAAAAAA") -> Column:
    """Length to which a read is cut: at the reverse complement of `tail`, else at the first block of A, and then before
    any A or N that stands there."""
    rc, poly = F.position(reverse_complement(tail), seq), F.position(F.lit(block), seq)
    at = F.when((F.length(tail) > 0) & (rc > 0), rc - 1).when(poly > 0, poly - 1).otherwise(F.length(seq))
    return F.length(F.regexp_replace(F.substring(seq, F.lit(1), at), "[AN]+$", ""))


def poly_a_outcome(seq: Column, tail: Column, block: str = "AAAAAAAA") -> Column:
    rc, poly = F.position(reverse_complement(tail), seq), F.position(F.lit(block), seq)
    cut = poly_a_cut(seq, tail, block)
    found = F.when((F.length(tail) > 0) & (rc > 0), "rc").when(poly > 0, "poly_a")
    return F.coalesce(found, F.when(cut < F.length(seq), "a").otherwise("none"))


def quality_window(quality: Column, leading: int, trailing: int, least: int) -> Column:
    """(start, end) that is left of a read: after the last low base of the first `leading`, before the leftmost low one
    of the last `trailing`. The whole read where least is 0 or less."""
    n = F.length(quality)
    if least <= 0:
        return F.struct(F.lit(0).alias("start"), n.alias("end"))
    low = F.filter(F.transform(phred(quality), lambda q, i: F.when(q < least, i)), lambda i: i.isNotNull())
    start = F.coalesce(F.array_max(F.filter(low, lambda i: i < leading)) + 1, F.lit(0))
    end = F.coalesce(F.array_min(F.filter(low, lambda i: i >= n - trailing)), n)
    return F.struct(start.alias("start"), end.alias("end"))


def neighbours(seq: Column) -> Column:
    """The strings at Hamming distance 1, three for each place."""
    others = F.array(*[F.lit(b) for b in BASES])
    at = lambda i: F.filter(F.transform(others, lambda b: F.when(F.substring(seq, i, F.lit(1)) != b, F.overlay(seq, b, i, F.lit(1)))), lambda s: s.isNotNull())
    return F.flatten(F.transform(F.sequence(F.lit(1), F.length(seq)), at))


def filled(seq: Column, *keys: Column) -> Column:
    """N replaced by bases that a hash of the keys and the place chooses, the same each time."""
    base = lambda i: F.element_at(F.array(*[F.lit(b) for b in BASES]), (F.pmod(F.xxhash64(seq, *keys, i), F.lit(4)) + 1).cast("int"))
    return F.array_join(F.transform(characters(seq), lambda c, i: F.when(c == "N", base(i)).otherwise(c)), "")


def split_barcode(barcode: Column, lengths: list[int]) -> list[Column]:
    """Parts of a barcode by their lengths."""
    starts = [sum(lengths[:i]) + 1 for i in range(len(lengths))]
    return [F.substring(barcode, s, n) for s, n in zip(starts, lengths, strict=True)]


def read_id(prefix: Column, barcode: Column, umi: Column) -> Column:
    return F.concat(prefix, F.lit("!"), barcode, F.lit("#"), umi)


def parse_read_id(name: Column) -> tuple[Column, Column]:
    """(barcode, umi) of prefix!barcode#umi: the last #, and the last ! before it. Both null where one is missing or empty."""
    pattern = r"^.*!([^!]*)#([^#]*)$"
    parts = [F.nullif(F.regexp_extract(name, pattern, k), F.lit("")) for k in (1, 2)]
    both = parts[0].isNotNull() & parts[1].isNotNull()
    return F.when(both, parts[0]), F.when(both, parts[1])


def find_spacer(seq: Column, spacer: str, max_edits: int, search: int, shortest: int, longest: int, after: int) -> Column:
    """struct(start, end, outcome) of matching.spacer_places(), a batch of reads at a time."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield matching.spacer_places(b, spacer, max_edits, search, shortest, longest, after)

    return F.arrow_udf(run, "struct<start:int, end:int, outcome:string>")(seq)
