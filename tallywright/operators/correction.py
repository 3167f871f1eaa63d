"""Correction of sequencing errors in molecular identifiers, gene by gene: one entry, by a Bayesian or the classic rule.

molecules: cb, gene, umi, reads, qual (mean quality of each place). An identifier is taken for an error of an adjacent
one of no fewer reads if so many adjacent smaller ones are likelier errors than molecules that happen to be adjacent:
the first by how many errors so many reads make and by the quality at the place that differs, the second by how often
identifiers are drawn.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywright.functions import statistics as st
from tallywright.functions.sequences import BASES, neighbours

from . import pairs as pr
from .identifiers import GROUP, KEY, adjacent, classic_filter, neighbour_counts
from .tables import stored


@dataclass(frozen=True)
class Model:
    """What a gene is judged by; its size follows the identifiers' length and the bounds of train(), not the data.

    errors[e, r]: probability of e erroneous identifiers from r reads, for as many reads as are worked out beforehand; those of
    more follow from `error`, the share of reads that are errors (None: they count as the last); quality_error and quality_all: log probabilities
    of the quality classes below `borders`; collisions: molecules behind so many distinct identifiers.
    """

    length: int
    errors: np.ndarray
    borders: tuple[float, ...]
    quality_error: np.ndarray
    quality_all: np.ndarray
    collisions: tuple[int, ...]
    error: float | None = None

    def error_columns(self, upto: int, reads: np.ndarray) -> np.ndarray:
        """errors[:upto, r] for each number of reads."""
        known = self.errors.shape[1] - 1
        if self.error is None or reads.max(initial=0) <= known:
            return self.errors[:upto, np.minimum(reads, known)]
        column = lambda r: self.errors[:, r] if r <= known else st.error_column(self.most, r, self.error)
        return np.stack([column(r)[:upto] for r in reads.tolist()], axis=1)

    @property
    def most(self) -> int:
        return 3 * self.length

    def quality_class(self, quality: float) -> int:
        return next((i for i, b in enumerate(self.borders) if quality < b + 1e-7), len(self.borders) - 1)


def distribution(molecules: DataFrame, length: int, smooth: float = 10.0, compat: bool = True) -> tuple[DataFrame, float, float]:
    """(umi, n) of the identifiers that are seen, what each identifier of the length has added, and the sum over all.

    compat adds the smoothing four times, as is known."""
    seen = molecules.groupBy("umi").agg(F.count("*").alias("n"))
    added = smooth * (4 if compat else 1)
    return seen, added, float(seen.agg(F.sum("n")).first()[0] or 0) + added * 4**length


def neighbour_classes(molecules: DataFrame, length: int, smooth: float = 10.0, classes: int = 50) -> DataFrame:
    """umi, p, class: for each identifier that is seen the probability of its neighbours, rounded to `classes` steps up
    to the largest over all identifiers of the length, and the step's number."""
    seen, added, total = distribution(molecules, length, smooth)
    near = seen.select(F.explode(neighbours(F.col("umi"))).alias("umi"), "n").groupBy("umi").agg(F.sum("n").alias("n"))
    sums = near.select("umi", ((F.col("n") + added * 3 * length) / total).alias("p"))
    step = (sums.agg(F.max("p")).first()[0] or 1.0) / classes
    found = seen.select("umi").join(sums, "umi", "left").withColumn("p", F.coalesce("p", F.lit(added * 3 * length / total)))
    return found.withColumn("class", F.round(F.col("p") / step).cast("int")).withColumn("p", F.col("class") * step)


def collisions(molecules: DataFrame, length: int, largest: int, smooth: float = 10.0) -> tuple[int, ...]:
    """Molecules behind 1 .. largest distinct identifiers; only the histogram of frequencies reaches the driver."""
    seen, added, total = distribution(molecules, length, smooth)
    weights = {r["n"]: r["w"] for r in seen.groupBy("n").agg(F.count("*").alias("w")).collect()}
    weights[0] = 4**length - sum(weights.values())
    p, w = zip(*[((n + added) / total, w) for n, w in sorted(weights.items())], strict=True)
    return tuple(st.collision_table(np.array(p), np.array(w), largest))


def error_share(molecules: DataFrame, most: int = 4) -> float:
    """Share of reads that are errors, from genes of up to `most` identifiers one of which is next to all others and has
    the most reads; a gene of one identifier has none. Where no gene is such a star, identifiers next to one of more reads are the errors."""
    small = molecules.groupBy(*GROUP).agg(F.count("*").alias("n")).filter(F.col("n") <= most).select(*GROUP)
    molecules = molecules.join(small, GROUP, "left_semi")
    rows = neighbour_counts(molecules).select(*KEY, "total").join(molecules.select(*KEY, "reads"), KEY)
    genes = rows.groupBy(*GROUP).agg(F.count("*").alias("n"), F.max("reads").alias("large"), F.sum("reads").alias("all"), F.collect_list(F.struct("reads", "total")).alias("each"))
    centre = F.exists("each", lambda x: (x["reads"] == F.col("large")) & (x["total"] == F.col("n") - 1))
    sums = genes.filter(centre).agg(F.sum("large").alias("large"), F.sum("all").alias("all")).first()
    if sums["all"]:
        return 1 - sums["large"] / sums["all"]
    sums = rows.join(smaller_pairs(molecules).select(*GROUP, F.col("base").alias("umi"), F.lit(1).alias("_base")).distinct(), KEY, "left").agg(F.sum(F.col("reads") * F.col("_base")).alias("bad"), F.sum("reads").alias("all")).first()
    return (sums["bad"] or 0) / sums["all"] if sums["all"] else 0.0


def least_crowded(molecules: DataFrame) -> int | None:
    """Identifiers of the smallest gene that holds adjacent ones, 2 at least; null where no gene does."""
    sizes = molecules.groupBy(*GROUP).agg(F.count("*").alias("n"))
    return sizes.join(adjacent(molecules).select(*GROUP).distinct(), GROUP, "left_semi").agg(F.min("n")).first()[0]


def train(molecules: DataFrame, length: int, classes: int = 10, smooth: float = 10.0, quality_smooth: float = 0.01, worked_out: int = 2000) -> Model:
    """A model from sums in Spark. Genes of two adjacent identifiers give the qualities of errors, those of at most two the
    qualities of all; where reads are so many that no gene has just two, the smallest ones with adjacent identifiers take their place.
    Error numbers of up to `worked_out` reads are a table, those of more are worked out where they occur. No adjacent identifiers
    at all raise."""
    small = least_crowded(molecules)
    if small is None:
        raise ValueError("no adjacent identifiers to learn errors from")
    sizes = molecules.groupBy(*GROUP).agg(F.count("*").alias("n"))
    few = stored(molecules.join(sizes.filter(F.col("n") <= small).select(*GROUP), GROUP, "left_semi"))
    bad = stored(smaller_pairs(few).select(F.col("quality").cast("int").alias("value")))
    every = few.select(F.explode(F.col("qual").cast("array<int>")).alias("value"))
    borders = tuple(sorted(float(r["border"]) for r in pr.quantile_borders(pr.mixed_distribution(bad, every, "value"), classes).collect()))

    def classed(rows: DataFrame) -> np.ndarray:
        counts = np.zeros(len(borders))
        for r in rows.groupBy(st.quantized(F.col("value"), list(borders)).alias("k")).agg(F.count("*").alias("n")).collect():
            counts[r["k"]] = r["n"]
        shares = counts / counts.sum() + quality_smooth
        return np.log(shares / shares.sum())

    top = molecules.agg(F.max("reads")).first()[0]
    largest = sizes.agg(F.max("n")).first()[0]
    error = error_share(molecules, max(4, small))
    errors = st.error_numbers(3 * length, min(worked_out, max(1, round(top * 1.5))), error)
    return Model(length, errors, borders, classed(bad), classed(every), collisions(molecules, length, largest + 1, smooth), error)


def smaller_pairs(molecules: DataFrame) -> DataFrame:
    """cb, gene, base, target, quality: adjacent pairs of genes, base having no more reads, with its quality at the place
    that differs; of equal reads the smaller identifier is the base."""
    near = adjacent(molecules).filter("reads < other_reads or (reads = other_reads and umi < other)")
    rows = near.join(molecules.select(*KEY, "qual"), KEY)
    differs = F.filter(F.sequence(F.lit(1), F.length("umi")), lambda i: F.substring("umi", i, F.lit(1)) != F.substring("other", i, F.lit(1)))
    return rows.select(*GROUP, F.col("umi").alias("base"), F.col("other").alias("target"), F.get("qual", F.get(differs, F.lit(0)) - 1).alias("quality"))


def likely_errors(model: Model, small: list[int], large: int, log_error: np.ndarray, log_all: np.ndarray, larger: int, drawn: np.ndarray) -> int:
    """How many of the smaller neighbours of an identifier, in ascending order, are likeliest to be its errors.

    small: their reads; large: its own; larger: its neighbours of more reads; drawn: probabilities of 0, 1, ...
    neighbours that are molecules beyond these.
    """
    m = len(small)
    columns = model.error_columns(m + 1, large + np.concatenate(([0], np.cumsum(small))).astype(np.int64))
    prior_error = st.adjusted_error_prior(np.diagonal(columns) / np.maximum(columns.sum(axis=0), 1e-300), larger, model.most)
    prior_true = drawn[: m + 1] / max(drawn[: m + 1].sum(), 1e-300)
    with np.errstate(divide="ignore"):
        score = np.log(prior_error) + np.log(prior_true[::-1])
    score = score + np.concatenate(([0], log_error)) + np.concatenate((np.cumsum(log_all[::-1])[::-1], [0]))
    return int(np.argmax(score))


def resolved(bases: list[str], targets: list[str]) -> set[str]:
    """The bases that go if each is merged into its first target in turn; one whose chain leads back to itself stays."""
    into: dict[str, str] = {}
    known = set(bases)
    for base, target in zip(bases, targets, strict=True):
        if base in into:
            continue
        end = target
        while end in known and end != base and end in into:
            end = into[end]
        if end != base:
            into[base] = end
    return set(into)


def kept_identifiers(model: Model, reads: dict[str, int], quality: dict[str, list[float]], near_probability: dict[str, float], rounds: int = 100) -> list[str]:
    """Identifiers of one gene that are left when errors are resolved into their targets, in rounds until none is."""
    spelled = {u: [u[:i] + b + u[i + 1 :] for i in range(len(u)) for b in BASES if b != u[i]] for u in reads}
    near = {u: [v for v in vs if v in reads] for u, vs in spelled.items()}

    def grade(u: str, v: str) -> float:
        return quality[u][next(i for i in range(len(u)) if u[i] != v[i])]

    rows = [(v, reads[u], grade(u, v), u) for u in reads for v in near[u] if reads[u] <= reads[v]]  # target, reads, quality, base
    rows.sort()
    classes = {(u, v): model.quality_class(q) for v, _, q, u in rows}
    left = set(reads)
    for _ in range(rounds):
        if not rows:
            break
        draws = model.collisions[min(len(left), len(model.collisions)) - 1] - 1
        by_target: dict[str, list[tuple[int, float, str]]] = {}
        for v, n, q, u in rows:
            by_target.setdefault(v, []).append((n, q, u))
        found: list[tuple[int, int, float, str, str]] = []
        for v, small in by_target.items():
            larger = sum(w in left and reads[w] > reads[v] for w in near[v])
            drawn = st.neighbours_beyond(near_probability[v], model.most, draws, larger)
            k = [classes[u, v] for _, _, u in small]
            n = likely_errors(model, [s[0] for s in small], reads[v], model.quality_error[k], model.quality_all[k], larger, drawn)
            upto = 0
            for s, q, u in small[:n]:
                upto += s
                found.append((-reads[v], upto, q, u, v))
        found.sort()
        gone = resolved([f[3] for f in found], [f[4] for f in found])
        left -= gone
        rows = [r for r in rows if r[0] in left and r[3] in left]
        if not gone:
            break
    return sorted(left) if left else [max(sorted(reads), key=reads.get)]


def bayesian_filter(molecules: DataFrame, model: Model, smooth: float = 10.0, classes: int = 50) -> DataFrame:
    """The molecules that are kept. Genes without adjacent identifiers need no Python; the others are small groups, as the
    identifiers of a gene in a cell are."""
    crowded = stored(smaller_pairs(molecules).select(*GROUP).distinct())
    probability = neighbour_classes(molecules, model.length, smooth, classes)
    rows = molecules.join(crowded, GROUP, "left_semi").select(*KEY, "reads", "qual").join(probability.select("umi", "p"), "umi")

    def group(df: pd.DataFrame) -> pd.DataFrame:
        reads, quality, p = (dict(zip(df["umi"], df[c], strict=True)) for c in ("reads", "qual", "p"))
        kept = kept_identifiers(model, {u: int(n) for u, n in reads.items()}, quality, p)
        return pd.DataFrame([(df["cb"].iloc[0], df["gene"].iloc[0], u) for u in kept], columns=KEY, dtype=object)

    kept = rows.groupBy(*GROUP).applyInPandas(group, "cb string, gene string, umi string")
    return molecules.join(crowded, GROUP, "left_anti").unionByName(molecules.join(crowded, GROUP, "left_semi").join(kept, KEY, "left_semi"))


def correct_identifiers(molecules: DataFrame, length: int, method: str = "bayesian", returns: str = "matrix", multiplier: float = 1.0, smooth: float = 10.0, classes: int = 10, adjust: bool = True) -> DataFrame:
    """Corrected identifiers by the `bayesian` or the `classic` method.

    returns: `reads` the molecules that are kept; `umis` or `matrix` (cb, gene, n), their number for each gene of a cell,
    by default adjusted for identifiers that collided. Without adjacent identifiers there is nothing to correct.
    """
    if method not in ("bayesian", "classic"):
        raise ValueError(f"unknown method: {method}")
    if returns not in ("matrix", "reads", "umis"):
        raise ValueError(f"unknown kind of result: {returns}")
    molecules = stored(molecules)
    if method == "bayesian" and least_crowded(molecules) is None:
        kept, table = molecules, None
    elif method == "bayesian":
        model = train(molecules, length, classes, smooth)
        kept, table = bayesian_filter(molecules, model, smooth), model.collisions
    else:
        kept, table = classic_filter(molecules, multiplier), None
    if returns == "reads":
        return kept
    counts = kept.groupBy("cb", "gene").agg(F.count("*").alias("n"))
    if not adjust:
        return counts
    if table is None:
        table = collisions(molecules, length, (counts.agg(F.max("n")).first()[0] or 0) + 1, smooth)
    rows = molecules.sparkSession.createDataFrame(list(enumerate(table, 1)), "n long, adjusted long")
    return counts.join(rows, "n").select("cb", "gene", F.col("adjusted").alias("n"))

