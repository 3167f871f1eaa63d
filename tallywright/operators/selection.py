"""Exact order statistics of a column by histograms, refined in the bin that holds the rank: nothing is sorted whole, no task sees all values."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.functions import statistics as st

from .tables import stored

#: Bins of a histogram, distinct values of a bin that are looked at one by one, and rounds before giving up.
BINS, FEW, ROUNDS = 4096, 4096, 64


def scale(x: Column) -> Column:
    """Never falls where x grows, and spreads values of any size over a short range."""
    return F.signum(x) * F.log1p(F.abs(x))


def at_rank(rows: DataFrame, x: str, rank: int) -> float:
    """The value of x (doubles, none null) at a rank from 0 in ascending order.

    A round counts values by equal bins between the least and the greatest that are left; as bins are ranges of values, only
    those between the ends of the bin that holds the rank go on. The driver sees one row a bin. Each round reads the rows again,
    so they should be stored ones.
    """
    for _ in range(ROUNDS):
        ends = rows.agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.min(scale(F.col(x))).alias("a"), F.max(scale(F.col(x))).alias("b"), F.count("*").alias("n")).first()
        if ends["lo"] == ends["hi"]:
            return ends["lo"]
        if ends["n"] <= FEW:
            for step in rows.groupBy(x).agg(F.count("*").alias("n")).orderBy(x).collect():
                if rank < step["n"]:
                    return step[x]
                rank -= step["n"]
        width = (ends["b"] - ends["a"]) / BINS
        if not width > 0 or math.isinf(width):  # too close for the scale to tell apart: bins of the values themselves
            coordinate, a, width = F.col(x) / 2, ends["lo"] / 2, (ends["hi"] / 2 - ends["lo"] / 2) / BINS
        else:
            coordinate, a = scale(F.col(x)), ends["a"]
        number = F.least(F.floor((coordinate - a) / max(width, 5e-324)), F.lit(BINS - 1))
        bins = rows.groupBy(number.alias("bin")).agg(F.count("*").alias("n"), F.min(x).alias("lo"), F.max(x).alias("hi")).orderBy("bin").collect()
        for here in bins:
            if rank < here["n"]:
                break
            rank -= here["n"]
        if here["lo"] == here["hi"]:
            return here["lo"]
        rows = rows.filter(F.col(x).between(here["lo"], here["hi"]))
        if here["n"] <= FEW or len(bins) == 1:
            steps = rows.groupBy(x).agg(F.count("*").alias("n")).orderBy(x).limit(FEW + 1).collect()
            for step in steps[:FEW]:
                if rank < step["n"]:
                    return step[x]
                rank -= step["n"]
            if len(steps) > FEW:  # more values than a row each: the rest goes on
                rows = rows.filter(F.col(x) >= steps[FEW][x])
    raise RuntimeError(f"no single value after {ROUNDS} rounds")


def values(rows: DataFrame, column: str | Column) -> DataFrame:
    """The column as doubles named x, without nulls and NaN."""
    column = F.col(column) if isinstance(column, str) else column
    return rows.select(column.cast("double").alias("x")).filter("x is not null and not isnan(x)")


def quantile(rows: DataFrame, column: str | Column, share: float) -> float | None:
    """The value at this share of the way from the least to the greatest, between neighbours in proportion; null where there are none."""
    found = stored(values(rows, column))
    n = found.count()
    if n == 0:
        return None
    place = share * (n - 1)
    low, high = at_rank(found, "x", math.floor(place)), at_rank(found, "x", math.ceil(place)) if place % 1 else None
    return low if high is None else low + (high - low) * (place - math.floor(place))


def median(rows: DataFrame, column: str | Column) -> float | None:
    return quantile(rows, column, 0.5)


def median_deviation(rows: DataFrame, column: str, middle: float) -> float | None:
    """Median absolute deviation, times 1.4826."""
    found = median(rows, F.abs(F.col(column).cast("double") - F.lit(middle)))
    return None if found is None else 1.4826 * found


def trimmed_mean(rows: DataFrame, column: str, trim: float) -> float | None:
    """Mean of the values without the int(trim * n) least and as many greatest; values tied with the last that goes count for
    those that stay."""
    found = stored(values(rows, column))
    n = found.count()
    if n == 0:
        return None
    cut = int(n * trim)
    low, high = at_rank(found, "x", cut), at_rank(found, "x", n - cut - 1)
    if low == high:
        return low
    x = F.col("x")
    sums = found.agg(F.sum(F.when((x > low) & (x < high), x)).alias("inner"), F.count_if(x <= low).alias("upto"), F.count_if(x < high).alias("below")).first()
    return ((sums["inner"] or 0.0) + low * (sums["upto"] - cut) + high * (n - cut - sums["below"])) / (n - 2 * cut)


#: Ranges that spreads() parts the values along a direction into in a round, values of a range that are handed over to the driver, and
#: what becomes of a range's values.
PARTS, MOST_HANDED = 1024, 16_384
PASSED, COUNTED, HANDED = range(3)


def spreads(rows: DataFrame, columns: list[str]) -> Callable[[np.ndarray], np.ndarray]:
    """A function of directions (loadings of the columns, a column each) that gives the median absolute deviation, times 1.4826, of
    all rows along each, exactly. The rows have no nulls; they are stored here, as each call reads them twice or more.

    As in at_rank(), a round counts values by ranges, for all directions in one job. Ranges that may hold the middle ranks of
    the values, or of their distances from the median, go on; where their values are few these are handed over themselves. The
    greatest value of a range gets one of its own, so ranges narrow down to single values.
    """
    rows = stored(rows.select(*[F.col(c).cast("double").alias(c) for c in columns]))
    ends = np.array(rows.agg(*[f(c) for f in (F.min, F.max) for c in columns]).first(), float).reshape(2, -1, 1)

    def along(directions: np.ndarray) -> np.ndarray:
        lo, hi = (pick(*(ends * directions)).sum(axis=0) for pick in (np.minimum, np.maximum))
        asked = {d: (np.concatenate([[-np.inf], np.linspace(*x, PARTS), [np.inf]]), np.full(PARTS + 1, COUNTED)) for d, x in enumerate(zip(lo, hi, strict=True))}
        parts, found = {d: np.zeros((3, 0)) for d in asked}, np.zeros(len(asked))
        while asked:
            more = looked_at(rows, directions[:, list(asked)], list(asked.values()))
            for d, new in zip(list(asked), more, strict=True):
                known = np.concatenate([parts[d], new], axis=1)
                known = known[:, np.argsort(known[1], kind="stable")]
                wide, found[d] = undecided(*known)
                parts[d] = known[:, ~wide]
                asked[d] = finer(known[:, wide])
            asked = {d: x for d, x in asked.items() if x[0].size}
        return 1.4826 * found

    return along


def undecided(counts: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, float]:
    """(which of the ranges, in ascending order, must be parted further; the median distance from the median, where none must)."""
    n, single = int(counts.sum()), least == most
    ranks, everywhere = [(n - 1) // 2, n // 2], np.arange(len(counts))
    first, last = np.searchsorted(np.cumsum(counts), ranks, side="right")
    at_once = first < last or single[first]  # between two ranges the median is known
    lo, hi = [(most[first] + least[last]) / 2] * 2 if at_once else (least[first], most[first])
    near, far = np.maximum(0, np.maximum(least - hi, lo - most)), np.maximum(most - lo, hi - least)
    (a, b), (c, d) = (at_ranks(x, counts, ranks) for x in (near, far))
    wide = ~single & (far >= a) & (near <= d) if (a, b) != (c, d) else np.zeros(len(counts), bool)
    return wide | (~at_once & (everywhere == first)), (a + b) / 2


def at_ranks(x: np.ndarray, counts: np.ndarray, ranks: list[int]) -> tuple[float, ...]:
    """The values at these ranks, where each of x is there so many times."""
    order = np.argsort(x, kind="stable")
    return tuple(x[order][np.searchsorted(np.cumsum(counts[order]), ranks, side="right")].tolist())


def finer(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(edges, what becomes of the values from each edge to the next) that part these ranges."""
    edges, kinds = [], []
    for n, lo, hi in parts.T:
        starts = [lo] if n <= MOST_HANDED else np.linspace(lo, hi, max(16, PARTS // parts.shape[1])).tolist()
        edges += [*starts, np.nextafter(hi, np.inf)]
        kinds += [HANDED if n <= MOST_HANDED else COUNTED] * len(starts) + [PASSED]
    return np.array(edges), np.array(kinds[:-1])


def looked_at(rows: DataFrame, directions: np.ndarray, asked: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
    """For each direction the numbers of values, the least and the greatest one, of all ranges between the edges asked for that have
    any; values that are handed over have a range each."""
    starts = np.cumsum([0] + [len(kinds) for _, kinds in asked])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, least, most, values = np.zeros(starts[-1], np.int64), np.full(starts[-1], np.inf), np.full(starts[-1], -np.inf), [[np.zeros(0)] for _ in asked]
        for batch in batches:
            data = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            for d, x in enumerate(st.projected(data, directions)):
                edges, kinds = asked[d]
                x.sort()
                cuts = np.searchsorted(x, edges)
                some = np.flatnonzero((np.diff(cuts) > 0) & (kinds == COUNTED))
                at = starts[d] + some
                counts[at] += cuts[some + 1] - cuts[some]
                least[at] = np.minimum(least[at], x[cuts[some]])
                most[at] = np.maximum(most[at], x[cuts[some + 1] - 1])
                values[d] += [x[cuts[i] : cuts[i + 1]].copy() for i in np.flatnonzero(kinds == HANDED)]
        handed = [np.concatenate(v) for v in values]
        made = {"counts": counts, "least": least, "most": most, "sizes": np.array([len(v) for v in handed], np.int64), "x": np.concatenate(handed)}
        yield pa.RecordBatch.from_pydict({k: [v.tobytes()] for k, v in made.items()})

    counts, least, most, values = np.zeros(starts[-1]), np.full(starts[-1], np.inf), np.full(starts[-1], -np.inf), [[np.zeros(0)] for _ in asked]
    for task in rows.mapInArrow(look, "counts binary, least binary, most binary, sizes binary, x binary").collect():
        counts += np.frombuffer(task["counts"], np.int64)
        least, most = np.minimum(least, np.frombuffer(task["least"])), np.maximum(most, np.frombuffer(task["most"]))
        for v, x in zip(values, np.split(np.frombuffer(task["x"]), np.cumsum(np.frombuffer(task["sizes"], np.int64))[:-1]), strict=True):
            v.append(x)
    found = []
    for d, v in enumerate(values):
        ranges = np.stack([counts, least, most])[:, starts[d] : starts[d + 1]]
        x, n = np.unique(np.concatenate(v), return_counts=True)
        found.append(np.concatenate([ranges[:, ranges[0] > 0], [n, x, x]], axis=1))
    return found
