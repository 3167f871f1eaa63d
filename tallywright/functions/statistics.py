"""Probability functions for merging cells and molecules: collisions, Poisson tails, binomial mixtures, kernel densities.

Tables over the distribution of identifiers are built on the driver from its histogram: the number of distinct
probabilities is small whatever the number of reads.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import lru_cache

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_away(x: float) -> int:
    return int(math.floor(abs(x) + 0.5)) * (1 if x >= 0 else -1)


def collision_table(probabilities: np.ndarray, weights: np.ndarray, largest: int) -> list[int]:
    """Molecules that were there where s distinct identifiers are seen, for s = 1 .. largest.

    probabilities: distinct values; weights: how many identifiers have each. One new identifier takes on average
    1 / (1 - p(seen)) draws; what exceeds one draw is added up.
    """
    p, unseen = np.asarray(probabilities, float), np.ones(len(probabilities))
    w, total, extra, table = np.asarray(weights, float), 0, 0.0, []
    for s in range(1, largest + 1):
        drawn = s + int(extra)
        unseen *= (1 - p) ** (drawn - total)
        seen, total = float((w * p * (1 - unseen)).sum()), drawn
        extra += 1 / (1 - seen) - 1
        table.append(round_half_away(s + extra))
    return table


def expected_intersection(probabilities: np.ndarray, weights: np.ndarray, a: int, b: int) -> float:
    """Identifiers that two genes of a and b molecules share by chance."""
    p = np.asarray(probabilities, float)
    return float((np.asarray(weights) * (1 - (1 - p) ** a) * (1 - (1 - p) ** b)).sum())


def poisson_upper(k: Column, mean: Column) -> Column:
    """P(X >= k). Above the mean the upper terms are summed themselves, as 1 - P(X < k) would cancel."""
    log_pmf = lambda i: i * F.log(mean) - mean - F.aggregate(F.sequence(F.lit(1), F.greatest(i, F.lit(1))), F.lit(0.0), lambda acc, j: acc + F.log(j))
    first = F.exp(log_pmf(k.cast("int")))
    start = F.struct(first.alias("term"), first.alias("sum"))
    steps = F.sequence(F.lit(1), F.lit(60) + (mean * 4).cast("int"))
    grown = lambda acc, j: F.struct((acc["term"] * mean / (k + j)).alias("term"), (acc["sum"] + acc["term"] * mean / (k + j)).alias("sum"))
    tail = F.aggregate(steps, start, grown, lambda acc: F.least(acc["sum"], F.lit(1.0)))
    return F.when(k <= 0, F.lit(1.0)).when(mean <= 0, F.lit(0.0)).otherwise(tail)


def uniform_adjusted(seen: Column, identifiers: int) -> Column:
    """Molecules from distinct identifiers where all are equally likely; when all are seen, by extrapolation of the last step."""
    n = float(identifiers)
    at = lambda v: -F.log(1 - v / n) * n
    last = at(F.lit(n - 1)) + (at(F.lit(n - 1)) - at(F.lit(n - 2)))
    return F.round(F.when(seen >= identifiers, last).otherwise(at(seen))).cast("long")


def deadjusted(value: Column, table: list[int]) -> Column:
    """Distinct identifiers from molecules: the inverse of a collision table, linear between its entries."""
    array = F.array(*[F.lit(float(x)) for x in table])
    above = F.array_min(F.filter(F.transform(array, lambda x, i: F.when(x >= value, i + 1)), lambda i: i.isNotNull()))
    high, low = F.element_at(array, above), F.when(above > 1, F.element_at(array, F.greatest(above - 1, F.lit(1)))).otherwise(F.lit(0.0))
    between = F.when(high > low, above - 1 + (value - low) / (high - low)).otherwise(above.cast("double"))
    return F.when(above.isNull(), F.lit(float(len(table)))).otherwise(between)


def quantized(value: Column, borders: list[float]) -> Column:
    """Index of the first border above the value (by 1e-7), else of the last."""
    if not borders:
        return F.lit(0)
    out = F.lit(len(borders) - 1)
    for i in range(len(borders) - 1, -1, -1):
        out = F.when(value < borders[i] + 1e-7, i).otherwise(out)
    return out


def neighbour_matrix(probability: float, neighbours: int, reads: int) -> np.ndarray:
    """m[i, r]: probability that r draws, each hitting one of the neighbours not yet hit in proportion, hit i of them."""
    m = np.zeros((neighbours + 1, reads + 1))
    m[0, 0] = 1.0
    for r in range(1, reads + 1):
        for i in range(min(r, neighbours) + 1):
            stay = m[i, r - 1] * (1 - probability * (neighbours - i) / neighbours if neighbours else 1.0)
            come = m[i - 1, r - 1] * probability * (neighbours - i + 1) / neighbours if i else 0.0
            m[i, r] = stay + come
    return m


def binomial_pmf(k: int, n: int, p: float) -> float:
    if not 0 <= k <= n:
        return 0.0
    if p in (0.0, 1.0):
        return float(k == n * p)
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)
    return math.exp(log + k * math.log(p) + (n - k) * math.log1p(-p))


def error_number_probability(errors: int, reads: int, error: float, collisions: np.ndarray) -> float:
    """Probability that reads of one molecule give so many distinct erroneous identifiers: erroneous reads may collide."""
    return sum(binomial_pmf(i, reads, error) * collisions[errors, i] for i in range(errors, reads + 1)) if errors <= reads else 0.0


def error_numbers(neighbours: int, reads: int, error: float) -> np.ndarray:
    """m[e, r]: probability that r reads of one molecule give e distinct erroneous identifiers, e up to `neighbours`."""
    hit = neighbour_matrix(1.0, neighbours + 1, reads)[: neighbours + 1]
    m = np.zeros((neighbours + 1, reads + 1))
    m[0, 0] = 1.0
    steps = np.arange(reads + 1)
    log_factorial = np.concatenate(([0.0], np.cumsum(np.log(np.arange(1, reads + 1)))))
    p = min(max(error, 1e-300), 1 - 1e-16)
    for r in range(1, reads + 1):
        i = steps[: r + 1]
        wrong = np.exp(log_factorial[r] - log_factorial[i] - log_factorial[r - i] + i * math.log(p) + (r - i) * math.log1p(-p))
        m[:, r] = hit[:, : r + 1] @ wrong
    return m


def error_column(neighbours: int, reads: int, error: float) -> np.ndarray:
    """The column of error_numbers() for so many reads: each errs and meets an identifier not met before, or changes nothing."""
    p = min(max(error, 1e-300), 1 - 1e-16)
    return np.array(neighbours_hit(p, neighbours + 1, reads)[: neighbours + 1])


def adjusted_error_prior(prior: np.ndarray, larger: int, most: int) -> np.ndarray:
    """Probability of seeing 0, 1, ... erroneous identifiers where some fall on identifiers that are there already.

    prior: probability of so many errors; of e errors each meets one of the present neighbours (smaller and larger ones)
    with their share of the `most` neighbours."""
    m = len(prior) - 1
    present = min(1.0, (m + larger) / most)
    return np.array([sum(prior[e] * binomial_pmf(e - seen, e, present) for e in range(seen, m + 1)) for seen in range(m + 1)])


@lru_cache(maxsize=1 << 16)
def neighbours_hit(probability: float, neighbours: int, draws: int) -> tuple[float, ...]:
    """The last column of neighbour_matrix(), by powers of one draw's transition."""
    i = np.arange(neighbours + 1)
    come = probability * (1 - i / neighbours)
    return tuple(np.linalg.matrix_power(np.diag(1 - come) + np.diag(come[:-1], -1), draws)[:, 0])


def neighbours_beyond(probability: float, neighbours: int, draws: int, larger: int, smaller: int | None = None, kind: str = "raw") -> np.ndarray:
    """Distribution of how many more neighbours than the `larger` known ones are hit by so many draws.

    kind: `raw` the probabilities of 0, 1, ...; `tail` of at least so many; `ratio` with `smaller`, the tail up to
    that number over the head before it.
    """
    beyond = np.array(neighbours_hit(probability, neighbours, draws))[larger:]
    total = beyond.sum()
    if kind == "raw" and total < 1e-10:
        return np.concatenate(([1.0], beyond[1:]))
    beyond = beyond / (total if total >= 1e-10 else 1.0)
    if kind == "raw":
        return beyond
    if kind == "tail":
        return np.cumsum(beyond[::-1])[::-1]
    if smaller is None or larger + smaller > neighbours:
        raise ValueError("the number of smaller neighbours does not fit")
    head = np.cumsum(beyond[: smaller + 1])
    if head[-1] < 1e-20:
        head = np.full(smaller + 1, 1e10)
    tail = np.cumsum(beyond[smaller:0:-1])[::-1]
    return np.concatenate(([0.0], tail / head[:smaller]))


def normal_bandwidth(data: np.ndarray) -> np.ndarray:
    """Bandwidth matrix of the normal-scale rule."""
    n, d = data.shape
    return (4 / (d + 2)) ** (2 / (d + 4)) * n ** (-2 / (d + 4)) * np.cov(data, rowvar=False).reshape(d, d)


#: Points that a density sums over at once, so that memory does not grow with their number.
SUMMED = 4096


def density(data: np.ndarray, bandwidth: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Gaussian kernel density of data at points."""
    values, vectors = np.linalg.eigh(np.linalg.pinv(bandwidth, hermitian=True))
    norm = 1 / math.sqrt(max(np.linalg.det(2 * math.pi * bandwidth), 1e-300))
    root = vectors * np.sqrt(np.maximum(values, 0))
    centers, places, total = data @ root, at @ root, np.zeros(len(at))
    for a in range(0, len(centers), SUMMED):
        total += np.exp(-0.5 * sum((p[:, None] - c) ** 2 for p, c in zip(places.T, centers[a : a + SUMMED].T, strict=True))).sum(axis=1)
    return norm * total / len(data)


def good_toulmin(counts: dict[int, int], ratio: float, terms: int = 20) -> float:
    """Distinct molecules expected at `ratio` times the reads, from how many have 1, 2, ... reads.

    The alternating series is evaluated as a continued fraction (Pade approximant), which stays bounded beyond ratio 2.
    """
    t = ratio - 1.0
    seen = float(sum(counts.values()))
    if t <= 0:  # fewer reads: each is kept with probability ratio
        return sum(n * (1 - (1 - ratio) ** k) for k, n in counts.items())
    longest = 0
    while longest < terms and counts.get(longest + 1, 0) > 0:
        longest += 1
    series = np.array([(-1) ** k * counts[k + 1] for k in range(longest)], float)
    order = len(series) // 2
    for m in range(order, 0, -1):  # [m-1/m] approximants of the series divided by t
        a = np.array([[series[m + i - j - 1] if m + i - j - 1 >= 0 else 0.0 for j in range(m)] for i in range(m)])
        try:
            q = np.linalg.solve(a, -series[m : 2 * m])
        except np.linalg.LinAlgError:
            continue
        p = [series[i] + sum(q[j] * series[i - j - 1] for j in range(i)) for i in range(m)]
        below = 1 + sum(q[j] * t ** (j + 1) for j in range(m))
        roots = np.roots(np.append(q[::-1], 1.0))
        if below > 0 and not any(abs(r.imag) < 1e-9 and 0 < r.real <= t for r in roots):
            gain = t * sum(c * t**i for i, c in enumerate(p)) / below
            if gain >= 0:
                return seen + gain
    return seen


def continued_fraction(series: np.ndarray) -> np.ndarray:
    """c with series[0] + series[1] t + ... = c[0] / (1 + c[1] t / (1 + c[2] t / ...)), by the quotient-difference table; it ends
    before the first coefficient that is not finite or 0."""
    n = len(series)
    if n == 0 or series[0] == 0:
        return np.zeros(0)
    with np.errstate(divide="ignore", invalid="ignore"):
        q, e = series[1:] / series[:-1], np.zeros(n)
        found = [series[0]]
        for k in range(1, n):
            found.append(-(q[0] if k % 2 else e[0]))
            if k % 2:
                e = q[1:] - q[:-1] + e[1 : len(q)]
            else:
                q = q[1 : len(e)] * e[1:] / e[:-1]
            if (k % 2 and not len(e)) or (not k % 2 and not len(q)):
                break
    c = np.array(found)
    bad = np.flatnonzero(~np.isfinite(c) | (c == 0))
    return c[: bad[0]] if bad.size else c


def fraction_at(c: np.ndarray, t: np.ndarray) -> np.ndarray:
    """The continued fraction at t; infinite where it has a pole."""
    below = np.ones_like(t)
    with np.errstate(divide="ignore", invalid="ignore"):
        for x in c[:0:-1]:
            below = 1 + x * t / below
        return c[0] / below


#: Largest order of a fraction, the multiple of the reads up to which it must behave, and places looked at.
MOST_TERMS, REACH, PLACES = 100, 20.0, 400


def stable_fraction(counts: dict[int, int], reach: float = REACH) -> np.ndarray:
    """The fraction of the highest even order whose curve of gained molecules never falls and never turns upwards up to `reach` times
    the reads; empty where not even the lowest does."""
    longest = 0
    while longest < MOST_TERMS and counts.get(longest + 1, 0) > 0:
        longest += 1
    series = np.array([(-1) ** k * counts[k + 1] for k in range(longest)], float)
    c, t = continued_fraction(series), np.linspace(0, max(reach - 1, 1e-6), PLACES)
    for order in range(len(c) - len(c) % 2, 1, -2):
        gained = t * fraction_at(c[:order], t)
        steps = np.diff(gained)
        if np.isfinite(gained).all() and (steps >= 0).all() and (np.diff(steps) <= 1e-9 * max(gained[-1], 1)).all():
            return c[:order]
    return np.zeros(0)


def expected_distinct(counts: dict[int, int], ratios: np.ndarray) -> np.ndarray:
    """Distinct molecules expected at multiples of the reads, from how many have 1, 2, ... reads.

    Below the present reads by thinning, exactly; beyond, the alternating series is taken as a continued fraction of the
    highest order that is stable over all that is asked for; without one nothing is gained.
    """
    ratios = np.asarray(ratios, float)
    seen = float(sum(counts.values()))
    k, n = np.array(list(counts), float), np.array(list(counts.values()), float)
    fewer = (n * (1 - (1 - np.minimum(ratios, 1.0))[:, None] ** k)).sum(axis=1) if len(k) else np.zeros(len(ratios))
    c = stable_fraction(counts, max(REACH, float(ratios.max(initial=1.0))))
    t = np.maximum(ratios - 1, 0)
    return np.where(ratios <= 1, fewer, seen + (t * fraction_at(c, t) if c.size else 0.0))


def distinct_range(counts: dict[int, int], ratios: np.ndarray, level: float = 0.95, draws: int = 100, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper ends of the share `level` of estimates from resampled molecules; a draw without a stable fraction is drawn anew
    (up to ten times as many)."""
    rnd = np.random.default_rng(seed)
    k, n = list(counts), np.array(list(counts.values()), float)
    found = []
    for _ in range(10 * draws):
        if len(found) == draws or not len(k):
            break
        again = {x: int(m) for x, m in zip(k, rnd.multinomial(int(n.sum()), n / n.sum()), strict=True) if m}
        if stable_fraction(again, max(REACH, float(np.max(ratios, initial=1.0)))).size:
            found.append(expected_distinct(again, ratios))
    if not found:
        alone = expected_distinct(counts, ratios)
        return alone, alone
    return tuple(np.quantile(np.array(found), x, axis=0) for x in ((1 - level) / 2, (1 + level) / 2))


def spread(x: np.ndarray) -> np.ndarray:
    """Median absolute deviation of the columns, times 1.4826."""
    x = np.ascontiguousarray(x.T)  # medians of what lies together are found faster
    return 1.4826 * np.median(np.abs(x - np.median(x, axis=1, keepdims=True)), axis=1)


#: Rounds of the search for a direction, angles tried in each, and loadings that are taken for 0.
CYCLES, ANGLES, NOTHING = 10, 24, 0.02


def projected(data: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The rows along each column of directions, as one row each; summed feature by feature, so that a value does not depend on the
    rows beside its own."""
    return sum((x * d[:, None] for x, d in zip(data.T, directions, strict=True)), np.zeros((directions.shape[1], len(data))))


def sparse_components(data: np.ndarray, penalty: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """sparse_directions() of the rows of data."""
    return sparse_directions(data.shape[1], lambda a: spread(projected(data, a).T), penalty)


def sparse_directions(width: int, spreads: Callable[[np.ndarray], np.ndarray], penalty: float = 0.3) -> tuple[np.ndarray, np.ndarray]:
    """(directions as columns, their spreads), by projection pursuit: each direction maximises the robust spread of the data along
    it, less a penalty on the sum of its loadings, among those orthogonal to what earlier ones explain.

    The data are asked only for their spreads along directions: columns of `width` loadings. A direction starts as the feature of
    the largest spread and is turned towards one feature at a time, by angles on a grid that halves each round. Less than half of
    the rows, however far out, hardly move the spread.
    """
    left = np.eye(width)  # takes the directions that are found out of others
    whole = float(spreads(left).max(initial=0.0))
    found, sizes = [], []

    def worth(a: np.ndarray) -> np.ndarray:
        """Of each column of directions."""
        return spreads(left @ a) - penalty * whole * (np.abs(a).sum(axis=0) - 1) / max(1.0, math.sqrt(len(a)) - 1)

    for _ in range(width):
        order = np.argsort(-spreads(left), kind="stable")
        a = np.zeros(width)
        a[order[0]] = 1.0
        best = worth(a[:, None])[0]
        for cycle in range(CYCLES):
            for j in order.tolist():
                angles = np.linspace(-np.pi / 2, np.pi / 2, ANGLES + 1) / 2**cycle
                turned = a[:, None] * np.cos(angles)
                turned[j] += np.sin(angles)
                size = np.linalg.norm(turned, axis=0)
                turned = turned[:, size > 1e-9] / size[size > 1e-9]
                values = worth(turned)
                if values.max() > best + 1e-12:
                    best, a = values.max(), turned[:, values.argmax()]
        a = np.where(np.abs(a) < NOTHING, 0.0, a)
        a /= np.linalg.norm(a)
        found.append(a), sizes.append(float(spreads(left @ a[:, None])[0]))
        left = left - np.outer(left @ a, a)
    return np.array(found).T, np.array(sizes)
