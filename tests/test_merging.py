"""Merging by chance overlap, barcodes near each other, corrected identifiers and cell scores, against known values and brute force."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.functions import statistics as st
from tallywright.functions.sequences import edit_distance_of
from tallywright.operators import correction, identifiers, merging, quality, results, tagging
from tallywright.operators import molecules as mo
from tallywright.plans import estimate as plan
from tallywright.sources import annotation

# Cells of a known case, and what is known of their overlaps.
KNOWN = [
    ("AAATTAGGTCCA", [("AAACCT", "Gene1"), ("CCCCCT", "Gene2"), ("ACCCCT", "Gene3")]),
    ("AAATTAGGTCCC", [("CAACCT", "Gene1")]),
    ("AAATTAGGTCCG", [("CAACCT", "Gene1")]),
    ("AAATTAGGTCGG", [("AAACCT", "Gene1"), ("CCCCCT", "Gene2")]),
    ("CCCTTAGGTCCA", [("CCATTC", "Gene3"), ("CCCCCT", "Gene2"), ("ACCCCT", "Gene3")]),
    ("CAATTAGGTCCG", [("CAACCT", "Gene1"), ("AAACCT", "Gene1"), ("CCCCCT", "Gene2"), ("TTTTTT", "Gene2"), ("TTCTTT", "Gene2")]),
    ("CCCCCCCCCCCC", [("CAACCT", "Gene1"), ("AAACCT", "Gene1"), ("CCCCCT", "Gene2"), ("TTTTTT", "Gene2"), ("TTCTTT", "Gene2")]),
    ("TAATTAGGTCCA", [("AAAAAA", "Gene4")]),
]
INTERSECTIONS = {(1, 5): 0.7748, (2, 5): 1.9437, (3, 5): 2.3853, (4, 5): 3.3316, (5, 5): 3.9163, (5, 3): 2.3853}
CHANCES = {(1, 2): (0.16, 0.05), (3, 4): (0.15, 0.05), (5, 6): (0.105, 0.01)}
WHITELIST = [(0, "AAT"), (0, "GAA"), (0, "AAA"), (1, "TTAGGTCCA"), (1, "TTAGGGGCC"), (1, "TTAGGTCCC")]


@pytest.fixture(scope="module")
def known(spark):
    rows = [(cb, umi, gene, "chr1", 2, umi) for cb, found in KNOWN for umi, gene in found]
    return mo.molecules(spark.createDataFrame(rows, "cb string, umi string, gene string, chrom string, mark int, umi_qual string")).cache()


def probabilities():
    seen = Counter(umi for _, found in KNOWN for umi, _ in found)
    histogram = sorted(Counter(seen.values()).items())
    total = sum(seen.values())
    return np.array([n / total for n, _ in histogram]), np.array([w for _, w in histogram])


def test_known_intersections():
    p, w = probabilities()
    table = st.collision_table(p, w, 8)
    for (a, b), want in INTERSECTIONS.items():
        assert abs(st.expected_intersection(p, w, table[a - 1], table[b - 1]) - want) < 1e-4


def test_known_chances(spark, known):
    names = [cb for cb, _ in KNOWN]
    pairs = spark.createDataFrame([(a, b) for a in names for b in names if a != b], "cb_a string, cb_b string")
    shared = merging.shared_molecules(known, pairs)
    assert sorted(map(tuple, shared.collect())) == sorted(map(tuple, merging.shared_molecules(known).collect()))
    found = pairs.join(shared, ["cb_a", "cb_b"], "left").fillna(0, ["shared"])
    judged = {(names.index(r["cb_a"]), names.index(r["cb_b"])): r for r in merging.chance_overlap(known, found).collect()}
    assert judged[0, 1]["p_value"] == 1
    for pair, (want, off) in CHANCES.items():
        assert abs(judged[pair]["p_value"] - want) <= off
    p, w = probabilities()
    table = st.collision_table(p, w, 8)
    sizes = {cb: Counter(gene for _, gene in found) for cb, found in KNOWN}
    for (a, b), r in judged.items():
        if r["shared"]:
            mean = sum(st.expected_intersection(p, w, table[n - 1], table[sizes[names[b]][g] - 1]) for g, n in sizes[names[a]].items() if g in sizes[names[b]])
            assert r["expected"] == pytest.approx(mean)
            assert r["p_value"] == pytest.approx(1 - sum(math.exp(-mean) * mean**i / math.factorial(i) for i in range(r["shared"])))


def test_chance_targets(spark, known):
    cells = mo.cells(known)
    whitelist = spark.createDataFrame(WHITELIST, "part int, barcode string")
    candidates = merging.whitelist_candidates(cells, whitelist, [3, None])
    for own, other in ((1e-4, 1e-7), (0.9, 0.9)):
        got = {r["cb_from"]: r["cb_to"] for r in merging.poisson_whitelist_targets(known, cells, candidates, own, other).collect()}
        assert len(got) == 8 and got["AAATTAGGTCCA"] is not None and got["AAATTAGGTCCC"] is not None
        assert got["TAATTAGGTCCA"] is None  # no neighbour shares a molecule
        assert got["AAATTAGGTCCG"] == (None if other < 1e-3 else "AAATTAGGTCCC")
    simple = lambda p: {r["cb_from"]: r["cb_to"] for r in merging.poisson_simple_targets(known, cells, 2, p).collect()}
    assert all(a == b for a, b in simple(1e-7).items())
    assert simple(0.9)["AAATTAGGTCCG"] == "AAATTAGGTCCC" and simple(0.9)["CCCCCCCCCCCC"] == "CCCCCCCCCCCC"


def test_near_strings(spark):
    rnd = random.Random(12)
    letters = lambda n: "".join(rnd.choice("ACGT" * 5 + "N") for _ in range(n))
    left = sorted({letters(rnd.randint(1, 9)) for _ in range(50)})
    right = sorted({letters(rnd.randint(1, 9)) for _ in range(50)} | {x[:3] + x[4:] for x in left if len(x) > 4})
    frame = lambda xs, c: spark.createDataFrame([(x,) for x in xs], f"{c} string")
    for k in (1, 2, 4):
        want = {(a, b, edit_distance_of(a, b)) for a in left for b in right if edit_distance_of(a, b) <= k}
        for listed in (2000, 7):  # handed to all tasks at once, or in turns
            assert sorted(map(tuple, merging.near_strings(frame(left, "a"), "a", frame(right, "b"), "b", k, listed).collect())) == sorted(want)


def test_near_strings_by_deletion_keys(spark):
    rnd = random.Random(22)
    letters = lambda n: "".join(rnd.choice("ACGT" * 12 + "N") for _ in range(n))
    left = {letters(rnd.choice([14, 15, 16])) for _ in range(60)} | {"N" * 15, "NNNNN" + letters(10)}

    def edited(x):
        at = rnd.randrange(len(x))
        return rnd.choice([x[:at] + x[at + 1 :], x[:at] + rnd.choice("ACGT") + x[at:], x[:at] + rnd.choice("ACGT") + x[at + 1 :]])

    right = {edited(edited(x)) for x in left} | {edited(x) for x in left} | {letters(15) for _ in range(30)}
    frame = lambda xs, c: spark.createDataFrame([(x,) for x in [*xs, None]], f"{c} string")
    for k in (0, 1, 2, 3):
        want = sorted((a, b, edit_distance_of(a, b)) for a in left for b in right if edit_distance_of(a, b) <= k)
        near = merging.near_strings(frame(left, "a"), "a", frame(right, "b"), "b", k, listed=1)
        assert sorted(map(tuple, near.collect())) == want
    assert "CartesianProduct" not in near._jdf.queryExecution().executedPlan().toString()


def test_a_molecule_of_all_cells_costs_rows_in_proportion(spark):
    """One molecule in all cells: the pairs looked up are those of near barcodes, not all pairs of cells."""
    rnd = random.Random(23)
    names = sorted({"".join(rnd.choice("ACGT") for _ in range(12)) for _ in range(3000)})
    rows = [(cb, "u", "g", 2) for cb in names] + [(cb, f"u{i % 50}", f"g{i % 7}", 2) for i, cb in enumerate(names)]
    m = mo.molecules(spark.createDataFrame(rows, "cb string, umi string, gene string, mark int"))
    cells = mo.cells(m).cache()
    near = merging.near_strings(cells, "cb", cells.withColumnRenamed("cb", "_cb"), "_cb", 2, listed=10)
    pairs = near.filter("cb != _cb").count()
    assert pairs < len(names)
    found = merging.neighbouring(m, cells, 2)
    assert found.count() <= pairs and found.agg({"shared": "min"}).first()[0] >= 1


def test_near_cells_share_what_all_cells_share(spark):
    rnd = random.Random(13)
    rows = [("".join(rnd.choice("AC") for _ in range(5)), f"u{rnd.randint(0, 8)}", f"g{rnd.randint(0, 3)}", 2) for _ in range(400)]
    m = mo.molecules(spark.createDataFrame(rows, "cb string, umi string, gene string, mark int"))
    cells = mo.cells(m)
    near = {tuple(r) for r in merging.neighbouring(m, cells, 2).collect()}
    genes = {r["cb"]: r["n_genes"] for r in cells.collect()}
    want = {(r["cb_a"], r["cb_b"], r["shared"]) for r in merging.shared_molecules(m).collect() if genes[r["cb_b"]] >= genes[r["cb_a"]] and edit_distance_of(r["cb_a"], r["cb_b"]) <= 2}
    assert near == want == {tuple(r) for r in merging.neighbouring(m, cells, 4).collect() if edit_distance_of(r["cb_a"], r["cb_b"]) <= 2}


def test_merge_validation_is_the_same_again(spark, known):
    cells = mo.cells(known)
    runs = [sorted(map(tuple, merging.merge_validation(known, cells.repartition(n), 10, 1, 9).collect())) for n in (1, 5)]
    assert runs[0] == runs[1] and runs[0] and all(1 <= r[2] <= 9 for r in runs[0])


def test_merge_keeps_own_qualities(spark):
    rows = [("AA", "u", "g", 2, "5"), ("AA", "u", "g", 2, "5"), ("CC", "u", "g", 2, "A"), ("CC", "v", "g", 2, "A"), ("GG", "v", "g", 2, "I")]
    m = mo.molecules_with_quality(spark.createDataFrame(rows, "cb string, umi string, gene string, mark int, umi_qual string"), 1)
    targets = spark.createDataFrame([("CC", "AA"), ("GG", "AA")], "cb_from string, cb_to string")
    got = {(r["umi"], r["reads"], tuple(r["qual_sum"])) for r in merging.merge_cells(m, targets).collect()}
    assert got == {("u", 3, (2 * ord("5"),)), ("v", 2, (ord("A"),))}
    fixed = identifiers.apply_targets(m, spark.createDataFrame([("CC", "g", "v", "u")], "cb string, gene string, umi string, target string"))
    assert {(r["cb"], r["umi"], r["reads"], r["qual_sum"][0]) for r in fixed.collect()} == {("AA", "u", 2, 2 * ord("5")), ("CC", "u", 2, ord("A")), ("GG", "v", 1, ord("I"))}
    with pytest.raises(Exception, match="unequal length"):
        mo.molecules_with_quality(spark.createDataFrame([("A", "u", "g", 2, "II"), ("A", "u", "g", 2, "I")], "cb string, umi string, gene string, mark int, umi_qual string")).collect()


def test_directional_by_join_and_by_group(spark):
    rnd = random.Random(14)
    rows = {(f"c{rnd.randint(0, 3)}", "g", "".join(rnd.choice("ACG") for _ in range(3))): rnd.choice((1, 2, 4, 5, 8, 9, 20, 41)) for _ in range(120)}
    m = spark.createDataFrame([(*k, n, 2) for k, n in rows.items()], "cb string, gene string, umi string, reads long, mark int")
    joined = {tuple(r) for r in identifiers.directional_targets(m).collect()}
    wild = m.unionByName(spark.createDataFrame([(f"c{i}", "g", "NGGGGGGG", 1000, 2) for i in range(4)], m.schema))  # sends each group to Python
    assert joined and joined == {tuple(r) for r in identifiers.directional_targets(wild).filter("umi != 'NGGGGGGG'").collect()}


def test_error_numbers_of_very_many_reads():
    import dataclasses

    for error in (1e-4, 0.02, 0.3):
        table = st.error_numbers(9, 300, error)
        for r in (1, 7, 299):
            assert st.error_column(9, r, error) == pytest.approx(table[:, r], abs=1e-12)
    m = correction.Model(3, st.error_numbers(9, 50, 1e-3), (20.0, 40.0), np.log([0.9, 0.1]), np.log([0.2, 0.8]), tuple(range(1, 70)), 1e-3)
    whole = dataclasses.replace(m, errors=st.error_numbers(9, 13_000, 1e-3))
    drawn = st.neighbours_beyond(0.01, m.most, 10, 0)
    zeros = np.zeros(2)
    for large, small in ((10_000, [3, 2_000]), (10_000, [1, 1]), (40, [5, 5]), (45, [1, 10_000])):
        assert correction.likely_errors(m, small, large, zeros, zeros, 0, drawn) == correction.likely_errors(whole, small, large, zeros, zeros, 0, drawn)
    assert m.error_columns(3, np.array([10_000])) != pytest.approx(m.errors[:3, 50:51], abs=1e-3)  # they are not taken for the last of the table


def test_error_numbers():
    m = st.error_numbers(3, 6, 0.3)
    for r in range(7):  # each read is wrong with 0.3 and then goes to one of the neighbours, with one to spare
        want = np.zeros(4)
        for wrong in itertools.product((0, 1), repeat=r):
            weight = 0.3 ** sum(wrong) * 0.7 ** (r - sum(wrong))
            hit = st.neighbour_matrix(1.0, 4, max(1, r))[:, sum(wrong)]
            want += weight * hit[:4]
        assert m[:, r] == pytest.approx(want)
        assert m[2, r] == pytest.approx(st.error_number_probability(2, r, 0.3, st.neighbour_matrix(1.0, 4, 6)))
    assert st.neighbours_hit(0.2, 9, 30) == pytest.approx(tuple(st.neighbour_matrix(0.2, 9, 30)[:, 30]))
    raw, tail = (st.neighbours_beyond(0.2, 9, 30, 2, kind=k) for k in ("raw", "tail"))
    assert raw.sum() == pytest.approx(1) and tail[0] == pytest.approx(1) and tail[3] == pytest.approx(raw[3:].sum())
    ratio = st.neighbours_beyond(0.2, 9, 30, 2, smaller=3, kind="ratio")
    assert ratio[2] == pytest.approx((raw[2] + raw[3]) / (raw[0] + raw[1]))


def test_adjusted_error_prior():
    prior = np.array([0.5, 0.3, 0.2])
    p = (2 + 1) / 9  # a present neighbour is met with its share
    got = st.adjusted_error_prior(prior, 1, 9)
    assert got == pytest.approx([0.5 + 0.3 * p + 0.2 * p * p, 0.3 * (1 - p) + 0.2 * 2 * p * (1 - p), 0.2 * (1 - p) ** 2])


def model(length=3):
    return correction.Model(length, st.error_numbers(9, 200, 0.001), (20.0, 40.0), np.log([0.9, 0.1]), np.log([0.2, 0.8]), tuple(range(1, 70)))


def brute_errors(m, small, large, log_error, log_all, larger, drawn):
    """The likeliest number of errors, term by term."""
    scores, log = [], lambda x: math.log(x) if x > 0 else -math.inf
    for n in range(len(small) + 1):
        total = min(large + sum(small[:n]), m.errors.shape[1] - 1)
        prior = [m.errors[e, min(large + sum(small[:e]), m.errors.shape[1] - 1)] for e in range(len(small) + 1)]
        prior = [x / sum(m.errors[k, min(large + sum(small[:e]), m.errors.shape[1] - 1)] for k in range(len(small) + 1)) for e, x in enumerate(prior)]
        share = (len(small) + larger) / m.most
        seen = sum(prior[e] * math.comb(e, e - n) * share ** (e - n) * (1 - share) ** n for e in range(n, len(small) + 1))
        true = drawn[len(small) - n] / sum(drawn[: len(small) + 1])
        scores.append(log(seen) + log(true) + ([0, *log_error][n]) + sum(log_all[n:]))
        assert total >= large
    return max(range(len(scores)), key=lambda i: (scores[i], -i))


def test_likely_errors():
    rnd, m = random.Random(15), model()
    for _ in range(200):
        small = sorted(rnd.randint(1, 12) for _ in range(rnd.randint(1, 4)))
        k = [rnd.randint(0, 1) for _ in small]
        larger, large = rnd.randint(0, 2), rnd.randint(12, 120)
        drawn = st.neighbours_beyond(rnd.random(), m.most, rnd.randint(1, 40), larger)
        args = (m, small, large, m.quality_error[k], m.quality_all[k], larger, drawn)
        assert correction.likely_errors(*args) == brute_errors(*args)


def test_resolved():
    assert correction.resolved(["a", "b", "c"], ["b", "c", "a"]) == {"a", "b"}
    assert correction.resolved(["a", "a"], ["x", "y"]) == {"a"}
    assert correction.resolved(["a", "b"], ["b", "a"]) == {"a"}


def test_errors_of_a_gene_are_resolved(spark):
    reads = {"AAA": 100, "AAC": 2, "CCC": 80, "GGG": 90, "GGT": 85}
    good = {u: [10.0, 10.0, 10.0] if u == "AAC" else [35.0] * 3 for u in reads}
    assert correction.kept_identifiers(model(), reads, good, dict.fromkeys(reads, 0.02)) == ["AAA", "CCC", "GGG", "GGT"]


def test_correction_entry(spark):
    rnd = random.Random(16)
    rows = []
    for i in range(400):
        umi = "".join(rnd.choice("ACGT") for _ in range(5))
        rows.append((f"c{i % 7}", f"g{i}", umi, 30, 2, [35] * 5))
        if i % 3 == 0:
            at = rnd.randrange(5)
            wrong = umi[:at] + rnd.choice([b for b in "ACGT" if b != umi[at]]) + umi[at + 1 :]
            rows.append((f"c{i % 7}", f"g{i}", wrong, 1, 2, [12 if j == at else 35 for j in range(5)]))
    m = spark.createDataFrame(rows, "cb string, gene string, umi string, reads long, mark int, qual array<int>")
    for method in ("bayesian", "classic"):
        kept = correction.correct_identifiers(m, 5, method, "reads")
        assert {r["reads"] for r in kept.collect()} == {30} and kept.count() == 400
        for kind in ("matrix", "umis"):
            assert {r["n"] for r in correction.correct_identifiers(m, 5, method, kind).collect()} == {1}
    assert correction.error_share(m) == pytest.approx(134 / (134 + 400 * 30))
    for wrong in ({"method": "x"}, {"returns": "x"}):
        with pytest.raises(ValueError, match="unknown"):
            correction.correct_identifiers(m, 5, **wrong)


def spread(values, counts, lag=0.05):
    """The knee of the curve written out cell by cell."""
    log_size, log_rank = np.log(np.repeat(values, counts)), np.log(np.arange(1, sum(counts) + 1))
    k = max(1, int(np.round(len(log_size) * lag)))
    slope = lambda x, y: (y[k:] - y[:-k]) / (x[k:] - x[:-k])
    x, y = log_rank[k:], slope(log_rank, log_size)
    x2, y2 = x[k:], slope(x, y)
    up = np.concatenate(([0], (y2 > 1e-12).astype(int), [0]))
    starts, ends = np.flatnonzero(np.diff(up) == 1), np.flatnonzero(np.diff(up) == -1)
    most = int(np.round(np.exp(x2[starts[np.argmax(ends - starts)] if len(starts) else len(x2) - 1])))
    return np.exp(x[np.argmin(y[: max(1, most - k)])]) - k / 2, most


def test_knee_by_distinct_sizes():
    rnd = np.random.default_rng(3)
    for _ in range(60):
        values = np.unique(np.concatenate((rnd.pareto(1.2, 500) * 50 + 1, rnd.normal(5000, 1500, 80).clip(200))).astype(int))[::-1].astype(float)
        counts = rnd.geometric(0.3, len(values))
        counts[-3:] += rnd.integers(0, 2000)
        expected, most = quality.knee(values.tolist(), counts.tolist())
        want = spread(values, counts)
        assert most == want[1] and abs(expected - want[0]) < 0.5 + 1e-6


def test_scores(spark):
    rnd = np.random.default_rng(4)
    n = 120
    x = np.concatenate((rnd.normal(0, 1, (60, 3)), rnd.normal(3, 1, (60, 3))))
    x[5, 2] = 50
    rows = spark.createDataFrame([(f"c{i:03d}", *map(float, x[i])) for i in range(n)], "cb string, a double, b double, c double")
    sizes = spark.createDataFrame([(f"c{i:03d}", 1000 - i) for i in range(n)], "cb string, n_umis long")
    number = {"min": 50, "expected": 60, "max": 70}
    got = {r["cb"]: r["score"] for r in quality.score_cells(rows, sizes, ["a", "b", "c"], number, flags=["c"]).collect()}
    z = (x - x.min(0)) / (x.max(0) - x.min(0))
    values, vectors = np.linalg.eigh(np.cov(z, rowvar=False))
    order = np.argsort(values)[::-1]
    share = np.cumsum(values[order]) / values.sum()
    pcs = z @ vectors[:, order][:, : min(3, int(np.searchsorted(share, 0.98) + 1))]
    pcs = (pcs - pcs.min(0)) / (pcs.max(0) - pcs.min(0))
    high = [i for i in range(50) if i != 5]
    low = [5, *range(69, n)][:74]  # the outlier counts as low: the components use its feature
    kernel = lambda data, at: st.density(data, st.normal_bandwidth(data) + 1e-9 * np.eye(data.shape[1]), at)
    d1, d0 = kernel(pcs[high], pcs), kernel(pcs[low], pcs)
    want = np.where((d1 + d0) / 2 < 1e-10, 0.5, d1 / np.maximum(d1 + d0, 1e-300))
    assert [got[f"c{i:03d}"] for i in range(n)] == pytest.approx(want.tolist(), abs=1e-6)


def test_saturation_curve(spark):
    rnd = np.random.default_rng(5)
    reads = rnd.negative_binomial(2, 0.3, 20000)
    counts = Counter(int(r) for r in reads if r)
    for ratio in (0.0, 0.3, 0.7, 1.0):
        assert st.good_toulmin(counts, ratio) == pytest.approx(sum(n * (1 - (1 - ratio) ** k) for k, n in counts.items()))
    for ratio in (1.5, 2.0, 4.0):  # gamma rates: the chance of no read at `ratio` times the depth
        truth = 20000 * (1 - (0.3 / (0.3 + 0.7 * ratio)) ** 2)
        assert abs(st.good_toulmin(counts, ratio) / truth - 1) < 0.05


def test_library_tags(spark):
    from tallywright.operators.layouts import PROTOCOLS, Layout

    rows = [(0, "AAAACCCC", "GGGGTTTTACGTAC", "ACGTACGTACGT", t) for t in ("TTGG", "TTGC", "CCCC")]
    reads = spark.createDataFrame([(i, a, "I" * len(a), b, "I" * len(b), g, "I" * len(g), t) for i, (_, a, b, g, t) in enumerate(rows)], "ord int, seq1 string, qual1 string, seq2 string, qual2 string, seq3 string, qual3 string, seq4 string")
    got = {r["ord"]: (r["cb"], r["outcome"]) for r in PROTOCOLS["indrop3"](reads, Layout(library_tag="TTGG", max_tag_edits=1)).collect()}
    assert got == {0: ("AAAACCCCGGGGTTTT", "ok"), 1: ("AAAACCCCGGGGTTTT", "ok"), 2: (None, "other_library")}


def test_written_results(spark, known, tmp_path):
    found = plan.estimate(known.select("cb", "umi", "gene", F.lit("chr1").alias("chrom"), "mark"), plan.Settings(min_genes_before=1, min_genes_after=1, merge="simple", directional=True))
    results.write_results(found, str(tmp_path / "out"))
    for name, rows in found.items():
        assert spark.read.parquet(str(tmp_path / "out" / name)).count() == rows.count()
    line = spark.createDataFrame([("@r0!A#C", "A", "C", "I", "J")], "read_id string, cb string, umi string, cb_qual string, umi_qual string")
    tagging.write_params(line, str(tmp_path / "params"))
    assert [tuple(r) for r in annotation.read_params(spark, str(tmp_path / "params")).collect()] == [("r0!A#C", "A", "C", "I", "J")]
    (tmp_path / "c.xml").write_text("<config><Estimation><Merge><max_cb_merge_edit_distance> 2 </max_cb_merge_edit_distance></Merge></Estimation></config>")
    assert annotation.read_config(str(tmp_path / "c.xml")) == {"Estimation": {"Merge": {"max_cb_merge_edit_distance": "2"}}}
    names = spark.createDataFrame([("g1_intron_3_0_chr1",), ("g2",)], "name string")
    assert [r[0] for r in names.select(annotation.trimmed_intron_name("name")).collect()] == ["g1", "g2"]
