"""Sequence and statistics functions on the literal fixtures."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywright.functions import sequences as s
from tallywright.functions import statistics as st
from tallywright.operators import layouts, tagging

# The sequences, read ids and barcodes below and what is expected of them are known cases, stated as they are.
SPACER = "GAGTGATTGCTTGTGACGCCTT"
V1 = layouts.Layout(barcode1=8, barcode1_longest=11, barcode2=8, umi=6, tail=8, spacer=SPACER, max_spacer_edits=3, spacer_search=5)


@pytest.mark.parametrize(
    ("a", "b", "wild", "want"),
    [("ATTTTC", "ATTTGC", True, 1), ("ATTTTCC", "ATTTGNC", True, 1), ("ATTTTCC", "ATTTGNC", False, 2), ("ATTTTCC", "ATTTGTC", True, 2), ("ACGT", "ACGT", True, 0), ("BC", "ABC", True, 1)],
)
def test_edit_distance(spark, a, b, wild, want):
    row = spark.createDataFrame([(a, b)], "a string, b string").select(s.edit_distance(F.col("a"), F.col("b"), wild).alias("d")).first()
    assert row["d"] == want


def test_hamming_and_reverse_complement(spark):
    df = spark.createDataFrame([("ACGNT", "ACCTT")], "a string, b string")
    row = df.select(s.hamming_distance(F.col("a"), F.col("b")).alias("w"), s.hamming_distance(F.col("a"), F.col("b"), False).alias("p"), s.reverse_complement(F.col("a")).alias("r")).first()
    assert (row["w"], row["p"], row["r"]) == (1, 2, "ANCGT")
    with pytest.raises(Exception, match="unequal length"):
        df.select(s.hamming_distance(F.col("a"), F.lit("A")).alias("x")).collect()


@pytest.mark.parametrize(("name", "want"), [("@111!ATTTGC#ATATC", ("ATTTGC", "ATATC")), ("trash!ATTTG#ATAT", ("ATTTG", "ATAT")), ("!ATTTGC#ATATC", ("ATTTGC", "ATATC")), ("ATTTG#ATAT", (None, None))])
def test_read_ids(spark, name, want):
    assert tuple(spark.createDataFrame([(name,)], "n string").select(*s.parse_read_id(F.col("n"))).first()) == want


@pytest.mark.parametrize(
    ("seq", "cb", "umi", "outcome"),
    [
        ("TAGTTTCGGAGTGTTTGCTTGTGACGCCTTACCTTGCCCGCGACTTTTTTTTTTT", "TAGTTTCGACCTTGCC", "CGCGAC", "modified"),
        ("TAGTCTAGGAGTGATTGCTTGTGACGCCTTTCATCCTTATAATATTTTTTTTTTT", "TAGTCTAGTCATCCTT", "ATAATA", "ok"),
        ("TAGTCTAGGAGTGATTGCTTGTGACGGGTTTCATCCTTATAATATTTTTTTTTTT", "TAGTCTAGTCATCCTT", "ATAATA", "modified"),
        ("TAGTCTAG", None, None, "short"),
        ("A" * 60, None, None, "no_spacer"),
    ],
)
def test_spacer_layout(spark, seq, cb, umi, outcome):
    reads = spark.createDataFrame([(0, seq, "I" * len(seq), "ACGT" * 10, "I" * 40)], "ord long, seq1 string, qual1 string, seq2 string, qual2 string")
    row = layouts.spacer_reads(reads, V1).first()
    assert (row["cb"], row["umi"], row["outcome"]) == (cb, umi, outcome)


def test_mask():
    parts = layouts.mask_parts("[20]TGAC[20]TCCC[20]CAACGAGGTCGGCTAGGCG(8)")
    assert [n for _, n, _ in parts] == [20, 4, 20, 4, 20, 19, 8]
    with pytest.raises(ValueError, match="not a mask"):
        layouts.mask_parts("[20]tgac")


@pytest.mark.parametrize(
    ("qual", "want"), [(";*;;;;;;;;;;;;;;*", (2, 16)), (";;;;;;;;;;;;;***;", (0, 14)), ("******;;;;;;;;;;;", (5, 17)), ("******;;;;;;;;***", (5, 14))]
)
def test_quality_window(spark, qual, want):
    row = spark.createDataFrame([(qual,)], "q string").select(s.quality_window(F.col("q"), 5, 3, 25).alias("w")).first()
    assert tuple(row["w"]) == want


@pytest.mark.parametrize(("seq", "qual", "want"), [("AAAAAAAAAA", ";;;;;**;;;", True), ("GGGGGAGGGG", ";;;;;;;;;;", False), ("AAAAAAAAAA", "******;;;;", False)])
def test_gene_quality(spark, seq, qual, want):
    assert spark.createDataFrame([(seq, qual)], "s string, q string").select(s.passes_gene_quality(F.col("s"), F.col("q"), 25, 0.8).alias("x")).first()["x"] is want


def test_poly_a(spark):
    rows = [("ACGTCCGGTTAANCG", "CCGG", 3), ("ACGTAAAAAAAACC", "GGG", 4), ("ACGTCCAAN", "GGG", 6), ("ACGT", "GGG", 4)]
    found = spark.createDataFrame(rows, "s string, t string, n int").select("n", s.poly_a_cut(F.col("s"), F.col("t")).alias("got"), s.poly_a_outcome(F.col("s"), F.col("t")).alias("o")).collect()
    assert [r["got"] for r in found[1:]] == [r["n"] for r in found[1:]]
    assert [r["o"] for r in found[1:]] == ["poly_a", "a", "none"]


def test_neighbours_and_fill(spark):
    row = spark.createDataFrame([("ACG", "ANNG")], "a string, b string").select(s.neighbours(F.col("a")).alias("n"), s.filled(F.col("b")).alias("f"), s.filled(F.col("b")).alias("g")).first()
    assert len(set(row["n"])) == 9 and all(sum(x != y for x, y in zip(v, "ACG")) == 1 for v in row["n"])
    assert row["f"] == row["g"] and "N" not in row["f"] and row["f"][0] == "A" and row["f"][3] == "G"


def test_tagging_drops_short_and_bad(spark):
    good, gene = "ACGTACGT" * 3, "ACGTTGCA" * 4
    rows = [(0, good, "I" * 24, good, "I" * 24, gene, "I" * 32), (1, "ACG", "III", good, "I" * 24, gene, "I" * 32), (2, good, "I" * 24, good, "I" * 24, gene, "#" * 32)]
    reads = spark.createDataFrame(rows, "ord long, seq1 string, qual1 string, seq2 string, qual2 string, seq3 string, qual3 string")
    filters = tagging.Filters(min_median_quality=20)
    assert [r["read_id"] for r in tagging.tag_reads(reads, "10x", layouts.Layout(), filters).collect()] == ["@r0!ACGTACGTACGTACGT#ACGTAC"]
    assert {r["ord"]: r["verdict"] for r in tagging.judged(layouts.two_barcode_reads(reads, layouts.Layout()), filters).collect()} == {0: "kept", 1: "short_read1", 2: "low_quality"}


def test_lock_step_raises_on_a_short_file(spark):
    one = spark.createDataFrame([(0, "a", "AC", "II"), (1, "b", "AC", "II")], "ord long, id string, seq string, qual string")
    assert tagging.lock_step([one, one]).count() == 2
    with pytest.raises(Exception, match="prematurely"):
        tagging.lock_step([one, one.filter("ord = 0")]).collect()


def test_collisions_and_poisson(spark):
    table = st.collision_table(np.array([1 / 64]), np.array([64]), 40)
    assert table[0] == 1 and all(b >= a for a, b in zip(table, table[1:])) and table[39] > 55
    rows = [(3, 0.5), (1, 2.0), (20, 3.0), (0, 1.0), (5, 30.0)]
    got = [r["p"] for r in spark.createDataFrame(rows, "k int, m double").select(st.poisson_upper(F.col("k"), F.col("m")).alias("p")).collect()]
    import math

    want = [1 - sum(math.exp(-m) * m**i / math.factorial(i) for i in range(k)) for k, m in rows]
    assert got == pytest.approx(want, rel=1e-6, abs=1e-9)
    assert got[2] == pytest.approx(sum(math.exp(-3) * 3.0**i / math.factorial(i) for i in range(20, 60)), rel=1e-9)


def test_deadjust_inverts(spark):
    table = [1, 2, 4, 7, 11]
    got = [r["x"] for r in spark.createDataFrame([(1.0,), (4.0,), (5.5,), (50.0,)], "v double").select(st.deadjusted(F.col("v"), table).alias("x")).collect()]
    assert got == pytest.approx([1.0, 3.0, 3.5, 5.0])


def test_quantize(spark):
    got = [r["k"] for r in spark.createDataFrame([(0.5,), (1.0,), (9.0,)], "v double").select(st.quantized(F.col("v"), [1.0, 2.0, 3.0]).alias("k")).collect()]
    assert got == [0, 0, 2]


def test_neighbour_matrix_and_saturation():
    m = st.neighbour_matrix(1.0, 6, 10)
    assert m.sum(axis=0) == pytest.approx(np.ones(11)) and m[1, 1] == 1.0
    counts = {1: 100, 2: 50, 3: 20, 4: 8}
    assert st.good_toulmin(counts, 1.0) == 178 and st.good_toulmin(counts, 0.5) < 178 < st.good_toulmin(counts, 2.0) < st.good_toulmin(counts, 4.0)


def observed(rates, share, rnd):
    """How many molecules have 1, 2, ... reads at a share of the reads, and the numbers expected at all multiples."""
    reads = rnd.poisson(rates * share)
    return {int(k): int((reads == k).sum()) for k in np.unique(reads[reads > 0])}


@pytest.mark.parametrize("kind", ["even", "gamma", "lognormal"])
def test_extrapolation_of_known_richness(kind):
    """Molecules of different abundance: within 4 % at five times the reads, the truth in the range of resampling. Where all are
    equally abundant few reads say so: within 6 % at three times, 15 % at five."""
    rnd = np.random.default_rng(5)
    n = 40_000
    rates = {"even": np.ones(n), "gamma": rnd.gamma(1.5, 1 / 1.5, n), "lognormal": rnd.lognormal(-0.3, 0.8, n)}[kind]
    counts = observed(rates, 0.8, rnd)
    ratios = np.array([0.25, 0.5, 1.0, 1.5, 2.0, 3.0, 5.0])
    truth = np.array([(1 - np.exp(-rates * 0.8 * r)).sum() for r in ratios])
    found = st.expected_distinct(counts, ratios)
    off = np.abs(found / truth - 1)
    assert off.max() < 0.04 if kind != "even" else off[:6].max() < 0.06 and off[6] < 0.15
    assert found[2] == sum(counts.values()) and (np.diff(found) > 0).all()
    lower, upper = st.distinct_range(counts, ratios, draws=40)
    assert (lower <= found * 1.02).all() and (upper >= found * 0.98).all()
    assert kind == "even" or ((lower * 0.99 <= truth) & (truth <= upper * 1.01)).all()


def test_extrapolation_without_a_stable_series():
    assert st.expected_distinct({}, np.array([0.0, 1.0, 5.0])).tolist() == [0, 0, 0]
    assert st.expected_distinct({3: 10}, np.array([1.0, 5.0])).tolist() == [10, 10]
    c = st.continued_fraction(np.array([1.0, -1.0, 1.0, -1.0, 1.0]))
    assert st.fraction_at(c, np.array([0.0, 1.0, 3.0])) == pytest.approx([1, 0.5, 0.25])
    c = st.continued_fraction(np.array([(-1) ** k / (k + 1) for k in range(12)]))  # log(1 + t) / t
    assert st.fraction_at(c, np.array([1.0, 4.0])) == pytest.approx([np.log(2), np.log(5) / 4], rel=1e-4)


def test_sparse_components_stand_outliers():
    """A tenth of the rows far out in a direction of their own: the classical first component follows them, the robust one does not."""
    rnd = np.random.default_rng(2)
    n = 1000
    factor, other = rnd.normal(size=n), rnd.normal(size=n)
    data = np.stack([3 * factor, 3 * factor, 1.5 * other, 0.1 * rnd.normal(size=n), 0.1 * rnd.normal(size=n)], axis=1) + 0.05 * rnd.normal(size=(n, 5))
    data[:100, 4] += 60
    classical = np.linalg.eigh(np.cov(data, rowvar=False))[1][:, -1]
    assert abs(classical[4]) > 0.9
    vectors, sizes = st.sparse_components(data)
    assert abs(vectors[:, 0] @ [0.5**0.5, 0.5**0.5, 0, 0, 0]) > 0.98 and abs(vectors[2, 1]) > 0.98
    assert vectors[3, 0] == 0 and abs(vectors[2, 0]) < 0.05 and abs(vectors[4, 0]) < 0.25
    best = max(st.spread(data @ [[np.cos(x)], [np.sin(x)], [0], [0], [0]])[0] for x in np.linspace(0, np.pi, 721))
    assert sizes[0] > 0.97 * best
    constant, zero = st.sparse_components(np.ones((10, 3)))
    assert np.isfinite(constant).all() and (zero == 0).all()
