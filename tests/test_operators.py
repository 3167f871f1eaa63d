"""Molecules, cell merging, identifiers, intervals and sources on the literal fixtures, and properties by brute force."""

import random
import struct
import zlib

import pytest
from pyspark.sql import functions as F

from tallywright.operators import identifiers, intervals, merging, quality, results
from tallywright.operators import molecules as mo
from tallywright.sources import annotation, bam, fastq
from tallywright.streaming.molecules import streaming_molecules

CELLS = {
    "AAATTAGGTCCA": [("AAACCT", "Gene1"), ("CCCCCT", "Gene2"), ("ACCCCT", "Gene3"), ("ACCCCT", "Gene4")],
    "AAATTAGGTCCC": [("CAACCT", "Gene1"), ("CAACCT", "Gene10"), ("CAACCT", "Gene20")],
    "AAATTAGGTCCG": [("CAACCT", "Gene1")],
    "AAATTAGGTCGG": [("AAACCT", "Gene1"), ("CCCCCT", "Gene2")],
    "CCCTTAGGTCCA": [("CCATTC", "Gene3"), ("CCCCCT", "Gene2"), ("ACCCCT", "Gene3")],
    "CAATTAGGTCCG": [("CAACCT", "Gene1"), ("AAACCT", "Gene1"), ("CCCCCT", "Gene2")],
    "AAAAAAAAAAAA": [("CCCCCT", "Gene2")],
}
WHITELIST = [(0, "AAT"), (0, "GAA"), (0, "AAA"), (1, "TTAGGTCCA"), (1, "TTAGGGGCC"), (1, "TTAGGTCCC")]


@pytest.fixture(scope="module")
def reads(spark):
    rows = [(cb, umi, gene, "", 2, umi) for cb, found in CELLS.items() for umi, gene in found]
    return spark.createDataFrame(rows, "cb string, umi string, gene string, chrom string, mark int, umi_qual string")


def test_whitelist_merge(spark, reads):
    m = mo.molecules(reads)
    cells = mo.cells(m)
    whitelist = spark.createDataFrame(WHITELIST, "part int, barcode string")
    candidates = merging.whitelist_candidates(cells, whitelist, [3, None])
    targets = merging.whitelist_targets(m, cells, candidates, min_fraction=0)
    got = {r["cb_from"]: r["cb_to"] for r in targets.collect()}
    a, c = "AAATTAGGTCCA", "AAATTAGGTCCC"
    assert got == {a: a, c: c, "AAATTAGGTCCG": c, "AAATTAGGTCGG": a, "CCCTTAGGTCCA": a, "CAATTAGGTCCG": a, "AAAAAAAAAAAA": None}
    ranks = cells.select("cb", F.struct("n_genes", "n_umis", "n_reads", "cb").alias("rank"))
    merged = {(r["cb"], r["gene"], r["umi"]): r["reads"] for r in merging.merge_cells(m, merging.closure(targets, ranks)).collect()}
    assert {k[0] for k in merged} == {a, c}
    assert merged[c, "Gene1", "CAACCT"] == 2 and merged[a, "Gene1", "AAACCT"] == 3 and merged[a, "Gene2", "CCCCCT"] == 4
    assert merged[a, "Gene3", "ACCCCT"] == 2 and merged[a, "Gene3", "CCATTC"] == 1 and len([k for k in merged if k[:2] == (a, "Gene1")]) == 2


def test_shared_molecules(reads):
    got = {(r["cb_a"], r["cb_b"]): r["shared"] for r in merging.shared_molecules(mo.molecules(reads)).collect()}
    names = list(CELLS)
    assert got[names[0], names[4]] == 2 and got[names[1], names[2]] == 1 and (names[0], names[1]) not in got


def follow(targets, rank):
    """Merges applied one by one in ascending rank, with forwarding."""
    now = {c: c for c in targets}
    for c in sorted(targets, key=lambda x: rank[x]):
        to = targets[c]
        if to is None:
            end = None
        else:
            end = now[to]
        if end == c:
            continue
        for x in now:
            if now[x] == c:
                now[x] = end
    return now


def test_closure_follows_forwarding(spark):
    rnd = random.Random(7)
    for _ in range(6):
        n = rnd.randint(2, 12)
        names = [f"c{i:02d}" for i in range(n)]
        rank = dict(zip(names, rnd.sample(range(100), n)))
        targets = {c: rnd.choice([*names, None]) if rnd.random() < 0.15 else rnd.choice(names) for c in names}
        t = spark.createDataFrame(list(targets.items()), "cb_from string, cb_to string")
        r = spark.createDataFrame(list(rank.items()), "cb string, rank int")
        got = {x["cb_from"]: x["cb_to"] for x in merging.closure(t, r).collect()}
        assert got == follow(targets, rank)


def test_merge_all_by_pieces(spark):
    rnd = random.Random(9)
    names = sorted({"".join(rnd.choice("ACGT") for _ in range(6)) for _ in range(60)})
    cells = spark.createDataFrame([(c, rnd.randint(1, 9)) for c in names], "cb string, n_umis int").cache()
    size = {r["cb"]: r["n_umis"] for r in cells.collect()}
    from tallywright.functions.sequences import edit_distance_of

    for k in (1, 2):
        want = {}
        for c in names:
            near = [(edit_distance_of(c, x), -size[x], x) for x in names if size[x] > size[c] and edit_distance_of(c, x) <= k]
            want[c] = min(near)[2] if near else c
        assert {r["cb_from"]: r["cb_to"] for r in merging.all_targets(cells, k).collect()} == want


def test_directional(spark):
    sizes = {"AAA": 2, "AAC": 5, "AAT": 6, "AGT": 20, "CCC": 10, "TCC": 20}
    m = spark.createDataFrame([("c", "g", u, n, 2) for u, n in sizes.items()], "cb string, gene string, umi string, reads long, mark int")
    assert {(r["umi"], r["target"]) for r in identifiers.directional_targets(m).collect()} == {("AAA", "AGT"), ("AAT", "AGT"), ("CCC", "TCC")}


def test_unknown_bases(spark):
    rows = [("Gene1", u, n) for u, n in [("AAACCT", 2), ("AAACCG", 1), ("AAACCN", 1), ("CCCCCT", 1), ("ACCCCT", 1)]] + [("Gene2", u, 1) for u in ("TTTTTT", "TTTNNG", "TTGNNG", "ACCCCT", "NNNNNN")]
    m = spark.createDataFrame([("c", g, u, n, 2) for g, u, n in rows], "cb string, gene string, umi string, reads long, mark int")
    done = identifiers.apply_targets(m, identifiers.unknown_base_targets(m)).collect()
    one = {r["umi"]: r["reads"] for r in done if r["gene"] == "Gene1"}
    assert len(one) == 4 and one["AAACCT"] == 3 and not any("N" in r["umi"] for r in done)
    assert sum(r["reads"] for r in done) == sum(n for *_, n in rows)


def test_marks_are_joined_before_they_are_asked(spark):
    rows = [("c", "u1", "g", 2), ("c", "u1", "g", 1), ("c", "u2", "g", 2)]
    m = mo.molecules(spark.createDataFrame(rows, "cb string, umi string, gene string, mark int"))
    n = lambda level: sum(r["n"] for r in mo.counts(m, level).collect())
    assert (n("e"), n("eE"), n("i")) == (1, 2, 0)


def brute_segments(rows):
    edges = sorted({x for a, b, _ in rows for x in (a, b)})
    out = set()
    for a, b in zip(edges, edges[1:]):
        labels = tuple(sorted({name for s, e, name in rows if s <= a < e}))
        if labels:
            out.add((a, b, labels))
    return out


def test_segments_and_coalesce(spark):
    rnd = random.Random(3)
    rows = [(s, s + rnd.randint(1, 40_000), rnd.choice("abc")) for s in (rnd.randint(0, 100_000) for _ in range(40))]
    df = spark.createDataFrame([("chr1", *r) for r in rows], "chrom string, start_pos long, end_pos long, label string")
    got = {(r["start_pos"], r["end_pos"], tuple(r["labels"])) for r in intervals.segments(df, "label").collect()}
    assert got == brute_segments(rows)
    for ranges in (1, 3, 50):  # one chromosome over many tasks, intervals carried over several ranges
        again = {(r["start_pos"], r["end_pos"], tuple(r["labels"])) for r in intervals.segments(df.repartition(3), "label", ranges=ranges).collect()}
        assert again == got
    named = df.select(F.col("chrom").alias("_g"), F.col("start_pos").alias("a"))
    assert len(intervals.range_starts(named, 20).first()["starts"]) > 10
    odd = spark.createDataFrame([("c", 5, 5, "a"), ("c", 9, 2, "a"), ("c", None, 3, "b"), (None, 1, 2, "a"), ("c", 1, 4, None), ("d", 0, 3, "x"), ("d", 1, 2, "x"), ("d", 3, 4, "x")], "chrom string, start_pos long, end_pos long, label string")
    assert sorted(map(tuple, intervals.segments(odd, "label").collect())) == [("d", 0, 1, ["x"]), ("d", 1, 2, ["x"]), ("d", 2, 3, ["x"]), ("d", 3, 4, ["x"])]
    points = {x for a, b, name in rows if name == "a" for x in (a, b - 1)}
    merged = [(r["start_pos"], r["end_pos"]) for r in intervals.coalesce(df.filter("label = 'a'"), ["chrom"]).collect()]
    assert all(any(a <= x < b for a, b in merged) for x in points)
    assert all(b1 < a2 for (_, b1), (a2, _) in zip(sorted(merged), sorted(merged)[1:]))


ANNOTATION = [
    ("chr1", "WASH7P", "T1", 14361, 18366), ("chr1", "WASH7P", "T1", 24320, 29370), ("chrX", "FAM138A", "T2", 34610, 35174), ("chrX", "FAM138A", "T2", 35276, 35481),
]


def test_two_ends(spark):
    ann = spark.createDataFrame([(*r, "exon") for r in ANNOTATION], "chrom string, gene_name string, transcript_id string, start_pos long, end_pos long, kind string")
    rows = [(1, "chrX", 34610, 34620), (2, "chrX", 34600, 34615), (3, "chr1", 24315, 24325), (4, "chr1", 23750, 24750), (5, "chr1", 20000, 20010), (6, "chr1", 10, 20), (7, "chr9", 1, 2)]
    got = {r["id"]: (r["gene"], r["mark"]) for r in intervals.annotate(spark.createDataFrame(rows, "id long, chrom string, pos long, end_pos long"), ann).collect()}
    assert got == {1: ("FAM138A", 2), 2: ("FAM138A", 3), 3: ("WASH7P", 6), 4: ("WASH7P", 6), 5: ("WASH7P", 4), 6: (None, 0)}


def test_fastq_round_trip(spark, tmp_path):
    path = tmp_path / "r.fastq"
    path.write_text("@a\nACGT\n+\nIIII\n@b\nGG\n+\n@@")
    got = [(r["ord"], r["id"], r["seq"], r["qual"]) for r in fastq.read_fastq(spark, str(path)).orderBy("ord").collect()]
    assert got == [(0, "@a", "ACGT", "IIII"), (1, "@b", "GG", "@@")]
    fastq.write_fastq(fastq.read_fastq(spark, str(path)).withColumnRenamed("id", "read_id"), str(tmp_path / "out"), 1)
    assert fastq.read_fastq(spark, str(tmp_path / "out")).count() == 2
    (tmp_path / "bad.fastq").write_text("@a\nACGT\n+\nIII\n")
    with pytest.raises(Exception, match="unequal length"):
        fastq.read_fastq(spark, str(tmp_path / "bad.fastq")).collect()


def encode_bam(rows):
    body = b"BAM\1" + struct.pack("<i", 0) + struct.pack("<i", 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 1000)
    for name, ref, pos, flag, seq, tags in rows:
        codes = ["=ACMGRSVTWYHKDBN".index(c) for c in seq] + [0]
        packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(seq), 2))
        rec = struct.pack("<iiBBHHHiiii", ref, pos, len(name) + 1, 0, 0, 1, flag, len(seq), -1, -1, 0) + name.encode() + b"\0" + struct.pack("<I", len(seq) << 4)
        rec += packed + bytes([30] * len(seq)) + b"".join(k.encode() + b"Z" + v.encode() + b"\0" for k, v in tags.items())
        body += struct.pack("<i", len(rec)) + rec
    out = b""
    for i in range(0, len(body), 50):
        z = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += z.compress(body[i : i + 50]) + z.flush()
    return out


def test_bam(spark, tmp_path):
    (tmp_path / "x.bam").write_bytes(encode_bam([("r1", 0, 10, 0, "ACG", {"CB": "AA", "UB": "CC"}), ("r2", 0, 5, 4, "AC", {}), ("r3", -1, 5, 256, "AC", {})]))
    got = bam.read_bam(spark, str(tmp_path / "x.bam"))
    row = bam.barcode_tags(got).first()
    assert got.count() == 1 and (row["name"], row["chrom"], row["pos"], row["end_pos"], row["seq"], row["cb"], row["umi"]) == ("r1", "chr1", 10, 13, "ACG", "AA", "CC")
    assert bam.read_bam(spark, str(tmp_path / "x.bam"), all_records=True).count() == 3


def encode_blocked(body, size):
    out = b""
    for part in [body[i : i + size] for i in range(0, len(body), size)] + [b""]:
        z = zlib.compressobj(6, zlib.DEFLATED, -15)
        packed = z.compress(part) + z.flush()
        head = b"\x1f\x8b\x08\x04" + bytes(6) + struct.pack("<H", 6) + b"BC" + struct.pack("<HH", 2, len(packed) + 25)
        out += head + packed + struct.pack("<II", zlib.crc32(part), len(part))
    return out


@pytest.mark.parametrize("size", [97, 400, 5000])
def test_bam_in_ranges(spark, tmp_path, size):
    rnd = random.Random(size)
    letters = lambda n: "".join(rnd.choice("ACGTN") for _ in range(n))
    rows = [(f"r{i}:{letters(4)}", rnd.randint(-1, 0), rnd.randint(0, 900), rnd.choice((0, 4, 16, 256)), letters(rnd.randint(1, 150)), {"CB": letters(16), "UB": letters(10)}) for i in range(1500)]
    body = zlib.decompressobj(31)
    plain, rest = b"", encode_bam(rows)
    while rest:
        body = zlib.decompressobj(31)
        plain, rest = plain + body.decompress(rest), body.unused_data
    (tmp_path / "x.bam").write_bytes(encode_blocked(plain, size))
    whole = [r for r in bam.read_bam(spark, str(tmp_path), all_records=True, split=1 << 30).orderBy("ord").collect()]
    assert [(r["name"], r["seq"], r["flag"], r["tags"]["CB"]) for r in whole] == [(n, q, f, t["CB"]) for n, _, _, f, q, t in rows]
    split = bam.read_bam(spark, str(tmp_path), all_records=True, split=4000)
    assert split.rdd.getNumPartitions() > 10
    assert split.orderBy("ord").collect() == whole


def test_annotation_params_whitelist(spark, tmp_path):
    gtf = tmp_path / "a.gtf"
    gtf.write_text('#x\nchr1\tunknown\texon\t878633\t878757\t.\t+\t2\tgene_id "SAMD11"; gene_name "SAMD11"; transcript_id "NM_152486";\nchr1\tu\tCDS\t1\t2\t.\t+\t.\tgene_id "x";\n')
    rows = annotation.read_annotation(spark, str(gtf)).collect()
    assert [(r["chrom"], r["gene_name"], r["transcript_id"], r["start_pos"], r["end_pos"], r["kind"]) for r in rows] == [("chr1", "SAMD11", "NM_152486", 878632, 878757, "exon")]
    (tmp_path / "a.bed").write_text("chr1 5 9 g1\n")
    assert annotation.read_annotation(spark, str(tmp_path / "a.bed")).first()["transcript_id"] == "g1"
    (tmp_path / "p.txt").write_text("@r1 AA CC II II\n@r1 GG TT II II\nbad line\n")
    assert [(r["name"], r["cb"]) for r in annotation.read_params(spark, str(tmp_path / "p.txt")).collect()] == [("r1", "AA")]
    (tmp_path / "w.txt").write_text("ATT TTC TTT\nTGGACCTAA GGCCCCTAA GGGACCTAA")
    got = [(r["part"], r["barcode"]) for r in annotation.read_whitelist(spark, str(tmp_path / "w.txt"), "indrop").orderBy("part", "idx").collect()]
    assert got == WHITELIST


def test_matrix_market(spark, tmp_path):
    counts = spark.createDataFrame([("c1", "g1", 2), ("c2", "g1", 1), ("c2", "g2", 5)], "cb string, gene string, n long")
    results.write_matrix_market(counts, str(tmp_path / "m"))
    lines = {r["value"] for r in spark.read.text(str(tmp_path / "m" / "matrix")).collect()}
    assert lines == {"1 1 2", "1 2 1", "2 2 5"}


def test_cell_number_and_scores(spark):
    sizes = spark.createDataFrame([(f"c{i:04d}", 5000 - i if i < 200 else max(1, 60 - i // 40)) for i in range(1500)], "cb string, n_umis long")
    found = quality.cell_number(sizes)
    assert 100 <= found["expected"] <= 260 and found["min"] <= found["expected"]
    labels = {r["quality"]: r["n"] for r in quality.labels(sizes, {"min": 100, "expected": 150, "max": 400}).groupBy("quality").agg(F.count("*").alias("n")).collect()}
    assert labels == {"High": 100, "Unknown": 299, "Low": 1101}


def test_stream(spark, reads, tmp_path):
    reads.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(reads.schema).parquet(str(tmp_path / "in"))
    q = streaming_molecules(stream).writeStream.outputMode("complete").format("memory").queryName("mols").start()
    q.processAllAvailable()
    q.stop()
    assert spark.table("mols").count() == mo.molecules(reads).count()


def test_order_statistics(spark):
    import numpy as np

    from tallywright.operators import molecules as mo_
    from tallywright.operators import selection as sel

    rnd = np.random.default_rng(3)
    tables = [[5.0], [1.0, 2.0], [3.0] * 50 + [4.0], rnd.normal(size=3001).tolist(), np.exp(rnd.normal(scale=30, size=2000)).tolist() + [0.0] * 300, (1e6 + rnd.integers(0, 5, 900) * 1e-9).tolist(), [-1e308, 1e308, 0.0, 1e-300, 2e-300, 3e-300, -5.0]]
    for x in tables:
        rows = spark.createDataFrame([(v,) for v in [*x, None, float("nan")]], "v double").repartition(3).cache()
        for share in (0.0, 0.1, 0.5, 0.99, 1.0):
            assert sel.quantile(rows, "v", share) == pytest.approx(float(np.quantile(np.array(x), share)), rel=1e-12) or max(map(abs, x)) > 1e300
        cut = int(len(x) * 0.2)
        want = np.sort(x)[cut : len(x) - cut].mean()
        assert sel.trimmed_mean(rows, "v", 0.2) == pytest.approx(want, rel=1e-9, abs=1e-9)
        assert sel.median(rows, "v") == pytest.approx(float(np.median(x)), rel=1e-12, abs=1e-300)
    none = spark.createDataFrame([(None,)], "v double")
    assert sel.median(none, "v") is None and sel.trimmed_mean(none, "v", 0.2) is None
    many = spark.range(20000).select((F.col("id") % 9973 * 1.5).alias("v"))  # more distinct values than a round looks at
    assert sel.median(many, "v") == pytest.approx(float(np.median(np.arange(20000) % 9973 * 1.5)))

    long_ = spark.createDataFrame([("c", "g", u) for u in ("ACGTACGTACGTACGT", "TCGTACGTACGTACGT", "TCGTACGTACGTACGA", "NNGTACGTACGTACGA")] + [("d", "g", "ACGTACGTACGTACGT")], "cb string, gene string, umi string")
    found = {r["umi"]: (r["p"], int(r["times"])) for r in mo_.implicit_umi_distribution(long_, 16, 1.0).collect()}
    assert len(found) == 4 and found[None][1] == 4**16 - 3 and found["ACGTACGTACGTACGT"][0] == pytest.approx(6 / (4 + 4.0 * 4**16))
    assert sum(p * n for p, n in found.values()) == pytest.approx(1)


def test_a_scope_removes_what_was_written_in_it(spark, tmp_path):
    import os

    from tallywright.operators import tables

    paths = lambda df: {os.path.dirname(f.removeprefix("file:").replace("//", "/")) for f in df.inputFiles()}
    outside = paths(tables.stored(spark.range(3)))
    with tables.scope(spark):
        inner = paths(tables.stored(spark.range(4)))
        with tables.scope(spark):
            innermost = paths(tables.stored(spark.range(5)))
        assert not any(map(os.path.exists, innermost)) and all(map(os.path.exists, inner))
    assert not any(map(os.path.exists, inner)) and all(map(os.path.exists, outside))
    with pytest.raises(ZeroDivisionError), tables.scope(spark):
        inner = paths(tables.stored(spark.range(4)))
        1 / 0
    assert not any(map(os.path.exists, inner)) and tables.SCOPES == []
