"""Named queries over the driver's tables, with SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.functions import sequences as s
from tallywright.functions import statistics as st
from tallywright.operators import correction, identifiers, intervals, layouts, merging, pairs, quality, report, tagging
from tallywright.operators import molecules as mo
from tallywright.operators.tables import stored

from . import derived as d

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def mols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mo.molecules(d.reads(spark, sf_dir))


def event_mols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mo.molecules(d.events(spark, sf_dir))


REQUESTED = "mark in (2, 3, 6, 7)"
REAL, FINAL = "select cb from cells where n_genes >= 10", "select cb from cells where n_genes >= 10 and req_genes >= 10"


# molecules and matrices


@query(f"with {d.MOLECULES_SQL} select * from mol")
def molecules(spark, sf_dir):
    return mols(spark, sf_dir)


@query(f"""with {d.CELLS_SQL} select cb, gene, count(*)::bigint as n from mol where {REQUESTED} and cb in ({FINAL}) group by all""")
def count_matrix(spark, sf_dir):
    m = mols(spark, sf_dir)
    return mo.count_matrix(m, mo.filtered_cells(mo.cells(m)))


@query(f"""with {d.CELLS_SQL} select cb, gene, sum(reads)::bigint as n from mol where {REQUESTED} and cb in ({FINAL}) group by all""")
def count_matrix_reads(spark, sf_dir):
    m = mols(spark, sf_dir)
    return mo.count_matrix(m, mo.filtered_cells(mo.cells(m)), reads=True)


@query(f"with {d.CELLS_SQL} select cb, gene, count(*)::bigint as n from mol where cb in ({REAL}) group by all")
def count_matrix_raw(spark, sf_dir):
    m = mols(spark, sf_dir)
    return mo.count_matrix(m, mo.real_cells(mo.cells(m)), level=None)


@query(f"with {d.CELLS_SQL} select * from cells")
def cell_sizes(spark, sf_dir):
    return mo.cells(mols(spark, sf_dir))


@query(f"""with {d.CELLS_SQL} select * from (
  select cb, gene, count(*) filter (where mark = 2)::bigint as exon, count(*) filter (where mark = 4)::bigint as intron, count(*) filter (where mark in (6, 7))::bigint as spanning
  from mol where cb in ({REAL}) group by all) where exon + intron + spanning > 0""")
def velocity_matrices(spark, sf_dir):
    m = mols(spark, sf_dir)
    return mo.velocity_matrices(m, mo.real_cells(mo.cells(m)))


@query(f"""with {d.CELLS_SQL}, k as (
  select cb, chrom, unnest(list_filter([case when gene is not null and mark & 2 <> 0 then 'exon' end, case when gene is not null and mark & 4 <> 0 then 'intron' end,
         case when gene is null then 'intergenic' end], lambda x: x is not null)) as kind from reads where cb in ({REAL}))
select kind, cb, chrom, count(*)::bigint as n from k group by all""")
def reads_per_chromosome(spark, sf_dir):
    r = d.reads(spark, sf_dir)
    return mo.reads_per_chromosome(r, mo.real_cells(mo.cells(mo.molecules(r))))


@query(f"with {d.CELLS_SQL} select cb, round(n_reads::double / n_umis, 9) as reads_per_umi from cells")
def mean_reads_per_umi(spark, sf_dir):
    return mo.mean_reads_per_umi(mo.cells(mols(spark, sf_dir))).withColumn("reads_per_umi", F.round("reads_per_umi", 9))


@query(f"with {d.CELLS_SQL} select cb, gene, umi, reads from mol where {REQUESTED} and cb in ({REAL})")
def saturation_info(spark, sf_dir):
    m = mols(spark, sf_dir)
    return mo.saturation_info(m, mo.real_cells(mo.cells(m)))


@query(f"with {d.CELLS_SQL}, c as (select reads as value, count(*)::bigint as n from mol where {REQUESTED} and cb in ({REAL}) group by all) select value, n, round(n::double / sum(n) over (), 9) as share from c")
def saturation_histogram(spark, sf_dir):
    return mo.value_counts(saturation_info(spark, sf_dir), "reads").withColumn("share", F.round("share", 9))


@query(f"""with {d.READS_SQL}, r as (select *, starts_with(umi, 'AAAA') as broken, ascii(umi_qual) < 38 as low from reads), g as (select *, not broken and not low as good from r)
select count(*)::bigint as total, count(*) filter (where broken)::bigint as cant_parse, count(*) filter (where not broken and low)::bigint as low_quality,
  count(*) filter (where good and gene is null)::bigint as intergenic, count(*) filter (where good and gene is not null and mark & 2 <> 0)::bigint as exon,
  count(*) filter (where good and gene is not null and mark & 4 <> 0)::bigint as intron, count(*) filter (where good and gene is not null and mark & 1 <> 0)::bigint as not_annotated from g""")
def read_counters(spark, sf_dir):
    reads = d.reads(spark, sf_dir).withColumns({"pass_quality": F.ascii("umi_qual") >= 38, "cb": F.when(~F.startswith("umi", F.lit("AAAA")), F.col("cb"))})
    return mo.read_counters(reads)


@query(f"""with {d.READS_SQL}, q as (
  select cb, gene, umi, i, sum(ascii(substr(umi_qual, i, 1)))::bigint as code, count(*) as n from reads, range(1, 7) t(i) where gene is not null group by all)
select cb, gene, umi, n::bigint as reads, string_agg(cast((code - 33) // n as varchar), ',' order by i) as qual from q group by cb, gene, umi, n""")
def mean_umi_quality(spark, sf_dir):
    found = mo.molecules_with_quality(d.reads(spark, sf_dir), 6)
    return found.select("cb", "gene", "umi", "reads", F.concat_ws(",", F.col("qual").cast("array<string>")).alias("qual"))


@query(f"with {d.CELLS_SQL} select umi, count(*)::bigint as n from mol where cb in ({FINAL}) group by all")
def umi_distribution(spark, sf_dir):
    m = mols(spark, sf_dir)
    return mo.umi_distribution(m, mo.filtered_cells(mo.cells(m)))


@query(f"""with {d.MOLECULES_SQL}, every as (select {d.SPELL.format(key="i", n=6)} as umi from range(4096) t(i)),
c as (select umi, count(*) as n from mol group by all), s as (select every.umi, coalesce(n, 0) + 4.0::double as n from every left join c on every.umi = c.umi)
select umi, round(n / sum(n) over (), 12) as p from s""")
def smoothed_umi_distribution(spark, sf_dir):
    return mo.smoothed_umi_distribution(mols(spark, sf_dir), 6, 1.0).withColumn("p", F.round("p", 12))


@query(f"with {d.MOLECULES_SQL} select gene, count(*)::bigint as n from mol where {REQUESTED} group by all order by n desc, gene limit 10")
def top_genes(spark, sf_dir):
    return mo.gene_totals(mo.counts(mols(spark, sf_dir))).orderBy(F.desc("n"), "gene").limit(10)


@query(f"with {d.MOLECULES_SQL} select cb, gene, substr(umi, 1, 4) as umi, sum(reads)::bigint as reads, bit_or(mark) as mark from mol group by all")
def trimmed_umis(spark, sf_dir):
    return mo.trimmed_umis(mols(spark, sf_dir), 4)


def graded_mols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mo.molecules_with_quality(d.graded_events(spark, sf_dir), 3)


@query(f"""with {d.GRADED_SQL}, t as (select cb, gene, substr(umi, 1, 2) as umi, i, sum(reads)::bigint as reads, round(sum(((code - 33) // reads) * reads)::double / sum(reads), 6) as q from gq where i < 3 group by all)
select cb, gene, umi, reads, max(q) filter (where i = 1) as q1, max(q) filter (where i = 2) as q2 from t group by all""")
def trimmed_qualities(spark, sf_dir):
    rows = mo.trimmed_umis(graded_mols(spark, sf_dir), 2)
    return rows.select("cb", "gene", "umi", "reads", *[F.round(F.get("qual", F.lit(i)), 6).alias(f"q{i + 1}") for i in range(2)])


@query(f"""with {d.GRADED_SQL}, m as (select *, (code - 33) // reads as q from gq), k as (select cb, gene, umi, any_value(reads) as reads, string_agg(cast(q as varchar), ' ' order by i) as q from m group by all)
select cb, gene, string_agg(umi || ':' || reads || ':' || q, ',' order by umi) as umis from k group by all""")
def reads_per_umi_lists(spark, sf_dir):
    m = graded_mols(spark, sf_dir)
    found = mo.reads_per_umi_per_cell(m, m.select("cb").distinct())
    line = lambda u: F.concat_ws(":", u["umi"], u["reads"].cast("string"), F.concat_ws(" ", u["qual"].cast("array<string>")))
    return found.select("cb", "gene", F.array_join(F.transform("umis", line), ",").alias("umis"))


@query(f"with {d.MOLECULES_SQL}, c as (select cb, case when umi like 'A%' then gene || ';x' else gene end as gene, count(*)::bigint as n from mol where {REQUESTED} group by all) select * from c where gene not like '%;%'")
def single_genes(spark, sf_dir):
    name = F.when(F.startswith("umi", F.lit("A")), F.concat("gene", F.lit(";x"))).otherwise(F.col("gene"))
    return mo.without_ambiguous_genes(mo.counts(mols(spark, sf_dir).withColumn("gene", name)))


@query(f"with {d.CELLS_SQL} select cb from cells where n_genes >= 10 and req_genes >= 10 order by req_genes desc, req_umis desc, n_umis desc, cb desc limit 20")
def largest_cells(spark, sf_dir):
    return mo.filtered_cells(mo.cells(mols(spark, sf_dir)), top=20).select("cb")


@query("""with r as (select cast(l_orderkey as varchar) as name, l_returnflag as organism from lineitem),
u as (select name from r group by name having count(distinct organism) = 1) select name, organism, count(*)::bigint as n from r semi join u using (name) group by all""")
def mixture_filter(spark, sf_dir):
    rows = d.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").cast("string").alias("name"), F.col("l_returnflag").alias("organism"))
    return mo.uniquely_mapped(rows).groupBy("name", "organism").agg(F.count("*").alias("n"))


# reads and layouts

LAYOUT = layouts.Layout(barcode1=8, barcode2=8, umi=6, tail=8, barcode_parts=((10, 8), (20, 8)), umi_start=0)


@query(f"""with {d.FASTQ_SQL} select ord, substr(seq1, 1, 8) || substr(seq2, 1, 8) as cb, substr(qual1, 1, 8) || substr(qual2, 1, 8) as cb_qual,
  substr(seq2, 9, 6) as umi, substr(qual2, 9, 6) as umi_qual, substr(seq2, 7, 8) as tail from fq""")
def layout_two_barcodes(spark, sf_dir):
    return layouts.PROTOCOLS["10x"](d.fastq(spark, sf_dir), LAYOUT).select("ord", "cb", "cb_qual", "umi", "umi_qual", "tail")


@query(f"with {d.FASTQ_SQL} select ord, substr(seq1, 11, 8) || substr(seq1, 21, 8) as cb, substr(seq1, 1, 6) as umi from fq")
def layout_placed(spark, sf_dir):
    return layouts.PROTOCOLS["split_seq"](d.fastq(spark, sf_dir), LAYOUT).select("ord", "cb", "umi")


@query(f"with {d.FASTQ_SQL} select ord, substr(seq1, 7, 8) as cb, substr(seq1, 1, 6) as umi, substr(seq1, 15) as seq, substr(qual1, 15) as qual from fq")
def layout_inline(spark, sf_dir):
    return layouts.PROTOCOLS["iclip"](d.fastq(spark, sf_dir), LAYOUT).select("ord", "cb", "umi", "seq", "qual")


@query(f"""with {d.FASTQ_SQL} select ord, case when levenshtein(substr(seq1, 5, 4), 'ACGT') > 2 then null else substr(seq1, 1, 4) || substr(seq1, 9, 4) end as cb,
  case when levenshtein(substr(seq1, 5, 4), 'ACGT') > 2 then null else substr(seq1, 13, 6) end as umi,
  case when levenshtein(substr(seq1, 5, 4), 'ACGT') > 2 then 'no_spacer1' else 'ok' end as outcome from fq""")
def layout_masked(spark, sf_dir):
    layout = layouts.Layout(mask="[4]ACGT[4](6)", mask_edits=(2,))
    return layouts.masked_reads(d.fastq(spark, sf_dir), layout).select("ord", "cb", "umi", "outcome")


@query(f"""with {d.FASTQ_SQL}, t as (
  select ord, seq3, case when contains(seq3, translate(reverse(substr(seq2, 13, 2)), 'ACGT', 'TGCA')) then strpos(seq3, translate(reverse(substr(seq2, 13, 2)), 'ACGT', 'TGCA')) - 1
         when contains(seq3, 'AAA') then strpos(seq3, 'AAA') - 1 else length(seq3) end as cut from fq)
select ord, regexp_replace(substr(seq3, 1, cut), '[AN]+$', '') as seq from t""")
def poly_a_trim(spark, sf_dir):
    rows = layouts.two_barcode_reads(d.fastq(spark, sf_dir), layouts.Layout(tail=2))
    return rows.withColumn("n", s.poly_a_cut(F.col("seq"), F.col("tail"), "AAA")).select("ord", F.expr("substring(seq, 1, n)").alias("seq"))


@query(f"""with {d.FASTQ_SQL}, t as (
  select ord, seq3, qual3, list_filter(range(0, 32), lambda i: ascii(substr(qual3, i + 1, 1)) < 33 + 20) as low from fq),
w as (select *, coalesce(list_max(list_filter(low, lambda i: i < 6)) + 1, 0) as a, coalesce(list_min(list_filter(low, lambda i: i >= 27)), 32) as b from t)
select ord, substr(seq3, cast(a + 1 as int), cast(b - a as int)) as seq, substr(qual3, cast(a + 1 as int), cast(b - a as int)) as qual from w""")
def quality_trim(spark, sf_dir):
    rows = d.fastq(spark, sf_dir).withColumn("w", s.quality_window(F.col("qual3"), 6, 5, 20))
    return rows.select("ord", F.expr("substring(seq3, w.start + 1, w.end - w.start)").alias("seq"), F.expr("substring(qual3, w.start + 1, w.end - w.start)").alias("qual"))


@query(f"""with {d.FASTQ_SQL}, t as (select *, len(list_filter(range(1, 33), lambda i: ascii(substr(qual3, i, 1)) < 33 + 30)) as low,
  length(regexp_replace(seq3, '[^GN]', '', 'g')) as g, len(list_filter(range(1, 9), lambda i: ascii(substr(qual1, i, 1)) < 33 + 8)) as bad from fq)
select ord, low / 32.0::double <= 0.5 and g / 32.0::double < 0.3 as gene_ok, bad = 0 as barcode_ok from t""")
def quality_filters(spark, sf_dir):
    gene = s.passes_gene_quality(F.col("seq3"), F.col("qual3"), 30, 0.3)
    return d.fastq(spark, sf_dir).select("ord", gene.alias("gene_ok"), s.all_above(F.substring("qual1", 1, 8), 8).alias("barcode_ok"))


@query(f"""with {d.FASTQ_SQL}, t as (select ord, substr(seq1, 9, 8) as tag, substr(seq1, 1, 8) || substr(seq2, 1, 8) as cb from fq)
select ord, case when levenshtein(tag, 'ACGTACGT') <= 5 then cb end as cb, case when levenshtein(tag, 'ACGTACGT') <= 5 then 'ok' else 'other_library' end as outcome from t""")
def layout_library_tag(spark, sf_dir):
    reads = d.fastq(spark, sf_dir).withColumn("seq4", F.substring("seq1", 9, 8))
    layout = layouts.Layout(barcode1=8, barcode2=8, umi=6, tail=8, library_tag="ACGTACGT", max_tag_edits=5)
    return layouts.PROTOCOLS["indrop3"](reads, layout).select("ord", "cb", "outcome")


@query(f"with {d.FASTQ_SQL} select ord, substr(seq1, 1, 3) as a, substr(seq1, 4, 8) as b, substr(seq1, 12, 5) as c from fq")
def barcode_parts(spark, sf_dir):
    a, b, c = s.split_barcode(F.col("seq1"), [3, 8, 5])
    return d.fastq(spark, sf_dir).select("ord", a.alias("a"), b.alias("b"), c.alias("c"))


@query("select p_partkey, 'T' || p_partkey as name from part")
def intron_names(spark, sf_dir):
    from tallywright.sources.annotation import trimmed_intron_name

    suffix = F.when(F.col("p_partkey") % 2 == 0, "_intron_3_0").otherwise("")
    rows = d.table(spark, sf_dir, "part").withColumn("name", F.concat(F.lit("T"), F.col("p_partkey").cast("string"), suffix))
    return rows.select("p_partkey", trimmed_intron_name("name").alias("name"))


@query(f"""with {d.FASTQ_SQL}, a as (
  select ord, substr(seq1, 1, 8) || substr(seq2, 1, 8) as cb, substr(qual1, 1, 8) || substr(qual2, 1, 8) as cb_qual, substr(seq2, 9, 6) as umi, substr(qual2, 9, 6) as umi_qual,
         translate(reverse(substr(seq2, 7, 8)), 'ACGT', 'TGCA') as rc, seq3, qual3 from fq),
b as (select *, length(regexp_replace(substr(seq3, 1, case when contains(seq3, rc) then strpos(seq3, rc) - 1 when contains(seq3, 'AAAAAAAA') then strpos(seq3, 'AAAAAAAA') - 1 else length(seq3) end), '[AN]+$', '')) as n from a),
c as (select *, substr(seq3, 1, n) as s, substr(qual3, 1, n) as q from b where n >= 10),
e as (select *, list_filter(range(0, n), lambda i: ascii(substr(q, i + 1, 1)) < 38) as low, len(list_filter(range(1, n + 1), lambda i: ascii(substr(q, i, 1)) < 43)) as bad,
  length(regexp_replace(s, '[^GN]', '', 'g')) as g, len(list_filter(range(1, 23), lambda i: ascii(substr(cb_qual || umi_qual, i, 1)) < 41)) as weak from c),
f as (select *, coalesce(list_max(list_filter(low, lambda i: i < 3)) + 1, 0) as x, coalesce(list_min(list_filter(low, lambda i: i >= n - 3)), n) as y from e where bad <= n * 0.5 and g / n::double < 0.8)
select '@r' || ord || '!' || cb || '#' || umi as read_id, cb, umi, cb_qual, umi_qual, weak = 0 as pass_quality, substr(s, cast(x + 1 as int), cast(y - x as int)) as seq, substr(q, cast(x + 1 as int), cast(y - x as int)) as qual
from f where y - x >= 10""")
def tagged_reads(spark, sf_dir):
    filters = tagging.Filters(trim_quality=5, leading_trim=3, trailing_trim=3, min_median_quality=10, max_g_fraction=0.8, min_barcode_quality=8)
    return tagging.tag_reads(d.fastq(spark, sf_dir), "10x", LAYOUT, filters)


@query(f"""with {d.FASTQ_SQL}, t as (select case when levenshtein(substr(seq1, 5, 4), 'ACGT') > 2 then 'no_spacer1' else 'ok' end as outcome from fq),
c as (select outcome, count(*)::bigint as reads from t group by all) select outcome, reads, round(reads * 100.0::double / sum(reads) over (), 6) as percent from c""")
def outcome_counts(spark, sf_dir):
    return tagging.outcome_counts(layout_masked(spark, sf_dir)).withColumn("percent", F.round("percent", 6))


SPACER = layouts.Layout(barcode1=6, barcode1_longest=12, barcode2=4, umi=5, tail=4, spacer="ACGT", max_spacer_edits=1, spacer_search=2)


@query(f"""with {d.FASTQ_SQL}, a as (
  select *, strpos(seq1, 'ACGT') - 1 as exact, 16 - strpos(reverse(substr(seq1, 1, 17)), 'TG') as tail, strpos(substr(seq1, 7), 'AC') - 1 as ahead,
    strpos(reverse(substr(seq1, 1, 17)), 'TG') as back from fq),
b as (select *, case when exact >= 0 then exact when back = 0 or tail < 7 or tail - 2 < 0 then case when ahead >= 0 and ahead + 6 <= 12 then ahead + 6 end else tail - 2 end as place from a),
c as (select *, case when place is null or exact < 0 and levenshtein('ACGT', substr(seq1, place::int + 1, 4)) > 1 then 'no_spacer' when length(seq1) < place + 13 then 'short'
  when exact >= 0 then 'ok' else 'modified' end as outcome, (place + 4)::int as e from b)
select ord, outcome, case when outcome in ('ok', 'modified') then substr(seq1, 1, place::int) || substr(seq1, e + 1, 4) end as cb,
  case when outcome in ('ok', 'modified') then substr(seq1, e + 5, 5) end as umi from c""")
def layout_spacer(spark, sf_dir):
    return layouts.spacer_reads(d.fastq(spark, sf_dir), SPACER).select("ord", "outcome", "cb", "umi")


@query(f"with {d.FASTQ_SQL} select substr(seq1, 1, 3) as cb, count(*)::bigint as reads from fq group by all")
def reads_per_barcode(spark, sf_dir):
    return tagging.reads_per_barcode(d.fastq(spark, sf_dir).select(F.substring("seq1", 1, 3).alias("cb")))


@query(f"""with {d.FASTQ_SQL} select ord, translate(reverse(seq3), 'ACGTN', 'TGCAN') as rc, levenshtein(substr(seq1, 1, 8), substr(seq2, 1, 8))::int as edits,
  len(list_filter(range(1, 33), lambda i: substr(seq1, i, 1) <> substr(seq3, i, 1) and substr(seq3, i, 1) <> 'N'))::int as hamming from fq""")
def sequence_functions(spark, sf_dir):
    return d.fastq(spark, sf_dir).select(
        "ord",
        s.reverse_complement(F.col("seq3")).alias("rc"),
        s.edit_distance(F.substring("seq1", 1, 8), F.substring("seq2", 1, 8)).alias("edits"),
        s.hamming_distance(F.col("seq1"), F.col("seq3")).alias("hamming"),
    )


@query(f"""with {d.FASTQ_SQL} select ord, substr(seq1, 1, 4) as cb, substr(seq2, 1, 4) as umi from fq""")
def read_ids(spark, sf_dir):
    name = s.read_id(F.concat(F.lit("@r!#"), F.col("ord").cast("string")), F.substring("seq1", 1, 4), F.substring("seq2", 1, 4))
    cb, umi = s.parse_read_id(F.col("name"))
    return d.fastq(spark, sf_dir).select("ord", name.alias("name")).select("ord", cb.alias("cb"), umi.alias("umi"))


@query("""with a as (select l_orderkey as name, l_linenumber, row_number() over (partition by l_orderkey order by l_linenumber) as r from lineitem)
select name, l_linenumber, case when r = 1 then o_orderpriority end as cb from a left join orders on name = o_orderkey and o_orderkey % 2 = 0""")
def params_lookup(spark, sf_dir):
    from tallywright.sources.annotation import with_params

    line = d.table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("name"), F.lit("f").alias("file"), F.col("l_linenumber").alias("ord"))
    order = d.table(spark, sf_dir, "orders").filter("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("name"), F.col("o_orderpriority").alias("cb"), *[F.lit("x").alias(c) for c in ("umi", "cb_qual", "umi_qual")])
    return with_params(line, order).select("name", F.col("ord").alias("l_linenumber"), "cb")


# intervals

LOOKUP_SQL = f"""{d.ANNOTATION_SQL}, {d.ALIGNMENTS_SQL},
ext as (select chrom, transcript_id, min(gene_name) as gene_name, min(start_pos) as ta, max(end_pos) as tb from ann group by all),
pts as (select id, chrom, 1 as side, pos as at_ from aln union all select id, chrom, 2, end_pos - 1 from aln),
held as (select id, side, pts.chrom, at_, transcript_id, gene_name from pts join ext on pts.chrom = ext.chrom and at_ >= ta and at_ < tb),
h1 as (select id, side, held.gene_name as gene, case when kind = 'intron' then 4 else 2 end as kind, held.transcript_id from held join ann on held.transcript_id = ann.transcript_id and at_ >= start_pos and at_ < end_pos),
h2 as (select id, side, gene_name as gene, 4 as kind, transcript_id from held where not exists (select 1 from h1 where h1.id = held.id and h1.side = held.side and h1.transcript_id = held.transcript_id)
       and transcript_id not in (select transcript_id from ann where kind = 'intron')),
hits as (select distinct id, side, gene, kind from (select * from h1 union all select * from h2))"""


@query(f"with {d.ANNOTATION_SQL} select chrom, transcript_id, min(gene_name) as gene_name, min(start_pos)::bigint as start_pos, max(end_pos)::bigint as end_pos from ann group by all")
def transcript_extents(spark, sf_dir):
    return intervals.transcript_extents(d.annotation(spark, sf_dir))


@query(f"""with {d.ANNOTATION_SQL}, o as (select chrom, start_pos, end_pos, max(end_pos) over (partition by chrom order by start_pos, end_pos rows between unbounded preceding and 1 preceding) as reach from ann),
g as (select *, sum(case when reach is null or start_pos > reach then 1 else 0 end) over (partition by chrom order by start_pos, end_pos) as grp from o)
select chrom, min(start_pos)::bigint as start_pos, max(end_pos)::bigint as end_pos from g group by chrom, grp""")
def interval_coalesce(spark, sf_dir):
    return intervals.coalesce(d.annotation(spark, sf_dir), ["chrom"])


@query(f"""with {d.ANNOTATION_SQL}, e as (select distinct chrom, x from (select chrom, start_pos as x from ann union all select chrom, end_pos from ann)),
b as (select chrom, x as start_pos, lead(x) over (partition by chrom order by x) as end_pos from e)
select b.chrom, b.start_pos, b.end_pos, string_agg(distinct gene_name, ',' order by gene_name) as labels from b join ann on b.chrom = ann.chrom and b.start_pos >= ann.start_pos and b.start_pos < ann.end_pos
where b.end_pos is not null group by all""")
def interval_segments(spark, sf_dir):
    return intervals.segments(d.annotation(spark, sf_dir), "gene_name").withColumn("labels", F.concat_ws(",", "labels"))


@query(f"with {LOOKUP_SQL} select id, gene, kind from hits where side = 1")
def genes_at_points(spark, sf_dir):
    return intervals.genes_at(d.alignments(spark, sf_dir), d.annotation(spark, sf_dir), "pos")


@query(f"""with {LOOKUP_SQL},
s as (select aln.id, count(*) filter (where side = 1) as n1, count(*) filter (where side = 2) as n2, min(gene) filter (where side = 1) as g1, min(gene) filter (where side = 2) as g2,
  min(kind) filter (where side = 1) as k1, min(kind) filter (where side = 2) as k2, count(distinct case when side = 1 and kind = 2 then gene end) as x1, count(distinct case when side = 2 and kind = 2 then gene end) as x2,
  min(case when side = 1 and kind = 2 then gene end) as e1, min(case when side = 2 and kind = 2 then gene end) as e2
  from aln left join hits on aln.id = hits.id where aln.chrom in (select chrom from ann) group by aln.id),
r as (select *, case when n1 = 0 and n2 = 0 then 0 when n1 = 1 and n2 = 1 then case when g1 = g2 then 1 else 0 end when n1 <= 1 and n2 <= 1 then 2 when n1 = 0 or n2 = 0 then 0
  when x1 = 1 and x2 = 1 and e1 = e2 then 3 else 0 end as rule from s)
select id, case rule when 1 then g1 when 2 then coalesce(g1, g2) when 3 then e1 end as gene, (case rule when 1 then k1 | k2 when 2 then coalesce(k1, k2) | 1 when 3 then 2 else 0 end)::int as mark from r""")
def two_end_annotation(spark, sf_dir):
    return intervals.annotate(d.alignments(spark, sf_dir), d.annotation(spark, sf_dir)).select("id", "gene", "mark")


# merging cells

SHARED_SQL = f"""{d.EVENTS_SQL}, ecells as (select cb, count(distinct gene)::bigint as n_genes, count(*)::bigint as n_umis, sum(reads)::bigint as n_reads from emol group by cb),
shared as (select a.cb as cb_a, b.cb as cb_b, count(*)::bigint as shared from emol a join emol b on a.gene = b.gene and a.umi = b.umi and a.cb <> b.cb group by all)"""
SIMPLE_SQL = f"""{SHARED_SQL}, pairs as (
  select cb_a, cb_b, a.n_genes as ga, b.n_genes as gb, 0.5::double * shared * (1.0::double / a.n_umis + 1.0::double / b.n_umis) as fraction
  from shared join ecells a on a.cb = cb_a join ecells b on b.cb = cb_b where b.n_genes >= a.n_genes and levenshtein(cb_a, cb_b) < 3),
best as (select * from pairs qualify row_number() over (partition by cb_a order by round(fraction, 5) desc, gb desc, cb_b) = 1),
targets as (select cb as cb_from, case when fraction >= 0.2 then cb_b else cb end as cb_to from ecells left join best on cb = cb_a)"""


@query(f"with {SHARED_SQL} select * from shared")
def shared_molecules(spark, sf_dir):
    return merging.shared_molecules(event_mols(spark, sf_dir))


@query(f"with {SIMPLE_SQL} select * from targets")
def simple_merge_targets(spark, sf_dir):
    m = event_mols(spark, sf_dir)
    return merging.simple_targets(m, mo.cells(m), 3)


CLOSED_SQL = f"""with recursive {SIMPLE_SQL}, ranks as (select cb, row_number() over (order by n_genes, n_umis, n_reads, cb) as rank from ecells),
up as (select cb_from, cb_to, rank from targets join ranks on cb = cb_from),
walk as (select cb_from, cb_from as at_, [cb_from] as seen, false as ended from up
  union all select w.cb_from, u.cb_to, list_append(seen, u.cb_to), u.cb_to = w.at_ or list_contains(seen, u.cb_to) from walk w join up u on u.cb_from = w.at_ where not w.ended),
last as (select * from walk where ended),
cyc as (select last.cb_from, at_, list_slice(seen, list_position(seen, at_), len(seen)) as loop from last),
root as (select c.cb_from, max_by(x, rank) as cb_to from (select cb_from, unnest(loop) as x from cyc) c join ranks on ranks.cb = x group by c.cb_from)"""


@query(f"{CLOSED_SQL} select cb_from, cb_to from root")
def merge_closure(spark, sf_dir):
    m = event_mols(spark, sf_dir)
    cells = mo.cells(m)
    ranks = cells.select("cb", F.struct("n_genes", "n_umis", "n_reads", "cb").alias("rank"))
    return merging.closure(merging.simple_targets(m, cells, 3), ranks)


@query(f"""{CLOSED_SQL} select cb_to as cb, gene, umi, sum(reads)::bigint as reads, bit_or(mark) as mark from emol join root on cb = cb_from group by all""")
def merged_cells(spark, sf_dir):
    return merging.merge_cells(event_mols(spark, sf_dir), merge_closure(spark, sf_dir))


@query(f"""{CLOSED_SQL}, m as (select gq.*, root.cb_to, cb_to <> cb as moved from gq join root on cb = cb_from),
own as (select cb_to, gene, umi, i, arg_min(code, (moved, cb)) as code, sum(reads)::bigint as reads from m group by all)
select cb_to as cb, gene, umi, any_value(reads) as reads, string_agg(cast((code - 33) // reads as varchar), ' ' order by i) as qual from own group by cb_to, gene, umi""".replace(d.EVENTS_SQL, d.EVENTS_SQL + ", " + d.GRADED_SQL))
def merged_qualities(spark, sf_dir):
    merged = merging.merge_cells(graded_mols(spark, sf_dir), merge_closure(spark, sf_dir))
    return merged.select("cb", "gene", "umi", "reads", F.concat_ws(" ", F.col("qual").cast("array<string>")).alias("qual"))


@query(f"""{CLOSED_SQL}, merged as (select cb_to as cb, gene, umi, sum(reads)::bigint as reads from emol join root on cb = cb_from group by all),
adj as (select a.cb, a.gene, a.umi, b.umi as other, b.reads as more from merged a join merged b on a.cb = b.cb and a.gene = b.gene and hamming(a.umi, b.umi) = 1 where a.reads * 2 <= b.reads),
one as (select * from adj qualify row_number() over (partition by cb, gene, umi order by more desc, other) = 1),
chain as (select cb, gene, umi, other as end_ from one union all select c.cb, c.gene, c.umi, o.other from chain c join one o on o.cb = c.cb and o.gene = c.gene and o.umi = c.end_),
ends as (select chain.cb, chain.gene, chain.umi, chain.end_ from chain anti join one on one.cb = chain.cb and one.gene = chain.gene and one.umi = chain.end_),
fixed as (select distinct m.cb, m.gene, coalesce(e.end_, m.umi) as umi from merged m left join ends e on m.cb = e.cb and m.gene = e.gene and m.umi = e.umi)
select cb, gene, count(*)::bigint as n from fixed where cb in (select cb from fixed group by cb having count(distinct gene) >= 3) group by all""".replace("(order by n_genes, n_umis, n_reads, cb)", "(order by n_genes, n_umis, cb)"))
def estimate_merged(spark, sf_dir):
    from . import estimate as plan

    settings = plan.Settings(merge="simple", max_cell_distance=3, directional=True, min_genes_before=1, min_genes_after=3)
    return plan.estimate(d.events(spark, sf_dir).withColumn("chrom", F.lit("chr1")), settings)["count_matrix"]


@query(f"""{CLOSED_SQL}, one as (
  select a.cb, a.gene, a.umi, b.umi as other from emol a join emol b on a.cb = b.cb and a.gene = b.gene and hamming(a.umi, b.umi) = 1 where a.reads * 2 <= b.reads
  qualify row_number() over (partition by a.cb, a.gene, a.umi order by b.reads desc, b.umi) = 1),
kept as (select ev.gene, coalesce(cb_to, ev.cb) as cb, ev.umi from ev left join root on ev.cb = cb_from),
named as (select kept.cb, kept.gene, coalesce(other, kept.umi) as umi from kept left join one on kept.cb = one.cb and kept.gene = one.gene and kept.umi = one.umi)
select cb, gene, umi, count(*)::bigint as reads from named semi join (select cb, gene, umi from emol where reads > 1) m using (cb, gene, umi) group by all""")
def filtered_reads(spark, sf_dir):
    from tallywright.operators import results

    m = event_mols(spark, sf_dir)
    kept = results.filtered_alignments(d.events(spark, sf_dir), merge_closure(spark, sf_dir), identifiers.directional_pairs(m), m.filter("reads > 1"))
    return kept.groupBy("cb", "gene", "umi").agg(F.count("*").alias("reads"))


@query(f"""with {d.READS_SQL} select cb, umi, gene, mark, map_extract(m, 'RE')[1] as kind from (
  select *, map {{'RE': case when gene is null then 'INTERGENIC' when mark = 2 then 'EXONIC' when mark = 4 then 'INTRONIC' end}} as m from reads)""")
def tagged_alignments(spark, sf_dir):
    from tallywright.operators import results

    tag = lambda t: F.try_element_at("tags", F.lit(t))
    rows = results.tagged_alignments(d.reads(spark, sf_dir))
    return rows.select(tag("CR").alias("cb"), tag("UR").alias("umi"), tag("GX").alias("gene"), "mark", tag("RE").alias("kind"))


WHITELIST_SQL = f"""wl as (select 0 as part, {d.SPELL.format(key="i * 5", n=3)} as barcode from range(12) t(i) union all select 1, {d.SPELL.format(key="i * 3", n=3)} from range(20) t(i)),
{SHARED_SQL}, cand as (select cb, w0.barcode || w1.barcode as barcode, (levenshtein(substr(cb, 1, 3), w0.barcode) + levenshtein(substr(cb, 4), w1.barcode))::int as distance
  from ecells, wl w0, wl w1 where w0.part = 0 and w1.part = 1 and levenshtein(substr(cb, 1, 3), w0.barcode) + levenshtein(substr(cb, 4), w1.barcode) <= 5)"""


def whitelist(spark: SparkSession) -> DataFrame:
    first = spark.range(12).select(F.lit(0).alias("part"), d.spelled(F.col("id") * 5, 3).alias("barcode"))
    return first.unionByName(spark.range(20).select(F.lit(1).alias("part"), d.spelled(F.col("id") * 3, 3).alias("barcode")))


@query(f"with {WHITELIST_SQL} select * from cand")
def whitelist_candidates(spark, sf_dir):
    return merging.whitelist_candidates(mo.cells(event_mols(spark, sf_dir)), whitelist(spark), [3, None])


@query(f"""with {WHITELIST_SQL}, near as (
  select a.cb as cb_a, b.cb as cb_b, distance, a.n_umis as ua, b.n_umis as ub from cand join ecells a on a.cb = cand.cb join ecells b on b.cb = barcode where b.n_umis >= a.n_umis
  qualify distance = min(distance) over (partition by a.cb)),
f as (select near.cb_a, near.cb_b, 0.5::double * coalesce(shared, 0) * (1.0::double / ua + 1.0::double / ub) as fraction from near left join shared on near.cb_a = shared.cb_a and near.cb_b = shared.cb_b),
best as (select * from f qualify row_number() over (partition by cb_a order by cb_a = cb_b desc, fraction desc, cb_b) = 1)
select cb as cb_from, case when cb_a = cb_b or fraction >= 0.2 then cb_b end as cb_to from ecells left join best on cb = cb_a""")
def whitelist_merge_targets(spark, sf_dir):
    m = event_mols(spark, sf_dir)
    cells = mo.cells(m)
    return merging.whitelist_targets(m, cells, merging.whitelist_candidates(cells, whitelist(spark), [3, None]))


@query(f"""with {SHARED_SQL}, pairs as (select a.cb as cb_a, b.cb as cb_b, levenshtein(a.cb, b.cb) as dist, b.n_umis as ub from ecells a join ecells b on b.n_umis > a.n_umis and levenshtein(a.cb, b.cb) <= 1),
best as (select * from pairs qualify row_number() over (partition by cb_a order by dist, ub desc, cb_b) = 1) select cb as cb_from, coalesce(cb_b, cb) as cb_to from ecells left join best on cb = cb_a""")
def merge_all_targets(spark, sf_dir):
    return merging.all_targets(mo.cells(event_mols(spark, sf_dir)), 1)


@query()
def poisson_merge_targets(spark, sf_dir):
    m = stored(event_mols(spark, sf_dir))
    return merging.poisson_simple_targets(m, stored(mo.cells(m)), 3, 1e-3)


@query()
def poisson_whitelist_targets(spark, sf_dir):
    m = stored(event_mols(spark, sf_dir))
    cells = stored(mo.cells(m))
    return merging.poisson_whitelist_targets(m, cells, merging.whitelist_candidates(cells, whitelist(spark), [3, None]))


@query()
def merge_validation(spark, sf_dir):
    m = event_mols(spark, sf_dir)
    return merging.merge_validation(m, mo.cells(m), 1000, 2, 5)


# identifiers

ADJACENT_SQL = f"""{d.EVENTS_SQL}, adj as (select a.cb, a.gene, a.umi, a.reads, b.umi as other, b.reads as other_reads from emol a join emol b on a.cb = b.cb and a.gene = b.gene and hamming(a.umi, b.umi) = 1)"""


@query(f"with {ADJACENT_SQL} select * from adj")
def adjacent_umis(spark, sf_dir):
    return identifiers.adjacent(event_mols(spark, sf_dir))


@query(f"""with {ADJACENT_SQL}, c as (select cb, gene, umi, count(*) filter (where other_reads <= reads)::bigint as smaller, count(*) filter (where other_reads > reads)::bigint as larger, count(*)::bigint as total from adj group by all)
select cb, gene, umi, coalesce(smaller, 0)::bigint as smaller, coalesce(larger, 0)::bigint as larger, coalesce(total, 0)::bigint as total from emol left join c using (cb, gene, umi)""")
def umi_neighbour_counts(spark, sf_dir):
    return identifiers.neighbour_counts(event_mols(spark, sf_dir))


@query(f"with {ADJACENT_SQL} select cb, gene, umi, other as target from adj where reads * 2 <= other_reads qualify row_number() over (partition by cb, gene, umi order by other_reads desc, other) = 1")
def directional_pairs(spark, sf_dir):
    return identifiers.directional_pairs(event_mols(spark, sf_dir))


@query(f"""with {ADJACENT_SQL}, one as (select cb, gene, umi, other as target from adj where reads * 2 <= other_reads qualify row_number() over (partition by cb, gene, umi order by other_reads desc, other) = 1),
two as (select one.cb, one.gene, one.umi, coalesce(t3.target, t2.target, one.target) as target from one left join one t2 on one.cb = t2.cb and one.gene = t2.gene and one.target = t2.umi
  left join one t3 on t2.cb = t3.cb and t2.gene = t3.gene and t2.target = t3.umi)
select emol.cb, emol.gene, coalesce(target, emol.umi) as umi, sum(reads)::bigint as reads, bit_or(mark) as mark from emol left join two on emol.cb = two.cb and emol.gene = two.gene and emol.umi = two.umi group by all""")
def directional_merge(spark, sf_dir):
    m = event_mols(spark, sf_dir)
    return identifiers.apply_targets(m, identifiers.directional_targets(m))


@query(f"""with {ADJACENT_SQL}, lost as (select distinct cb, gene, umi from adj where other_reads >= reads * 1.0 - 1e-8 and (reads < other_reads or (reads = other_reads and umi > other)))
select emol.* from emol anti join lost using (cb, gene, umi)""")
def classic_umi_filter(spark, sf_dir):
    return identifiers.classic_filter(event_mols(spark, sf_dir))


@query(f"""with {d.EVENTS_SQL}, n as (select cb, gene, case when umi like '%T' then substr(umi, 1, 2) || 'N' else umi end as umi, sum(reads)::bigint as reads, bit_or(mark) as mark from emol group by all),
t as (select b.cb, b.gene, b.umi, g.umi as target from n b join n g on b.cb = g.cb and b.gene = g.gene and b.umi like '%N' and g.umi not like '%N' and
  (case when substr(b.umi, 1, 1) <> substr(g.umi, 1, 1) then 1 else 0 end + case when substr(b.umi, 2, 1) <> substr(g.umi, 2, 1) then 1 else 0 end) <= 1
  qualify row_number() over (partition by b.cb, b.gene, b.umi order by case when substr(b.umi, 1, 1) <> substr(g.umi, 1, 1) then 1 else 0 end + case when substr(b.umi, 2, 1) <> substr(g.umi, 2, 1) then 1 else 0 end, g.reads desc, g.umi) = 1)
select cb, gene, umi, target from t""")
def unknown_base_targets(spark, sf_dir):
    m = event_mols(spark, sf_dir)
    wild = mo.merged_molecules(m.withColumn("umi", F.when(F.endswith("umi", F.lit("T")), F.concat(F.substring("umi", 1, 2), F.lit("N"))).otherwise(F.col("umi"))))
    found = identifiers.unknown_base_targets(wild)
    return found.join(wild.filter("umi not like '%N'").select("cb", "gene", F.col("umi").alias("target")), ["cb", "gene", "target"], "left_semi").filter(
        s.hamming_distance(F.col("umi"), F.col("target")) <= 1
    ).select("cb", "gene", "umi", "target").join(nearest_known(wild), ["cb", "gene", "umi"], "left_semi")


def nearest_known(wild: DataFrame) -> DataFrame:
    """Identifiers with N that have one without near them."""
    bad, good = wild.filter("umi like '%N'"), wild.filter("umi not like '%N'").select("cb", "gene", F.col("umi").alias("g"))
    return bad.join(good, ["cb", "gene"]).filter(s.hamming_distance(F.col("umi"), F.col("g")) <= 1).select("cb", "gene", "umi").distinct()


@query(f"""with {d.EVENTS_SQL}, g as (select cb, gene, count(*) as n from emol group by all)
select cb, gene, n::bigint as n, (case when n >= 64 then round(-ln(1 - 63 / 64.0::double) * 64 + (-ln(1 - 63 / 64.0::double) * 64 + ln(1 - 62 / 64.0::double) * 64)) else round(-ln(1 - n / 64.0::double) * 64) end)::bigint as adjusted from g""")
def uniform_collisions(spark, sf_dir):
    """Molecules behind the identifiers of each gene, of 4 ** 3 equally likely ones."""
    genes = event_mols(spark, sf_dir).groupBy("cb", "gene").agg(F.count("*").alias("n"))
    return genes.select("cb", "gene", "n", st.uniform_adjusted(F.col("n"), 64).alias("adjusted"))


@query(f"with {d.CELLS_SQL} select cb, (case when x < 1.01 then 0 when x < 1.02 then 1 when x < 1.05 then 2 else 3 end)::int as k from (select cb, n_reads::double / n_umis - 1e-7 as x from cells)")
def quantized_reads(spark, sf_dir):
    cells = mo.cells(mols(spark, sf_dir))
    return cells.select("cb", st.quantized(F.col("n_reads") / F.col("n_umis"), [1.01, 1.02, 1.05, 9.0]).alias("k"))


# quality

CHROM_SQL = f"""{d.CELLS_SQL}, k as (select cb, chrom, unnest(list_filter([case when gene is not null and mark & 2 <> 0 then 'exon' end, case when gene is not null and mark & 4 <> 0 then 'intron' end,
  case when gene is null then 'intergenic' end], lambda x: x is not null)) as kind from reads where cb in ({REAL})), byc as (select kind, cb, chrom, count(*)::bigint as n from k group by all)"""


@query(f"with {d.MOLECULES_SQL}, c as (select cb, gene, count(*) as n from mol where {REQUESTED} group by all) select cb, round(sum(case when gene in ('G1', 'G2', 'G3') then n else 0 end)::double / sum(n)::double, 9) as fraction from c group by cb")
def geneset_fraction(spark, sf_dir):
    genes = spark.createDataFrame([("G1",), ("G2",), ("G3",)], "gene string")
    return quality.geneset_fraction(mo.counts(mols(spark, sf_dir)), genes).withColumn("fraction", F.round("fraction", 9))


@query(f"with {CHROM_SQL} select cb, round(sum(case when chrom = 'chr1' then n else 0 end)::double / sum(n)::double, 9) as fraction from byc group by cb")
def chromosome_fraction(spark, sf_dir):
    return quality.chromosome_fraction(reads_per_chromosome(spark, sf_dir), "chr1").withColumn("fraction", F.round("fraction", 9))


@query(f"with {CHROM_SQL}, t as (select chrom, kind, sum(n)::bigint as n from byc group by all) select chrom, kind, n, round(sum(n) over (partition by chrom)::double / sum(n) over ()::double, 9) as share from t qualify sum(n) over (partition by chrom)::double / sum(n) over () > 0.001")
def chromosome_shares(spark, sf_dir):
    return quality.chromosome_shares(reads_per_chromosome(spark, sf_dir)).withColumn("share", F.round("share", 9))


FEATURES_SQL = f"""{CHROM_SQL}, cnt as (select cb, gene, count(*) as n from mol where cb in ({REAL}) group by all),
shape as (select cb, sum(n)::double / count(*) as umi_per_gene, count(*) filter (where n = 1)::double / count(*) as low_expressed_frac from cnt group by cb),
rd as (select cb, sum(n) as a, sum(case when kind = 'intergenic' then n else 0 end) as i, sum(case when kind <> 'intergenic' then n else 0 end) as g, sum(case when kind <> 'intergenic' and chrom = 'chr2' then n else 0 end) as m from byc group by cb),
feat as (select cb, n_reads::double / n_umis as reads_per_umi, umi_per_gene, low_expressed_frac, coalesce(i::double / nullif(a, 0)::double, 0) as intergenic_frac, 0.0::double as not_aligned_frac, coalesce(m::double / nullif(g, 0)::double, 0) as mito_frac
  from shape join cells using (cb) left join rd using (cb))"""
FEATURES = ["reads_per_umi", "umi_per_gene", "low_expressed_frac", "intergenic_frac", "not_aligned_frac", "mito_frac"]


def feature_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = d.reads(spark, sf_dir)
    m = stored(mo.molecules(r))
    cells = stored(mo.cells(m))
    real = mo.real_cells(cells)
    return quality.features(mo.count_matrix(m, real, level=None), mo.mean_reads_per_umi(cells), mo.reads_per_chromosome(r, real), mitochondrial="chr2")


@query(f"with {FEATURES_SQL} select cb, {', '.join(f'round({c}, 9) as {c}' for c in FEATURES)} from feat")
def quality_features(spark, sf_dir):
    return feature_rows(spark, sf_dir).select("cb", *[F.round(c, 9).alias(c) for c in FEATURES])


@query(f"with {FEATURES_SQL} select cb, {', '.join(f'round(coalesce(({c} - min({c}) over ()) / nullif(max({c}) over () - min({c}) over (), 0), 0), 7) as {c}' for c in FEATURES if c != 'not_aligned_frac')} from feat")
def scaled_features(spark, sf_dir):
    rows = quality.scaled(feature_rows(spark, sf_dir), [c for c in FEATURES if c != "not_aligned_frac"], drop_constant=False)
    return rows.select(*[F.round(c, 7).alias(c) if c != "cb" else c for c in rows.columns if c != "not_aligned_frac"])


@query(f"""with {d.CELLS_SQL}, n as (select count(*) as n, median(n_umis::double) as med from cells), o as (select cb, n_umis, row_number() over (order by n_umis, cb) as r from cells),
t as (select avg(n_umis::double) as mean from o, n where r > floor(n * 0.2) and r <= n - floor(n * 0.2)), a as (select 1.4826 * median(abs(n_umis - med)) as mad from cells, n)
select cb, n_umis > mean + 4 * mad as outlier from cells, t, a""")
def high_outliers(spark, sf_dir):
    return quality.high_outliers(mo.cells(mols(spark, sf_dir)), "n_umis").select("cb", "outlier")


@query(f"""with {d.EVENTS_SQL}, c as (select cb, count(*) as n_umis from emol group by cb), r as (select cb, row_number() over (order by n_umis desc, cb) as r from c)
select cb, case when r >= 300 then 'Low' when r <= 100 then 'High' else 'Unknown' end as quality from r""")
def cell_labels(spark, sf_dir):
    return quality.labels(mo.cells(event_mols(spark, sf_dir)), {"min": 100, "expected": 150, "max": 300})


@query(f"with {d.EVENTS_SQL}, c as (select cb, count(*)::bigint as n_umis from emol group by cb) select cb, n_umis, row_number() over (order by n_umis desc, cb)::bigint as rank from c")
def cell_ranks(spark, sf_dir):
    return quality.ranked(mo.cells(event_mols(spark, sf_dir)).select("cb", "n_umis"))


@query(f"""with {d.MOLECULES_SQL}, c as (select cb, gene, count(*)::bigint as n from mol where {REQUESTED} group by all), h as (select n, count(*) as k from c group by n), p as (select n, k::double / sum(k) over ()::double as share from h)
select n, round(share, 9) as share, round(1 - sum(share) over (order by n), 9) as tail from p where share > 5e-4""")
def umis_per_gene_tail(spark, sf_dir):
    rows = quality.tail_shares(mo.counts(mols(spark, sf_dir)))
    return rows.select("n", F.round("share", 9).alias("share"), F.round("tail", 9).alias("tail"))


@query()
def cell_scores(spark, sf_dir):
    rows = stored(feature_rows(spark, sf_dir))
    sizes = stored(mo.cells(mols(spark, sf_dir)).select("cb", "n_umis").join(rows.select("cb"), "cb", "left_semi"))
    n = sizes.count()
    return quality.score_cells(rows, sizes, FEATURES, {"min": max(3, n // 3), "expected": n // 2, "max": max(4, 2 * n // 3)}, flags=["mito_frac"], robust=True)


@query()
def saturation_curve(spark, sf_dir):
    m = mols(spark, sf_dir)
    cells = mo.cells(m)
    return spark.createDataFrame(quality.saturation(mo.saturation_info(m, cells), cells))


@query()
def bayesian_correction(spark, sf_dir):
    return correction.correct_identifiers(graded_mols(spark, sf_dir), 3)


@query()
def classic_correction(spark, sf_dir):
    return correction.correct_identifiers(graded_mols(spark, sf_dir), 3, method="classic")


@query(f"""with {d.GRADED_SQL}, seen as (select umi, count(*) as n from (select distinct cb, gene, umi from gr) group by umi), t as (select sum(n) + 40.0::double * 64 as t from seen),
every as (select {d.SPELL.format(key="i", n=3)} as umi from range(64) t(i)), near as (select e.umi, (coalesce(sum(s.n), 0) + 40.0::double * 9) / t as p from every e cross join t left join seen s on hamming(e.umi, s.umi) = 1 group by e.umi, t),
step as (select max(p) / 50 as step from near) select umi, round(round(p / step) * step, 9) as p, round(p / step)::int as class from near, step semi join seen using (umi)""".replace("from near, step semi join seen using (umi)", "from near, step where umi in (select umi from seen)"))
def neighbour_classes(spark, sf_dir):
    rows = correction.neighbour_classes(graded_mols(spark, sf_dir), 3)
    return rows.select("umi", F.round("p", 9).alias("p"), "class")


# pairs and report

PAIRS_SQL = f"""{ADJACENT_SQL}, prs as (select cb, gene, umi as base, other as target, reads as min_rpu, other_reads as max_rpu, ((ascii(substr(umi, 1, 1)) + ascii(substr(umi, 3, 1)) + reads) % 7)::double as quality
  from adj where reads < other_reads or (reads = other_reads and umi < other))"""


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    quality_ = (F.ascii(F.substring("umi", 1, 1)) + F.ascii(F.substring("umi", 3, 1)) + F.col("reads")) % 7
    return event_mols(spark, sf_dir).withColumn("quality", quality_.cast("double"))


@query(f"with {PAIRS_SQL} select cb, gene, base, target, row_number() over (partition by cb, gene order by min_rpu, quality, base, target)::int as place from prs")
def ranked_predictions(spark, sf_dir):
    return pairs.ranked_predictions(classifier_pairs(spark, sf_dir), "min_rpu", "quality").select("cb", "gene", "base", "target", "place")


@query(f"with {PAIRS_SQL} select * from prs")
def classifier_pairs(spark, sf_dir):
    return pairs.classifier_pairs(graded(spark, sf_dir))


@query(f"""with {PAIRS_SQL} select *, row_number() over (partition by cb, gene, target order by min_rpu, quality, base)::int as place,
  sum(min_rpu) over (partition by cb, gene, target order by min_rpu, quality, base rows between unbounded preceding and current row)::bigint as min_rpu_sum from prs""")
def running_reads(spark, sf_dir):
    return pairs.running_reads(classifier_pairs(spark, sf_dir), ["cb", "gene"])


@query(f"with {PAIRS_SQL}, once as (select cb, gene, target as base from prs group by all having count(*) = 1) select prs.* from prs semi join once using (cb, gene, base)")
def cross_merged_pairs(spark, sf_dir):
    return pairs.cross_merged(classifier_pairs(spark, sf_dir), ["cb", "gene"])


@query(f"with {PAIRS_SQL}, big as (select cb, gene, umi from emol where reads >= 2) select prs.* from prs semi join big b on prs.cb = b.cb and prs.gene = b.gene and prs.base = b.umi where exists (select 1 from big t where t.cb = prs.cb and t.gene = prs.gene and t.umi = prs.target)")
def pairs_among_kept(spark, sf_dir):
    return pairs.among(classifier_pairs(spark, sf_dir), event_mols(spark, sf_dir).filter("reads >= 2"))


@query(f"""with {ADJACENT_SQL}, p as (select cb, gene, umi as base, other as target, (reads / 10.0)::double as prob from adj)
select a.* from p a join p b on a.cb = b.cb and a.gene = b.gene and a.base = b.target and a.target = b.base where b.prob > a.prob + 1e-5 or (abs(b.prob - a.prob) <= 1e-5 and a.base < a.target)""")
def mirrored_pairs(spark, sf_dir):
    rows = identifiers.adjacent(event_mols(spark, sf_dir)).select("cb", "gene", F.col("umi").alias("base"), F.col("other").alias("target"), (F.col("reads") / 10.0).alias("prob"))
    return pairs.mirrored(rows, ["cb", "gene"])


@query(f"""with {PAIRS_SQL}, a as (select quality as value, count(*)::double / sum(count(*)) over ()::double as p from prs where min_rpu = 1 group by quality),
b as (select quality as value, count(*)::double / sum(count(*)) over ()::double as p from prs where min_rpu > 1 group by quality)
select coalesce(a.value, b.value) as value, round((coalesce(a.p, 0) + coalesce(b.p, 0)) / 2, 9) as p from a full join b on a.value = b.value""")
def mixed_quality_distribution(spark, sf_dir):
    rows = classifier_pairs(spark, sf_dir)
    return pairs.mixed_distribution(rows.filter("min_rpu = 1"), rows.filter("min_rpu > 1"), "quality").withColumn("p", F.round("p", 9))


@query(f"""with {PAIRS_SQL}, d as (select quality as value, count(*)::double / sum(count(*)) over ()::double as p from prs group by quality), r as (select value, sum(p) over (order by value) as upto from d)
select distinct min(value) as border from r, range(1, 5) q(i) where upto >= i / 4.0::double - 1e-9 group by i""")
def quality_borders(spark, sf_dir):
    rows = classifier_pairs(spark, sf_dir)
    return pairs.quantile_borders(pairs.mixed_distribution(rows, rows, "quality"), 4)


@query(f"""with {d.EVENTS_SQL}, m as (select max(reads) as top from emol), c as (select i as value, (select count(*) from emol where reads = i) + 0.5::double as n from m, range(0, top + 1) t(i))
select value::bigint as value, round(n / sum(n) over (), 9) as p from c""")
def smoothed_reads(spark, sf_dir):
    return pairs.smoothed(event_mols(spark, sf_dir), "reads", 0.5).withColumn("p", F.round("p", 9))


@query(f"""{CLOSED_SQL}, tag as (select cb, count(*)::bigint as reads from ev group by cb), more as (select cb_to as cb, sum(reads) as extra from tag join root on cb = cb_from where cb_from <> cb_to group by cb_to)
select cb, (reads + coalesce(extra, 0))::bigint as reads from tag left join more using (cb)""")
def reads_added_back(spark, sf_dir):
    return pairs.added_back(tagging.reads_per_barcode(d.events(spark, sf_dir)), merge_closure(spark, sf_dir))


@query(f"""{CLOSED_SQL} select cb_to as cb, sum(n_umis)::bigint as n_umis, sum(n_reads)::bigint as n_reads from ecells join root on cb = cb_from group by cb_to""")
def counters_after_merge(spark, sf_dir):
    return merging.counters_after_merge(mo.cells(event_mols(spark, sf_dir)), merge_closure(spark, sf_dir))


@query(f"""with {d.MOLECULES_SQL}, g as (select cb, log10(count(distinct gene)) as v from mol where {REQUESTED} group by cb), b as (select min(v) as lo, max(v) as hi from g)
select least(floor((v - lo) / (case when hi > lo then (hi - lo) / 10 else 1.0::double end)), 9)::int as bin, count(*)::bigint as n from g, b group by 1""")
def genes_per_cell(spark, sf_dir):
    return report.genes_per_cell(mo.counts(mols(spark, sf_dir)), 10)


@query(f"with {d.CELLS_SQL}, m as (select median(n_umis::double) as m from cells) select round(max(m) + 4 * 1.4826::double * median(abs(n_umis - m)), 6) as threshold from cells, m")
def fraction_threshold(spark, sf_dir):
    return report.fraction_threshold(mo.cells(mols(spark, sf_dir)), "n_umis").select(F.round("threshold", 6).alias("threshold"))


@query(f"with {d.CELLS_SQL} select cb, round(log10(n_umis), 9) as log_umis, round(n_reads::double / n_umis, 9) as reads_per_umi from cells")
def reads_per_umi_by_size(spark, sf_dir):
    return report.reads_per_umi_by_size(mo.cells(mols(spark, sf_dir))).select("cb", F.round("log_umis", 9).alias("log_umis"), F.round("reads_per_umi", 9).alias("reads_per_umi"))


@query(f"""with {d.CELLS_SQL}, b as (select min(log10(n_umis)) as lo, (max(log10(n_umis)) - min(log10(n_umis))) / 20 as w from cells)
select least(floor((log10(n_umis) - lo) / w), 19)::int as bin, count(*)::bigint as cells from cells, b group by 1""")
def size_histogram(spark, sf_dir):
    return quality.size_histogram(mo.cells(mols(spark, sf_dir))).select("bin", "cells")


@query(f"""with {d.MOLECULES_SQL}, every as (select {d.SPELL.format(key="i", n=6)} as umi from range(4096) t(i)), c as (select umi, count(*) as n from mol group by all),
s as (select coalesce(n, 0) + 4.0::double as n from every left join c on every.umi = c.umi), p as (select n / sum(n) over () as p from s), q as (select quantile_cont(p, 0.99) as q from p),
k as (select p from p, q where p < q), b as (select min(p) as lo, max(p) as hi from k) select least(floor((p - lo) / ((hi - lo) / 10)), 9)::int as bin, count(*)::bigint as n from k, b group by 1""")
def umi_probabilities(spark, sf_dir):
    return report.umi_probabilities(mo.implicit_umi_distribution(mols(spark, sf_dir), 6, 1.0), bins=10)


@query(f"""with {d.MOLECULES_SQL}, c as (select umi, count(*) as n from mol group by all), t as (select sum(n) + 4.0::double * 4096 as total, count(*) as kinds from c)
select umi, round((n + 4.0::double) / total, 12) as p, 1::bigint as times from c, t union all select null, round(4.0::double / total, 12), (4096 - kinds)::bigint from t where kinds < 4096""")
def implicit_umi_distribution(spark, sf_dir):
    found = mo.implicit_umi_distribution(mols(spark, sf_dir), 6, 1.0)
    return found.select("umi", F.round("p", 12).alias("p"), F.col("times").cast("long").alias("times"))


@query(f"""with {d.CELLS_SQL}, n as (select count(*) as n from cells), o as (select n_reads, row_number() over (order by n_reads) as r from cells)
select (select quantile_cont(n_reads, 0.5)::double from cells) as median, (select round(quantile_cont(n_reads::double, 0.9), 9) from cells) as upper,
  (select round(avg(n_reads::double), 6) from o, n where r > floor(n * 0.2) and r <= n - floor(n * 0.2)) as trimmed,
  (select round(1.4826::double * median(abs(n_reads - (select median(n_reads) from cells))), 9) from cells) as deviation""")
def order_statistics(spark, sf_dir):
    from tallywright.operators import selection as sel

    cells = stored(mo.cells(mols(spark, sf_dir)))
    middle = sel.median(cells, "n_reads")
    found = (middle, round(sel.quantile(cells, "n_reads", 0.9), 9), round(sel.trimmed_mean(cells, "n_reads", 0.2), 6), round(sel.median_deviation(cells, "n_reads", middle), 9))
    return spark.createDataFrame([found], "median double, upper double, trimmed double, deviation double")


@query(f"with {d.EVENTS_SQL}, c as (select cb, count(*) as n_umis from emol group by cb) select row_number() over (order by n_umis desc, cb)::bigint as rank, round(1.0::double / n_umis, 9) as score from c")
def scores_by_rank(spark, sf_dir):
    cells = mo.cells(event_mols(spark, sf_dir))
    found = report.scores_by_rank(cells.select("cb", (F.lit(1.0) / F.col("n_umis")).alias("score")), cells)
    return found.select("rank", F.round("score", 9).alias("score"))


@query(f"with {d.CELLS_SQL} select cb, n_reads::double as depth, n_reads < (select avg(n_reads) from cells) as predicted from cells")
def saturation_points(spark, sf_dir):
    cells = mo.cells(mols(spark, sf_dir))
    present = cells.agg(F.avg("n_reads")).first()[0]
    return report.saturation_points(cells.select("cb", F.col("n_reads").cast("double").alias("depth")), present)


@query(f"with {d.CELLS_SQL} select cb, gene, count(*)::bigint as n from mol where {REQUESTED} and cb in ({FINAL}) group by all")
def estimate(spark, sf_dir):
    from . import estimate as plan

    return plan.estimate(d.reads(spark, sf_dir))["count_matrix"]


from . import files  # noqa: E402, F401  (queries over written files; they use the names above)
