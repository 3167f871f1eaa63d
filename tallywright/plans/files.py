"""Queries that write files from the driver's tables and read them back, with SQL over the tables themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.operators import identifiers, results, tagging
from tallywright.operators.tables import fresh, stored
from tallywright.sources import annotation, bam, fastq, lock_step

from . import derived as d
from .catalog import CLOSED_SQL, event_mols, merge_closure, query


def files(spark: SparkSession, path: str) -> list[str]:
    """Data files of a folder, in order of their names (which number the parts)."""
    return sorted(r["path"] for r in spark.read.format("binaryFile").load(path).select("path").collect())


def sequenced(spark: SparkSession, sf_dir: str) -> list[list[str]]:
    """The derived reads as compressed files: for each part of the table a run of three files with its records in order."""
    rows = stored(d.fastq(spark, sf_dir).repartitionByRange("ord").sortWithinPartitions("ord"))
    parts = []
    for i in (1, 2, 3):
        path = fresh(spark)
        fastq.write_fastq(rows.select(F.concat(F.lit("@"), F.col("ord").cast("string")).alias("read_id"), F.col(f"seq{i}").alias("seq"), F.col(f"qual{i}").alias("qual")), path)
        parts.append(files(spark, path))
    return [list(run) for run in zip(*parts, strict=True)]


@query(f"with {d.FASTQ_SQL} select '@' || ord as id, seq1, qual1, seq2, qual2, seq3, qual3 from fq")
def lock_step_reads(spark, sf_dir):
    return lock_step.read_lock_step(spark, sequenced(spark, sf_dir)).drop("run", "ord")


def aligned(reads: DataFrame) -> DataFrame:
    """Reads of derived tables as alignments: places and bases from their fields."""
    place = F.length("gene") * 1000 + F.ascii("umi")
    return reads.withColumns({
        "name": F.concat_ws(":", "cb", "umi"), "pos": F.coalesce(place, F.lit(7)).cast("long"), "flag": F.when(F.col("umi").endswith("A"), 16).otherwise(0), "seq": F.concat("cb", "umi"),
        "qual": F.rpad(F.lit(""), F.length("cb") + F.length("umi"), F.lit("F")),
    }).withColumn("end_pos", F.col("pos") + F.length("seq"))


@query(f"""with {d.READS_SQL} select cb || ':' || umi as name, chrom, coalesce(length(gene) * 1000 + ascii(umi), 7)::bigint as pos, coalesce(length(gene) * 1000 + ascii(umi), 7)::bigint + 12 as end_pos,
  case when right(umi, 1) = 'A' then 16 else 0 end as flag, cb || umi as seq, '12M' as cigar, cb, umi, gene, case when gene is null then 'INTERGENIC' when mark = 2 then 'EXONIC' when mark = 4 then 'INTRONIC' end as kind from reads""")
def tagged_bam(spark, sf_dir):
    path = fresh(spark)
    results.write_tagged(aligned(d.reads(spark, sf_dir)), path, sort=True)
    tag = lambda t: F.try_element_at("tags", F.lit(t))
    return bam.read_bam(spark, path).select("name", "chrom", "pos", "end_pos", "flag", "seq", "cigar", tag("CR").alias("cb"), tag("UR").alias("umi"), tag("GX").alias("gene"), tag("RE").alias("kind"))


@query(f"""{CLOSED_SQL}, one as (
  select a.cb, a.gene, a.umi, b.umi as other from emol a join emol b on a.cb = b.cb and a.gene = b.gene and hamming(a.umi, b.umi) = 1 where a.reads * 2 <= b.reads
  qualify row_number() over (partition by a.cb, a.gene, a.umi order by b.reads desc, b.umi) = 1),
kept as (select ev.gene, coalesce(cb_to, ev.cb) as cb, ev.umi, ev.cb || ':' || ev.umi as name from ev left join root on ev.cb = cb_from),
named as (select kept.cb, kept.gene, coalesce(other, kept.umi) as umi, name from kept left join one on kept.cb = one.cb and kept.gene = one.gene and kept.umi = one.umi)
select cb, gene, umi, count(*)::bigint as reads from named semi join (select cb, gene, umi from emol where reads > 1) m using (cb, gene, umi) group by all""")
def filtered_bam(spark, sf_dir):
    path, m = fresh(spark), event_mols(spark, sf_dir)
    reads = aligned(d.events(spark, sf_dir).withColumn("chrom", F.lit("chr1")))
    results.write_filtered(reads, merge_closure(spark, sf_dir), identifiers.directional_pairs(m), m.filter("reads > 1"), path)
    kept = bam.barcode_tags(bam.read_bam(spark, path))
    return kept.groupBy("cb", F.try_element_at("tags", F.lit("GX")).alias("gene"), "umi").agg(F.count("*").alias("reads"))


@query(f"with {d.ANNOTATION_SQL} select chrom, gene_name as gene_id, gene_name, transcript_id, start_pos, end_pos, kind from ann")
def annotation_as_gtf(spark, sf_dir):
    """The derived annotation as a GTF file: 1-based, closed."""
    path, quoted = fresh(spark), lambda name, c: F.concat(F.lit(f'{name} "'), F.col(c), F.lit('";'))
    line = F.concat_ws("\t", "chrom", F.lit("x"), "kind", F.col("start_pos") + 1, "end_pos", F.lit("."), F.lit("+"), F.lit("."), F.concat_ws(" ", quoted("gene_name", "gene_name"), quoted("transcript_id", "transcript_id")))
    d.annotation(spark, sf_dir).select(line.alias("value")).write.option("compression", "gzip").text(path)
    return annotation.read_gtf(spark, path)


@query(f"with {d.ANNOTATION_SQL} select chrom, transcript_id || '_intron' as name, transcript_id as whole, start_pos, end_pos, 'exon' as kind from ann where kind = 'intron'")
def introns_as_bed(spark, sf_dir):
    """The derived introns as a BED file, and the names that introns are trimmed to."""
    path = fresh(spark)
    rows = d.annotation(spark, sf_dir).filter("kind = 'intron'")
    rows.select(F.concat_ws("\t", "chrom", "start_pos", "end_pos", F.concat("transcript_id", F.lit("_intron"))).alias("value")).write.text(path)
    found = annotation.read_bed(spark, path)
    return found.select("chrom", F.col("gene_name").alias("name"), annotation.trimmed_intron_name("gene_name").alias("whole"), "start_pos", "end_pos", "kind")


@query(f"""with {d.FASTQ_SQL}, p as (select '@r' || ord || '!' || substr(seq1, 1, 4) || '#' || substr(seq2, 1, 4) as read_id, seq1, seq2, qual1, qual2 from fq)
select substr(read_id, 2) as name, substr(seq1, 1, 4) as cb, substr(seq2, 1, 4) as umi, substr(qual1, 1, 4) as cb_qual, substr(qual2, 1, 4) as umi_qual from p""")
def params_written(spark, sf_dir):
    """Parameters of the derived reads as lines, written and read back."""
    path, part = fresh(spark), lambda c: F.substring(c, 1, 4)
    reads = d.fastq(spark, sf_dir).select(part("seq1").alias("cb"), part("seq2").alias("umi"), part("qual1").alias("cb_qual"), part("qual2").alias("umi_qual"), "ord")
    name = F.concat(F.lit("@r"), F.col("ord").cast("string"), F.lit("!"), F.col("cb"), F.lit("#"), F.col("umi"))
    tagging.write_params(reads.withColumn("read_id", name), path)
    return annotation.read_params(spark, path)
