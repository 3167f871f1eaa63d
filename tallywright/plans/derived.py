"""Sequencing tables derived from the driver's tables, in Spark and, by the same rules, in SQL.

Barcodes spell keys in base 4; pseudo-reads and qualities spell digests; intervals and alignments come from part keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.operators.tables import with_once

HEX = "0123456789abcdef"
NUCLEOTIDES, WITH_N, QUALITIES = "ACGTACGTACGTACGT", "ACGTACGTACGTACGN", "#(-27<ACEFGHHIIJ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spelled(key: Column, length: int = 6) -> Column:
    return F.translate(F.lpad(F.conv(key.cast("string"), 10, 4), length, "0"), "0123", "ACGT")


def digest(key: Column, letters: str) -> Column:
    return F.translate(F.md5(key.cast("string")), HEX, letters)


def reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = F.when(F.col("l_returnflag") == "A", 2).when(F.col("l_returnflag") == "N", 4).otherwise(1)
    gene = F.when(F.col("l_linenumber") < 7, F.concat(F.lit("G"), (F.col("l_partkey") % 50).cast("string")))
    return table(spark, sf_dir, "lineitem").select(
        spelled(F.col("l_suppkey")).alias("cb"),
        spelled(F.col("l_orderkey") % 4096).alias("umi"),
        gene.alias("gene"),
        F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")).alias("chrom"),
        mark.alias("mark"),
        F.substring(digest(F.col("l_orderkey"), QUALITIES), 1, 6).alias("umi_qual"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads of small cells: users as cells; identifiers of three bases, so that neighbours abound."""
    return table(spark, sf_dir, "events").select(
        spelled(F.col("user_id") % 500, 6).alias("cb"), spelled(F.col("event_id") % 64, 3).alias("umi"), F.concat(F.lit("G"), (F.col("event_id") % 7).cast("string")).alias("gene"), F.lit(2).alias("mark")
    )


def graded_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with qualities of identifiers, over more genes."""
    key = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        spelled(F.col("user_id") % 500, 6).alias("cb"), spelled(key * key % 64, 3).alias("umi"), F.concat(F.lit("G"), (key % 37).cast("string")).alias("gene"), F.lit(2).alias("mark"),
        F.substring(digest(key, QUALITIES), 1, 3).alias("umi_qual"),
    )


def fastq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reads in lock-step from orders: 32 bases each."""
    key = F.col("o_orderkey")
    made = {f"seq{i}": digest(key + i - 1, NUCLEOTIDES if i < 3 else WITH_N) for i in (1, 2, 3)} | {f"qual{i}": digest(key + 10 * i, QUALITIES) for i in (1, 2, 3)}
    return with_once(table(spark, sf_dir, "orders").select("o_orderkey"), made).withColumnRenamed("o_orderkey", "ord")


def annotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts of two exons on three chromosomes; those of some parts list their intron."""
    key, size = F.col("p_partkey"), F.col("p_size").cast("long")
    start = key * 10
    exon = lambda a, b: F.struct(a.alias("start_pos"), b.alias("end_pos"), F.lit("exon").alias("kind"))
    intron = F.struct((start + size).alias("start_pos"), (start + 2 * size).alias("end_pos"), F.lit("intron").alias("kind"))
    parts = F.array_compact(F.array(exon(start, start + size), exon(start + 2 * size, start + 3 * size), F.when(key % 3 == 0, intron)))
    rows = table(spark, sf_dir, "part").select(
        F.concat(F.lit("chr"), (key % 3).cast("string")).alias("chrom"), F.concat(F.lit("G"), (key % 200).cast("string")).alias("gene_name"), F.concat(F.lit("T"), key.cast("string")).alias("transcript_id"), F.explode(parts).alias("e")
    )
    return rows.select("chrom", "gene_name", "transcript_id", "e.*")


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    pos = F.col("l_partkey") * 10 + F.col("l_linenumber")
    rows = table(spark, sf_dir, "lineitem").select(
        key.alias("id"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 4).cast("string")).alias("chrom"), pos.alias("pos"), F.col("l_quantity").cast("long").alias("span")
    )
    first = rows.groupBy("id").agg(F.min(F.struct("pos", "chrom", "span")).alias("a"))
    return first.select("id", "a.chrom", "a.pos", (F.col("a.pos") + F.col("a.span")).alias("end_pos"))


#: The same tables as common table expressions.
SPELL = "translate(lpad(to_base({key}, 4), {n}, '0'), '0123', 'ACGT')"


def sql_digest(key: str, letters: str) -> str:
    return f"translate(md5(cast({key} as varchar)), '{HEX}', '{letters}')"


READS_SQL = f"""reads as (
  select {SPELL.format(key="l_suppkey", n=6)} as cb, {SPELL.format(key="l_orderkey % 4096", n=6)} as umi,
         case when l_linenumber < 7 then 'G' || cast(l_partkey % 50 as varchar) end as gene, 'chr' || cast(l_linenumber as varchar) as chrom,
         case l_returnflag when 'A' then 2 when 'N' then 4 else 1 end as mark, substr({sql_digest("l_orderkey", QUALITIES)}, 1, 6) as umi_qual
  from lineitem)"""
MOLECULES_SQL = READS_SQL + """, mol as (
  select cb, gene, umi, count(*)::bigint as reads, bit_or(mark) as mark from reads where gene is not null group by all)"""
CELLS_SQL = MOLECULES_SQL + """, cells as (
  select cb, count(distinct gene)::bigint as n_genes, count(*)::bigint as n_umis, sum(reads)::bigint as n_reads,
         count(distinct case when mark in (2, 3, 6, 7) then gene end)::bigint as req_genes,
         count(*) filter (where mark in (2, 3, 6, 7))::bigint as req_umis, coalesce(sum(reads) filter (where mark in (2, 3, 6, 7)), 0)::bigint as req_reads
  from mol group by cb)"""
EVENTS_SQL = f"""ev as (
  select {SPELL.format(key="user_id % 500", n=6)} as cb, {SPELL.format(key="event_id % 64", n=3)} as umi, 'G' || cast(event_id % 7 as varchar) as gene, 2 as mark from events),
emol as (select cb, gene, umi, count(*)::bigint as reads, bit_or(mark) as mark from ev group by all)"""
GRADED_SQL = f"""gr as (
  select {SPELL.format(key="user_id % 500", n=6)} as cb, {SPELL.format(key="event_id * event_id % 64", n=3)} as umi, 'G' || cast(event_id % 37 as varchar) as gene, 2 as mark,
         substr({sql_digest("event_id", QUALITIES)}, 1, 3) as umi_qual from events),
gq as (select cb, gene, umi, i, sum(ascii(substr(umi_qual, i, 1)))::bigint as code, count(*)::bigint as reads, bit_or(mark) as mark from gr, range(1, 4) t(i) group by all)"""
FASTQ_SQL = "fq as (select o_orderkey as ord, " + ", ".join(
    f"{sql_digest(f'o_orderkey + {i - 1}', NUCLEOTIDES if i < 3 else WITH_N)} as seq{i}, {sql_digest(f'o_orderkey + {10 * i}', QUALITIES)} as qual{i}" for i in (1, 2, 3)
) + " from orders)"
ANNOTATION_SQL = """p0 as (
  select 'chr' || cast(p_partkey % 3 as varchar) as chrom, 'G' || cast(p_partkey % 200 as varchar) as gene_name, 'T' || cast(p_partkey as varchar) as transcript_id,
         p_partkey * 10 as s, cast(p_size as bigint) as z, p_partkey from part),
ann as (
  select chrom, gene_name, transcript_id, s as start_pos, s + z as end_pos, 'exon' as kind from p0
  union all select chrom, gene_name, transcript_id, s + 2 * z, s + 3 * z, 'exon' from p0
  union all select chrom, gene_name, transcript_id, s + z, s + 2 * z, 'intron' from p0 where p_partkey % 3 = 0)"""
ALIGNMENTS_SQL = """a0 as (
  select l_orderkey * 10 + l_linenumber as id, 'chr' || cast(l_suppkey % 4 as varchar) as chrom, l_partkey * 10 + l_linenumber as pos, cast(l_quantity as bigint) as span from lineitem),
aln as (select id, chrom, pos, pos + span as end_pos from a0 qualify row_number() over (partition by id order by pos, chrom, span) = 1)"""
