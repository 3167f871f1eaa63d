"""Document fingerprints by SimHash, and search within a Hamming radius by permuted block tables (DataFrame functions only)."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, words

BITS = 64
#: Two counters of 32 bits share a long: bit j of a hash and bit j + 32.
LANES = 32
PAIR = 0x0000000100000001


def term_hashes(text: Column) -> Column:
    """Hashes of the three words that start at each word of the lower-cased text (fewer at its end), repeats included."""

    def starts(found: Column) -> Column:
        return F.transform(found, lambda x, i: F.xxhash64(x, F.get(found, i + 1), F.get(found, i + 2)))

    # the array of one element has the words split once, not at each step
    return F.element_at(F.transform(F.array(words(F.lower(text))), starts), 1)


def simhash(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """keys + fp: bit j is set where the hashes of the terms that set it outweigh those that don't; no term: 0.

    A term weighs as often as it occurs: each occurrence votes. Votes are summed as packed counters, partial sums first,
    so a very long text costs rows, not memory. Rows that repeat a key with the same text change nothing.
    """
    terms = texts.select(*keys, F.explode_outer(term_hashes(F.col(text_col))).alias("h"))
    return votes_to_fp(terms, keys)


def votes_to_fp(terms: DataFrame, keys: list[str]) -> DataFrame:
    """keys, h (one row a term, null: none) -> keys, fp."""
    votes = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(F.lit(PAIR))).alias(f"v{j}") for j in range(LANES)]
    counted = terms.groupBy(*keys).agg(F.count("h").alias("n"), *votes)

    def bit(j: int) -> Column:
        lane = F.coalesce(F.col(f"v{j % LANES}"), F.lit(0))
        count = lane.bitwiseAND(F.lit(0xFFFFFFFF)) if j < LANES else F.shiftrightunsigned(lane, 32)
        return F.when(count * 2 > F.col("n"), F.lit((1 << j) - (1 << BITS) if j == BITS - 1 else 1 << j)).otherwise(F.lit(0))

    return counted.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), [bit(j).cast("long") for j in range(BITS)]).alias("fp"))


def likeness(a: Column, b: Column) -> Column:
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def block_masks(radius: int, kept: int) -> list[int]:
    """For each choice of `kept` of radius + kept blocks, the bits of those blocks, as a signed number."""
    blocks = radius + kept
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    masks = [sum((1 << edges[b + 1]) - (1 << edges[b]) for b in choice) for choice in combinations(range(blocks), kept)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def block_tables(fps: DataFrame, masks: list[int]) -> DataFrame:
    """fps(fp, ...) with tab and key, one row for each mask, key holding its bits.

    Fingerprints that differ in at most `radius` bits differ in at most as many blocks, so some table has them under one key.
    """
    rows = F.array(*[F.struct(F.lit(t).alias("tab"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for t, m in enumerate(masks)])
    return fps.select("*", F.explode(rows).alias("t")).select(*fps.columns, "t.tab", "t.key")


def within(queries: DataFrame, fps: DataFrame, radius: int = 3, kept: int = 3) -> DataFrame:
    """(query, fp, distance, ...): all fingerprints of fps(fp, ...) at most `radius` bits from each of queries(fp), itself
    included; both distinct, so that copies cost nothing.

    A pair comes from the first table that has it under one key. With the defaults a key holds about half of the bits,
    so unrelated fingerprints seldom meet even among 10^10 of them.
    """
    masks = block_masks(radius, kept)
    left = block_tables(queries.select("fp"), masks).withColumnRenamed("fp", "query")
    right = block_tables(fps, masks).withColumnsRenamed({"tab": "_tab", "key": "_key"})
    apart = F.col("query").bitwiseXOR(F.col("fp"))
    earlier = reduce(lambda a, b: a | b, [(F.col("tab") > t) & (apart.bitwiseAND(F.lit(m)) == 0) for t, m in enumerate(masks[:-1])])
    same = (F.col("tab") == F.col("_tab")) & (F.col("key") == F.col("_key"))
    met = left.join(right, same & (F.bit_count(apart) <= radius) & ~earlier)
    return met.select("query", *fps.columns, F.bit_count(apart).alias("distance"))


def next_rows(slim: DataFrame) -> DataFrame:
    """slim(id, th, ...), distinct keys -> + next: struct(id, th) of the row after it in ascending order, the last's is the first.

    Rows are dealt by ranges of the order; only the first key of each range is looked at across ranges.
    """
    dealt = materialize(slim.repartitionByRange("id", "th").withColumn("part", F.spark_partition_id()), "order")
    key = F.struct("id", "th")
    firsts = dealt.groupBy("part").agg(F.min(key).alias("first"))
    ranges = W.orderBy("part")
    all_ranges = ranges.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("first").over(ranges), F.first("first").over(all_ranges)).alias("after"))
    inside = dealt.withColumn("next", F.lead(key).over(W.partitionBy("part").orderBy("id", "th")))
    return inside.join(after, "part").withColumn("next", F.coalesce("next", "after")).drop("part", "after")


def edited_prints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 3, every: int = 50) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next, n_within, one row for each row of docs.

    The edited text has the last floor(n_chars / 4) code points replaced by the first as many (or all) of the next
    document's in ascending id (then text hash); after the last comes the first, and a lone document follows itself.
    Null texts count as empty (fingerprint 0). Null ids come first. Rows that repeat id and text are one document here
    and all get its values. n_within is set for ids divisible by `every`, the search's queries: how many documents, itself
    included, have fingerprints within the radius, by block tables over all. A pair of texts without terms has likeness 1. Empty tables give none.
    """
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("th", F.xxhash64("text"))
    slim = source.groupBy("id", "th").agg(F.max(F.length("text")).alias("n"))
    order = materialize(next_rows(slim), "order-next")
    by_next = order.select(F.col("next.id").alias("rid"), F.col("next.th").alias("rth"), F.col("id").alias("oid"), F.col("th").alias("oth"), "n")
    take = F.floor(F.col("n") / 4).cast("int")
    asked = source.join(by_next, F.col("id").eqNullSafe(F.col("rid")) & (F.col("th") == F.col("rth")))
    tails = asked.select("oid", "oth", F.col("text").substr(F.lit(1), take).alias("tail")).groupBy("oid", "oth").agg(F.max("tail").alias("tail"))
    n = F.length("text")
    kept = F.col("text").substr(F.lit(1), n - F.floor(n / 4).cast("int"))
    both = source.join(tails, F.col("id").eqNullSafe(F.col("oid")) & (F.col("th") == F.col("oth")))
    edited = F.concat(kept, F.col("tail"))
    versions = F.array(F.struct(F.col("text"), F.lit(None).cast("string").alias("sha")), F.struct(edited.alias("text"), F.sha2(edited, 256).alias("sha")))
    both = both.select("id", "th", n.cast("long").alias("n_chars"), F.posexplode(versions).alias("edit", "v"))
    # the digest goes along as a key, so the texts are dealt out once and not once more for it
    prints = simhash(both.select("id", "th", "n_chars", "edit", "v.text", "v.sha"), ["id", "th", "n_chars", "edit", "sha"])
    pick = lambda k: F.max(F.when(F.col("edit") == k, F.col("fp")))
    prints = prints.groupBy("id", "th").agg(F.max("n_chars").alias("n_chars"), F.max("sha").alias("edited_sha256"), pick(0).alias("fp"), pick(1).alias("edited_fp"))
    prints = materialize(prints, "prints")
    rows = source.select("id", "th")
    same = lambda a, b: F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.th") == F.col(f"{b}.th"))
    follow = F.col("o.next.id").eqNullSafe(F.col("p.id")) & (F.col("o.next.th") == F.col("p.th"))
    upcoming = order.alias("o").join(prints.alias("p"), follow).select("o.id", "o.th", F.col("p.fp").alias("next_fp"))
    near = [likeness(F.col("p.fp"), F.col("p.edited_fp")).alias("near_edited"), likeness(F.col("p.fp"), F.col("u.next_fp")).alias("near_next")]
    asks = F.col("id").cast("long") % every == 0
    copies = prints.groupBy("fp").agg(F.count("*").alias("copies"), F.max(asks).alias("asked"))
    hits = within(copies.filter("asked").select("fp"), copies.select("fp", "copies"), radius).groupBy("query").agg(F.sum("copies").alias("n_within"))
    found = rows.alias("r").join(prints.alias("p"), same("r", "p")).join(upcoming.alias("u"), same("r", "u")).join(hits.alias("h"), F.col("p.fp") == F.col("h.query"), "left")
    n_within = F.when(F.col("r.id").cast("long") % every == 0, F.col("h.n_within"))
    return found.select(F.col("r.id").alias("doc_id"), "p.n_chars", "p.edited_sha256", "p.fp", "p.edited_fp", *near, n_within.alias("n_within"))
