"""Benchmark decontamination by SimHash of item-sized windows and multi-index Hamming blocks (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, broadcast_if, materialize, words
from .fingerprints import BITS, votes_to_fp

SHINGLE = 5
#: Benchmark tables (one row a shingle, or a block) are broadcast up to this number of rows, else joined by shuffle.
MAX_BROADCAST_ROWS = 1_000_000


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """Hash of the `size` lower-cased words that start at each word; none for texts of fewer words."""

    def starts(found: Column) -> Column:
        full = F.slice(found, F.lit(1), F.greatest(F.size(found) - (size - 1), F.lit(0)))
        return F.transform(full, lambda x, i: F.xxhash64(x, *[F.get(found, i + k) for k in range(1, size)]))

    return F.element_at(F.transform(F.array(words(F.lower(text))), starts), 1)


def blocks(fp: Column, radius: int) -> Column:
    """One (block, value) for each of radius + 1 blocks: fingerprints within the radius agree in one at least."""
    edges = [round(i * BITS / (radius + 1)) for i in range(radius + 2)]
    return F.array(
        *[
            F.struct(F.lit(i).alias("block"), F.shiftrightunsigned(fp, a).bitwiseAND(F.lit((1 << (b - a)) - 1)).alias("value"))
            for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False))
        ]
    )


def promising(least: float) -> Column:
    """(first, last) of each run of starts whose window of `len` of `all` shingles holds enough of the sorted places `at`."""
    own = F.least("len", "all")
    need = F.ceil(F.lit(least / (1 + least)) * (own + F.col("len")) - 1e-6).cast("int")

    def run(i: Column) -> Column:
        # places i to i + need - 1 are all in windows that start from `first` to `last`; starts that run i - 1 has are left out
        low = F.get("at", i + need - 1) - F.col("len") + 1
        first = F.greatest(F.lit(0), low, F.coalesce(F.get("at", i - 1) + 1, F.lit(0)))
        return F.struct(first.alias("first"), F.least(F.get("at", i), F.col("all") - own).alias("last"))

    runs = F.transform(F.sequence(F.lit(0), F.size("at") - need), run)
    return F.when(F.size("at") >= need, F.filter(runs, lambda r: r["first"] <= r["last"]))


def short_leaks(source: DataFrame, items: DataFrame) -> DataFrame:
    """leaks() for items(item_id, text) of fewer than five words in source(id, text).

    Such an item is one shingle, its whole sequence, and so is each window of its size. The fingerprint of one shingle is
    its hash and the similarity of two is 1 or 0, so only equal fingerprints can pass: an equi-join. Only the sizes that
    occur, four at most, are looked for; without such items no text is read.
    """
    counted = items.select("item_id", "text", F.size(words(F.col("text"))).alias("len"))
    counted = counted.filter(F.col("len").between(1, SHINGLE - 1))
    sizes = sorted(r["len"] for r in counted.select("len").distinct().collect())  # at most SHINGLE - 1 of them
    whole = [F.when(F.col("len") == k, F.get(shingle_hashes(F.col("text"), k), 0)) for k in sizes]
    named = counted.select("item_id", "len", F.coalesce(F.lit(None).cast("long"), *whole).alias("h")).distinct()
    named = materialize(named, "short-items")

    def grams(size: int) -> Column:
        return F.transform(shingle_hashes(F.col("text"), size), lambda h, i: F.struct(F.lit(size).alias("len"), h.alias("h"), i.alias("start")))

    none = F.array().cast("array<struct<len:int,h:bigint,start:int>>")
    seen = source.limit(0) if not sizes else source
    seen = seen.select("id", F.xxhash64("text").alias("th"), F.explode(F.concat(none, *map(grams, sizes))).alias("g")).select("id", "th", "g.*")
    # a frequent item is one row a text before it is named by all items that are equal
    first = seen.join(broadcast_if(named.select("len", "h").distinct(), MAX_BROADCAST_ROWS), ["len", "h"], "left_semi").groupBy("id", "th", "len", "h").agg(F.min("start").alias("start"))
    met = first.join(named, ["len", "h"])
    return met.select(
        F.col("id").alias("doc_id"), "th", "item_id", F.col("start").cast("long").alias("start"), F.col("len").cast("long").alias("n_words"), F.lit(1.0).alias("similarity")
    )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    least: float = 0.8,
    radius: int = 20,
) -> DataFrame:
    """(doc_id, th, item_id, start, n_words, similarity): the best window of each document text and item it leaks.

    Windows have an item's number of words. A window is looked at where enough of its five-word shingles are in items of
    that size, wherever they stand, for the similarity to be reached: `both` shared of `own` and n shingles give
    both / (own + n - both), so fewer than least * (own + n) / (1 + least) cannot. Those windows and the items get
    SimHash fingerprints; blocks of the fingerprint give all pairs of one size within `radius` bits; those are verified by
    the weighted Jaccard similarity of their shingle multisets, which must reach `least`. At similarity 0.8 the mean
    distance is 9.7 bits and 20 is 3.6 standard deviations above it. Of equal windows the earliest is taken.

    th is the text's hash: rows that repeat an id with other texts are judged apart, equal rows give one result. Null
    and empty texts and items leak nothing. An item of fewer than five words is one shingle, its whole sequence: it leaks
    where these words stand in a row. Windows at a document's ends are moved inside it. Empty tables give no rows.
    """
    # null ids are kept: groups hold them together, joins compare null-safe
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter(F.col("text").isNotNull())
    items = benchmark.select(F.col(item_col).alias("item_id"), shingle_hashes(F.col(item_text_col)).alias("hs")).filter(F.size("hs") > 0)
    items = materialize(items.groupBy("hs").agg(F.collect_set("item_id").alias("item_ids")).withColumn("item", F.xxhash64("hs")), "items")
    held = items.select(F.size("hs").alias("len"), F.explode("hs").alias("h")).distinct()
    held = broadcast_if(materialize(held, "item-shingles"), MAX_BROADCAST_ROWS)

    hashed = source.select("id", F.xxhash64("text").alias("th"), shingle_hashes(F.col("text")).alias("hs"))
    seen = hashed.select("id", "th", F.size("hs").alias("all"), F.posexplode("hs").alias("pos", "h"))
    met = seen.join(held, "h").groupBy("id", "th", "len", "all").agg(F.sort_array(F.collect_set("pos")).alias("at"))
    met = met.select("id", "th", "len", F.explode(promising(least)).alias("run"))
    met = materialize(met, "windows").groupBy("id", "th").agg(F.collect_list(F.struct("len", "run.first", "run.last")).alias("runs"))
    met = met.select(F.col("id").alias("wid"), F.col("th").alias("wth"), "runs")
    windows = hashed.join(met, F.col("id").eqNullSafe(F.col("wid")) & (F.col("th") == F.col("wth"))).dropDuplicates(["id", "th"])
    windows = windows.select("id", "th", "hs", F.explode("runs").alias("run"))
    windows = windows.select("id", "th", "hs", "run.len", F.explode(F.sequence("run.first", "run.last")).alias("start"))
    windows = windows.select("id", "th", "start", "len", F.slice("hs", F.col("start") + 1, F.col("len")).alias("hs"))
    windows = materialize(windows, "windows-hashed")

    keys = ["id", "th", "start", "len"]
    prints = votes_to_fp(windows.select(*keys, F.explode("hs").alias("h")), keys)
    item_prints = votes_to_fp(items.select("item", F.size("hs").alias("len"), F.explode("hs").alias("h")), ["item", "len"])
    left = prints.select(*keys, F.col("fp"), F.explode(blocks(F.col("fp"), radius)).alias("b")).select(*keys, "fp", "b.block", "b.value")
    right = item_prints.select("item", "len", F.col("fp").alias("item_fp"), F.explode(blocks(F.col("fp"), radius)).alias("b"))
    right = materialize(right.select("item", "len", "item_fp", "b.block", "b.value"), "item-blocks")
    near = left.join(broadcast_if(right, MAX_BROADCAST_ROWS), ["len", "block", "value"])
    near = near.filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius).select(*keys, "item").distinct()
    near = materialize(near, "near-windows")

    counted = windows.select(*keys, F.explode("hs").alias("h")).groupBy(*keys, "h").agg(F.count("*").alias("c"))
    item_counted = items.select("item", F.explode("hs").alias("h")).groupBy("item", "h").agg(F.count("*").alias("ic"))
    pair = near.select(*[F.col(k).alias(f"n_{k}") for k in keys], "item")
    on = [F.col(k).eqNullSafe(F.col(f"n_{k}")) for k in keys]
    shared = counted.join(pair, on).join(broadcast_if(materialize(item_counted, "item-counts"), MAX_BROADCAST_ROWS), ["item", "h"])
    shared = shared.groupBy(*keys, "item").agg(F.sum(F.least("c", "ic")).alias("both"))
    lengths = windows.select(*[F.col(k).alias(f"n_{k}") for k in keys], F.size("hs").alias("own"))
    judged = shared.join(lengths, on).withColumn("similarity", F.col("both") / (F.col("own") + F.col("len") - F.col("both")))
    best = judged.filter(F.col("similarity") >= least).groupBy("id", "th", "item").agg(F.max(F.struct("similarity", -F.col("start"), "len")).alias("best"))
    named = best.join(items.select("item", F.explode("item_ids").alias("item_id")), "item")
    of_five = named.select(
        F.col("id").alias("doc_id"),
        "th",
        "item_id",
        (-F.col("best.col2")).cast("long").alias("start"),
        (F.col("best.len") + (SHINGLE - 1)).cast("long").alias("n_words"),
        F.col("best.similarity").alias("similarity"),
    )
    return of_five.unionByName(short_leaks(source, benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text"))))


def clean(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more) -> DataFrame:
    """The rows of docs that leak no item, columns unchanged, whatever their names."""
    rows, (id_, text) = apart(docs, id_col, text_col)
    bad = leaks(rows, benchmark, id_, text, **more).select(F.col("doc_id").alias("bad_id"), F.col("th").alias("bad_th")).distinct()
    return rows.join(bad, F.col(id_).eqNullSafe(F.col("bad_id")) & (F.xxhash64(text) == F.col("bad_th")), "left_anti").toDF(*docs.columns)
