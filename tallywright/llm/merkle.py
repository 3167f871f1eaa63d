"""A Merkle manifest of a table: one tree a group, the group roots under one root, with each leaf's path (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import apart, broadcast_if, materialize

#: Children of a node, and levels that share one shuffle: a block of FANOUT ** LEVELS nodes is sorted in one task.
FANOUT = 3
LEVELS = 6
#: Rows of upper paths (some KB each) that may be broadcast, and runs of the numbering (some 50 bytes each).
MOST_PATHS, MOST_RUNS = 5_000, 100_000
STEP = "struct<left: string, right: string>"


def digest(*parts: Column) -> Column:
    """Lowercase hex sha256 of the parts, strings as UTF-8, one after another."""
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value for a leaf: its length in UTF-8 bytes, a colon and itself; null: a hyphen. No two lists of values give one preimage."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows + at (0, 1, ... within the group, ascending by `order`) and size (rows of the group).

    Rows are dealt by ranges of (group, order), so a group of any size is spread over tasks; a row's number is its place in its
    range and what earlier ranges hold of its group. Rows equal in `order` are numbered in some order.
    """
    dealt = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    dealt = materialize(dealt.withColumn("place", F.monotonically_increasing_id()), "merkle-order")
    part = F.shiftrightunsigned("place", 33).alias("part")
    runs = dealt.groupBy(group, part).agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    earlier = W.partitionBy(group).orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.select(group, "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(W.partitionBy(group)).alias("size"))
    runs = broadcast_if(materialize(runs, "merkle-runs"), MOST_RUNS)
    return dealt.withColumn("part", part).join(runs, [group, "part"]).withColumn("at", F.col("place") + F.col("shift")).drop("place", "shift", "part")


def climbed(nodes: DataFrame) -> DataFrame:
    """nodes(grp, at, size, node, ...) -> + block (at div FANOUT ** LEVELS), path (steps up to the block's own node) and up, that node's
    digest, on the first row of a block.

    Rows are dealt once by block. At each level the window of a parent has, in order, its children: the preimage and each
    child's siblings. A parent goes on once: of the rows below it only the first carries its digest to the next level.
    A level is left out where one node remains in the group.
    """
    found = nodes.withColumn("block", F.floor(F.col("at") / FANOUT**LEVELS)).withColumn("up", F.col("node")).withColumn("path", F.array().cast(f"array<{STEP}>"))
    found = found.repartition("grp", "block")
    for level in range(LEVELS):
        below, above = FANOUT**level, FANOUT ** (level + 1)
        run = W.partitionBy("grp", "block", F.floor(F.col("at") / above)).orderBy("at").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
        found = found.withColumn("children", F.collect_list("up").over(run))
        place = (F.floor(F.col("at") / below) % FANOUT).cast("int")
        joined = lambda part: F.array_join(part, "")
        step = F.struct(joined(F.slice("children", F.lit(1), place)).alias("left"), joined(F.slice("children", place + 2, F.lit(FANOUT))).alias("right"))
        several = F.col("size") > below
        path = F.when(several, F.concat("path", F.array(step))).otherwise(F.col("path"))
        up = F.when(~several, F.col("up")).when(F.col("at") % above == 0, F.sha2(joined(F.col("children")), 256))
        found = found.withColumns({"path": path, "up": up})
    return found.drop("children")


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """nodes(grp, at, size, node, ...) -> (the climbed() nodes of each turn, (grp, root)). A turn climbs LEVELS levels and keeps one
    row in FANOUT ** LEVELS."""
    most = nodes.agg(F.max("size")).first()[0] or 1
    turns, level = [], nodes
    while True:
        turns.append(climbed(level))
        tops = turns[-1].filter(F.col("at") % FANOUT**LEVELS == 0)
        tops = tops.select("grp", F.col("block").alias("at"), F.ceil(F.col("size") / FANOUT**LEVELS).alias("size"), F.col("up").alias("node"))
        level = materialize(tops, "merkle-nodes")
        most = -(-most // FANOUT**LEVELS)
        if most == 1:
            return turns, level.select("grp", F.col("node").alias("root"))


def descend(turns: list[DataFrame], upper: DataFrame) -> DataFrame:
    """The first turn's nodes with whole paths: those of their blocks, from the last turn down, are joined on, and at the top upper(grp,
    subroot, rest). The last turn has at most FANOUT ** LEVELS nodes a group, so no group is hot there; below, keys are blocks."""
    keys = ["grp"]
    for turn in reversed(turns):
        upper = broadcast_if(materialize(upper, "merkle-paths"), MOST_PATHS)
        found = turn.join(upper, keys).withColumn("path", F.concat("path", "rest")).drop("rest")
        upper = found.select("grp", F.col("at").alias("block"), "subroot", F.col("path").alias("rest"))
        keys = ["grp", "block"]
    return found


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings on its path."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["left"], node, step["right"]))


def proof(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step["left"], step["right"])), ""), 256)


def without_line_ends(id_col: Column, text: Column) -> Column:
    """The tampering of the check: where the crc32 of the id's digits is even, the text without its line feeds."""
    even = F.crc32(id_col.cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def manifest(
    docs: DataFrame,
    group_col: str = "source",
    id_col: str = "doc_id",
    fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"),
    text_col: str = "text",
    tampered=without_line_ends,
) -> DataFrame:
    """(doc_id, leaf, subroot, root, path, folded_root), one row for each row of docs; path: the siblings left and right of each
    node from the leaf to the root, as hex text.

    A leaf is the digest of the row's fields. Leaves of a group ascend by id (null first), then by leaf; while several nodes
    remain every three in a row become the digest of their hex texts, and so do the group roots, ordered by group (null first, UTF-8
    bytewise). folded_root is worked out from the leaf of the row with `tampered(id, text)` as its text and the path.
    Null fields count as such; a null group is a group. Rows that are equal in all fields have equal leaves and each their
    own place. A group of one row is its own root, as is a single group; an empty table gives no row. Other columns of docs,
    whatever their names, take no part. Texts are read once, only digests are shuffled; a group of any size is spread over tasks.
    """
    rows, names = apart(docs, *fields)
    _, (grp, key, text) = apart(docs, group_col, id_col, text_col)
    changed = tampered(F.col(key), F.col(text))
    leaf = digest(*[field(F.col(n)) for n in names])
    other = digest(*[field(changed if n == text else F.col(n)) for n in names])
    group = F.coalesce(F.concat(F.lit("1"), F.col(grp).cast("string")), F.lit("0"))
    leaves = rows.select(F.col(key).alias("doc_id"), group.alias("grp"), leaf.alias("node"), F.when(changed.eqNullSafe(F.col(text)), F.lit(None)).otherwise(other).alias("tampered"))
    leaves = numbered(materialize(leaves, "merkle-leaves"), "grp", ["doc_id", "node"])
    turns, subroots = climb(leaves)
    tops = numbered(subroots.select(F.lit(0).alias("grp"), F.col("grp").alias("name"), F.col("root").alias("node")), "grp", ["name"])
    top_turns, root = climb(tops)
    found = root.first()
    root_hex = F.lit(found["root"] if found else None).cast("string")
    start_path = subroots.sparkSession.range(1).select(F.lit(0).alias("grp"), F.lit("").alias("subroot"), F.array().cast(f"array<{STEP}>").alias("rest"))
    upper = descend(top_turns, start_path).select(F.col("name").alias("grp"), F.col("node").alias("subroot"), F.col("path").alias("rest"))
    found = descend(turns, upper)
    start = F.coalesce("tampered", "node")
    return found.select("doc_id", F.col("node").alias("leaf"), "subroot", root_hex.alias("root"), "path", folded(start, F.col("path")).alias("folded_root"))
