"""Chat formatting into prefix trees: turns that conversations share at their start are emitted once, depth first."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import broadcast_if, materialize

#: The template. A turn is HEAD role LINE text END; ESCAPED characters never stand bare in a role or text.
HEAD, LINE, END = "### ", "\n", "</turn>\n"
ESCAPED = r"([\\#<])"
TURN = re.compile(r"### ((?:[^\\\n]|\\.)*)\n((?:[^\\<]|\\.)*)</turn>\n", re.S)
LEARNED = "assistant"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"\\$1")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def turns(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, path, turns): of each conversation its turns, formatted, and the ids of their nodes in the tree.

    A node's id is a digest (128 bits) of its parent's id and its turn, so conversations share nodes as far as they begin alike.
    Turns go by turn (null first), then role and text; a null role or text is empty; a repeated row is a turn more.
    A conversation is one record, as a document is.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.struct(F.col(turn_col).alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"))
    grouped = rows.groupBy(F.col(conv_col).alias("conv_id")).agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def made(t: Column) -> Column:
        head = F.concat(F.lit(HEAD), F.regexp_replace(escaped(t["role"]), "\n", "\\\\\n"), F.lit(LINE))
        body = escaped(t["text"])
        learned = t["role"] == LEARNED
        return F.struct(
            F.concat(head, body, F.lit(END)).alias("segment"),
            F.when(learned, F.length(head)).otherwise(F.lit(0)).alias("loss_from"),
            F.when(learned, F.length(head) + F.length(body)).otherwise(F.lit(0)).alias("loss_to"),
        )

    def extend(acc: Column, t: Column) -> Column:
        parent = F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(""))
        digest = F.substring(F.unhex(F.sha2(F.concat(parent, t["segment"]), 256)), 1, 16)
        return F.concat(acc, F.array(F.base64(digest)))

    shaped = grouped.select("conv_id", F.transform("turns", made).alias("turns"))
    return shaped.select("conv_id", F.aggregate("turns", F.array().cast("array<string>"), extend).alias("path"), "turns")


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
#: What first_seen() tells of a node: name and type, in Spark's words and in Arrow's.
NODES = [
    ("part", "int", pa.int32()), ("head", "boolean", pa.bool_()), ("tree", "string", pa.string()), ("node", "string", pa.string()), ("parent", "string", pa.string()),
    ("depth", "int", pa.int32()), ("segment", "string", pa.string()), ("loss_from", "int", pa.int32()), ("loss_to", "int", pa.int32()), ("position", "long", pa.int64()),
    ("size", "long", pa.int64()), ("begin", "long", pa.int64()), ("root", "long", pa.int64()), ("shared", "int", pa.int32()),
    ("spans", "array<struct<start: long, end: long>>", SPANS),
]


def joined_spans(spans: list[dict], start: int, end: int) -> list[dict]:
    """spans with one more after them, joined to the last where they meet."""
    if spans and spans[-1]["end"] == start:
        return [*spans[:-1], {"start": spans[-1]["start"], "end": end}]
    return [*spans, {"start": start, "end": end}]


def first_seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted paths (part, path, turns), each node where it first comes, with the tokens of this part before it.

    head marks nodes of a part's first path: those may have come in an earlier part. shared: how many nodes of a node's
    path are on that first path; spans: the tokens of the others, by their places in this part; root: the place of its
    root in this part, null where that is on the first path.
    """
    last: list[str] = []
    begins: list[int] = []  # of the nodes of the present path
    spans: list[list[dict]] = []
    begin, on_first = 0, -1
    for b in batches:
        out: list[tuple] = []
        for part, path, turns_ in zip(*(c.to_pylist() for c in b.columns), strict=True):
            same = 0
            while same < min(len(last), len(path)) and last[same] == path[same]:
                same += 1
            first = on_first < 0
            on_first = len(path) if first else min(on_first, same)
            del begins[same:], spans[same:]
            at = 0
            for i, (node, t) in enumerate(zip(path, turns_, strict=True)):
                size = len(t["segment"])
                if i >= same:
                    begins.append(begin)
                    before = spans[-1] if i > on_first else []
                    spans.append([] if i < on_first else joined_spans(before, begin, begin + size))
                    root = None if on_first else begins[0]
                    mine = (part, first, path[0], node, path[i - 1] if i else None, i, t["segment"], t["loss_from"], t["loss_to"])
                    out.append((*mine, at, size, begin, root, min(on_first, i + 1), spans[-1]))
                    begin += size
                at += size
            last = path
        columns = list(zip(*out, strict=True)) if out else [[]] * len(NODES)
        yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, (_, _, kind) in zip(columns, NODES, strict=True)], [name for name, *_ in NODES])


def first_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, offset, nodes of its first path) -> part, offset, the first root's place, and the spans of 1, 2, ... nodes."""
    for b in batches:
        roots, lists = [], []
        for nodes in b.column(2).to_pylist():
            spans: list[list[dict]] = []
            for n in nodes:
                spans.append(joined_spans(spans[-1] if spans else [], n["begin"], n["begin"] + n["size"]))
            roots.append(nodes[0]["begin"])
            lists.append(spans)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(roots, pa.int64()), pa.array(lists, pa.list_(SPANS))], ["part", "offset", "first_root", "first_spans"])


def tree(conversations: DataFrame) -> DataFrame:
    """conversations(path, turns) -> one row a node: tree, node, parent, depth, segment and its loss range, and its place.

    tree: the root's id. Tokens are code points. start: place of the first token in the tree's depth-first sequence;
    position: its position id, the tokens of the ancestors (which an own copy of the conversation would give it too);
    intervals: (start, end) of what the node's tokens may attend to, the ancestors and the node itself, spans that meet
    joined; causal within the node. Conversations are sorted by path over ranges: a node comes first in the first path
    that has it, after all of its ancestors, so a tree of any size is laid out by many tasks, in one pass. What a range
    needs to know of those before it, its offset and the places of its first path's nodes, is one row a range; texts are
    not moved again.
    """
    ordered = conversations.select("path", "turns").repartitionByRange("path").sortWithinPartitions("path").select(F.spark_partition_id().alias("part"), "path", "turns")
    rows = materialize(ordered.mapInArrow(first_seen, ", ".join(f"{name} {kind}" for name, kind, _ in NODES)), "chat-nodes")
    heads = rows.filter("head").select("part", "node", "depth", "size", "begin")  # a path a range
    earlier = rows.select(F.col("part").alias("first_part"), F.col("node").alias("first_node"), F.col("begin").alias("first_begin"))
    again = heads.join(earlier, (F.col("node") == F.col("first_node")) & (F.col("first_part") < F.col("part"))).groupBy("part", "node")
    again = materialize(again.agg(F.min(F.struct("first_part", "first_begin")).alias("first")).select("part", "node", "first.first_part", "first.first_begin"), "chat-again")
    sizes = rows.groupBy("part").agg(F.sum("size").alias("all"))  # one row a range, as all tables below
    sizes = sizes.join(heads.join(again, ["part", "node"]).groupBy("part").agg(F.sum("size").alias("repeated")), "part", "left").fillna(0, ["repeated"])
    before = F.coalesce(F.sum(F.col("all") - F.col("repeated")).over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = materialize(sizes.select("part", (before - F.col("repeated")).alias("offset")), "chat-offsets")
    known = heads.join(again, ["part", "node"], "left").join(offsets.select(F.col("part").alias("first_part"), F.col("offset").alias("first_offset")), "first_part", "left")
    known = known.join(offsets, "part").withColumn("begin", F.coalesce(F.col("first_begin") + F.col("first_offset"), F.col("begin") + F.col("offset")))
    lists = known.groupBy("part", "offset").agg(F.array_sort(F.collect_list(F.struct("depth", "begin", "size"))).alias("nodes"))
    firsts = lists.mapInArrow(first_paths, "part int, offset long, first_root long, first_spans array<array<struct<start: long, end: long>>>")
    firsts = broadcast_if(materialize(firsts, "chat-firsts"), MAX_BROADCAST_ROWS)
    fresh = rows.join(broadcast_if(again.select("part", "node"), MAX_BROADCAST_ROWS), ["part", "node"], "left_anti").join(firsts, "part")
    root = F.coalesce(F.col("root") + F.col("offset"), F.col("first_root"))
    moved = lambda spans, by: F.transform(spans, lambda x: F.struct((x["start"] + by).alias("start"), (x["end"] + by).alias("end")))
    none = F.array().cast("array<struct<start: long, end: long>>")
    a, b = moved(F.coalesce(F.get("first_spans", F.col("shared") - 1), none), -root), moved(F.col("spans"), F.col("offset") - root)
    placed = fresh.withColumns({"start": F.col("begin") + F.col("offset") - root, "_a": a, "_b": b})
    last, head = F.element_at("_a", F.size("_a")), F.get("_b", F.lit(0))
    meet = F.concat(F.slice("_a", F.lit(1), F.size("_a") - 1), F.array(F.struct(last["start"].alias("start"), head["end"].alias("end"))), F.slice("_b", F.lit(2), F.size("_b")))
    both = F.when((F.size("_a") > 0) & (F.size("_b") > 0), F.when(last["end"] == head["start"], meet))
    return placed.select("tree", "node", "parent", "depth", "segment", "loss_from", "loss_to", "position", "size", "start", F.coalesce(both, F.concat("_a", "_b")).alias("intervals"))


#: Nodes that come again at the start of a range, and what a range knows of its first path, are broadcast up to this number of rows.
MAX_BROADCAST_ROWS = 200_000


def format_chats(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(nodes, paths): the tree() table, and (conv_id, path), the nodes of each conversation.

    Conversations that are equal, or where one begins the other, end at nodes of one path. Empty tables give empty ones.
    """
    found = materialize(turns(rows, conv_col, turn_col, role_col, text_col), "chat-turns")
    return materialize(tree(found), "chat-tree"), found.select("conv_id", "path")


def read_back(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """(conv_id, formatted, learned): each conversation's text and its unescaped text under the loss mask, gathered from
    the segments that its last node's intervals cover, in the order of the sequence."""
    leaf = nodes.select(F.col("node").alias("leaf"), "intervals")
    each = paths.withColumn("leaf", F.element_at("path", -1)).join(leaf, "leaf").select("conv_id", "intervals", F.explode("path").alias("node"))
    parts = each.join(nodes.select("node", "start", "size", "segment", "loss_from", "loss_to"), "node")
    seen = F.exists("intervals", lambda s: (s["start"] <= F.col("start")) & (F.col("start") + F.col("size") <= s["end"]))
    gathered = parts.filter(seen).groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("start", "segment", "loss_from", "loss_to"))).alias("parts"))
    masked = lambda p: unescaped(F.substring(p["segment"], p["loss_from"] + 1, p["loss_to"] - p["loss_from"]))
    return gathered.select("conv_id", F.array_join("parts.segment", "").alias("formatted"), F.array_join(F.transform("parts", masked), "").alias("learned"))


def parsed(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of the turns of a formatted conversation."""
    found, at = [], 0
    for m in TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError(f"no turn at {at}")
        at = m.end()
        found.append(tuple(re.sub(r"(?s)\\(.)", r"\1", x) for x in m.groups()))
    if at != len(formatted):
        raise ValueError(f"no turn at {at}")
    return found


def digest(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [parsed(t) for t in b.column(1).to_pylist()]
            digests = [hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in x).encode()).hexdigest() for x in found]
            arrays = [b.column(0), pa.array(map(len, found), pa.int64()), pa.array(digests, pa.string()), *(b.column(i) for i in (2, 3, 4))]
            yield pa.RecordBatch.from_arrays(arrays, ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    back = read_back(nodes, paths)
    chars = lambda c: F.length(c).cast("long")
    rows = back.select("conv_id", "formatted", chars("learned").alias("lc"), F.sha2("learned", 256).alias("ls"), chars("formatted").alias("fc"))
    kind = paths.schema["conv_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"conv_id {kind}, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")
