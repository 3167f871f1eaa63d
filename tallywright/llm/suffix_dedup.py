"""Removal of byte strings that occur twice or more: positions sampled by content, told apart by digests of their contexts.

This is not prefix doubling: `doubling` is, gives the same rows and exceeds the disk allowed; README has its figures.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from .passages import Context, Units, judged_texts

BYTES = Units(window=200, gram=64, words=False)


def judge_strings(groups: list[list[Context]]) -> list[list[list[int] | None]]:
    """For each context the runs (first, length) of its windows that occur more than once, flattened."""
    size = BYTES.window
    said: list[list[list[int] | None]] = []
    for group in groups:
        if len(group) == 1:
            _, context, _, n = group[0]
            said.append([[0, len(context) - size + 1] if n > 1 else None])
            continue
        repeated = [np.zeros(len(c[1]) - size + 1, bool) for c in group]
        ahead = [c[0] for c in group]
        for back in range(max(ahead) + 1):  # windows that start so many bytes before the anchor: one length of table at a time
            seen: dict[bytes, int] = {}
            twice = set()
            for k, (off, context, _, n) in enumerate(group):
                i = off - back
                if 0 <= i < len(repeated[k]):
                    w = context[i : i + size]
                    if n > 1 or w in seen:
                        twice.add(w)
                    seen[w] = k
            if twice:
                for k, (off, context, _, _) in enumerate(group):
                    i = off - back
                    if 0 <= i < len(repeated[k]) and context[i : i + size] in twice:
                        repeated[k][i] = True
        verdicts: list[list[int] | None] = []
        for r in repeated:
            edges = np.flatnonzero(np.diff(np.concatenate(([0], r.view(np.int8), [0]))))
            runs = np.stack((edges[::2], edges[1::2] - edges[::2]), axis=1).ravel()
            verdicts.append(runs.tolist() if runs.size else None)
        said.append(verdicts)
    return said


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept): each text without the bytes of any 200-byte string that also starts
    somewhere else, in the same document too. n_spans: maximal removed runs.

    Strings are judged on the input and end with their document. Null, empty and shorter texts keep all their bytes.
    Rows that repeat a text hold each of its strings twice. One row for each row of docs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total, removed, spans, kept = [], [], [], []
            for raw, found in zip(b.column(2), b.column(3), strict=True):
                raw = raw.as_py()
                gone = np.zeros(len(raw) + 1, np.int64)
                if found.is_valid:
                    items = found.values
                    runs = items.field("verdict").flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
                    each = pa.compute.list_value_length(items.field("verdict")).to_numpy(zero_copy_only=False) // 2
                    at = np.repeat(items.field("unit").to_numpy(zero_copy_only=False), each) + runs[:, 0]
                    length = np.where(runs[:, 1] < 0, np.repeat(items.field("windows").to_numpy(zero_copy_only=False), each), runs[:, 1])
                    np.add.at(gone, at, 1)
                    np.add.at(gone, at + length + BYTES.window - 1, -1)
                covered = np.cumsum(gone[:-1]) > 0
                total.append(len(raw))
                removed.append(int(covered.sum()))
                spans.append(int((np.diff(np.concatenate(([0], covered.view(np.int8)))) == 1).sum()))
                kept.append(np.frombuffer(raw, np.uint8)[~covered].tobytes() if removed[-1] else raw)
            arrays = [b.column(0), *(pa.array(x, pa.int64()) for x in (total, removed, spans)), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "n_bytes", "n_removed", "n_spans", "kept"])

    judged = judged_texts(docs, id_col, text_col, BYTES, False, judge_strings, **limits)
    id_type = docs.schema[id_col].dataType.simpleString()
    return judged.mapInArrow(run, f"id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
