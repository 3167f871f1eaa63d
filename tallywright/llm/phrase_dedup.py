"""Substring deduplication of word windows with sharded Aho-Corasick automata of repeated phrases."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame

from .passages import Context, Units, judged_texts


def judge_phrases(groups: list[list[Context]]) -> list[list[list[int] | None]]:
    """For each context the smallest rank that has each of its windows (one number where all are equal).

    A context that is the only one of its anchor is confirmed as it is. The windows of the others are the phrases of
    one automaton for all these groups, and the contexts are streamed through it to find each window's occurrences.
    """
    size = WORDS.window
    automaton, ranks = ahocorasick.Automaton(ahocorasick.STORE_INTS), []
    texts: dict[tuple[int, int], tuple[str, list[int]]] = {}
    for g, group in enumerate(groups):
        if len(group) == 1:
            continue
        for c, (_, context, low, _) in enumerate(group):
            line = context.decode("latin-1")  # one character a byte
            ends = [e - 1 for e in accumulate(len(w) + 1 for w in line.split(" "))]
            starts = [0, *(e + 1 for e in ends[:-1])]
            line = f" {line} "
            phrases = [line[starts[i] : ends[i + size - 1] + 2] for i in range(len(ends) - size + 1)]  # with the spaces around
            texts[g, c] = line, [e + 1 for e in ends[size - 1 :]]
            for p in phrases:
                k = automaton.get(p, -1)
                if k < 0:
                    automaton.add_word(p, len(ranks))
                    ranks.append(low)
                elif low < ranks[k]:
                    ranks[k] = low
    if ranks:
        automaton.make_automaton()
    said: list[list[list[int] | None]] = []
    for g, group in enumerate(groups):
        if len(group) == 1:
            said.append([[group[0][2]] if group[0][3] > 1 else None])
            continue
        verdicts: list[list[int] | None] = []
        for c, (_, _, low, n) in enumerate(group):
            line, ends = texts[g, c]
            at = {e: i for i, e in enumerate(ends)}
            best = [low] * len(ends)
            for end, k in automaton.iter(line):
                if (i := at.get(end)) is not None:
                    best[i] = min(best[i], ranks[k])
            lowest = min(best)
            verdicts.append(None if n == 1 and lowest >= low else [lowest] if lowest == max(best) else best)
        said.append(verdicts)
    return said


WORDS = Units(window=13, gram=5, words=True)


def cover(found: pa.Array, base: np.ndarray, ranks: np.ndarray, size: int) -> np.ndarray:
    """Which words of a batch (text i has those from base[i]) lie in a window whose smallest rank is below its text's."""
    gone = np.zeros(base[-1] + 1, np.int64)
    row = np.repeat(np.arange(len(found)), pa.compute.fill_null(pa.compute.list_value_length(found), 0).to_numpy(zero_copy_only=False))
    flat = found.flatten()
    if len(flat):
        unit, windows, lists = (flat.field(k) for k in ("unit", "windows", "verdict"))
        given = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        windows, lows = windows.to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().to_numpy(zero_copy_only=False)
        lows = np.repeat(lows, np.repeat(np.where(given == 1, windows, 1), given))  # one verdict stands for all windows of its context
        which = np.repeat(np.arange(len(flat)), windows)
        at = unit.to_numpy(zero_copy_only=False)[which] + np.arange(len(which)) - (np.cumsum(windows) - windows)[which] + base[row[which]]
        at = at[lows < ranks[row[which]]]
        np.add.at(gone, at, 1)
        np.add.at(gone, at + size, -1)
    return np.cumsum(gone[:-1]) > 0


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **limits: int) -> DataFrame:
    """(id, n_words, n_removed, kept): each text without the words of windows of 13 words that also start in a document
    of a smaller id, its words joined by one space.

    Windows are judged on the input. Null, empty and shorter texts keep all their words. A null id counts as larger than
    all others; rows that repeat an id are judged apart and do not remove each other. One row for each row of docs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for rows in range(0, b.num_rows, 512):
                part = b.slice(rows, 512)
                texts = [raw.as_py().split() for raw in part.column(2)]
                base = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
                covered = cover(part.column(3), base, part.column(1).to_numpy(zero_copy_only=False), WORDS.window)
                removed, kept = [], []
                for i, words in enumerate(texts):
                    gone = covered[base[i] : base[i + 1]]
                    removed.append(int(gone.sum()))
                    kept.append(b" ".join(words if not removed[-1] else [words[k] for k in np.flatnonzero(~gone).tolist()]))
                numbers = [pa.array(np.diff(base), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary())]
                yield pa.RecordBatch.from_arrays([part.column(0), *numbers], ["id", "n_words", "n_removed", "kept"])

    judged = judged_texts(docs, id_col, text_col, WORDS, True, judge_phrases, **limits)
    id_type = docs.schema[id_col].dataType.simpleString()
    return judged.mapInArrow(run, f"id {id_type}, n_words bigint, n_removed bigint, kept binary")
