"""Repeated passages where rows repeat, texts are long and ids are names."""

import random
import time
import tracemalloc

import numpy as np
import pytest

from tallywright.llm import passages, phrase_dedup, suffix_dedup


def prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7))) for _ in range(n))


def test_rows_that_repeat_id_and_text(spark):
    """Time and memory in proportion: every copy's contexts are said once, not once a copy for each copy."""
    text = prose(random.Random(1), 90)
    docs = spark.createDataFrame([(None, text)] * 8000 + [(3, text), (4, prose(random.Random(2), 30))], "doc_id long, text string").repartition(4)
    start = time.perf_counter()
    words = phrase_dedup.remove_repeats(docs).groupBy("id", "n_removed").count().collect()
    assert sorted((r["id"] is None, r["n_removed"], r["count"]) for r in words) == [(False, 0, 1), (False, 0, 1), (True, 90, 8000)]
    strings = suffix_dedup.remove_repeats(docs).groupBy("id", "n_removed").count().collect()
    n = len(text)
    assert sorted((r["id"] is None, r["n_removed"], r["count"]) for r in strings) == [(False, 0, 1), (False, n, 1), (True, n, 8000)]
    assert time.perf_counter() - start < 90


def test_ids_that_are_names(spark):
    text = prose(random.Random(3), 90)
    docs = spark.createDataFrame([("a", text), ("b", text), (None, prose(random.Random(4), 90))], "doc_id string, text string")
    assert sorted((r["id"] or "", r["n_removed"] > 0) for r in suffix_dedup.remove_repeats(docs).collect()) == [("", False), ("a", True), ("b", True)]
    with pytest.raises(TypeError, match="whole-number"):
        phrase_dedup.remove_repeats(docs)


@pytest.mark.parametrize("units", [phrase_dedup.WORDS, suffix_dedup.BYTES])
def test_cuts_change_nothing(units, monkeypatch):
    rnd = random.Random(5)
    text = units.text((prose(rnd, 4000) + " " + "x" * 900 + " " + prose(rnd, 50) + " tail ").encode())

    def found():
        return [c for c in passages.contexts(text, units, lambda h: np.ones(len(h), bool))]

    def windows(items):
        return sorted((u + i, w) for _, _, u, n, c in items for i, w in enumerate(passages.split(c, n, units)))

    whole = found()
    for piece in (64, 1000):
        monkeypatch.setattr(passages, "PIECE", piece)
        assert windows(found()) == windows(whole)


def test_memory_of_a_long_text():
    text = (prose(random.Random(6), 20000) + " ").encode() * 80
    text = phrase_dedup.WORDS.text(text)
    tracemalloc.start()
    n = sum(len(x[3]) for x in passages.cut(text, phrase_dedup.WORDS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n > 100_000 and peak < 160e6 < 25 * len(text)


def test_texts_without_a_wide_anchor_are_not_cut_again(spark, monkeypatch):
    """An anchor of very many contexts is judged by its windows: one pass, over the texts that hold it, in place of two over all texts."""
    rnd = random.Random(7)
    # five words of a small hash, which so are the anchor of most windows that hold them
    common = min((prose(rnd, 5) for _ in range(300)), key=lambda t: int(passages.run_hashes(passages.word_values(t.encode())[0], 5)[0]))
    rows = [(i, f"{prose(rnd, 12)} {common} {prose(rnd, 12)}") for i in range(200)]
    rows += [(1000 + i, text) for i, (_, text) in enumerate(rows[:20])] + [(2000 + i, prose(rnd, 30)) for i in range(300)] + [(3000, rows[-1][1])]
    docs, kept = spark.createDataFrame(rows, "doc_id long, text string").repartition(4), {}
    write = passages.materialize
    monkeypatch.setattr(passages, "materialize", lambda df, tag: kept.setdefault(tag, write(df, tag)))
    plain = {tuple(r) for r in phrase_dedup.remove_repeats(docs, wide=10**6).collect()}
    assert "anchor-windows" not in kept and sum(r[2] > 0 for r in plain) == 21
    kept.clear()
    assert {tuple(r) for r in phrase_dedup.remove_repeats(docs, wide=10).collect()} == plain
    assert kept["anchor-windows"].count() > 0 and kept["wide-texts"].count() <= 200
    kept.clear()
    monkeypatch.setattr(passages, "MOST_TEXTS", 0)
    assert {tuple(r) for r in phrase_dedup.remove_repeats(docs, wide=10).collect()} == plain
