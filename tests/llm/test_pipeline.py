"""The corpus pipeline on a small table, stage by stage against brute force."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallywright.llm import queries, simhash_dedup

from .test_operators import base_spans, near_texts, split


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rnd = random.Random(11)
    words = {"en": ["the", "thing", "with", "that", "ing", "tion", "over", "under"], "fr": ["le", "eau", "que", "oui", "aux", "été", "dans", "pour"]}
    prose = lambda lang, n: " ".join(rnd.choice(words[lang]) + rnd.choice(words[lang]) for _ in range(n))
    item = prose("en", 30)
    rows = []
    for i in range(80):
        lang = ("en", "fr")[i % 2]
        rows.append((i, prose(lang, rnd.randint(20, 200)), lang, f"s{i % 3}"))
    rows += [(100, rows[5][1], "en", "s0"), (101, rows[6][1], None, None), (102, None, "en", "s1"), (103, "12 34 !!", "fr", "s1"), (104, "", None, None)]
    rows += [(105, prose("en", 40) + " " + item + " " + prose("en", 40), "en", "s2"), (106, prose("fr", 60) + " password: hunter2hunter2 " + prose("fr", 20), "fr", "s2"), (107, prose("en", 30000), "en", "s1")]
    rows += [rows[7], (None, prose("en", 50), "en", "s0")]
    path = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_dedup", "decontaminate", "secrets", "mix"]
    kept = []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if i < 4:
            assert out.columns == docs.columns
        before, after = docs.collect(), out.collect()
        if name == "language":
            assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {102, 103, 104}
        elif name == "near_dedup":
            first = {}
            for r, k in zip(before, near_texts([r["text"] for r in before])):
                key = (r["doc_id"] is None, r["doc_id"] or 0)
                first[k] = min(first.get(k, key), key)
            assert Counter((r["doc_id"] is None, r["doc_id"] or 0) for r in after) == Counter(first.values())
            assert 100 not in {r["doc_id"] for r in after} and 101 not in {r["doc_id"] for r in after}
        elif name == "decontaminate":
            assert {r["doc_id"] for r in before} - {r["doc_id"] for r in after} == {105}
        elif name == "secrets":
            assert len(before) == len(after) and all(not base_spans(r["text"]) and r["n_chars"] == len(r["text"]) for r in after)
            old = {r["doc_id"]: r["text"] for r in before}
            assert [r["doc_id"] for r in after if r["text"] != old[r["doc_id"]]] == [106]
        else:
            size, taken = Counter(), Counter()
            for r in before:
                size[r["source"]] += len(split(r["text"]))
            for r in after:
                assert 1 <= r["copies"] <= 2
                taken[r["source"]] += r["copies"] * len(split(r["text"]))
            assert all(taken[s] <= 2 * size[s] for s in taken)
            assert abs(sum(taken.values()) - 1.5 * sum(size.values())) < 3 * 30000
        docs = out
        kept.append(len(after))
    assert corpus_pipeline.run(spark, sf_dir).count() == kept[-1]


def test_empty_tables(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{sf_dir}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_numbered_query_is_registered():
    names = list(queries.queries())
    assert [n.split("_")[0] for n in names] == [f"op{i}" for i in range(1, 14)] + ["pipeline"]
    assert set(queries.oracle_sql()) <= set(names)


HELPERS = "_id _th _kept _judged _asked _asked_id _spans_hex _clean _lang_pred _score _margin _rejected plan_source plan_passes plan_threshold source_size target id th fp root k hs h hash size place column0_ bad_id bad_th kept_id kept_th".split()


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_with_clashing_columns(spark, sf_dir, name, stage):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    more = docs.withColumns({h: F.col("n_chars") for h in HELPERS}).withColumn("copies", F.lit(7))
    want, got = stage(spark, docs, sf_dir), stage(spark, more, sf_dir)
    assert set(got.columns) == {*more.columns}
    assert all(r[h] == (r["n_chars"] if name != "secrets" else r[h]) for r in got.collect() for h in HELPERS)
    assert Counter(map(tuple, got.select(*want.columns).collect())) == Counter(map(tuple, want.collect()))


def test_one_row_of_those_that_repeat_id_and_text(spark):
    rows = [(1, "one text of some words", "en", s, 22) for s in ("b", "a", None, "c")] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = [[tuple(r) for r in simhash_dedup.keep_one(docs.repartition(n)).collect()] for n in (1, 5)]
    assert kept[0] == kept[1] and len(kept[0]) == 1
