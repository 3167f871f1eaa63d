"""The Merkle manifest, byte-level BPE and centroid clustering against brute force, and against their SQL."""

import base64
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallywright.llm import bpe, centroids, merkle, queries

DOCS = "doc_id long, source string, lang string, n_chars long, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


# --- manifest


def leaf_of(fields):
    return sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels_of(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([sha(*found[-1][i : i + 3]) for i in range(0, len(found[-1]), 3)])
    return found


def siblings(levels, i):
    for nodes in levels[:-1]:
        first = i // 3 * 3
        yield nodes[first:i], nodes[i + 1 : first + 3]
        i //= 3


def expected_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        members = sorted(groups[g], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[g] = levels_of([leaf_of(r) for r in members]), members
    top = levels_of([trees[g][0][-1][0] for g in order])
    out = []
    for k, g in enumerate(order):
        levels, members = trees[g]
        for i, r in enumerate(members):
            path = [*siblings(levels, i), *siblings(top, k)]
            text = r[4]
            if r[0] is not None and text is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf_of((*r[:4], text))
            for left, right in path:
                node = sha(*left, node, *right)
            proof = sha(*(x for left, right in path for x in left + right))
            out.append((r[0], levels[0][i], levels[-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=repr)


def manifest_rows(docs):
    found = merkle.manifest(docs).select("doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof"), "folded_root", (F.col("folded_root") == F.col("root")).alias("ok"))
    return sorted(map(tuple, found.collect()), key=repr)


MANIFESTS = {
    "none": [],
    "one": [(1, None, None, None, None)],
    "hot source, ties, repeats": [(i, None if i % 7 == 0 else "é" if i % 7 == 1 else "z", "en", 3, f"a\nb{i}" * (i % 3)) for i in range(1700)] + [(None, "z", None, None, "")] * 3 + [(5, "z", None, 1, t) for t in ("b", "a", "a")],
    "many sources": [(i, chr(97 + i % 26) + str(i), None, 1, "x\n") for i in range(800)],
    "long": [(2, "a", "en", None, "lang\n" * 200000), (4, "", "en", 0, "\n"), (6, "", "", 0, "")],
}


@pytest.mark.parametrize("name", MANIFESTS)
def test_manifest(spark, name):
    docs = spark.createDataFrame(MANIFESTS[name], DOCS).repartition(3).withColumns({c: F.lit(1) for c in ("path", "grp", "at", "size", "node", "leaf")})
    assert manifest_rows(docs) == expected_manifest(MANIFESTS[name])


def test_numbers_of_a_group_over_many_ranges(spark):
    rows = merkle.numbered(spark.range(5000).select((F.col("id") % 2).alias("grp"), F.col("id").alias("x")).repartition(7), "grp", ["x"])
    assert rows.filter((F.col("at") != F.floor(F.col("x") / 2)) | (F.col("size") != 2500)).count() == 0
    assert rows.count() == 5000


# --- byte-level BPE

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def tokenizer(vocabulary):
    ranks = bpe.codec(vocabulary.lines, vocabulary.pattern).ranks
    return tiktoken.Encoding("own", pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", "a", " ", "\n\n", " " * 300, "é" * 500, "a" * 5000, "abcdefghij" * 60, "x" * 256, "x" * 257, "日本" * 300, "<|endoftext|> hi", "it's  \x85 a b\x1c", "🙂🙃 1234567"]


def test_tokens_equal_the_library(spark, vocabulary, tokenizer):
    rnd = random.Random(3)
    letters = "ab cdé\n\t  'sZ09.,!日本語ǅ​　🙂<|"
    texts = [*TEXTS, *("".join(rnd.choice(letters) for _ in range(rnd.randint(1, 300))) for _ in range(300))]
    texts += ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(1, 600))) for _ in range(200)]
    texts += [" ".join("".join(rnd.choice("aeioustrn") for _ in range(rnd.randint(1, 9))) for _ in range(700_000))]  # cut at piece ends
    rows = [(i, t, 1, 1) for i, t in enumerate(texts)] + [(7, TEXTS[7], 1, 1), (None, None, 1, 1), (3, None, 1, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id int, ids int").repartition(3)
    done = bpe.decode(bpe.encode(docs, vocabulary), vocabulary).collect()
    show = lambda i, ids, text: (i is None, i or 0, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text).hexdigest())
    got = sorted(show(r["id"], np.frombuffer(r["ids"], "<u4").tolist(), bytes(r["decoded"])) for r in done)
    assert got == sorted(show(r[0], tokenizer.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows)
    assert all(r["n_tokens"] * 4 == len(r["ids"]) for r in done)
    assert bpe.decode(bpe.encode(docs.limit(0), vocabulary), vocabulary).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=400))
def test_tokens_of_any_text(vocabulary, tokenizer, text):
    made = bpe.codec(vocabulary.lines, vocabulary.pattern)
    [ids] = made.encode([text.encode("utf-8", "replace").decode()])
    assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode_ordinary(text.encode("utf-8", "replace").decode())


def test_long_pieces_equal_short_ones(vocabulary):
    made = bpe.codec(vocabulary.lines, vocabulary.pattern)
    rnd = random.Random(9)
    pieces = [bytes(rnd.choice(b"aeinrst \xc3\xa9") for _ in range(rnd.randint(2, 256))) for _ in range(300)]
    assert made.merged(pieces, 256) == [made.merged_long(p) for p in pieces]


def test_rank_order_decides_not_the_order_of_merges():
    """abc comes by a + bc only where ab does not merge first; a piece that is a token is that token, even if no merges give it."""
    tokens = [bytes([b]) for b in range(256)] + [b"bc", b"ab", b"abc", b"zqz"]
    lines = b"\n".join(base64.b64encode(t) + b" %d" % i for i, t in enumerate(tokens))
    made = bpe.Codec(lines, r"\S+|\s+")
    ids = lambda t: np.frombuffer(next(made.encode([t])), "<u4").tolist()
    assert ids("abc") == [258] and ids("xabcab") == [120, 258, 257] and ids("zqz") == [259] and ids("zqzq") == [122, 113, 122, 113]


def test_decode_refuses_unknown_ids(vocabulary):
    with pytest.raises(ValueError, match="not in the vocabulary"):
        bpe.codec(vocabulary.lines, vocabulary.pattern).decode(np.array([50256], "<u4").tobytes())
    with pytest.raises(ValueError, match="no token"):
        bpe.Codec(b"YQ== 0", ".")


# --- clustering


def expected_clusters(rows, k=8, rounds=10):
    kept = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((i is None, hashlib.sha256(f"3:{i}".encode()).hexdigest() if i is not None else "", q) for i, q in kept)
    cents = [q for _, _, q in named[:k]]
    away = lambda q: min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(cents))
    for _ in range(rounds):
        members = [[] for _ in cents]
        for _, q in kept:
            members[away(q)[1]].append(q)
        cents = [[sum(col) // len(m) for col in zip(*m)] if m else c for m, c in zip(members, cents)]
    found = [(i, *away(q)[::-1]) for i, q in kept]
    each = {c: sum(d for _, j, d in found if j == c) for c in range(len(cents))}
    return sorted(((i, c, d, each[c], sum(each.values()), sha(",".join(map(str, cents[c])))) for i, c, d in found), key=repr)


def cluster_rows(vectors):
    return sorted(map(tuple, centroids.with_inertia(*centroids.cluster(vectors)).select("id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()), key=repr)


def vectors_of(name):
    rnd = np.random.default_rng(4)
    spread = lambda n, scale: rnd.normal(size=(n, 64)).astype(np.float32) * scale
    if name == "groups":  # far groups: whole balls; copies of one vector; odd rows
        centers = spread(5, 20)
        rows = [(i, (centers[i % 5] + v).tolist()) for i, v in enumerate(spread(900, 0.5))]
        rows += [(10_000 + i, rows[3][1]) for i in range(300)] + [rows[0], (None, rows[1][1])]
        rows += [(5000, None), (5001, []), (5002, [0.0] * 63), (5003, [0.0] * 63 + [None]), (5004, [0.0] * 63 + [float("nan")]), (5005, [0.0] * 63 + [float("-inf")]), (5006, [0.0] * 65)]
        return rows
    if name == "ties":
        return [(i, [float(i % 3)] + [0.0] * 63) for i in range(200)]
    if name == "few":
        return [(i, v.tolist()) for i, v in enumerate(spread(3, 1))]
    if name == "wide":
        return [(i, v.tolist()) for i, v in enumerate(spread(150, 20000))]
    return {"none": [], "no usable": [(1, [1.0])], "one": [(1, [-0.5] * 64)]}[name]


@pytest.mark.parametrize("name", ["groups", "ties", "few", "wide", "none", "no usable", "one"])
def test_clusters(spark, name):
    rows = vectors_of(name)
    table = spark.createDataFrame([(*r, 1, 1) for r in rows], "vec_id long, embedding array<float>, cluster int, ids int").repartition(3)
    assert cluster_rows(table) == expected_clusters(rows)


def test_balls_are_given_whole_and_labels_are_exact():
    rnd = np.random.default_rng(1)
    means = rnd.integers(-5000, 5000, (6, 64))
    vectors = np.concatenate([means[i % 6] + rnd.integers(-40, 40, (37, 64)) for i in range(60)])
    tree, order = centroids.Tree.grown(vectors)
    assert sorted(order.tolist()) == list(range(len(vectors))) and (tree.vectors == vectors[order]).all()
    tree = centroids.Tree.unpacked(*tree.packed(), 64)
    labels, counts, sums, whole = tree.assigned(means)
    want = ((tree.vectors[:, None, :].astype(np.int64) - means) ** 2).sum(axis=2).argmin(axis=1)
    assert (labels == want).all() and whole > 5
    assert counts.tolist() == np.bincount(want, minlength=6).tolist()
    assert all((sums[c] == tree.vectors[want == c].sum(axis=0)).all() for c in range(6))


def test_too_wide_components_are_an_error(spark):
    with pytest.raises(Exception, match="would not fit a long"):
        centroids.cluster(spark.createDataFrame([(1, [1e6] * 64)], "vec_id long, embedding array<float>"))


# --- SQL


@pytest.mark.parametrize("name", ["op11_merkle_manifest", "op13_centroids"])
def test_queries_equal_their_sql(spark, name):
    sf = "/root/testdata/sf0.001"
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    want = duck.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = queries.queries()[name](spark, sf)
    assert sorted(columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*columns).collect()), key=repr) == sorted(want.fetchall(), key=repr)
