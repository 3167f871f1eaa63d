"""Each operator against brute force on a small table with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import pytest
import xxhash

from tallywright.llm import chat, decontaminate, doubling, fingerprints, html_text, language, mixing, phrase_dedup, secrets, simhash_dedup, suffix_dedup

WORDS = [a + b for a in ("ba", "ce", "di", "fo", "gu", "ha", "je", "ki") for b in ("lt", "mn", "pr", "qs", "tv", "wx", "yz", "rs")]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, hash string, h long, fp long, rank int, th long, id long, target string"


def corpus() -> list[tuple]:
    rnd = random.Random(5)
    prose = lambda n: " ".join(rnd.choice(WORDS) for _ in range(n))
    shared, base = prose(40), prose(120)
    near = base.split()
    near[60] = "changed"
    texts = [None, "", "  \t\n ", "one", "one", base, base, " ".join(near), prose(30) + " " + shared + "\n" + prose(20), prose(15) + "\t" + shared, shared, prose(3000)]
    texts += ["Of " * 400, shared + " " + shared, prose(200), "password = 'hunter2hunter2' x AKIA" + "Q" * 18 + " " + "ab12" * 8, "ünïcødé " * 30 + shared, prose(13), "token: abc token: abcdefgh"]
    rows = [(i * 3, t, "en" if i % 2 else "de", ["b", None, "a", "é"][i % 4], len(t or ""), 7, "x", 1, 2, 3, 4, 5, "y") for i, t in enumerate(texts)]
    return [*rows, rows[8], (None, base, None, None, None, None, None, None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


#: All anchors judged together; by windows from the start; by windows where contexts differ; without prefilters.
LIMITS = [{}, {"hot": 0}, {"wide": 1}, {"filtered": 0}, {"wide": 2, "filtered": 0}]


def expected_phrases(rows):
    first = {}
    order = lambda r: (1 << 62) if r[0] is None else r[0]
    for r in rows:
        w = split(r[1])
        for i in range(len(w) - 12):
            k = tuple(w[i : i + 13])
            first[k] = min(first.get(k, order(r)), order(r))
    out = []
    for r in rows:
        w = split(r[1])
        gone = [False] * len(w)
        for i in range(len(w) - 12):
            if first[tuple(w[i : i + 13])] < order(r):
                gone[i : i + 13] = [True] * 13
        out.append((r[0], len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("limits", LIMITS)
def test_repeated_phrases(docs, none, limits):
    got = Counter((r["id"], r["n_words"], r["n_removed"], bytes(r["kept"]).decode()) for r in phrase_dedup.remove_repeats(docs, **limits).collect())
    assert got == expected_phrases(corpus())
    assert phrase_dedup.remove_repeats(none).count() == 0


def expected_strings(rows):
    seen = Counter()
    raw = [(r[1] or "").encode() for r in rows]
    for b in raw:
        seen.update(b[i : i + 200] for i in range(len(b) - 199))
    out = []
    for r, b in zip(rows, raw):
        gone = [False] * len(b)
        for i in range(len(b) - 199):
            if seen[b[i : i + 200]] > 1:
                gone[i : i + 200] = [True] * 200
        spans = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out.append((r[0], len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return Counter(out)


@pytest.mark.parametrize("limits", LIMITS)
def test_repeated_strings(docs, none, limits):
    got = Counter((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in suffix_dedup.remove_repeats(docs, **limits).collect())
    assert got == expected_strings(corpus())
    assert suffix_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("first, piece", [(64, 1 << 20), (64, 100), (8, 1 << 20), (200, 1 << 20)])
def test_repeated_strings_by_prefix_doubling(spark, docs, none, first, piece, monkeypatch):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")  # pairs that go on over batches
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # and over ranges
    try:
        prefix_doubling(docs, none, first, piece, monkeypatch)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def prefix_doubling(docs, none, first, piece, monkeypatch):
    monkeypatch.setattr(doubling, "PIECE", piece)
    got = Counter((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in doubling.remove_repeats(docs, first=first).collect())
    assert got == expected_strings(corpus())
    assert doubling.remove_repeats(none).count() == 0


def expected_fingerprint(text):
    w = split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or ([" ".join(w)] if w else [])
    counts = [0] * 64
    for x in shingles:
        h = xxhash.xxh64_intdigest(x.encode(), 42)
        for b in range(64):
            counts[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * counts[b] > len(shingles))


def test_near_classes(docs, none):
    rows = corpus()
    fps = [expected_fingerprint(r[1]) for r in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    least = {k: min((r[0] for r, x in zip(rows, root) if x == k and r[0] is not None), default=None) for k in root}
    want = Counter((r[0], f, least[k]) for r, f, k in zip(rows, fps, root))
    got = Counter((r["id"], r["fp"] & (2**64 - 1), r["component_id"]) for r in simhash_dedup.near_classes(docs).collect())
    assert got == want
    assert simhash_dedup.near_classes(none).count() == 0
    kept = simhash_dedup.keep_one(docs, radius=4, shingle=4, count=1, least=None)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(least.values()))
    assert simhash_dedup.keep_one(none).count() == 0


def expected_fingerprints(text, shingle=5, count=5):
    """As the first one, but of hashes that are scrambled after a step for each."""
    mask = (1 << 64) - 1

    def scrambled(x):
        for m in (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53):
            x = (x ^ (x >> 33)) * m & mask
        return x ^ (x >> 33)

    w = split("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(w[i : i + shingle]) for i in range(len(w) - shingle + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(x.encode(), 42) for x in shingles]
    found = []
    for k in range(count):
        mixed = [scrambled((h + k * 0x9E3779B97F4A7C15) & mask) for h in hashes] if k else hashes
        found.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in mixed) > len(shingles)))
    return found


def near_texts(texts):
    """Class of each text by brute force: a fingerprint of both within 8 bits, all five within 59, and within 32 or shingles alike."""
    fps = [expected_fingerprints(t) for t in texts]
    sets = [simhash_dedup.shingles(t, 5) for t in texts]
    assert simhash_dedup.bit_bounds(0.8, 5) == (59, 32)
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            apart = [(a ^ b).bit_count() for a, b in zip(fps[i], fps[j])]
            if min(apart) <= 8 and sum(apart) <= 59 and (sum(apart) <= 32 or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) > 0):
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    return root


def test_keep_one_of_near_texts(spark):
    rnd = random.Random(8)
    texts = [None, "", "one", "one", "two words"]
    for n in (30, 120, 400):
        for share in (0.0, 0.01, 0.02, 0.05):
            base = [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n)]
            for _ in range(4):
                texts.append(" ".join("edited" + str(rnd.random()) if rnd.random() < share else x for x in base))
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    root = near_texts(texts)
    first = {r: min(i for i, x in enumerate(root) if x == r) for r in root}
    assert sorted(r["doc_id"] for r in simhash_dedup.keep_one(docs).collect()) == sorted(first.values())
    assert len(first) <= len(texts) - 1 - 3 * 3  # the unedited copies at least


def test_recall_and_precision_by_similarity(spark):
    """Pairs of texts in bands of similarity: at least nine of ten found from 0.8 on, nothing far below."""
    rnd = random.Random(18)
    rows, bands = [], {}
    for pair in range(900):
        n = rnd.choice([80, 200, 500])
        base = [rnd.choice(WORDS) + rnd.choice(WORDS) + str(pair) for _ in range(n)]
        other = list(base)
        for _ in range(rnd.randint(0, max(1, n // 25))):
            other[rnd.randrange(n)] = "edited" + str(rnd.random())
        texts = [" ".join(base), " ".join(other)]
        one, two = (simhash_dedup.shingles(t, 5) for t in texts)
        bands.setdefault(int(20 * len(one & two) / len(one | two)), []).append(pair)
        rows += [(2 * pair + i, t) for i, t in enumerate(texts)]
    kept = {r["doc_id"] for r in simhash_dedup.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert all(2 * pair in kept for pairs in bands.values() for pair in pairs)
    found = {band / 20: sum(2 * p + 1 not in kept for p in ps) / len(ps) for band, ps in bands.items() if len(ps) >= 20}
    assert {0.8, 0.85, 0.9, 0.95} <= set(found)
    assert all(share >= 0.9 if band >= 0.8 else share <= 0.1 for band, share in found.items()), found


@pytest.mark.parametrize("block", [simhash_dedup.BLOCK, 3])
def test_no_similar_pair_is_left_apart(spark, monkeypatch, block):
    """Pairs just above and below the similarity asked for, chains of edits and a group around one frequent passage: classes are those of all pairs."""
    monkeypatch.setattr(simhash_dedup, "BLOCK", block)
    rnd, texts = random.Random(31), [None, "", "one"]
    word = lambda: rnd.choice(WORDS) + rnd.choice(WORDS) + rnd.choice(WORDS)
    for n in [12, 24, 30, 60, 120, 240] * 20:
        base = [word() for _ in range(n)]
        for _ in range(3):  # a chain
            texts.append(" ".join(base))
            for _ in range(max(1, round(n * 0.02))):
                base[rnd.randrange(n)] = "edited" + str(rnd.random())
    passage = " ".join(word() for _ in range(60))
    texts += [passage + " " + " ".join(word() for _ in range(k)) for k in (2, 4, 5, 6, 7, 8, 9, 12, 20) for _ in range(2)]
    texts += [texts[-1].upper(), texts[-2].replace(" ", "  ")]
    sets, fps = [simhash_dedup.shingles(t, 5) for t in texts], [expected_fingerprints(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            bits = [(a ^ b).bit_count() for a, b in zip(fps[i], fps[j])]
            similar = len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) > 0
            if similar or min(bits) <= 8 and sum(bits) <= 32:
                old, new = root[i], root[j]
                root = [new if x == old else x for x in root]
    assert len(set(near_texts(texts))) > len(set(root))  # fingerprints alone leave some apart
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    assert sorted(r["doc_id"] for r in simhash_dedup.keep_one(docs).collect()) == sorted({r: i for i, r in reversed([*enumerate(root)])}.values())


@pytest.mark.parametrize("large,dense", [(1 << 14, 256), (1, 256), (1 << 14, 3), (1, 1)])
def test_pairs_keep_the_classes_of_all_pairs(large, dense, monkeypatch):
    import numpy as np

    monkeypatch.setattr(simhash_dedup, "LARGE_GROUP", large)
    monkeypatch.setattr(simhash_dedup, "DENSE", dense)
    rnd = random.Random(1)
    fps = set()
    for _ in range(40):
        x = rnd.getrandbits(64)
        for _ in range(6):
            fps.add(x)
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.randrange(64)
    fps |= {0xABCDEF ^ 1 << a ^ 1 << b for a in range(24) for b in range(a)}
    fps = np.array(sorted(fps), np.uint64)
    segments = simhash_dedup.ring(4)
    pairs = set()
    for s, (at, width) in enumerate(segments):
        keys = (fps >> np.uint64(at)) & np.uint64((1 << width) - 1)
        for k in np.unique(keys):
            group = fps[keys == k]
            for a, b, _ in simhash_dedup.pairs(group, s, segments):
                pairs |= set(zip(group[a].tolist(), group[b].tolist()))

    def classes(links):
        root = {int(x): int(x) for x in fps}
        for a, b in links:
            old, new = root[a], root[b]
            root = {x: new if r == old else r for x, r in root.items()}
        return {frozenset(x for x in root if root[x] == r) for r in root.values()}

    every = {(int(a), int(b)) for a in fps for b in fps if a < b and (int(a) ^ int(b)).bit_count() <= 4}
    assert classes(pairs) == classes(every)


@pytest.mark.parametrize("dense", [3, 1])
def test_doubtful_links_join_what_sure_ones_leave_apart(dense, monkeypatch):
    """A dense group's tree of links has the classes of all its pairs, by sure links alone and by all; so has a forest of the doubtful ones."""
    import numpy as np

    rnd = random.Random(4)
    fps = set()
    for x in [rnd.getrandbits(64) for _ in range(12)]:
        for _ in range(8):
            y = x
            for _ in range(rnd.randint(0, 7)):
                y ^= 1 << rnd.randrange(8, 64)
            fps.add(y & ~0xFF)  # one value in the first segment
    fps = np.array(sorted(fps), np.uint64)
    size, most, sure = len(fps), 6, 3

    def links(limit):
        monkeypatch.setattr(simhash_dedup, "DENSE", limit)
        return [np.concatenate(x) for x in zip(*simhash_dedup.pairs(fps, 0, simhash_dedup.ring(7), fps[:, None], most, sure))]

    def classes(a, b):
        root = simhash_dedup.smallest(np.arange(size), iter([(a, b)]))
        return root, {tuple(np.flatnonzero(root == r).tolist()) for r in root}

    (a, b, bits), (x, y, all_bits) = links(dense), links(1 << 30)
    assert len(a) < len(x) and all((int(fps[i]) ^ int(fps[j])).bit_count() == d for i, j, d in zip(a, b, bits))
    for limit in (sure, most):
        assert classes(a[bits <= limit], b[bits <= limit])[1] == classes(x[all_bits <= limit], y[all_bits <= limit])[1]
    root, parts = classes(x[all_bits <= sure], y[all_bits <= sure])
    rest = all_bits > sure
    kept = simhash_dedup.spanning(root, x[rest], y[rest], all_bits[rest])
    assert len(kept) == len(parts) - len(classes(x, y)[1]) > 0
    assert classes(np.append(x[~rest], x[rest][kept]), np.append(y[~rest], y[rest][kept]))[1] == classes(x, y)[1]


def test_mix(docs, none):
    rows = corpus()
    found = mixing.mix(docs).collect()
    assert len(found) == len(rows)
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += len(split(r[1]))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left = dict.fromkeys(order, 0.0), 1.5 * sum(sizes.values())
    free = set(order)
    while free:
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        full = {s for s in free if share[s] >= 2 * sizes[s]}
        if not full:
            target |= share
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        free -= full
    source = {r[0]: r[3] for r in rows}
    taken = Counter()
    for r in found:
        assert r["target"] == pytest.approx(target[source[r["doc_id"]]])
        assert r["source_size"] == sizes[source[r["doc_id"]]] and r["taken"] <= 2 * r["size"]
        taken[source[r["doc_id"]]] += r["taken"]
    largest = max(len(split(r[1])) for r in rows)
    for s in order:
        assert abs(taken[s] - target[s]) <= largest
    assert Counter(found) == Counter(mixing.mix(docs.repartition(5)).collect())
    assert mixing.mix(none).count() == 0 and mixing.mixed_rows(none).count() == 0
    copies = Counter()
    for r in mixing.mixed_rows(docs).collect():
        copies[r["source"]] += r["copies"] * len(split(r["text"]))
    assert {s: n for s, n in copies.items() if n} == {s: n for s, n in taken.items() if n}


def edited(rows):
    keyed = sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in rows}, key=lambda k: k[:2])
    following = {k: keyed[(i + 1) % len(keyed)][2] for i, k in enumerate(keyed)}
    out = {}
    for k in keyed:
        n = len(k[2])
        out[k] = k[2][: n - n // 4] + following[k][: n // 4]
    return out


def prints_of(rows):
    """Brute force: text -> SimHash of its three-word terms (fewer at the end), by Spark's chained XXH64 with seed 42."""

    def hashed(term):
        h = 42
        for w in term:
            h = xxhash.xxh64_intdigest(w.encode(), h)
        return h

    found = {}
    for text in {r[1] or "" for r in rows} | set(edited(rows).values()):
        w = split(text.lower())
        hs = [hashed(w[i : i + 3]) for i in range(len(w))]
        found[text] = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hs) > len(hs))
    return found


def test_fingerprints(docs, none):
    rows, texts = corpus(), edited(corpus())
    found = fingerprints.edited_prints(docs).collect()
    want = Counter((r[0], len(r[1] or ""), hashlib.sha256(texts[r[0] is not None, r[0] or 0, r[1] or ""].encode()).hexdigest()) for r in rows)
    assert Counter((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found) == want
    by_text = {}
    for r in found:
        text = next(x[1] or "" for x in rows if x[0] == r["doc_id"])
        assert by_text.setdefault(text, r["fp"]) == r["fp"]
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert by_text[""] == 0
    own, keyed = prints_of(rows), sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in rows}, key=lambda k: k[:2])
    like = lambda a, b: 1 - (a ^ b).bit_count() / 64
    likes = {k: (own[k[2]], like(own[k[2]], own[texts[k]]), like(own[k[2]], own[keyed[(i + 1) % len(keyed)][2]])) for i, k in enumerate(keyed)}
    want = Counter((r[0], *likes[r[0] is not None, r[0] or 0, r[1] or ""]) for r in rows)
    assert Counter((r["doc_id"], r["fp"] & (2**64 - 1), r["near_edited"], r["near_next"]) for r in found) == want
    docs_of = Counter({(r["doc_id"], by_text[next(x[1] or "" for x in rows if x[0] == r["doc_id"])]) for r in found})
    for r in fingerprints.edited_prints(docs, every=6).collect():
        asked = r["doc_id"] is not None and r["doc_id"] % 6 == 0
        near = sum(((f ^ r["fp"]) & (2**64 - 1)).bit_count() <= 3 for _, f in docs_of)
        assert r["n_within"] == (near if asked else None)
    assert fingerprints.edited_prints(none).count() == 0


def test_simhash_votes(spark):
    text = "a b c a b c d"
    w = text.split()
    terms = [w[i : i + 3] for i in range(len(w))]
    hashes = [r["h"] for r in spark.createDataFrame([t + [None] * (3 - len(t)) for t in terms], "a string, b string, c string").selectExpr("xxhash64(a, b, c) as h").collect()]
    want = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in hashes) > len(hashes))
    got = fingerprints.simhash(spark.createDataFrame([(1, text)], "id long, text string"), ["id"]).first()["fp"]
    assert got & (2**64 - 1) == want


def test_block_tables_find_all_within_the_radius(spark):
    rnd = random.Random(3)
    fps = []
    for _ in range(60):
        x = rnd.getrandbits(64)
        fps += [x, *(x ^ sum(1 << b for b in rnd.sample(range(64), d)) for d in (1, 2, 3, 4))]
    signed = sorted({x - (1 << 64) if x >> 63 else x for x in fps})
    table = spark.createDataFrame([(x,) for x in signed], "fp long")
    want = {(a, b) for a in signed for b in signed if ((a ^ b) & (2**64 - 1)).bit_count() <= 3}
    assert {(r["query"], r["fp"]) for r in fingerprints.within(table, table).collect()} == want


def test_leaks(spark, docs, none):
    rows = corpus()
    item = " ".join(rows[8][1].split()[35:55])  # inside the shared passage
    items = spark.createDataFrame([(1, item, 9), (2, item, 9), (3, None, 9), (4, "no such words", 9), (5, " ".join(f"w{i}" for i in range(20)), 9)], "item_id long, text string, doc_id int")
    found = decontaminate.leaks(docs, items).collect()
    holders = {r[0] for r in rows if r[1] and item in " ".join(r[1].split())}
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(d, i) for d in holders for i in (1, 2)}
    assert all(r["similarity"] == 1.0 and r["n_words"] == 20 for r in found)
    kept = decontaminate.clean(docs, items)
    assert kept.columns == docs.columns and kept.count() == sum(r[0] not in holders for r in rows)
    assert decontaminate.leaks(none, items).count() == 0 and decontaminate.leaks(docs, items.limit(0)).count() == 0


def every_window(texts, items, least=0.8):
    """(doc, item): the best similarity over all windows of an item's size, and the starts that reach it."""
    shingles = lambda t: [" ".join(w[i : i + 5]) for w in [t.lower().split()] for i in range(len(w) - 4)]
    found = {}
    for d, text in texts.items():
        for i, item in items.items():
            own, want = shingles(text), shingles(item)
            for start in range(max(0, len(own) - len(want)) + 1):
                window = own[start : start + len(want)]
                both = sum((Counter(window) & Counter(want)).values())
                s = both / (len(window) + len(want) - both)
                if s >= least:
                    best = found.setdefault((d, i), (0.0, set()))
                    found[d, i] = (s, {start}) if s > best[0] else (s, best[1] | {start}) if s == best[0] else best
    return found


def test_leaks_wherever_the_parts_of_an_item_stand(spark):
    rnd = random.Random(21)
    prose = lambda n: [rnd.choice(WORDS) + rnd.choice(WORDS) for _ in range(n)]
    a, b, c, d = prose(60), prose(100), prose(60), prose(16)
    same = ["of"] * 30
    edit = [*a[:1], "new", *a[2:30], "two", "more", *a[30:58], "x", a[59]]
    bodies = [a, a[30:] + a[:30], a[50:] + a[:50], b[85:] + b[:85], c[:20] + ["edited"] + c[21:], ["edited", *c[1:59], "edited"], edit, a[2:], d, same * 4, a[:50], b + b]
    texts = {k: " ".join(x) for k, x in enumerate([prose(40) + x + prose(25) for x in bodies] + [a[30:] + a[:30], a[3:], b[:97], a[57:] + prose(5)])}
    items = {k: " ".join(x) for k, x in enumerate([a, b, c, d, same])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = decontaminate.leaks(docs, spark.createDataFrame(list(items.items()), "item_id long, text string")).collect()
    want = every_window(texts, items)
    assert {(1, 0), (2, 0), (3, 1), (12, 0)} <= set(want)  # moved parts
    assert {(r["doc_id"], r["item_id"]): r["similarity"] for r in found} == {k: s for k, (s, _) in want.items()}
    assert all(r["start"] in want[r["doc_id"], r["item_id"]][1] for r in found)


SHORT_TEXTS = [(0, "How do I x"), (1, "x how\tDO  i how do i"), (2, "how do"), (3, None), (4, ""), (5, "i how"), (6, "a b c d e f"), (7, "b c"), (7, "c b"), (None, "how do i"), (8, "c " * 5000 + "b c")]
SHORT_ITEMS = [(1, "how do I"), (2, "HOW do i"), (2, "how do i"), (3, "b c"), (4, "c"), (5, None), (6, " "), (7, "a b c d"), (8, "a b c d e"), (None, "d e f")]


def test_leaks_of_short_items(spark, none):
    docs = spark.createDataFrame(SHORT_TEXTS + SHORT_TEXTS[:2], "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(SHORT_ITEMS, "item_id long, text string")
    want = set()
    for d, text in SHORT_TEXTS:
        w = split((text or "").lower())
        for i, item in SHORT_ITEMS:
            k = split((item or "").lower())
            at = [a for a in range(len(w) - len(k) + 1) if k and w[a : a + len(k)] == k]
            want |= {(d, text, i, at[0], len(k), 1.0)} if at else set()
    hashes = {r["th"]: r["text"] for r in docs.selectExpr("xxhash64(text) as th", "text").collect()}
    found = decontaminate.leaks(docs, items).collect()
    assert len(found) == len(want)
    assert {(r["doc_id"], hashes[r["th"]], r["item_id"], r["start"], r["n_words"], r["similarity"]) for r in found} == want
    assert decontaminate.clean(docs, items.filter("item_id = 1")).count() == docs.filter("doc_id not in (0, 1)").count()
    assert decontaminate.leaks(none, items).count() == 0


def test_sql_of_leaks_holds_for_short_items(spark, tmp_path):
    import duckdb

    from tallywright.llm import queries

    rows = [r for r in SHORT_TEXTS if r[0] != 7]  # the query keeps texts of one id apart, SQL does not name them
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(SHORT_ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.op3_decontaminate(spark, str(tmp_path))
    duck = duckdb.connect()
    for name in ("documents", "benchmark"):
        duck.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    want = duck.execute(queries.OP3_SQL)
    assert Counter(map(tuple, got.select(*[c[0] for c in want.description]).collect())) == Counter(want.fetchall())


def base_spans(text):
    found = []
    for k, (kind, pattern, group, least) in enumerate(
        [
            ("assign", r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
            ("access", r"AKIA[A-Z0-9]+", 0, 20),
            ("hex", r"[0-9a-f]+", 0, 24),
        ]
    ):
        found += [(m.start(), k, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m[group]) >= least]
    return ",".join(x for *_, x in sorted(found))


def test_secrets(docs, none):
    rows = corpus()
    got = Counter((r["doc_id"], r["base_sha256"]) for r in secrets.digest(docs).collect())
    assert got == Counter((r[0], hashlib.sha256(base_spans(r[1] or "").encode()).hexdigest()) for r in rows)
    assert secrets.digest(none).count() == 0
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs).collect()}
    assert clean[45] == "[SECRET] x [SECRET] [SECRET]".replace("[SECRET] x", "[SECRET]' x") and clean[0] is None
    assert secrets.redact(docs).columns == docs.columns


def test_trigram_queries_are_mandatory():
    rnd = random.Random(2)
    for rule in (*secrets.BASE_RULES, *secrets.ADDED_RULES):
        query = secrets.trigram_query(rule.regex)
        for text in ("PassWord='abcdefg'", "api_key: xyzxyz1", "apikey=abcdef", "AKIA" + "A" * 20, "ghp_" + "a" * 40, "xoxb-1234567890ab", "-----BEGIN RSA PRIVATE KEY-----"):
            if re.search(rule.regex, text) and query:
                assert any(all(t in text.lower() for t in clause) for clause in query)
    assert secrets.trigram_query("[0-9a-f]+") == [] and rnd


def test_language(spark, none):
    rnd = random.Random(4)
    words = {"en": ["the", "thing", "with", "that", "ing", "tion"], "fr": ["le", "eau", "que", "oui", "aux", "été"]}
    rows = [(i, " ".join(rnd.choice(words[lang]) for _ in range(rnd.randint(5, 60))).title(), lang) for i in range(120) for lang in [("en", "fr")[i % 2]]]
    rows += [(500, None, "en"), (501, "12 34", "fr"), (502, "", None), (None, "the thing with that", None), (503, "the thing with that " * 20000, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumnRenamed("doc_id", "doc_id")
    found = {r["doc_id"]: r for r in language.identify(docs).collect()}
    assert len(found) == len(rows)
    for i, text, lang in rows:
        r = found[i]
        assert 0 <= r["_score"] <= 1
        if text is None or not any(c.isalpha() for c in text):
            assert r["_lang_pred"] == "und" and r["_rejected"] and r["_score"] == 0
        elif lang and zlib.crc32(str(i).encode()) % 4 == 2:
            assert r["_lang_pred"] == lang and not r["_rejected"]
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id in (500, 501, 502)").count() == 0
    assert language.identify(none).count() == 0
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["_lang_pred"] for r in language.identify(unlabelled).collect()} == {"und"}


def test_language_sample_is_bounded_where_ids_repeat(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 4)
    rows = [(None, f"{WORDS[i % 64]} {WORDS[i // 64]}", "en") for i in range(300)]
    docs = spark.createDataFrame(rows + rows[:50] * 3 + [(1, "one text", "fr")] * 20, "doc_id long, text string, lang string")
    content = language.sample(docs, "doc_id", "text", "lang")
    assert {lang: data.count(b"\n") for lang, data in content.items()} == {"en": 4, "fr": 1}


def test_chat_round_trip(spark):
    said = r"\### Assistant: </turn> ok"
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "a <b> \\ #"), (2, 0, "user", "hi"), (2, 1, "assistant", "other"), (2, 2, "user", None), (3, 0, "user", said), (3, 1, "assistant", said)]
    rows += [(4, 1, "assistant", "z"), (4, 0, None, "first\n\n"), (5, 0, "user", "hi"), (6, 0, "user", "hi"), (None, 0, "assistant", ""), (7, 0, "a\nb", "x"), (7, 0, "a\nb", "x")]
    rows += [(8, i, "user" if i % 2 == 0 else "assistant", "long " * 3000) for i in range(3)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, start int")
    nodes, leaves = chat.format_chats(table)
    got = {r["conv_id"]: r for r in chat.digest(nodes, leaves).collect()}
    for c in {r[0] for r in rows}:
        turns = sorted([(t, role or "", text or "") for i, t, role, text in rows if i == c])
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        learned = "".join(x for _, r, x in turns if r == "assistant")
        assert (got[c]["n_turns"], got[c]["turns_sha256"], got[c]["loss_chars"]) == (len(turns), digest, len(learned))
        assert got[c]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
    trees = nodes.collect()
    assert sum(r["depth"] == 0 and "hi" in r["segment"] for r in trees) == 1  # shared once
    for name in {r["tree"] for r in trees}:
        own = sorted((r for r in trees if r["tree"] == name), key=lambda r: r["start"])
        at = 0
        for r in own:
            assert r["start"] == at and r["intervals"][-1]["end"] == at + r["size"]
            assert r["position"] + r["size"] == sum(s["end"] - s["start"] for s in r["intervals"])
            seen, up = [], r
            while up:
                seen.append((up["start"], up["start"] + up["size"]))
                up = next((x for x in trees if x["node"] == up["parent"]), None)
            assert {t for s in r["intervals"] for t in range(s["start"], s["end"])} == {t for a, b in seen for t in range(a, b)}
            at += r["size"]
    empty = table.limit(0)
    assert chat.digest(*chat.format_chats(empty)).count() == 0


@pytest.mark.parametrize("ranges", [1, 3, 40])
def test_chat_trees_over_many_ranges(spark, ranges):
    rnd = random.Random(17)
    rows = []
    for c in range(120):
        for t in range(rnd.randint(1, 7)):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", "x" * (1 + (c % 3 if t > 3 else rnd.randint(0, 1)) + t)))
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        nodes, paths = chat.format_chats(table)
        trees, got = nodes.collect(), {r["conv_id"]: r for r in chat.digest(nodes, paths).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    texts = {c: [x for i, _, _, x in rows if i == c] for c in range(120)}
    assert len(trees) == len({tuple(x[: k + 1]) for x in texts.values() for k in range(len(x))})  # each shared start once
    by_node = {r["node"]: r for r in trees}
    for name in {r["tree"] for r in trees}:
        own = sorted((r for r in trees if r["tree"] == name), key=lambda r: r["start"])
        assert [r["start"] for r in own] == [sum(x["size"] for x in own[:k]) for k in range(len(own))]
        for r in own:
            seen, up = [], r
            while up:
                seen.append((up["start"], up["start"] + up["size"]))
                up = by_node.get(up["parent"])
            assert {t for s in r["intervals"] for t in range(s["start"], s["end"])} == {t for a, b in seen for t in range(a, b)}
            assert all(a["end"] < b["start"] for a, b in zip(r["intervals"], r["intervals"][1:])) and r["position"] == sum(b - a for a, b in seen[1:])
    for c, said in texts.items():
        learned = "".join(x for k, x in enumerate(said) if k % 2)
        assert got[c]["n_turns"] == len(said) and got[c]["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body class="has-sidebar"><nav><ul><li><a href=x>menu</a></ul></nav>
<div class="content-%d"><h1>Head &amp; line</h1><p>First paragraph of the article,<br>with <b>bold</b> text that is long enough.<p>Second&nbsp;one &lt;i&gt; follows here with some more words in it.
<form>search</form><script>var a = "</p>";</script></div><div class="comments"><p>A reader's comment which is also rather long, longer than some of the paragraphs of the article.</p></div>
<aside>aside</aside><footer>foot</footer></body></html>"""
TEXT = "Head & line First paragraph of the article, with bold text that is long enough. Second one <i> follows here with some more words in it."


def test_main_text(spark):
    rows = [(i, f"http://a.example/{i}", PAGE % i, 1) for i in range(6)]
    rows += [(10, "http://a.example/none", None, 1), (11, None, "", 1), (12, "http://a.example/plain", "<p>Only a paragraph, without any container at all", 1), (13, "//A.example/x", "no markup", 1), (13, "//A.example/x", "no markup", 1)]
    rows += [(14, "http://b.example/", "<div>" * 500 + "<p>deep text" + "<!-- open", 1), (15, "http://c.example", "<article>" + "<p>very long text of a page. " * 20000, 1)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, host int")
    got = html_text.main_text(pages).collect()
    assert len(got) == len(rows)
    texts = {r["page_id"]: r["text"] for r in got}
    assert [texts[i] for i in range(6)] == [TEXT] * 6
    assert texts[10] == "" and texts[11] == "" and texts[12] == "Only a paragraph, without any container at all" and texts[13] == "no markup" and texts[14] == "deep text"
    assert len(texts[15]) == 20000 * 26 - 1
    assert html_text.main_text(pages.limit(0)).count() == 0


def test_main_text_of_wrapped_pages():
    start = "The first part of the article has enough words to be read as prose, and some more of them."
    rest = "The other part goes on with the story for a while, so that neither of the two is short."
    body = f"<div class=entry><h1>Title of it</h1><p>{start}<p>{rest}</div>"
    text = f"Title of it {start} {rest}"
    side = "<div class=sidebar><p>Some words of a side bar that are not the article.</div>"
    comments = f"<div class=comments><p>{start}</div>"
    read = lambda page: html_text.extract(html_text.parse(page), None)
    assert read(f"<!DOCTYPE html><title>t</title><head><meta charset=utf-8><title>t</title><style>p{{}}</style><body>{body}{side}") == text
    assert read(f"<html><head><meta charset=utf-8><title>t</title><link rel=x>{body}") == text
    assert read(f"<html><body><form id=aspnetForm action=x><input name=v>{body}{side}</form></body></html>") == text
    for name in ("content-sidebar-wrap", "content-with-sidebar"):
        assert read(f"<body><div class='{name}'>{body}{side}</div></body>") == text
    assert read(f"<body><div class=sidebar-layout><p>{start}<p>{rest}</div></body>") == f"{start} {rest}"
    assert read(f"<body>{body}{comments}{side}<form>search for words</form></body>") == text
    assert read(f"<body><div class=post><div class=intro><p>{start} {start}</div><div class=more><p>{rest}</div></div></body>") == f"{start} {start} {rest}"


def test_words_of_sentences_stay_and_clutter_goes():
    start = "The first part of the article has enough words to be read as prose, and some more of them."
    rest = "The other part goes on with the story for a while, so that neither of the two is short."
    read = lambda page: html_text.extract(html_text.parse(page), None)
    for element in ("span class='social'", "em class='alert'", "abbr class='ad'", "a class='related'", "b id=share", "mark class='notice'", "time class='menu'", "code class=widget"):
        tag = element.split()[0]
        assert read(f"<article><h1>T</h1><p>{start} He <{element}>met</{tag}> her.<p>{rest}</article>") == f"T {start} He met her. {rest}"
    for element in ("p class='search-party'", "h2 class='notice-of-death'", "li class='alert'", "td class=search", "section class='comment-on-policy'", "blockquote class='comment'", "dd id=menu", "div class='sharing-the-load'"):
        tag = element.split()[0]
        assert read(f"<article><h1>T</h1><p>{start}</p><{element}>some words of it</{tag}><p>{rest}</p></article>") == f"T {start} some words of it {rest}"
    ours = "post-comments entry-comments page-footer page-sidebar post-navigation post-share post-related entry-footer tag-cloud category-menu reader-responses disclaimer".split()
    for name in [*ours, *"comments comment-list sidebar widget-area cookie-banner related-posts newsletter-signup social-share share-buttons ad-slot nav-bar page-nav tag-widget".split()]:
        for tag in ("div", "section", "ul"):
            inner = f"<p>{start}</p>" if tag != "ul" else f"<li>{start}</li>"
            assert read(f"<article><h1>T</h1><p>{start}<p>{rest} {rest}</p><{tag} class='{name}'>{inner}</{tag}></article>") == f"T {start} {rest} {rest}", (tag, name)
    assert read(f"<article><h1>T</h1><p>{start}<p class=ad>Buy it now<p>{rest}</article>") == f"T {start} {rest}"
    assert read(f"<article><h1>T</h1><p>{start}<p>{rest} {rest}</article><section class=discussion><p>{start}</section>") == f"T {start} {rest} {rest}"
    assert read(f"<article><h1>T</h1><p>{start}<section id=discussion><p>{rest}</section></article>") == f"T {start} {rest}"


def test_main_text_of_broken_markup():
    start = "The first part of the article has enough words to be read as prose, and some more of them."
    rest = "The other part goes on with the story for a while, so that neither of the two is short."
    body, text = f"<h1>Title of it</h1><p>{start}<p>{rest}", f"Title of it {start} {rest}"
    read = lambda page: html_text.extract(html_text.parse(page), None)
    assert read(f"<body><title-bar>x</title-bar><article>{body}</article></body>").endswith(text)
    assert read(f"<body><article><h1>Title of it</h1><template-card></template-card><p>{start}<p>{rest}</article>") == text
    for name in ("market-share-report", "post tag-search", "category-social hentry"):
        assert read(f"<body><article class='{name}'>{body}</article><div class=comments><p>{start} {rest} {start}</div></body>") == text
    assert read(f"<body><div class=social-history>{body}</div><p>short</body>") == text
    assert read(f"<body><article><h1>Title of it</h1><p title=\"it>{start}</p><p data-x=it's>{rest}</p></article><a href=\"x\">y</a>") == text
    assert read(f"<body><article><h1 title='a > b'>Title of it</h1><p title=\"x='y'\">{start}<p class=a/>{rest}</article>") == text
    assert read(f"<body><main><header><a href=x>Site</a> slogan of the site</header><article>{body}</article></main>") == text
    assert read(f"<body><main><header><h1>Title of it</h1></header><p>{start}<p>{rest}</main>") == text
    assert read(f"<body><div>{body}<section><h3>3 Comments</h3><div><p>{start}</div></section></div></body>") == text
    assert read(f"<body><div><h1>Comments on a law</h1><p>{start}<p>{rest}</div></body>") == f"Comments on a law {start} {rest}"
    assert read(f"<head><title>never closed<body><article>{body}</article>").endswith(text)
    assert read(f"<article>{body}</article><script>var a = '") == text and read(f"<article>{body}</article><a href='x") == text
    assert read(f"<article>{body}</article>1 < 2 <!-> </ > <?x?>").startswith(text)


@pytest.mark.parametrize("piece", ["<a ", "<b>", "<div>", "<div class=a>", "<p title=\"it>", "<li><ul>", "<header><main>", "<title>", "<td x='", "</b>", "<!--", "<form class=ad>"])
def test_main_text_takes_time_in_proportion(piece):
    import time

    def seconds(n):
        start = time.perf_counter()
        page = html_text.parse("<article><p>some words</p>" + piece * n + "<p>more of them")
        html_text.extract(page, None)
        return time.perf_counter() - start, page

    assert seconds(20000)[0] < 5


def test_host_votes_do_not_depend_on_splits(spark):
    rows = [(i, "http://a.example/", f"<div class={'xy'[i % 2]}><p>{'words of a page that are long enough ' * 3}</div>") for i in range(40)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = [sorted(map(tuple, html_text.main_text(pages.repartition(n)).collect())) for n in (1, 7)]
    assert found[0] == found[1]
