"""Language by a plain version and on held-out rows; main text of generated pages with known articles."""

import html as entities
import random
import zlib
from collections import Counter, defaultdict

import regex
import zstandard

from tallywright.llm import html_text, language, queries

DATA = "/root/testdata"


def letters(text):
    return regex.sub(r"[^\p{L}]+", " ", text.lower()).strip(" ").encode() if text is not None and regex.search(r"\p{L}", text) else None


def held_out(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_language_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    rows = docs.selectExpr("doc_id", "text", "lang", "xxhash64('sample', doc_id) as h", "xxhash64(text) as th").collect()
    learned = defaultdict(dict)
    for r in rows:
        if r["lang"] is not None and not held_out(r["doc_id"]) and letters(r["text"]):
            learned[r["lang"]][r["h"], r["th"]] = letters(r["text"])[:2048]
    coders = {}
    for lang, texts in sorted(learned.items()):
        chosen = sorted(texts)[:256]
        data = b"".join(b"\n" + texts[k] for k in chosen)[: 1 << 17]
        coders[lang] = zstandard.ZstdCompressor(level=6, dict_data=zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT), write_content_size=False, write_checksum=False)
    want = {}
    for r in rows:
        t = letters(r["text"])
        if t is None:
            want[r["doc_id"]] = ("und", 0.0)
            continue
        sizes = sorted((sum(len(c.compress(t[a : a + 2048])) for a in range(0, len(t), 2048)), lang) for lang, c in coders.items())
        want[r["doc_id"]] = (sizes[0][1], 1 / (1 + 2 ** -min(60, 800 * (sizes[1][0] - sizes[0][0]) / len(t))))
    found = queries.op6_language(spark, f"{DATA}/sf0.001").collect()
    assert len(found) == len(rows) and len({lang for lang, _ in want.values()}) > 3
    assert {r["doc_id"]: (r["lang_pred"], round(r["score"], 9)) for r in found} == {k: (lang, round(s, 9)) for k, (lang, s) in want.items()}
    assert all(r["held_out"] == held_out(r["doc_id"]) for r in found)


def test_language_of_held_out_rows(spark):
    labels = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{DATA}/sf0.01/documents.parquet").select("doc_id", "lang").collect()}
    right, all_ = Counter(), Counter()
    for r in queries.op6_language(spark, f"{DATA}/sf0.01").collect():
        lang = labels[r["doc_id"]]
        if r["held_out"] and lang is not None and r["lang_pred"] != "und":
            all_[lang] += 1
            right[lang] += r["lang_pred"] == lang
    assert sum(all_.values()) > 100 and sum(right.values()) >= 0.98 * sum(all_.values())
    assert all(right[lang] >= 0.9 * n for lang, n in all_.items())


def test_sample_takes_no_held_out_row(spark):
    rows = [(i, f"word{'abcdefgh'[i % 8]} text{'ijklmnop'[i // 8 % 8]}", "en") for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    lines = language.sample(docs, "doc_id", "text", "lang")["en"].strip(b"\n").split(b"\n")
    assert sorted(lines) == sorted(letters(t) for i, t, _ in rows if not held_out(i))


VOICES = "the of a and to in with from over under while house river garden morning letter window story people reader market winter engine paper".split()
BODIES = ["<article>%s</article>", "<main>%s</main>", "<div class='post-content'>%s</div>", "<div class=entry>%s</div>", "<section class='story body-copy'>%s</section>"]
BODIES += ["<table><tr><td class=text>%s</td></tr></table>", "<div id=article><div class=inner>%s</div></div>", "<div class='has-sidebar content'>%s</div>"]
CLUTTER = ["post-comments", "sidebar", "related-posts", "cookie-notice", "newsletter-signup"]
TEMPLATES = [(body, clutter) for body in BODIES for clutter in CLUTTER]


def page(rnd, body, clutter, i):
    """(html, text) of a page: headings, paragraphs, a list, inline markup and references in the article; clutter in and around it."""
    said = lambda n: " ".join(rnd.choice(VOICES) for _ in range(n)) + rnd.choice(".!?")
    blocks, marked = [], []
    for k in range(rnd.randint(3, 9)):
        text = said(rnd.randint(12, 60)) if k else said(5)
        if k % 3 == 2:
            text += " R&D < 5 €"
        tag = "h1" if not k else ("p", "p", "h2", "blockquote")[k % 4] if k < 8 else "li"
        w = [entities.escape(x) for x in text.split()]
        if len(w) > 8:
            w[3], w[5] = f"<em class=alert>{w[3]}</em>", f"<a class=related href='/x?a=1&b=2'>{w[5]}</a>"
        blocks.append(text)
        marked.append(f"<{tag}>{'  '.join(w)}" + ("" if tag in ("p", "li") and rnd.random() < 0.5 else f"</{tag}>"))
    side = f"<div class='{clutter}'><p>{said(25)}</p><ul><li><a href=x>{said(4)}</a></ul></div>"
    inside = "".join(marked[:2]) + (side if i % 3 == 0 else "") + "".join(marked[2:])
    top = f"<header><a href=/>Site</a></header><nav><ul><li><a href=/a>{said(2)}</a><li><a href=/b>{said(2)}</a></ul></nav>"
    end = f"<div class=comments><p>{said(40)}</p></div><form><p>{said(6)}</p></form><footer>{said(15)}</footer><script>var a = '<p>{said(9)}</p>'</script>"
    return f"<!DOCTYPE html><html><head><title>{said(4)}</title></head><body>{top}{body % inside}{side}{end}</body></html>", " ".join(blocks)


def test_main_text_of_pages_with_known_articles(spark):
    rnd, rows, want = random.Random(8), [], {}
    for t, (body, clutter) in enumerate(TEMPLATES):
        for i in range(6):
            html, text = page(rnd, body, clutter, i)
            rows.append((t * 100 + i, f"https://host{t}.example/{i}", html))
            want[t * 100 + i] = text
    found = {r["page_id"]: r["text"] for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)).collect()}
    words = {k: (Counter(want[k].split()), Counter(found[k].split())) for k in want}
    both = sum(sum((a & b).values()) for a, b in words.values())
    precision, recall = both / sum(sum(b.values()) for _, b in words.values()), both / sum(sum(a.values()) for a, _ in words.values())
    wrong = sorted(k for k in want if found[k] != want[k])
    print(f"\nprecision {precision:.4f} recall {recall:.4f} pages that differ {len(wrong)} of {len(want)}: {wrong[:20]}")
    assert precision >= 0.99 and recall >= 0.99, wrong
