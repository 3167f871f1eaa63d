"""Main text of web pages by consensus host paths: pages score their containers, hosts vote on paths, the winners are extracted."""

from __future__ import annotations

import bisect
import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if, materialize

#: HTML's elements by how they are read.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
CONTAINERS = frozenset("html body main article section div td center".split())
LISTS = frozenset("ul ol table dl".split())
DROPPED = frozenset("nav footer aside form button select option datalist dialog menu script style noscript iframe object svg math canvas audio video template head title".split())
#: Elements whose content is text up to their end tag; without one, the first two take the rest of the page.
RAW = ("script", "style", "title", "textarea", "noscript", "iframe")
CLOSES = {"p": ("p",), "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Words of class, id or role that mark what is not the article.
ANYWHERE = frozenset(
    "ad ads adv advert advertisement advertising adslot banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus "
    "footer gdpr login menu menubar modal nav navbar navigation newsletter notice overlay pager pagination popup promo promoted recommended related "
    "replies respond responses disclaimer search share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar widget widgets complementary contentinfo dialog alert".split()
)
#: Those of them that an article element may be marked by: teasers, comments and adverts come as articles too.
IN_ARTICLES = frozenset("ad ads advert advertisement comment comments promo promoted recommended related replies sponsored".split())
#: Elements that a head may hold; any other start tag ends it.
HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
#: What a page has once, or around its article: an unwanted element that is or holds one may be a wrapper of the page.
MAIN = frozenset("h1 main article".split())
OUTSIDE_ARTICLE = frozenset("header masthead topbar discussion".split())
#: Elements that are part of a sentence or hold one: only the words that name an advert, alone in a class, mark those of the second list.
SENTENCES = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 li td th dt dd blockquote pre figure figcaption caption summary".split())
ADVERTS = frozenset("ad ads advert advertisement advertising adslot promoted sponsored".split())
#: Words that, at the start of a class, say what a page has (always), what it is about (unless a part of a page ends the class) or
#: whose part an element is (unless any marking word ends the class: post-comments, entry-footer, tag-cloud).
HAS = frozenset("has with without no is".split())
ABOUT = frozenset("tag tagged category cat topic type format status term".split())
PARTS = frozenset("menu menubar nav navbar navigation sidebar widget widgets footer breadcrumb breadcrumbs cloud pagination pager".split())
WHOSE = frozenset("post page entry".split())
#: A class with one of these in it is a phrase, a slug of a title, and not a name.
PHRASES = frozenset("a an and about at by for from in of on or the to".split())
#: What a section of reader comments is headed by.
COMMENTS = re.compile(
    r"(?:(?:\d[\d.,]*|no|all|reader|recent|user)\s+)?(?:comments?|replies|responses)(?:\s*\(\d+\))?\s*:?|\d+\s+(?:comments?|replies|responses|thoughts)\s+(?:on|to)\b.{0,100}"
    r"|leave\s+a\s+(?:comment|reply)\b.{0,24}|join\s+the\s+(?:discussion|conversation)",
    re.I | re.S,
)

#: The rest of a tag after its name. A quoted value ends at a quote that a space, / or > follows; another quote is an
#: ordinary character, so an unbalanced one ends with its tag.
VALUE = r"\"[^\"]*+\"(?=[\s/>])|'[^']*+'(?=[\s/>])"
TAG = re.compile(rf"<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:{VALUE}|))*+)>")
ATTRIBUTE = re.compile(rf"([^\s=/>\"']+)(?:\s*=\s*({VALUE}|[^\s>]+))?")
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Page:
    """Containers (parent, path's digest, last segment) and text blocks (container, text, characters in links) of a page,
    what is dropped left out. A path's digest is made of its parent's and its own segment."""

    parents: list[int] = field(default_factory=lambda: [-1])
    paths: list[str] = field(default_factory=lambda: ["html"])
    segments: list[str] = field(default_factory=lambda: ["html"])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def attributes(raw: str) -> dict[str, str]:
    """Attributes by lower-cased name; of a repeated one the first."""
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(raw + " "):
        value = m[2] or ""
        if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
            value = value[1:-1]
        found.setdefault(m[1].lower(), html.unescape(value.strip("\"'")))
    return found


#: How an element's text counts: kept, dropped unless the element turns out to wrap the page, dropped.
KEPT, MARKED, GONE = range(3)


def unwanted(tag: str, attrs: dict[str, str], in_article: bool) -> int:
    if tag in DROPPED and tag != "form":
        return GONE
    if tag in ("html", "body", "main"):
        return KEPT
    if "hidden" in attrs or attrs.get("aria-hidden") == "true" or "display:none" in attrs.get("style", "").replace(" ", "").lower():
        return GONE
    if tag in INLINE:
        return KEPT
    for name in f"{attrs.get('class', '')} {attrs.get('id', '')} {attrs.get('role', '')}".split():
        words = [w.lower() for w in WORD.findall(name)]
        if not words or not PHRASES.isdisjoint(words):
            continue
        if tag in SENTENCES:
            if len(words) == 1 and words[0] in ADVERTS:
                return MARKED
        elif tag == "article":
            if words[0] in IN_ARTICLES:
                return MARKED
        elif words[0] in HAS | ABOUT | WHOSE:
            ends = words[-1] if len(words) > 1 and words[0] not in HAS else ""
            if ends in PARTS or words[0] in WHOSE and ends in ANYWHERE:
                return MARKED
        elif not ANYWHERE.isdisjoint(words) or not in_article and not OUTSIDE_ARTICLE.isdisjoint(words):
            return MARKED
    return MARKED if tag == "form" else KEPT


def generalised(tag: str, attrs: dict[str, str]) -> str:
    """tag.class with digits as #, so numbered variants of a template share a path."""
    classes = sorted({re.sub(r"\d+", "#", c.lower()) for c in attrs.get("class", "").split()})
    return ".".join([tag, *classes])


#: An element marked by its words wraps the page if it holds half of the page's text outside links and a main part or a
#: form's fields, else with this share.
WRAPS = 0.8


def parse(source: str) -> Page:
    """A form, or an element with an unwanted word in its class, that wraps the page is read as any other container."""
    page, marked, plain = read(source, frozenset())
    for parent, own, main in reversed(marked):
        if parent >= 0:  # a parent comes before its children
            marked[parent][1] += own
            marked[parent][2] |= main
    wrappers = frozenset(i for i, (_, own, main) in enumerate(marked) if own > plain * (0.5 if main else WRAPS))
    return read(source, wrappers)[0] if wrappers else page


def tokens(source: str) -> Iterator[tuple[str, str, bool, str, int]]:
    """(text before, tag, whether it ends, attributes, its end) of each tag, in time in proportion to the source; what follows the
    last one comes with an empty tag. Comments, declarations and raw elements' contents are left out. A tag that the page
    ends in is left out with all after it."""
    at, text, unended = 0, [], set()
    while True:
        lt = source.find("<", at)
        if lt < 0:
            text.append(source[at:])
            break
        text.append(source[at:lt])
        after = source[lt + 1 : lt + 2]
        if after == "!" or after == "?" or after == "/" and not source[lt + 2 : lt + 3].isalpha():
            mark = "-->" if source.startswith("<!--", lt) else ">"
            if source.startswith(("<!-->", "<!--->"), lt):
                mark = ">"
            end = source.find(mark, lt + 2)
            if end < 0:
                break
            at = end + len(mark)
            continue
        if not (after.isascii() and after.isalpha() or after == "/"):
            text.append("<")
            at = lt + 1
            continue
        m = TAG.match(source, lt)
        if m is None:
            break
        tag, at = m[2].lower(), m.end()
        if tag in unended:
            continue
        if tag in RAW and not m[1]:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            if close is None:
                unended.add(tag)
                if tag in RAW[:2]:
                    break
                continue
            at = close.start()
        yield "".join(text), tag, bool(m[1]), m[3], m.end()
        text = []
    yield "".join(text), "", False, "", len(source)


def read(source: str, wrappers: frozenset[int]) -> tuple[Page, list[list], int]:
    """The page with these marked elements kept; [marked parent, its characters outside links, main part in it] of each; all such characters."""
    page = Page()
    open_: list[tuple[str, int, int, int, int]] = []  # tag, container, dropped, in main (1) or an article (2), marked element
    where: dict[str, list[int]] = {}  # places of the open elements of each tag
    bars: list[int] = []  # places of open containers and lists
    walls: list[int] = []  # and of containers only
    at, dropped, in_article, mark, links = 0, KEPT, 0, -1, 0
    marked: list[list] = []
    plain = 0
    text: list[str] = []
    in_links = 0

    def close_block() -> None:
        nonlocal in_links
        if text:
            words = " ".join("".join(text).split())
            if words:
                page.blocks.append((at, words, in_links))
            text.clear()
        in_links = 0

    def pop_to(i: int) -> None:
        nonlocal at, dropped, in_article, mark, links
        while len(open_) > i:
            tag, *_ = open_.pop()
            where[tag].pop()
            links -= tag == "a" and links > 0
            for places in (bars, walls):
                if places and places[-1] == len(open_):
                    places.pop()
        at, dropped, in_article, mark = open_[-1][1:] if open_ else (0, KEPT, 0, -1)

    def last(tag: str) -> int:
        places = where.get(tag)
        return places[-1] if places else -1

    def add(raw: str) -> None:
        nonlocal in_links, plain
        if open_ and open_[-1][0] == "head" and not raw.isspace() and raw:
            pop_to(len(open_) - 1)
        if raw and dropped != GONE and not links:
            size = len("".join(raw.split()))
            plain += size
            if mark >= 0:
                marked[mark][1] += size
        if raw and not dropped:
            decoded = html.unescape(raw) if "&" in raw else raw
            text.append(decoded)
            in_links += len(decoded.strip()) if links else 0

    headlines: list[tuple[int, bool]] | None = None  # places of <h1 and of </header

    def headed(end: int) -> bool:
        nonlocal headlines
        if headlines is None:
            headlines = [(m.start(), m[1] is None) for m in re.finditer(r"<(?:h1|(/header))(?=[\s/>])", source, re.I)]
        i = bisect.bisect_left(headlines, (end, False))
        return i < len(headlines) and headlines[i][1]

    for before, tag, ends, rest, end in tokens(source):
        add(before)
        if not tag:
            break
        if not ends and open_ and open_[-1][0] == "head" and tag not in HEAD:
            pop_to(len(open_) - 1)
        if tag not in INLINE:
            close_block()
        if ends:
            i = last(tag)
            # an inline or text end tag doesn't close containers
            if i >= 0 and (tag in CONTAINERS or tag in DROPPED or i >= (walls[-1] if walls else -1)):
                pop_to(i)
            continue
        i = max((last(x) for x in CLOSES.get(tag, ())), default=-1)
        if tag in CONTAINERS:
            i = max(i, last("p"))
        if i >= 0 and i >= (bars[-1] if bars else -1):
            pop_to(i)
        if tag in VOID or rest.endswith("/") and tag not in CONTAINERS:
            continue
        attrs = attributes(rest) if rest and dropped != GONE else {}
        gone = GONE if dropped == GONE else unwanted(tag, attrs, in_article > 0)
        if tag == "header" and in_article < 2 and not (in_article and headed(end)):
            gone = GONE  # the site's, or of a main part without its headline
        here, inner = at, mark
        if gone == MARKED:
            inner = len(marked)
            marked.append([mark, 0, tag in MAIN or tag == "form"])
            gone = KEPT if inner in wrappers else MARKED
        elif gone == KEPT and tag in MAIN and mark >= 0:
            marked[mark][2] = True
        gone = max(gone, dropped)
        if (tag in CONTAINERS or tag == "form") and not gone:
            page.parents.append(at)
            page.segments.append(generalised(tag, attrs))
            page.paths.append(xxhash.xxh3_64_hexdigest(f"{page.paths[at]}>{page.segments[-1]}"))
            here = len(page.paths) - 1
        inside = max(in_article, 2 if tag == "article" else int(tag == "main"))
        where.setdefault(tag, []).append(len(open_))
        if tag in CONTAINERS or tag in LISTS:
            bars.append(len(open_))
        if tag in CONTAINERS:
            walls.append(len(open_))
        open_.append((tag, here, gone, inside, inner))
        links += tag == "a"
        at, dropped, in_article, mark = here, gone, inside, inner
    close_block()
    return page, marked, plain


#: A page votes with its best containers, by their share of the page's score; a vote moves up while the parent's text
#: is at most LIFT times its own, or PROSE of what the parent adds is text outside links; blocks shorter than SHORT count a
#: quarter.
VOTES, LIFT, SHORT, PROSE = 3, 1.3, 40, 0.8


def comments(page: Page) -> list[bool]:
    """Whether each container is, or lies in, a section headed as reader comments that holds less than half of the text."""
    first, size, parents = [""] * len(page.paths), [0] * len(page.paths), page.parents
    for at, words, _ in page.blocks:
        size[at] += len(words)
        while at >= 0 and not first[at]:
            first[at], at = words, parents[at]
    for at in range(len(size) - 1, 0, -1):
        size[parents[at]] += size[at]
    gone = [False] * len(size)
    for at in range(1, len(size)):
        headed = page.segments[at].partition(".")[0] in ("section", "div") and 2 * size[at] < size[0] and COMMENTS.fullmatch(first[at])
        gone[at] = gone[parents[at]] or bool(headed)
    return gone


def votes(page: Page) -> list[tuple[str, int]]:
    """(path, millionths) of the best containers: text outside links, halved for a container's parent."""
    score, mass, prose = [0.0] * len(page.paths), [0] * len(page.paths), [0] * len(page.paths)
    gone = comments(page)
    for at, words, linked in page.blocks:
        if gone[at]:
            continue
        plain = max(0, len(words) - 2 * linked) * (1.0 if len(words) >= SHORT else 0.25)
        score[at] += plain
        if page.parents[at] >= 0:
            score[page.parents[at]] += plain / 2
        mass[at] += len(words)
        prose[at] += len(words) - linked if len(words) >= SHORT else 0
    for sums in (mass, prose):
        for at in range(len(sums) - 1, 0, -1):  # a parent comes before its children
            sums[page.parents[at]] += sums[at]
    total = sum(score)
    found: dict[str, int] = {}
    for at in sorted(range(len(score)), key=lambda i: (-score[i], i))[:VOTES]:
        if score[at] <= 0:
            continue
        share, up = score[at] / total, page.parents[at]
        while up >= 0 and page.segments[up].partition(".")[0] not in ("body", "html"):
            if mass[up] > LIFT * mass[at] and prose[up] - prose[at] < PROSE * (mass[up] - mass[at]):
                break
            at, up = up, page.parents[up]
        found[page.paths[at]] = found.get(page.paths[at], 0) + round(share * 1e6)  # whole numbers: no order of summing changes a winner
    return list(found.items())


def extract(page: Page, winner: str | None) -> str:
    """Blocks below containers of the winning path, else of the page's own best, joined by one space."""
    if winner is None or winner not in page.paths:
        own = votes(page)
        winner = max(own, key=lambda v: v[1])[0] if own else "html"
    inside, gone = [False] * len(page.paths), comments(page)
    for i, path in enumerate(page.paths):
        inside[i] = not gone[i] and (path == winner or page.parents[i] >= 0 and inside[page.parents[i]])
    return " ".join(words for at, words, _ in page.blocks if inside[at])


#: Winning paths are broadcast up to this number of hosts, else joined by shuffle.
MAX_BROADCAST_HOSTS = 500_000


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/@?#]*@)?([^/:?#]*)", 1)), F.lit(""))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text: the article of each page, from the whole html, one row for each row of pages.

    Each page scores its containers; a host's pages vote on generalised tag-class paths, with partial sums, so a host of
    any size is one small group; pages are then read again with their host's winning path. A page that lacks it goes by
    its own best container. Null html or one without text gives an empty text; pages without a host vote together.
    Votes that tie go to the smaller path. Rows that repeat vote and are returned repeatedly. Empty tables give none.
    """
    source = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host(F.col(url_col)).alias("host"), F.col(html_col).alias("html"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums: dict[tuple[str, str], int] = {}
            for name, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                for path, share in votes(parse(raw.as_py() or "")):
                    sums[name, path] = sums.get((name, path), 0) + share
            names, paths = zip(*sums, strict=True) if sums else ((), ())
            shares = pa.array(sums.values(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(paths, pa.string()), shares], ["host", "path", "share"])

    cast = source.select("host", "html").mapInArrow(vote, "host string, path string, share bigint").groupBy("host", "path").agg(F.sum("share").alias("share"))
    winners = materialize(cast.groupBy("host").agg(F.min(F.struct(-F.col("share"), "path")).alias("w")).select("host", F.col("w.path").alias("winner")), "host-paths")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [extract(parse(raw.as_py() or ""), winner) for raw, winner in zip(b.column(2), b.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    known = source.join(broadcast_if(winners, MAX_BROADCAST_HOSTS), "host", "left").select("page_id", "url", "html", "winner")
    kind = {f.name: f.dataType.simpleString() for f in source.schema}
    return known.mapInArrow(read, f"page_id {kind['page_id']}, url {kind['url']}, text string")
