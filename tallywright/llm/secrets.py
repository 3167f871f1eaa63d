"""Secret scans behind a trigram inverted index (DataFrame functions only)."""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import apart, broadcast_if, materialize


@dataclass(frozen=True)
class Rule:
    """A kind of secret: `regex` is matched leftmost and non-overlapping, then matches that fail `keep` are dropped.

    keep: (group, least length of it). The pattern uses syntax that Java and Python read alike.
    """

    kind: str
    regex: str
    keep: tuple[int, int] = (0, 0)


#: The three base rules.
BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", (2, 6)),
    Rule("access", r"AKIA[A-Z0-9]+", (0, 20)),
    Rule("hex", r"[0-9a-f]+", (0, 24)),
)
#: Spans added to those of the base rules.
ADDED_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("maps", r"AIza[0-9A-Za-z_-]{35}"),
)
#: Candidates (an id and a number) are broadcast up to this number of rows, else texts are joined with them by shuffle.
MAX_BROADCAST_ROWS = 500_000
#: A character class of up to this many members is spelled out when literals are derived.
SPELLED = 8


def literals(regex: str) -> list[frozenset[str]]:
    """The lower-cased literal strings of 3 or more characters that a match must hold: any one set, whole.

    An empty set in the list means that some match holds no such literal.
    """

    def strings(nodes) -> list[tuple[str, ...]]:
        """Alternative sequences of literal runs; the first and last may be continued by what stands beside them."""
        found: list[tuple[str, ...]] = [("",)]
        for op, arg in nodes:
            if op is sre.LITERAL:
                step = [(chr(arg).lower(),)]
            elif op is sre.IN and (spelled := members(arg)):
                step = [(c,) for c in spelled]
            elif op is sre.SUBPATTERN:
                step = strings(arg[-1])
            elif op is sre.BRANCH:
                step = [x for branch in arg[1] for x in strings(branch)]
            elif op is sre.MAX_REPEAT and arg[:2] == (0, 1):
                step = [("",), *strings(arg[2])]
            elif op is sre.MAX_REPEAT and arg[0] == arg[1] == 1:
                step = strings(arg[2])
            else:
                step = [("", "")]  # anything: ends the run on the left and starts one on the right
            found = [(*a[:-1], a[-1] + b[0], *b[1:]) for a in found for b in step]
        return found

    def members(arg) -> list[str]:
        spelled: list[str] = []
        for op, x in arg:
            if op is sre.LITERAL:
                spelled.append(chr(x).lower())
            elif op is sre.RANGE and x[1] - x[0] < SPELLED:
                spelled += [chr(c).lower() for c in range(x[0], x[1] + 1)]
            else:
                return []
        return sorted(set(spelled)) if len(set(spelled)) <= SPELLED else []

    return sorted({frozenset(run for run in runs if len(run) >= 3) for runs in strings(sre_parser.parse(regex))}, key=sorted)


def trigram_query(regex: str) -> list[frozenset[str]]:
    """An OR of ANDs of trigrams that every matching text satisfies; empty: no mandatory trigram, scan all texts."""
    clauses = {frozenset(s[i : i + 3] for s in ands for i in range(len(s) - 2)) for ands in literals(regex)}
    least = [c for c in clauses if not any(other < c for other in clauses)]
    return [] if frozenset() in clauses else sorted(least, key=sorted)


def build_index(docs: DataFrame, rules: tuple[Rule, ...], id_col: str = "doc_id", text_col: str = "text", segments: int = 256) -> DataFrame:
    """Postings (segment, trigram, ids) for the trigrams that the rules ask for, over lower-cased whole texts.

    A list holds the ids of one segment of the documents, so a trigram that all texts hold has no list over all of them;
    `segments` is to grow with the table (a few thousand documents each).
    """
    vocabulary = sorted({t for r in rules for clause in trigram_query(r.regex) for t in clause})
    folded = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("folded"))
    held = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in vocabulary]))
    postings = folded.select("id", F.pmod(F.xxhash64("id"), F.lit(segments)).alias("segment"), F.explode(held).alias("trigram"))
    return postings.groupBy("segment", "trigram").agg(F.collect_set("id").alias("ids"), F.max(F.col("id").isNull()).alias("null_id"))


def with_bit(ids: Column, k: int) -> Column:
    return F.transform(ids, lambda x: F.struct(x.alias("id"), F.lit(1 << k).alias("bit")))


def candidates(index: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(id, asked): bit k of `asked` is set where rule k's trigram query holds; only rules that have mandatory trigrams."""
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    lists = index.groupBy("segment").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "ids"))).alias("m"), F.max("null_id").alias("null_id"))
    none = F.array().cast(f"array<{id_type}>")
    asked = []
    for k, rule in enumerate(rules):
        if query := trigram_query(rule.regex):
            posting = lambda t: F.coalesce(F.try_element_at("m", F.lit(t)), none)
            hits = reduce(F.array_union, [reduce(F.array_intersect, [posting(t) for t in sorted(clause)]) for clause in query])
            asked.append(with_bit(hits, k))
    if not asked:
        return lists.select(F.lit(None).cast(id_type).alias("id"), F.lit(0).alias("asked")).limit(0)
    found = lists.select(F.explode(F.flatten(F.array(*asked))).alias("x")).select("x.id", "x.bit")
    return found.groupBy("id").agg(F.bit_or("bit").alias("asked"))


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind) in code points, end exclusive, of the kept matches of a rule in a text."""
    pattern = F.lit(rule.regex)
    pieces, matches = F.split(text, rule.regex, -1), F.regexp_extract_all(text, pattern, F.lit(0))
    group, least = rule.keep
    judged = matches if group == 0 else F.regexp_extract_all(text, pattern, F.lit(group))
    part = F.arrays_zip(pieces.alias("piece"), matches.alias("match"), judged.alias("judged"))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["piece"])
        end = start + F.coalesce(F.length(x["match"]), F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("ord"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        kept = x["match"].isNotNull() & (F.length(x["judged"]) >= least)
        return F.struct(end.alias("at"), F.when(kept, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    spans = F.aggregate(part, zero, step, lambda acc: acc["spans"])
    probe = "[0-9a-f]{24}" if rule.kind == "hex" else rule.regex  # one cheap pass before the exact ones
    return F.when(F.rlike(text, F.lit(probe)), spans).otherwise(zero["spans"])


def joined(spans: Column) -> Column:
    """kind:start:end by start, then rule order, comma-joined."""
    text = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), text), ",")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", added: tuple[Rule, ...] = ADDED_RULES, segment_docs: int = 2000) -> DataFrame:
    """Input columns + _spans_<kind> arrays of (start, ord, end, kind) for each rule, over whole texts (null: empty); columns
    of these names, or named _asked, are replaced.

    Rules with mandatory trigrams are verified on the documents that their Boolean trigram query finds in the inverted
    index; rules without (hex runs) scan all. An index hit is on the id: rows that repeat an id are all verified, so
    each keeps its own spans; null ids are found like others. Empty tables give empty results.
    """
    rules = (*BASE_RULES, *added)
    segments = max(16, docs.count() // segment_docs)
    index = build_index(docs, rules, id_col, text_col, segments)
    docs = docs.drop("_asked_id", "_asked")
    asked = candidates(index, rules).select(F.col("id").alias("_asked_id"), F.col("asked").alias("_asked"))
    asked = broadcast_if(materialize(asked, "secret-candidates"), MAX_BROADCAST_ROWS)
    rows = docs.join(asked, F.col(id_col).eqNullSafe(F.col("_asked_id")), "left").drop("_asked_id")
    text, mask = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col("_asked"), F.lit(0))
    none = F.array().cast("array<struct<start:int,ord:int,end:int,kind:string>>")
    for k, rule in enumerate(rules):
        spans = rule_spans(text, rule, k)
        hit = F.lit(True) if not trigram_query(rule.regex) else mask.bitwiseAND(F.lit(1 << k)) != 0
        rows = rows.withColumn(f"_spans_{rule.kind}", F.when(hit, spans).otherwise(none))
    return rows.drop("_asked")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, whatever their names, with every span of any rule replaced by one mark; overlapping spans merge."""
    rules = (*BASE_RULES, *ADDED_RULES)
    names, (docs, (id_col, text_col)) = docs.columns, apart(docs, id_col, text_col)
    found = scan(docs, id_col, text_col)
    every = F.array_sort(F.flatten(F.array(*[F.col(f"_spans_{r.kind}") for r in rules])))
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        between = F.substring(F.col(text_col), acc["at"] + 1, s["start"] - acc["at"])
        fresh = F.concat(acc["out"], between, F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    done = F.aggregate(every, zero, step, lambda acc: F.concat(acc["out"], F.substring(F.col(text_col), acc["at"] + 1, F.length(text_col))))
    clean = F.when(F.size(every) > 0, done).otherwise(F.col(text_col))
    return found.withColumn("_clean", clean).select(*[F.col("_clean").alias(c) if c == text_col else F.col(c) for c in docs.columns]).toDF(*names)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = scan(docs.select("doc_id", "text"))
    base = F.concat(*[F.col(f"_spans_{r.kind}") for r in BASE_RULES])
    every = F.concat(base, *[F.col(f"_spans_{r.kind}") for r in ADDED_RULES])
    counts = [F.size(f"_spans_{r.kind}").cast("long").alias(f"n_{r.kind}") for r in BASE_RULES]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(every).alias("spans"))


def digest_sql() -> str:
    """The same in DuckDB."""
    parts = []
    for k, r in enumerate(BASE_RULES + ADDED_RULES):
        regex = r.regex.replace("'", "''")
        parts.append(
            f"select doc_id, {k} as ord, '{r.kind}' as kind, regexp_split_to_array(t, '{regex}') as p, regexp_extract_all(t, '{regex}', 0) as m, "
            f"regexp_extract_all(t, '{regex}', {r.keep[0]}) as j, {r.keep[1]} as least from d"
        )
    return f"""
with d as (select doc_id, coalesce(text, '') as t from documents),
found as ({" union all ".join(parts)}),
each as (
  select doc_id, ord, kind, least, m, j, p, unnest(range(1, len(m) + 1)) as i from found where len(m) > 0),
spans as (
  select doc_id, ord, kind,
         coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m[1:i-1], lambda x: length(x))), 0) as s,
         length(m[i]) as n
  from each where length(j[i]) >= least),
text as (
  select doc_id, ord, s, kind || ':' || cast(cast(s as bigint) as varchar) || ':' || cast(cast(s + n as bigint) as varchar) as x from spans),
agg as (
  select doc_id, count(*) filter (where ord = 0) as n_assign, count(*) filter (where ord = 1) as n_access, count(*) filter (where ord = 2) as n_hex,
         string_agg(x, ',' order by s, ord) filter (where ord < 3) as base, string_agg(x, ',' order by s, ord) as spans
  from text group by doc_id)
select d.doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access, coalesce(n_hex, 0)::bigint as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from d left join agg using (doc_id)
"""
