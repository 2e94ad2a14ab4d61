"""Secret scans by a trigram inverted index, in DataFrame operations only (operator 7).

1. From each rule's regular expression a Boolean trigram query is derived: which lower-case trigrams any match must hold.
2. An inverted index of just those trigrams is built over the texts: postings (trigram, document).
3. Postings are intersected per document and the queries tell the candidates of each rule.
4. Candidates are verified by the expression itself, which gives the spans.  Rules without mandatory trigrams (runs of
   hexadecimal digits) scan every text.

Spans of a kind are leftmost and do not overlap.  Their places come from the lengths of what lies between matches and of the
matches, summed up in order.  A document is known by its id and its text's hash, so repeated rows (and rows that share an id) get
their own spans each; null ids are kept.  Null text counts as empty.  Very long texts are scanned whole.  Spans that begin together
stand in the order of the rules.  Extra columns, also ones whose names clash, are ignored or kept.  Empty table: no rows.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable
from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .tables import numbered, only, position

MARK = "[SECRET]"


@dataclass(frozen=True)
class Rule:
    """kind; expression (the same in Python's and Java's dialect); value: a match counts if it fits this whole expression too."""

    kind: str
    pattern: str
    value: str | None = None
    ignore_case: bool = False

    @property
    def java(self) -> str:
        return f"(?i){self.pattern}" if self.ignore_case else self.pattern


_ASSIGN = r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
#: Base rules in their order.  Where a shorter match is dropped, the count stands in the expression if that finds the same.
BASE = (
    Rule("assign", _ASSIGN + r"[A-Za-z0-9+/_.=-]+", _ASSIGN + r"[A-Za-z0-9+/_.=-]{12,}", True),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: What the method adds: well-known forms of keys.
MORE = (
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("login", r"[a-z][a-z0-9+.-]{1,15}://[A-Za-z0-9_.-]{1,64}:[^\x20\x09-\x0D/@:]{3,128}@"),
)
RULES = (*BASE, *MORE)

# ---- Boolean trigram queries: True, a trigram, ("and", parts) or ("or", parts) ------------------------------------------

#: Strings that an expression's part may stand for before they are given up as a set.
MOST = 64
#: Trigrams in one mask of a document.
MASK = 60
#: Trigrams asked of one string, evenly over it; fewer only let more candidates through.
ASKED = 4


def _both(op: str, parts: Iterable) -> object:
    parts = frozenset(p for p in parts if not (op == "and" and p is True))
    if op == "or" and True in parts:
        return True
    if not parts:
        return True
    return next(iter(parts)) if len(parts) == 1 else (op, parts)


def _held(strings: frozenset[str]) -> object:
    """What a text holds that holds one of these strings."""
    return _both("or", (_both("and", (s[i : i + 3] for i in range(0, len(s) - 2, -(-max(1, len(s) - 2) // ASKED)))) for s in strings))


def _walk(items) -> tuple[object, frozenset[str] | None]:
    """(query, the strings it stands for if they are few) of a parsed sequence."""
    found: list[object] = []
    now: frozenset[str] | None = frozenset([""])
    every: frozenset[str] | None = frozenset([""])
    for op, arg in items:
        query, strings = _part(op, arg)
        found.append(query)
        if strings is not None and now is not None and len(now) * len(strings) <= MOST:
            now = frozenset(a + b for a in now for b in strings)
            every = now if every is not None else None
            continue
        every = None
        if now is not None:
            found.append(_held(now))
        now = strings
    if now is not None:
        found.append(_held(now))
    return _both("and", found), every


def _part(op, arg) -> tuple[object, frozenset[str] | None]:
    if op is sre.LITERAL:
        return True, frozenset([chr(arg).lower()])
    if op is sre.IN:
        chars: set[str] = set()
        for kind, x in arg:
            if kind is sre.LITERAL:
                chars.add(chr(x).lower())
            elif kind is sre.RANGE and x[1] - x[0] < MOST:
                chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return True, None
        return True, frozenset(chars) if len(chars) <= 8 else None
    if op is sre.SUBPATTERN:
        return _walk(arg[-1])
    if op is sre.BRANCH:
        each = [_walk(x) for x in arg[1]]
        known = [s for _, s in each]
        strings = frozenset().union(*known) if all(s is not None for s in known) else None
        return _both("or", (_both("and", (q, _held(s) if s is not None else True)) for q, s in each)), strings
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, inner = arg
        query, strings = _walk(inner)
        if low == 0:
            return True, frozenset(["", *strings]) if strings is not None and high == len(strings) == 1 else None
        if strings is not None and low == high and len(strings) ** low <= MOST:
            return query, functools.reduce(lambda a, b: frozenset(x + y for x in a for y in b), [strings] * low)
        return query, None
    return True, None


def trigram_query(rule: Rule) -> object:
    return _walk(_parser.parse(rule.pattern))[0]


def trigrams(query: object) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(trigrams, query[1]))


def _asked(query: object, bits: dict[str, int], masks: list[Column]) -> Column:
    """The query over a document's masks of trigrams."""
    if query is True:
        return F.lit(True)
    op, parts = query if isinstance(query, tuple) else ("and", [query])
    tests = [_asked(p, bits, masks) for p in sorted(parts, key=str) if not isinstance(p, str)]
    alone = [bits[p] for p in parts if isinstance(p, str)]
    for n, mask in enumerate(masks):
        want = sum(1 << b % MASK for b in alone if b // MASK == n)
        if want:
            met = mask.bitwiseAND(F.lit(want).cast("long"))
            tests.append(met == want if op == "and" else met != 0)
    return functools.reduce(lambda a, b: (a & b) if op == "and" else (a | b), tests)


# ---- the scan ---------------------------------------------------------------------------------------------------------


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text (null: empty) and h, the text's hash."""
    return only(docs, "doc_id", "text").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("h", F.xxhash64("text"))


def postings(rows: DataFrame, terms: list[str]) -> DataFrame:
    """The inverted index of these trigrams: (term, doc_id, h)."""
    low = F.lower("text")
    has = F.filter(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(i)) for i, t in enumerate(terms)]), lambda x: x.isNotNull())
    return rows.select("doc_id", "h", F.explode(has).alias("term"))


def candidates(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(doc_id, h, rules): documents whose postings fit the query of at least one rule; the array has those rules' numbers.

    Any number of terms is asked, MASK of them in a mask.
    """
    queries = [trigram_query(r) for r in rules]
    terms = sorted(set().union(*map(trigrams, queries)))
    bits = {t: i for i, t in enumerate(terms)}
    names = [f"mask{n}" for n in range(-(-len(terms) // MASK))]
    held = [F.bit_or(F.when(F.floor(F.col("term") / MASK) == n, F.expr(f"shiftleft(1L, term % {MASK})")).otherwise(F.lit(0).cast("long"))).alias(m) for n, m in enumerate(names)]
    masks = postings(rows, terms).groupBy("doc_id", "h").agg(*held)
    fits = F.filter(F.array(*[F.when(_asked(q, bits, [F.col(m) for m in names]), F.lit(i)) for i, q in enumerate(queries)]), lambda x: x.isNotNull())
    return masks.select("doc_id", "h", fits.alias("rules")).where(F.size("rules") > 0)


def _found(rule: Rule, number: int, gate: Column) -> Column:
    """The array of (rule, place in order, length before, length, counts) of a rule's matches."""
    pattern = F.lit(rule.java)
    hits = F.regexp_extract_all("text", pattern, F.lit(0))
    gaps = F.split("text", rule.java, -1)
    good = (lambda m: m.rlike(f"^(?:{Rule('', rule.value, None, rule.ignore_case).java})$")) if rule.value else (lambda m: F.lit(True))
    return F.when(
        gate & F.col("text").rlike(rule.java),
        F.transform(
            F.arrays_zip(F.slice(gaps, 1, F.size(hits)).alias("g"), hits.alias("m")),
            lambda x, i: F.struct(F.lit(number).alias("rule"), i.alias("i"), F.length(x["g"]).alias("gap"), F.length(x["m"]).alias("len"), good(x["m"]).alias("good")),
        ),
    ).otherwise(F.array().cast("array<struct<rule:int,i:int,gap:int,len:int,good:boolean>>"))


def spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, h, rule, start, end): every span of every different row, in code points, the end exclusive."""
    rows = keyed(docs)
    indexed = [(i, r) for i, r in enumerate(rules) if trigram_query(r) is not True]
    scanned = [(i, r) for i, r in enumerate(rules) if trigram_query(r) is True]
    parts: list[DataFrame] = []
    if indexed:
        some = candidates(rows, tuple(r for _, r in indexed)).withColumnsRenamed({"doc_id": "c_id", "h": "c_h"})
        held = rows.join(some, F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("h") == F.col("c_h")))
        parts.append(held.select("doc_id", "h", F.inline(F.concat(*[_found(r, i, F.array_contains("rules", k)) for k, (i, r) in enumerate(indexed)]))))
    if scanned:
        parts.append(rows.select("doc_id", "h", F.inline(F.concat(*[_found(r, i, F.lit(True)) for i, r in scanned]))))
    found = functools.reduce(DataFrame.unionByName, parts).groupBy("doc_id", "h", "rule", "i").agg(*(F.first(c).alias(c) for c in ("gap", "len", "good")))
    before = W.partitionBy("doc_id", "h", "rule").orderBy("i").rowsBetween(W.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("len")).over(before)
    return found.withColumn("end", end).where("good").select("doc_id", "h", "rule", (F.col("end") - F.col("len")).alias("start"), "end")


def per_document(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, h, spans): the sorted (start, rule, end) of each document that has some."""
    return spans(docs, rules).groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(F.struct("start", "rule", "end"))).alias("spans"))


def _joined(docs: DataFrame, found: DataFrame) -> DataFrame:
    return docs.join(found.withColumnsRenamed({"doc_id": "s_id", "h": "s_h"}), F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("h") == F.col("s_h")), "left").drop("s_id", "s_h")


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every row of ``docs`` (doc_id, text)."""
    kinds = F.array(*[F.lit(r.kind) for r in RULES])
    said = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", F.get(kinds, x["rule"]), x["start"], x["end"])), ",")
    rows = _joined(keyed(docs).select("doc_id", "h"), per_document(docs))
    every = F.coalesce("spans", F.array().cast("array<struct<start:bigint,rule:int,end:bigint>>"))
    base = F.filter("every", lambda x: x["rule"] < len(BASE))
    of = lambda k: F.filter("every", lambda x: x["rule"] == k)
    counts = [F.size(of(k)).cast("long").alias(f"n_{r.kind}") for k, r in enumerate(BASE)]
    return rows.withColumn("every", every).select("doc_id", *counts, F.sha2(said(base), 256).alias("base_sha256"), said("every").alias("spans"))


def redact(docs: DataFrame, mark: str = MARK) -> DataFrame:
    """``docs`` with all columns, each span (overlapping ones as one) replaced by ``mark`` and n_chars counted anew there.

    Rows without a span are returned as they are.
    """
    rows = numbered(docs)
    at, own = f"c{position(docs, 'text')}", f"c{position(docs, 'doc_id')}"
    text = F.col(at)
    rows = rows.withColumns({"doc_id": F.col(own), "h": F.xxhash64(F.coalesce(text, F.lit("")))})
    joined = _joined(rows, per_document(docs))
    # Runs of overlapping spans: (start, end) pairs, grown from the left.
    runs = F.aggregate(
        "spans",
        F.array().cast("array<struct<start:bigint,end:bigint>>"),
        lambda acc, x: F.when(
            (F.size(acc) > 0) & (x["start"] < F.element_at(acc, -1)["end"]),
            F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["start"].alias("start"), F.greatest(F.element_at(acc, -1)["end"], x["end"]).alias("end")))),
        ).otherwise(F.concat(acc, F.array(F.struct(x["start"].alias("start"), x["end"].alias("end"))))),
    )
    cut = lambda a, b: text.substr((a + 1).cast("int"), (b - a).cast("int"))
    pieces = F.transform("runs", lambda x, i: cut(F.when(i == 0, F.lit(0).cast("long")).otherwise(F.get("runs", i - 1)["end"]), x["start"]))
    cleaned = F.concat(F.array_join(pieces, mark), F.lit(mark), cut(F.element_at("runs", -1)["end"], F.length(text).cast("long")))
    joined = joined.withColumn("runs", F.when(F.col("spans").isNotNull(), runs)).withColumn("clean", F.when(F.col("runs").isNotNull(), cleaned))
    new = {at: F.coalesce("clean", text)}
    if "n_chars" in docs.columns:
        n = f"c{position(docs, 'n_chars')}"
        new[n] = F.when(F.col("clean").isNotNull(), F.length("clean").cast(rows.schema[n].dataType)).otherwise(F.col(n))
    return joined.select(*[new.get(f"c{i}", F.col(f"c{i}")).alias(f"c{i}") for i in range(len(docs.columns))]).toDF(*docs.columns)
