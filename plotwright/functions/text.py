"""Text normal forms and measures as Spark columns."""

from __future__ import annotations

import functools
import sys
import unicodedata
from collections.abc import Callable
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's ``str`` sees it, spelled out for Java.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, however often the body names it.

    Nested conditions over one input would otherwise be copied into each other by the optimizer and grow exponentially.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def where_at_least(value: Column, least: float) -> Column:
    """A generator: the value in a row of its own if it is ``least`` or more, else no row.

    A filter on a costly value is pushed into the join below it, where nothing is computed once and shared; a generator is not.
    """
    return F.explode(F.filter(F.array(value), lambda x: x >= least))


@functools.cache
def accents() -> tuple[str, str]:
    """Characters and what they are without accents, for ``translate``; those beyond the second string's end are dropped."""
    kept, bare, dropped = ["Đ", "đ"], ["D", "d"], []
    for c in range(128, min(sys.maxunicode, 0x1FFFF)):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if unicodedata.category(ch) == "Mn":
            dropped.append(ch)
            continue
        rest = [x for x in unicodedata.normalize("NFD", ch) if unicodedata.category(x) != "Mn"]
        if len(rest) == 1 and rest[0] != ch:
            kept.append(ch)
            bare.append(rest[0])
    return "".join(kept + dropped), "".join(bare)


def without_accents(s: Column) -> Column:
    return F.translate(s, *accents())


def norm_space(s: Column) -> Column:
    """Runs of white space as one space, none at the ends; null as empty."""
    return F.trim(F.regexp_replace(F.coalesce(s, F.lit("")), f"{SPACE}+", " "))


def stripped(s: Column) -> Column:
    return F.regexp_replace(F.coalesce(s, F.lit("")), f"^{SPACE}+|{SPACE}+$", "")


def canon_a(s: Column) -> Column:
    """Without accents, ASCII letters and digits only, then upper case."""
    return F.upper(F.regexp_replace(without_accents(F.coalesce(s, F.lit(""))), "[^A-Za-z0-9]+", ""))


def canon_b(s: Column) -> Column:
    """Upper case first, then without accents and only ASCII: what upper case makes ASCII stays (ß as SS)."""
    return F.regexp_replace(without_accents(F.upper(F.coalesce(s, F.lit("")))), "[^A-Z0-9]+", "")


def bare_upper(s: Column) -> Column:
    return F.upper(norm_space(without_accents(F.coalesce(s, F.lit("")))))


def compact(s: Column) -> Column:
    """Upper case without anything but ASCII letters and digits; accented letters go."""
    return F.regexp_replace(F.upper(norm_space(s)), "[^A-Z0-9]", "")


def alnum_count(s: Column) -> Column:
    return F.length(F.regexp_replace(s, r"[^\p{L}\p{N}]", ""))


def punctuation_share(s: Column) -> Column:
    marks = F.length(F.regexp_replace(s, rf"[\p{{L}}\p{{N}}]|{SPACE}", ""))
    return F.when(F.length(s) > 0, marks / F.length(s)).otherwise(F.lit(0.0))


def quality_a(text: Column, area: Column, confidence: Column) -> Column:
    """Longer, cleaner, larger and surer texts score higher; for recognised items."""
    t = norm_space(text)
    return alnum_count(t) + F.log(F.greatest(area, F.lit(1)) + 1.0) * 0.15 + F.sqrt(F.greatest(confidence, F.lit(0.0))) * 0.35 - punctuation_share(t) * 0.5


def quality_b(text: Column, area: Column, confidence: Column) -> Column:
    """The same without the share of marks, for reconciliation."""
    return alnum_count(F.coalesce(text, F.lit(""))) + F.sqrt(F.greatest(confidence, F.lit(0.0))) * 0.35 + F.log(area + 1.0) * 0.15


def held_either_way(a: Column, b: Column) -> Column:
    """Whether one holds the other."""
    return F.contains(a, b) | F.contains(b, a)


def near_by_containment(canon_x: Column, canon_y: Column) -> Column:
    """The part of the near-duplicate test that needs no similarity: both say something and one holds the other."""
    return (canon_x != "") & (canon_y != "") & held_either_way(canon_x, canon_y)


def may_be_similar(canon_x: Column, canon_y: Column, threshold: float) -> Column:
    """A bound by lengths alone: where false, no similarity of at least ``threshold`` is possible."""
    a, b = F.length(canon_x), F.length(canon_y)
    return F.least(a, b) * 2.0 >= (a + b) * F.lit(threshold)


def similarity(a: Column, b: Column, threshold: float) -> Column:
    """Ratcliff-Obershelp similarity of two texts (in this order) where the lengths allow ``threshold`` or more, else 0.

    Python sees only the pairs that the lengths let through, in Arrow batches.
    """

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([SequenceMatcher(None, p, q).ratio() if p is not None and q is not None else 0.0 for p, q in zip(x, y, strict=True)], dtype="float64")

    let_through = may_be_similar(a, b, threshold)
    low = lambda c: F.when(let_through, F.lower(norm_space(c)))
    return F.coalesce(ratio(low(a), low(b)), F.lit(0.0))


def repeats_when_joined(canon_x: Column, canon_y: Column) -> Column:
    """Whether joining the two would only repeat something: periodic, or one ends or begins with the other."""
    both = F.concat(canon_x, canon_y)
    return (canon_x != "") & (canon_y != "") & ((canon_x == canon_y) | both.rlike(r"^(.+)\1+$") | canon_x.endswith(canon_y) | canon_y.startswith(canon_x))
