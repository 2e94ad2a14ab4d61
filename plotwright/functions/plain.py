"""The same text rules for single Python strings, for the order-dependent folds that work page by page."""

from __future__ import annotations

import functools
import math
import re
from difflib import SequenceMatcher

from .device import EDGE, VALID_SWITCH, GUARD, INSIDE, NUMBER_LEFT, NUMBER_RIGHT, ZERO_RIGHT
from .text import accents


@functools.cache
def _bare() -> dict[int, str | None]:
    kept, bare = accents()
    return {ord(c): bare[i] if i < len(bare) else None for i, c in enumerate(kept)}


_NOT_ASCII, _NOT_UPPER = re.compile("[^A-Za-z0-9]+"), re.compile("[^A-Z0-9]+")
_SERIES = re.compile(rf"{EDGE}SEL[-\s]?([0-9OIl]{{3,5}}[A-Z]?){EDGE}", re.I)
_DIGITS = str.maketrans("OoIl", "0011")
_RIGHT, _LEFT, _ZERO, _INSIDE = (re.compile(p) for p in (NUMBER_RIGHT, NUMBER_LEFT, ZERO_RIGHT, INSIDE))
_GUARD, _ALLOWED = re.compile(GUARD), re.compile(VALID_SWITCH)


def one_space(s: str) -> str:
    return " ".join(s.split())


@functools.lru_cache(100_000)
def canon(s: str) -> str:
    return _NOT_ASCII.sub("", s.translate(_bare())).upper()


@functools.lru_cache(100_000)
def canon_late(s: str) -> str:
    """Upper case before accents go, as reconciliation compares."""
    return _NOT_UPPER.sub("", s.upper().translate(_bare()))


def alnum(s: str) -> int:
    return sum(map(str.isalnum, s))


def quality_a(text: str, area: float, confidence: float) -> float:
    t = one_space(text)
    marks = sum(not (c.isalnum() or c.isspace()) for c in t) / len(t) if t else 0.0
    return alnum(t) + 0.15 * math.log(max(1, area) + 1.0) + 0.35 * math.sqrt(max(0.0, confidence)) - 0.5 * marks


def quality_b(text: str, area: float, confidence: float) -> float:
    return alnum(text) + 0.35 * math.sqrt(max(0.0, confidence)) + 0.15 * math.log(area + 1.0)


def similar(a: str, b: str, threshold: float) -> bool:
    """Ratcliff-Obershelp similarity of at least ``threshold``; not symmetric, so the order counts."""
    if 2 * min(len(a), len(b)) < threshold * (len(a) + len(b)):
        return False
    return SequenceMatcher(None, a, b).ratio() >= threshold


def contained(a: str, b: str) -> bool:
    return a in b or b in a


def near(a: str, b: str, threshold: float) -> bool:
    """Near-duplicate texts by canonical form."""
    x, y = canon(a), canon(b)
    return bool(x and y) and (contained(x, y) or similar(x, y, threshold))


def repeats(a: str, b: str) -> bool:
    x, y = canon(a), canon(b)
    if not (x and y):
        return False
    both = x + y
    return x == y or both in (both + both)[1:-1] or x.endswith(y) or y.startswith(x)


def packed(s: str) -> str:
    return _NOT_UPPER.sub("", one_space(s).upper())


def _canonical(s: str) -> str:
    if not s:
        return s
    up, tight = one_space(s).upper(), packed(s)
    if m := _RIGHT.search(up) or _LEFT.search(up):
        return m[1]
    if _ALLOWED.search(tight):
        return tight
    if m := _INSIDE.search(up):
        if m[2] is None:
            return m[1]
        digits = m[2].replace("0", "")
        return m[1] + digits if digits else ""
    if "DS" in tight or "ES" in tight:
        return ""
    return "CB" if re.fullmatch("[CG][B8E]", tight) else s


def _beside_number(s: str) -> str:
    up = one_space(s).upper()
    for pattern, part in ((_ZERO, 1), (_RIGHT, 1), (_LEFT, 2)):
        if m := pattern.search(up):
            return m[part]
    return s


def _ordinary(s: str) -> bool:
    """Whether a glance shows that no rule of :func:`normal` can change the text."""
    up = s.upper()
    if s.isascii() and s.isalnum():
        return len(s) != 2 and ("S" not in up or not ("DS" in up or "ES" in up or "SEL" in up))
    return not ("S" in up or "C" in up or "G" in up)


@functools.lru_cache(100_000)
def normal_without_beside(s: str) -> str:
    if _ordinary(s):
        return s
    return _canonical(_SERIES.sub(lambda m: "SEL-" + m[1].translate(_DIGITS), s))


def normal(s: str) -> str:
    return s if _ordinary(s) else _normal(s)


@functools.lru_cache(100_000)
def _normal(s: str) -> str:
    return _beside_number(normal_without_beside(s))


def guarded(s: str) -> bool:
    return _GUARD.search(s) is not None


def short_number(s: str) -> bool:
    return re.fullmatch(r"\d{1,2}", canon(s)) is not None


def device_like(s: str) -> bool:
    if len(s) != 2 and s.isascii() and s.isalpha():
        return False  # all others end in digits or have a digit before their last letter
    tight = packed(s)
    return bool(_ALLOWED.search(tight) or re.fullmatch(r"(?:DS|ES)[1-9]{1,3}[A-Z]?", tight) or re.fullmatch(r"(?:BB|C|TC|T)\d{1,2}", one_space(s).upper()))


def invalid(s: str) -> bool:
    if s.isascii() and s.isalnum() and not ("DS" in (up := s.upper()) or "ES" in up):
        return False
    t = s.strip()
    if not t or len(t) == 1 and not t.isalnum() or re.fullmatch(r"[^\w\s]+", t) or re.fullmatch(r"[-_/\\=.,:;|`~^'\"–—•·…]{2,}", t):
        return True
    tight = _NOT_UPPER.sub("", t.upper())
    return ("DS" in tight or "ES" in tight) and not _ALLOWED.search(tight)
