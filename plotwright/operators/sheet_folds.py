"""The folds on many pages at once: the results of ``folds`` item for item, from pairs that are found and judged as arrays.

Whether one item would make another go depends on the two alone, so all such pairs are found first; only the greedy choice among
them is taken in turn.  What a text says is worked out once a text, what two texts have in common once a pair of texts.  Where
items change as they meet (duplicates within a line, joined texts, several words in one place) the plain fold does that line or group.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, fields, replace

import numpy as np
import pandas as pd
import pyarrow as pa

from ..config import DEFAULT, Settings
from ..functions import plain
from . import folds
from .sheets import Sheet, areas, blocks, iou, least_gap, mean_height, meetings, shared_area, vertical_overlap

_CACHED = 100_000
_SEVERAL = -1
#: Bands that an item lies in, on average, beyond which items are met by cells (and four times as many that it meets).
_SWEPT = 8


def _upper(c: str) -> int:
    """The ASCII letter or digit that a character is in upper case (0: another one)."""
    up = c.upper()
    return _SEVERAL if len(up) > 1 else ord(up) if up.isascii() and up.isalnum() else 0


def _begins_guard(c: str) -> bool:
    """Whether a text that begins with it may be :func:`plain.guarded`, where case does not count (nor does a long s)."""
    return c.upper() in set("CDEVSTM")


class Texts:
    """Different texts by number, and what is known of them."""

    def __init__(self, held: list[str]):
        self.held = held
        self.facts: dict[object, np.ndarray] = {}

    def __len__(self) -> int:
        return len(self.held)

    @functools.cached_property
    def length(self) -> np.ndarray:
        return np.fromiter(map(len, self.held), np.int64, len(self))

    @functools.cached_property
    def codes(self) -> np.ndarray:
        """The code points of all texts."""
        return np.frombuffer("".join(self.held).encode("utf-32-le", "surrogatepass"), np.uint32)

    def by_char(self, rule: Callable[[str], object], kind: type = bool) -> np.ndarray:
        """A rule on single characters for all of them."""
        there, chars, size = self.alphabet
        table = np.zeros(size, kind)
        table[there] = list(map(rule, chars))
        return table[self.codes]

    @functools.cached_property
    def alphabet(self) -> tuple[np.ndarray, list[str], int]:
        """The different code points, as characters too, and one more than the last."""
        there = np.flatnonzero(np.bincount(self.codes))
        return there, list(map(chr, there.tolist())), int(self.codes.max(initial=0)) + 1

    def sums(self, per_char: np.ndarray) -> np.ndarray:
        """How many characters of each text are marked."""
        return np.bincount(np.repeat(np.arange(len(self)), self.length)[per_char], minlength=len(self))

    @functools.cached_property
    def spaced(self) -> bool:
        """Whether white space is in any."""
        return bool(self.by_char(str.isspace).any())

    def edge(self, rule: Callable[[str], bool], last: bool = False) -> np.ndarray:
        """A rule on the first or last character (false of an empty text)."""
        end = np.cumsum(self.length)
        marked = np.append(self.by_char(rule), False)
        return marked[np.where(self.length > 0, end - 1 if last else end - self.length, len(marked) - 1)]

    def fact(self, rule: Callable[[str], bool]) -> np.ndarray:
        """A property of each text."""
        if rule not in self.facts:
            self.facts[rule] = np.fromiter(map(rule, self.held), bool, len(self))
        return self.facts[rule]

    def of(self, rule: Callable[[str], bool], number: np.ndarray) -> np.ndarray:
        """A property of some texts, by their numbers."""
        there, place = np.unique(number, return_inverse=True)
        return np.array([rule(self.held[i]) for i in there.tolist()], bool)[place]

    @functools.cached_property
    def counted(self) -> tuple[np.ndarray, np.ndarray]:
        """Letters and digits, and the share of marks: what quality asks of a text."""
        t = Texts(list(map(plain.one_space, self.held))) if self.spaced else self
        n = t.sums(t.by_char(str.isalnum))
        return n, t.sums(t.by_char(lambda c: not (c.isalnum() or c.isspace()))) / np.maximum(1, t.length)

    @functools.cached_property
    def letters(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each text's canonical form (which is made character by character): how often each letter and digit is in it, and its length."""
        code = self.by_char(lambda c: ord(x) % 48 if (x := plain.canon(c)) else 48, np.int64)  # 0-9: 0-9, A-Z: 17-42
        held = np.bincount(np.repeat(np.arange(len(self)), self.length) * 49 + code, minlength=49 * len(self)).reshape(-1, 49)[:, :48].astype(np.int16)
        return held, held.sum(1, dtype=np.int64)

    @functools.cached_property
    def tight(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of the texts' upper-case forms: the ASCII letters and digits, each one's text, and the texts that no such character-wise view fits."""
        code = self.by_char(_upper, np.int64)
        own = np.repeat(np.arange(len(self)), self.length)
        kept = np.flatnonzero(code)
        odd = np.zeros(len(self), bool)
        odd[own[code == _SEVERAL]] = True
        return code[kept], own[kept], odd

    @functools.cached_property
    def switches(self) -> np.ndarray:
        """Texts that may hold DS or ES once all but letters and digits is gone (none other does)."""
        code, own, odd = self.tight
        here = np.flatnonzero((code[1:] == ord("S")) & (own[1:] == own[:-1]))
        out = odd.copy()
        out[own[here[(code[here] == ord("D")) | (code[here] == ord("E"))]]] = True
        return out

    @functools.cached_property
    def unsettled(self) -> np.ndarray:
        """Texts that :func:`plain.normal` may change (no other): with DS or ES or SEL, or like CB."""
        code, own, _ = self.tight
        out = self.switches.copy()
        here = np.flatnonzero((code[2:] == ord("L")) & (own[2:] == own[:-2]))
        out[own[here[(code[here] == ord("S")) & (code[here + 1] == ord("E"))]]] = True
        two = np.bincount(own, minlength=len(self)) == 2
        here = np.flatnonzero((code == ord("C")) | (code == ord("G")))
        out[own[here[two[own[here]]]]] = True
        return out

    @functools.cached_property
    def lost(self) -> np.ndarray:
        """Texts of more than five ASCII letters and digits with DS or ES: no switch is so long, so they are invalid, and empty in normal form
        unless SEL is in them."""
        here = np.flatnonzero(self.switches & (self.length > 5))
        out = np.zeros(len(self), bool)
        out[here] = [(t := self.held[i]).isascii() and t.isalnum() for i in here.tolist()]
        return out

    @functools.cached_property
    def wordless(self) -> np.ndarray:
        """Texts without a letter or digit."""
        return self.sums(self.by_char(str.isalnum)) == 0

    def normal(self) -> list[str]:
        """:func:`plain.normal` of each text."""
        now = list(self.held)
        for i, lost in zip(np.flatnonzero(self.unsettled).tolist(), self.lost[self.unsettled].tolist(), strict=True):
            now[i] = "" if lost and "SEL" not in now[i].upper() else plain.normal(now[i])
        return now

    @functools.cached_property
    def invalid(self) -> np.ndarray:
        """:func:`plain.invalid` of each text."""
        out = self.lost.copy()
        asked = np.flatnonzero((self.wordless | self.switches) & ~out)
        out[asked] = [plain.invalid(self.held[i]) for i in asked.tolist()]
        return out

    @functools.cached_property
    def guarded(self) -> np.ndarray:
        """:func:`plain.guarded` of each text: none is that begins otherwise, or is longer and has no digit."""
        out = np.zeros(len(self), bool)
        asked = np.flatnonzero(self.edge(_begins_guard) & ((self.length <= 3) | (self.sums(self.by_char(str.isdecimal)) > 0)))
        out[asked] = [plain.guarded(self.held[i]) for i in asked.tolist()]
        return out

    @functools.cached_property
    def late(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each text's form by :func:`plain.canon_late`, which is made character by character: as :attr:`letters`."""
        forms = [plain.canon_late(c) for c in self.alphabet[1]]
        place = {c: n for n, c in enumerate("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ")}
        held = np.zeros((len(self), 36), np.int16)
        own = np.repeat(np.arange(len(self)), self.length)
        for nth in range(max(map(len, forms), default=0)):
            code = self.by_char(lambda c: place[f[nth]] if len(f := plain.canon_late(c)) > nth else 36, np.int64)  # noqa: B023
            held += np.bincount(own * 37 + code, minlength=37 * len(self)).reshape(-1, 37)[:, :36].astype(np.int16)
        return held, held.sum(1, dtype=np.int64)

    @functools.cached_property
    def short_number(self) -> np.ndarray:
        """:func:`plain.short_number`."""
        held, size = self.letters
        return (size > 0) & (size <= 2) & (held[:, :10].sum(1) == size)


@dataclass
class Marks:
    """Items of pages in order; t: the number of an item's text in ``texts``, which may hold others."""

    ids: np.ndarray
    page: np.ndarray
    texts: Texts
    t: np.ndarray
    x0: np.ndarray
    y0: np.ndarray
    x1: np.ndarray
    y1: np.ndarray
    cx: np.ndarray
    cy: np.ndarray
    confidence: np.ndarray
    cut: np.ndarray

    def __len__(self) -> int:
        return len(self.page)

    def take(self, n: np.ndarray) -> Marks:
        return Marks(self.ids, self.page[n], self.texts, *(getattr(self, f.name)[n] for f in fields(self)[3:]))

    def said(self, rule: Callable[[str], str]) -> Marks:
        """With every text as ``rule`` has it."""
        return self._saying(list(map(rule, self.texts.held)))

    def normal(self) -> Marks:
        """With every text in normal form."""
        return self._saying(self.texts.normal()) if self.texts.unsettled.any() else self

    def stripped(self) -> Marks:
        return self.said(str.strip) if self.texts.spaced else self

    def _saying(self, now: list[str]) -> Marks:
        if now == self.texts.held:
            return self
        number, texts = pd.factorize(np.array([*now, ""], object))
        return replace(self, texts=Texts(list(texts)), t=number[self.t])

    def one_spaced(self) -> Marks:
        return self.said(plain.one_space) if self.texts.spaced else self

    def item(self, i: int) -> folds.Item:
        return folds.Item(self.texts.held[self.t[i]], tuple(v[i].item() for v in (self.x0, self.y0, self.x1, self.y1)), (self.cx[i].item(), self.cy[i].item()), self.confidence[i].item(), bool(self.cut[i]))

    def items(self, numbers: np.ndarray) -> list[folds.Item]:
        x0, y0, x1, y1, cx, cy, confidence, cut = (getattr(self, c)[numbers].tolist() for c in ("x0", "y0", "x1", "y1", "cx", "cy", "confidence", "cut"))
        texts = map(self.texts.held.__getitem__, self.t[numbers].tolist())
        return [folds.Item(t, b, c, q, bool(k)) for t, b, c, q, k in zip(texts, zip(x0, y0, x1, y1, strict=True), zip(cx, cy, strict=True), confidence, cut, strict=True)]

    @property
    def upright(self) -> bool:
        return not ((self.x1 < self.x0) | (self.y1 < self.y0)).any()

    @functools.cached_property
    def whole(self) -> Marks:
        """With boxes in whole pixels, halves to even."""
        return replace(self, **{c: np.rint(getattr(self, c)) for c in ("x0", "y0", "x1", "y1")})

    @functools.cached_property
    def quality(self) -> np.ndarray:
        """As ``Item.quality`` to the last digit."""
        b = self.whole
        place, size = pd.factorize(np.maximum(1, np.maximum(0, b.x1 - b.x0) * np.maximum(0, b.y1 - b.y0)))
        logs = np.array([math.log(x + 1.0) for x in size.tolist()] or [0.0])
        n, marks = (x[self.t] for x in self.texts.counted)
        return n + 0.15 * logs[place] + 0.35 * np.sqrt(np.maximum(0.0, self.confidence)) - 0.5 * marks

    def each(self, rule: Callable[[str, str], bool], a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """A rule on pairs of texts (numbers), asked once a pair."""
        codes, place = np.unique(a * len(self.texts) + b, return_inverse=True)
        texts = self.texts.held
        x, y = (codes // max(1, len(texts))).tolist(), (codes % max(1, len(texts))).tolist()
        return np.fromiter((rule(texts[i], texts[j]) for i, j in zip(x, y, strict=True)), bool, len(codes))[place]

    def near(self, a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
        """:func:`plain.near` of pairs of texts (numbers)."""
        held, size = self.texts.letters
        out = (size[a] > 0) & (size[b] > 0)
        other = np.flatnonzero(out & (a != b))
        out[other] = False
        for n in np.array_split(other, len(other) // 20_000 + 1):
            x, y = a[n], b[n]
            both = np.minimum(held[x], held[y]).sum(1, dtype=np.int64)
            # No text is held by another, nor as similar, that has fewer letters in common; forms hold each other where texts do.
            may = n[(both >= np.minimum(size[x], size[y])) | (2.0 * both / (size[x] + size[y]) >= threshold)]
            out[may] = self.each(lambda p, q: p in q or q in p or _near(p, q, threshold), a[may], b[may])
        return out


_near = functools.lru_cache(_CACHED)(plain.near)


def marks(s: Sheet, cx: np.ndarray, cy: np.ndarray, cut: np.ndarray) -> Marks:
    """Of a sheet's items with their centres and seam tags."""
    number, texts = pd.factorize(s.text)
    return Marks(s.ids, s.page, Texts(list(texts)), number, *(v.astype(float) for v in (s.x0, s.y0, s.x1, s.y1, cx, cy, s.confidence)), cut)


def best_first(m: Marks) -> tuple[np.ndarray, np.ndarray]:
    """Items by page and quality, and each one's place among them."""
    order = np.lexsort((-m.quality, m.page))
    place = np.empty(len(m), np.int64)
    place[order] = np.arange(len(m))
    return order, place


def middles(group: np.ndarray, n: int, value: np.ndarray) -> np.ndarray:
    """The median of each of n groups (0 of an empty one)."""
    order = np.lexsort((value, group))
    count = np.bincount(group, minlength=n)
    first = np.cumsum(count) - count
    v = np.append(value[order], 0.0)
    return (v[np.minimum(first + np.maximum(0, count - 1) // 2, len(v) - 1)] + v[np.minimum(first + count // 2, len(v) - 1)]) / 2


def met(m: Marks, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs a < b of a page whose areas meet (and some whose areas nearly do), each once, in blocks."""
    if len(m) < 2:
        return
    found = _swept(m.page, x0, y0, x1, y1)
    if found is None:
        wide, tall = max(16.0, float(np.median(x1 - x0))), max(8.0, float(np.median(y1 - y0)) / 1.5)
        cells = tuple(np.floor(v / c).astype(np.int64) for v, c in ((x0, wide), (x1, wide), (y0, tall), (y1, tall)))
        found = meetings(m.page, cells, m.page, cells, among=True)
    for i, j in found:
        a, b = np.minimum(i, j), np.maximum(i, j)
        there = np.flatnonzero((x0[a] <= x1[b]) & (x0[b] <= x1[a]) & (y0[a] <= y1[b]) & (y0[b] <= y1[a]))
        yield a[there], b[there]


def _swept(page: np.ndarray, x0: np.ndarray, y0: np.ndarray, x1: np.ndarray, y1: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]] | None:
    """Pairs that share a band of a page and meet in x, each once: those that begin, from left to right, before an item ends.

    None if areas are so unlike in height, or so far apart, that bands would not serve.
    """
    tall = max(8.0, float(np.median(y1 - y0)))
    first, last = (np.floor(v / tall) for v in (y0, y1))
    top, left = first.min(), x0.min() - 1.0
    bands, room = last.max() - top + 1.0, x1.max() - left + 2.0
    # Places on one axis: page by page, band by band, and in them from the left; half a pixel more than any rounding.
    if not (page.max() + 1.0) * bands * room < 2.0**50:
        return None
    count = (last - first).astype(np.int64) + 1
    if count.sum() > _SWEPT * len(page):
        return None
    of = np.repeat(np.arange(len(page)), count)
    band = first[of] + np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
    start = (page[of] * bands + (band - top)) * room
    place = start + (x0[of] - left)
    order = np.argsort(place, kind="stable")
    of, band, place = of[order], band[order], place[order]
    after = np.searchsorted(place, start[order] + (x1[of] - left + 0.5), "right") - np.arange(len(of)) - 1
    if after.sum() > _SWEPT * 4 * len(page):
        return None

    def pairs() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, n, step in blocks(after):
            i, j = of[n], of[n + 1 + step]
            once = np.flatnonzero(band[n] == np.maximum(first[i], first[j]))
            yield i[once], j[once]

    return pairs()


def chosen(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Greedily: an item stays unless one that stays comes before it and makes it go; pairs (before, after)."""
    gone = bytearray(n)
    if pairs:
        a, b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        order = np.argsort(b, kind="stable")
        for x, y in zip(a[order].tolist(), b[order].tolist(), strict=True):
            if not gone[x]:
                gone[y] = 1
    return np.flatnonzero(np.frombuffer(gone, np.uint8) == 0)


def _by_page(m: Marks, fold: Callable[[list[folds.Item]], list[folds.Item]]) -> Marks:
    """The plain fold on every page."""
    found = [(p, i) for p in range(len(m.ids)) for i in fold(m.items(np.flatnonzero(m.page == p)))]
    return _of_items(m, np.array([p for p, _ in found], np.int64), [i for _, i in found])


def _of_items(m: Marks, page: np.ndarray, items: list[folds.Item]) -> Marks:
    number, texts = pd.factorize(np.array([i.text for i in items] + [""], object))
    column = lambda f: np.array([f(i) for i in items], float)
    box = (column(lambda i, n=n: i.box[n]) for n in range(4))
    return Marks(m.ids, page, Texts(list(texts)), number[:-1], *box, column(lambda i: i.center[0]), column(lambda i: i.center[1]), column(lambda i: i.confidence), np.array([i.cut for i in items], bool))


# ---- suppression ----------------------------------------------------------------------------------------------------------


def suppress(m: Marks, s: Settings = DEFAULT) -> Marks:
    """:func:`folds.suppress` of every page."""
    m = m.one_spaced().whole
    if not m.upright:
        return _by_page(m, lambda items: folds.suppress(items, s=s))
    order, place = best_first(m)
    n = len(m.ids)
    base = middles(m.page, n, np.maximum(1, m.y1 - m.y0))
    cell = np.minimum(s.grid_px[1], np.maximum(s.grid_px[0], np.rint(s.grid_factor * base)))[m.page]
    center = np.rint(np.maximum(s.center_px, s.center_factor * base))[m.page]
    low = lambda v: np.floor(v / cell)
    gx0, gy0 = low(m.x0), low(m.y0)
    gx1, gy1 = np.maximum(gx0, low(np.maximum(0, m.x1 - 1))), np.maximum(gy0, low(np.maximum(0, m.y1 - 1)))
    aside, half = s.small_gap * np.maximum(1.0, m.y1 - m.y0), center / 2
    around = np.minimum(m.x0 - aside, m.cx - half), np.minimum(m.y0, m.cy - half), np.maximum(m.x1 + aside, m.cx + half), np.maximum(m.y1, m.cy + half)
    spared = m.texts.guarded[m.t]
    pairs = []
    for i, j in met(m, *around):
        a, b = _turned(i, j, place)
        cut, free = m.cut[a] | m.cut[b], ~(spared[a] | spared[b])
        over = iou(m, a, m, b) >= s.nms_iou
        close = (np.abs(m.cx[a] - m.cx[b]) <= center[a]) & (np.abs(m.cy[a] - m.cy[b]) <= center[a])
        gap = least_gap(m, a, b)
        beside = ~cut & (vertical_overlap(m, a, b) >= s.dup_overlap) & (gap >= 0) & (gap <= s.small_gap * mean_height(m, a, b))
        may = np.where(over, free, np.where(close, ~cut & free, beside))
        may &= (gx0[b] - 1 <= gx1[a]) & (gx0[a] <= gx1[b] + 1) & (gy0[b] - 1 <= gy1[a]) & (gy0[a] <= gy1[b] + 1)
        a, b = a[may], b[may]
        alike = m.near(m.t[b], m.t[a], s.nms_similarity)
        pairs.append((place[a[alike]], place[b[alike]]))
    return m.take(order[chosen(len(m), pairs)])


def _turned(i: np.ndarray, j: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs in order of their places."""
    late = place[i] > place[j]
    return np.where(late, j, i), np.where(late, i, j)


# ---- lines ----------------------------------------------------------------------------------------------------------------


def merge_lines(m: Marks, s: Settings = DEFAULT) -> Marks:
    """:func:`folds.merge_lines` of every page, where the better of two stays."""
    if not len(m):
        return m
    if not m.upright:
        return _by_page(m, lambda items: folds.merge_lines(items, s=s))
    line, turns = folds.sheet_lines(m, m.cy)
    order = turns[np.lexsort((m.x0[turns], line[turns], m.page[turns]))]
    m, line = m.take(order), line[order]
    new = lambda x, y: np.append(True, (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
    line = np.cumsum(new(m.page, line)) - 1
    tall = middles(line, line[-1] + 1, np.maximum(0, m.y1 - m.y0))
    tall = np.where(tall > 0, tall, s.default_height)
    order, cut = _distinct(m, line, tall, s)
    m, line = replace(m, cut=cut).take(order), line[order]
    # Each with the next of its line.
    a = np.flatnonzero(line[1:] == line[:-1])
    a = a[m.x0[a + 1] - m.x1[a] < (0.5 + s.cut_bonus) * tall[line[a]]]
    a = a[_joinable(replace(m, texts=Texts([x.strip() for x in m.texts.held])) if m.texts.spaced else m, a, a + 1, tall[line[a]], s)]
    return _walked(m, line, tall[line], a, s)


def _walked(m: Marks, line: np.ndarray, tall: np.ndarray, starts: np.ndarray, s: Settings) -> Marks:
    """Items of lines after neighbours are joined from left to right; starts: items that may join the next."""
    n = len(m)
    empty, gone, cut = m.texts.letters[1][m.t] == 0, np.zeros(n, bool), m.cut.copy()
    of, heights, quality, known = line.tolist(), tall.tolist(), m.quality.tolist(), set(starts.tolist())
    x0, x1, was_cut = m.x0.tolist(), m.x1.tolist(), m.cut.tolist()
    made: dict[int, folds.Item] = {}
    done = 0
    for now in starts.tolist():
        if now < done:
            continue
        i, tagged = now + 1, was_cut[now]
        one: folds.Item | None = None  # what several became
        while True:
            tagged |= was_cut[i]
            if one is None and not (empty[now] and empty[i]):
                if quality[now] >= quality[i]:
                    gone[i] = True
                else:
                    gone[now] = True
                    now = i
            else:
                one = folds.met_in_line(one or replace(m.item(now), cut=bool(cut[now])), m.item(i), heights[i], s=s)
                gone[i] = True
            cut[now] = tagged
            i += 1
            if i == n or of[i] != of[now]:
                break
            if one is None and now == i - 1 and tagged == was_cut[now]:
                joins = now in known
            elif joins := x0[i] - (one.box[2] if one else x1[now]) < (0.5 + s.cut_bonus) * heights[i]:
                joins = folds.may_join(one or replace(m.item(now), cut=tagged), m.item(i), heights[i], s)
            if not joins:
                break
        if one is not None:
            made[now] = one
            gone[now] = True
        done = i
    rest = replace(m, cut=cut).take(~gone).normal()
    if not made:
        return rest
    at = np.array(list(made))
    whole = joined([rest, _of_items(m, m.page[at], [replace(x, text=plain.normal(x.text)) for x in made.values()])])
    return whole.take(np.argsort(np.concatenate([np.flatnonzero(~gone), at]), kind="stable"))


def joined(parts: list[Marks]) -> Marks:
    """Items of the same pages, one part after the other."""
    number, texts = pd.factorize(np.array([x for m in parts for x in m.texts.held] + [""], object))
    ends = np.cumsum([0, *(len(m.texts) for m in parts)])
    t = np.concatenate([number[m.t + n] for m, n in zip(parts, ends, strict=False)])
    rest = (np.concatenate([getattr(m, f.name) for m in parts]) for f in fields(Marks)[4:])
    return Marks(parts[0].ids, np.concatenate([m.page for m in parts]), Texts(list(texts)), t, *rest)


def _distinct(m: Marks, line: np.ndarray, tall: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Items of lines after duplicates are gone, in order, and all seam tags.  Items by line and x."""
    shift = m.x0.min()
    room = m.x0.max() - shift + 1.0
    place = (m.x0 - shift) / room  # in [0, 1): lines come apart
    reach = s.line_gap * tall[line]
    end = np.minimum((m.x1 + reach - shift) / room + 1e-9, 1.0)
    count = np.maximum(0, np.searchsorted(line + place, line + end, "right") - np.arange(len(m)) - 1)
    blank = m.texts.length == 0
    left, step = np.arange(len(m)), 1
    same: dict[int, list[int]] = defaultdict(list)
    while len(left := left[count[left] >= step]):
        a = left[line[np.minimum(left + step, len(m) - 1)] == line[left]]
        b = a + step
        level = (vertical_overlap(m, a, b) >= s.line_overlap) & (least_gap(m, b, a) <= reach[a]) & (np.abs(m.cy[a] - m.cy[b]) <= s.line_center * tall[line[a]])
        a, b = a[level], b[level]
        alike = m.near(m.t[b], m.t[a], s.line_similarity) | blank[m.t[a]] & blank[m.t[b]]
        for x, y in zip(a[alike].tolist(), b[alike].tolist(), strict=True):
            same[y].append(x)
        step += 1
    order, cut = np.arange(len(m)), m.cut.copy()
    gone = np.zeros(len(m), bool)
    place_of: dict[int, int | None] = {}  # of items that took another's place, or lost theirs
    for y in sorted(same):
        places = [p for x in same[y] if (p := place_of.get(x, x)) is not None]
        if not places:
            continue
        p = min(places)
        old = order[p]
        cut[y] = cut[old] = cut[y] or cut[old]
        gone[y] = True
        if m.quality[y] >= m.quality[old]:
            order[p], place_of[y], place_of[int(old)] = y, p, None
        else:
            place_of[y] = None
    return order[~gone], cut


def _joinable(m: Marks, a: np.ndarray, b: np.ndarray, tall: np.ndarray, s: Settings) -> np.ndarray:
    """:func:`folds.may_join` of pairs, the left one first, whose texts are stripped."""
    ta, tb = m.t[a], m.t[b]
    gap, off = m.x0[b] - m.x1[a], np.abs(m.cy[a] - m.cy[b])
    level = vertical_overlap(m, a, b) >= s.dup_overlap
    within = lambda share: (share + s.cut_bonus * (m.cut[a] | m.cut[b])) * tall
    texts = m.texts
    dash = texts.edge("-".__eq__, last=True)[ta] | texts.edge("-".__eq__)[tb]
    dot = texts.edge(".".__eq__, last=True)[ta] & texts.edge(str.isdigit)[tb] | texts.edge(str.isalnum, last=True)[ta] & texts.edge(".".__eq__)[tb]
    out = dash & (gap < within(0.5)) | dot & (gap < within(0.35))
    out |= (gap < 0) & level & (off <= 0.30 * tall) & (-gap <= 0.25 * mean_height(m, a, b))
    out |= (gap >= 0) & m.cut[a] & m.cut[b] & (off <= 0.35 * tall) & (gap <= 0.30 * tall)
    held = np.flatnonzero(~out & (gap >= 0) & level & (gap <= within(0.20)))
    out[held] = m.each(plain.contained, ta[held], tb[held])
    blank, number = texts.length == 0, texts.short_number
    out &= ~(blank[ta] | blank[tb])
    for x, y in ((ta, tb), (tb, ta)):
        left = np.flatnonzero(out & number[x])
        out[left] = ~texts.of(plain.device_like, y[left])
    left = np.flatnonzero(out)
    out[left] = ~m.near(ta[left], tb[left], s.line_similarity)
    left = np.flatnonzero(out)
    out[left] = ~m.each(plain.repeats, ta[left], tb[left])
    return out


# ---- final dedupe -----------------------------------------------------------------------------------------------------------


def dedupe(m: Marks, s: Settings = DEFAULT) -> Marks:
    """:func:`folds.dedupe` of every page."""
    m = m.take((m.texts.sums(~m.texts.by_char(str.isspace)) > 0)[m.t])
    if not m.upright:
        return _by_page(m, lambda items: folds.dedupe(items, s=s))
    order, place = best_first(m)
    w, words = m.whole, m.one_spaced()
    spared = words.texts.guarded[words.t]
    aside = s.small_gap * np.maximum(1.0, m.y1 - m.y0) + 1
    again = lambda x, y: plain.contained(x, y) or _again(x, y, s.dedupe_similarity, s.dedupe_similarity_short)
    pairs = []
    for i, j in met(m, m.x0 - aside, m.y0 - 1, m.x1 + aside, m.y1 + 1):
        level = np.abs(m.cy[i] - m.cy[j]) <= s.baseline * mean_height(m, i, j)
        a, b = _turned(i[level], j[level], place)
        cut, over = m.cut[a] | m.cut[b], iou(w, a, w, b) >= s.dedupe_iou
        gap = least_gap(m, a, b)
        beside = ~over & ~cut & (vertical_overlap(m, a, b) >= s.dup_overlap) & (gap >= 0) & (gap <= s.small_gap * mean_height(m, a, b))
        over &= ~(spared[a] | spared[b])
        go = np.zeros(len(a), bool)
        ta, tb = words.t[a], words.t[b]
        n = np.flatnonzero(beside)
        go[n] = words.near(tb[n], ta[n], math.inf)  # containment alone
        go[over & (ta == tb)] = True
        for n, rule in ((np.flatnonzero(over & ~cut & (ta != tb)), again), (np.flatnonzero(over & cut & (ta != tb)), _held)):
            go[n] = words.each(rule, tb[n], ta[n])
        pairs.append((place[a[go]], place[b[go]]))
    return m.take(order[chosen(len(m), pairs)])


def _held(a: str, b: str) -> bool:
    return plain.contained(a, b) or folds.by_containment(a, b, 0.0)


@functools.lru_cache(_CACHED)
def _again(a: str, b: str, threshold: float, if_short: float) -> bool:
    """Whether one text only repeats the other where both stand in one place, whole."""
    return _held(a, b) or plain.similar(a.lower(), b.lower(), if_short if min(len(a), len(b)) <= 3 else threshold)


def cleaned(m: Marks) -> Marks:
    """:func:`folds.cleaned`."""
    m = m.normal()
    m = m.take(~m.texts.invalid[m.t])
    return replace(m, **{c: np.trunc(getattr(m, c)) for c in ("x0", "y0", "x1", "y1", "cx", "cy")})


def finished(m: Marks) -> Marks:
    """``plans.page.finished`` of every page."""
    return cleaned(dedupe(merge_lines(suppress(m))))


# ---- reconciliation ----------------------------------------------------------------------------------------------------------


def reconcile(m: Marks, w: Marks, s: Settings = DEFAULT) -> Marks:
    """:func:`folds.reconcile` of every page that has words.  Items and words that could meet are groups, which never meet each other.

    A word that meets one item alone is settled with all others like it; larger groups are settled by the plain fold.
    """
    worded = np.zeros(len(m.ids), bool)
    worded[w.page] = True
    w = w.stripped()
    w = w.take(~w.texts.invalid[w.t]).normal().stripped()
    w = replace(w, cx=(w.x0 + w.x1) / 2, cy=(w.y0 + w.y1) / 2, confidence=np.ones(len(w)), cut=np.zeros(len(w), bool))
    m = joined([m, w])
    is_word = np.arange(len(m)) >= len(m) - len(w)
    order = np.argsort(m.page, kind="stable")
    m, is_word = m.take(order), is_word[order]
    if not len(m):
        return m
    if not m.upright:
        pages = [(p, *(m.items(np.flatnonzero((m.page == p) & side)) for side in (~is_word, is_word))) for p in range(len(m.ids))]
        found = [(p, x) for p, own, words in pages for x in ([x for _, x in folds.settle(own, words, None, s)] if worded[p] else own)]
        return _of_items(m, np.array([p for p, _ in found], np.int64), [x for _, x in found])
    n = len(m)
    whole = m.whole
    high = np.maximum(1.0, m.y1 - m.y0)
    half = np.maximum(s.pdf_center, s.pdf_center_factor * high) / 2
    around = np.minimum(m.x0 - 1, m.cx - half), np.minimum(m.y0 - 1, m.cy - half), np.maximum(m.x1 + 1, m.cx + half), np.maximum(m.y1 + 1, m.cy + half)
    near: list[tuple[np.ndarray, ...]] = [(np.zeros(0, np.int64),) * 2 + (np.zeros(0),) + (np.zeros(0, bool),) * 3]
    for a, b in met(m, *around):
        a, b = (x[worded[m.page[a]]] for x in (a, b))
        t = np.maximum(s.pdf_center, s.pdf_center_factor * np.minimum(high[a], high[b]))
        off_x, off_y = np.abs(m.cx[a] - m.cx[b]), np.abs(m.cy[a] - m.cy[b])
        hit = (off_x <= t) & (off_y <= t)
        share, both, least = iou(whole, a, whole, b), shared_area(m, a, m, b), np.minimum(areas(m, a), areas(m, b))
        part = both / np.maximum(1.0, least)
        score = np.maximum(np.maximum(share / max(1e-6, s.pdf_iou), part / 0.5), hit)
        over = hit | (share >= 0.05) | (least > 0) & (both / np.where(least > 0, least, 1.0) >= 0.5)
        apart = ((off_x > 1.2 * t) | (off_y > 1.2 * t)) & (share < 0.05) & (part < 0.25)
        close = is_word[b] & (score >= 1.0)
        may = np.flatnonzero(over | close)
        same = _same_texts(m, m.t[b[may]], m.t[a[may]])
        placed = close[may] | same
        near.append(tuple(x[may][placed] for x in (a, b, score, over, apart)) + (same[placed],))
    a, b, score, over, apart, same = (np.concatenate(x) for x in zip(*near, strict=True))
    met_by = np.bincount(np.concatenate([a, b]), minlength=n)
    gone = np.zeros(n, bool)
    at, confidence = np.arange(n), m.confidence.copy()  # what stands in each place
    worth = _worth(m)
    # A word that alone meets an item that meets nothing else.
    single = (met_by[a] == 1) & (met_by[b] == 1) & ~is_word[a] & is_word[b] & (score >= 1.0)
    i, j = a[single], b[single]
    gone[j[same[single] | ~apart[single]]] = True
    wins = same[single] & (np.ones(len(i), bool) if s.pdf_prefer == "pdf" else worth[j] > worth[i])
    at[i[wins]] = j[wins]
    confidence[i[wins]] = np.maximum(1.0, confidence[i[wins]])
    a, b, score, over, apart, same = (x[~single].tolist() for x in (a, b, score, over & same, apart, same))
    pairs: dict[int, list[tuple[int, float, bool, bool, bool]]] = defaultdict(list)
    for x, y, *what in zip(a, b, score, over, apart, same, strict=True):
        pairs[x].append((y, *what))
        pairs[y].append((x, *what))
    groups = _groups(a, b)
    members = np.array(sorted(pairs), np.int64)
    gone[members] = True
    words = set(members[is_word[members]].tolist())
    sure = dict(zip(members.tolist(), zip(confidence[members].tolist(), worth[members].tolist(), strict=True), strict=True))

    def value(k: int, q: float) -> float:
        return sure[k][1] if q == sure[k][0] else folds._worth(replace(m.item(k), confidence=q))

    for group in groups:
        for k, (now, q) in _settled(group, pairs, words, {k: sure[k][0] for k in group}, value, s).items():
            gone[k], at[k], confidence[k] = False, now, q
    # Items first, then words that were added.
    kept = np.flatnonzero(~gone)
    kept = kept[np.lexsort((kept, is_word[kept], m.page[kept]))]
    return replace(m.take(at[kept]), confidence=confidence[kept])


def _same_texts(m: Marks, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``folds._same_text`` of pairs of texts (numbers)."""
    out = a == b
    settled, (held, size) = ~m.texts.unsettled, m.texts.late
    other = np.flatnonzero(~out)
    as_they_are = settled[a[other]] & settled[b[other]]
    n = other[~as_they_are]
    out[n] = m.each(folds._same_text, a[n], b[n])
    n = other[as_they_are]
    x, y = a[n], b[n]
    n = n[np.minimum(held[x], held[y]).sum(1, dtype=np.int64) >= np.minimum(size[x], size[y])]
    out[n] = m.each(_late_same, a[n], b[n])
    return out


def _late_same(a: str, b: str) -> bool:
    """``folds._same_text`` of texts in normal form: where one holds the other its form does."""
    return plain.contained(a, b) or plain.contained(plain.canon_late(a), plain.canon_late(b))


def _worth(m: Marks) -> np.ndarray:
    """As ``plain.quality_b`` to the last digit."""
    size, place = np.unique(areas(m, np.arange(len(m))), return_inverse=True)
    logs = np.array([math.log(x + 1.0) for x in size.tolist()])
    n = m.texts.sums(m.texts.by_char(str.isalnum))
    return n[m.t] + 0.35 * np.sqrt(np.maximum(0.0, m.confidence)) + 0.15 * logs[place]


def _groups(a: list[int], b: list[int]) -> list[list[int]]:
    """Numbers that pairs connect, each group in order."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := above.setdefault(x, x)) != x:
            above[x] = x = above[y]
        return x

    for x, y in zip(a, b, strict=True):
        p, q = top(x), top(y)
        above[max(p, q)] = min(p, q)
    found: dict[int, list[int]] = defaultdict(list)
    for x in sorted(above):
        found[top(x)].append(x)
    return list(found.values())


def _settled(group: list[int], pairs: dict[int, list[tuple]], words: set[int], sure: dict[int, float], value: Callable[[int, float], float], s: Settings) -> dict[int, tuple[int, float]]:
    """:func:`folds.settle` of some of a page's items and words by number, items first: by place what stands there, and its confidence.

    pairs: of each number the others it meets, with the score, whether a sweep has them as one, whether they are apart, and whether
    they say the same; sure: confidences, which change where a word takes a place; value: what a number is worth with a confidence.
    """
    wins = lambda new, old: s.pdf_prefer == "pdf" or value(new, sure[new]) > value(old, sure[old])
    place = {k: k for k in group if k not in words}
    for k in group:
        if k not in words:
            continue
        best = max(((score, -place[j], j, apart, same) for j, score, _, apart, same in pairs[k] if j in place and score >= 1.0), default=None)
        if best is None or not best[4] and best[3]:
            place[k] = k
        elif best[4] and wins(k, j := best[2]):
            place[k] = place.pop(j)
            sure[k] = max(1.0, sure[j])
    swept: dict[int, int] = {}
    for n, k in sorted((n, k) for k, n in place.items()):
        first = min(((swept[j], j) for j, _, one, _, _ in pairs[k] if one and j in swept), default=None)
        if first is None:
            swept[k] = n
        elif wins(k, first[1]):
            swept[k] = swept.pop(first[1])
    return {n: (k, sure[k]) for k, n in swept.items()}


def columns(m: Marks) -> list:
    """page_id, seq and ``folds.COLUMNS`` of items by page."""
    seq = np.arange(len(m)) - np.searchsorted(m.page, m.page)
    text = np.array([*m.texts.held, ""], object)[m.t]
    return [m.ids[m.page], seq, text, m.x0, m.y0, m.x1, m.y1, m.cx, m.cy, m.confidence, m.cut]


#: A page's row as :func:`nested` has it: its items, and those of their texts that hold a digit (no other names a voltage level).
NESTED = "page_id long, ocr array<struct<text:string,bbox:array<double>,center:array<double>,confidence:double>>, numbered array<string>"


def nested(m: Marks) -> list:
    def lists(values: pa.Array, page: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(np.append(0, np.cumsum(np.bincount(page, minlength=len(m.ids)))).astype(np.int32), values)

    def rows(*v: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(np.arange(0, len(v) * len(m) + 1, len(v), dtype=np.int32), pa.array(np.stack(v, 1).ravel()))

    text = pa.array(m.texts.held, pa.string()).take(pa.array(m.t))
    items = pa.StructArray.from_arrays([text, rows(m.x0, m.y0, m.x1, m.y1), rows(m.cx, m.cy), pa.array(m.confidence)], names=["text", "bbox", "center", "confidence"])
    named = (m.texts.sums(m.texts.by_char(str.isnumeric)) > 0)[m.t]
    return [m.ids, lists(items, m.page), lists(text.filter(pa.array(named)), m.page[named])]
