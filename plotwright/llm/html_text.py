"""HTML extraction: flat text blocks, classified by a decision tree (operator 4).

A page is read once, tag by tag, into flat blocks of text: runs between block-level tags.  A block's features are its words and
its link density (share of its words inside links), both of the block before and the one behind it and of the two blocks on
either side together, whether it is a heading, and what its containers say: an element that surrounds articles (navigation,
footer, form, ...) or only a class or id that is named so, the share of the page's plain words that are marked alike (a name that
holds nearly all of a page says nothing), and whether it lies in an article or outside one that the page has.  A decision tree
grown on a small labelled table (:func:`labelled_pages`) tells text from the rest.  Words and link densities decide where
containers say nothing or too much: pages without any, wrappers named after a part of them, lists of links within articles.
Containers decide where words cannot: readers' comments and side columns read like articles.

Kept blocks are joined in page order by a newline; nothing is capped.  Null and empty html give empty text.  Repeated rows and
rows of one id are extracted each; a null id or url is kept.  Broken markup: a tag whose quotes never close ends at the next
``>``; a comment or script that never closes takes the rest of the page; a lone ``<`` is text.  Very long pages are read whole, in
memory in proportion.  Ties between equal cuts of the tree go to the first feature and the lowest cut.  Extra columns, also ones
whose names clash, are ignored.  Empty table: no rows.
"""

from __future__ import annotations

import functools
import html as entities
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .tables import only

#: Tags that do not end a block.
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: Tags whose content is no text of the page.
RAW = frozenset("script style noscript template iframe object svg math canvas audio video textarea select title head".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Tags of what surrounds an article, and of articles.
AROUND, ARTICLE = frozenset("nav header footer aside form button dialog menu fieldset".split()), frozenset(("article", "main"))
#: Words in class, id or role that tell the same (fixed values).
AROUND_WORDS = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer discussion footer form gdpr header login menu meta modal "
    "nav navbar navigation newsletter notice pager pagination popup promo promoted recommended related replies reply respond search share sharing sidebar signup skip social sponsor sponsored "
    "subscribe tags teaser toolbar topbar widget widgets aside complementary contentinfo alert dialog".split()
)
ARTICLE_WORDS = frozenset("article articlebody content entry main post story".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Tags that end an open paragraph or list item are all block tags; these close one of their own kind.
OWN_KIND = frozenset("li dt dd tr td th option p".split())

_TAG = re.compile(r"""</?([a-zA-Z][^\s/>]*)((?:[^"'>]|"[^"]*"|'[^']*')*+)>""")
_LOOSE = re.compile(r"</?([a-zA-Z][^\s/>]*)([^>]*)>")
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'])(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORDS = re.compile(r"[^\W_]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    around: int
    inside: bool
    heading: bool


@dataclass
class _Open:
    """around: 0, 1 where a class or id says so, 2 where an element itself does."""

    tag: str
    around: int
    inside: bool


def _says(tag: str, attributes: str, inside: bool) -> tuple[int, bool]:
    """(belongs to what surrounds an article, is one) by a tag and its attributes."""
    around, article = 2 * (tag in AROUND), tag in ARTICLE
    if tag == "header" and inside:  # an article's own header holds its title
        around = 0
    if attributes and tag not in ("body", "html"):
        for m in _ATTRIBUTE.finditer(attributes):
            name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
            if name == "hidden" or name == "aria-hidden" and value.lower() == "true" or name == "style" and "display:none" in value.replace(" ", "").lower():
                around = 2
            elif name in ("class", "id", "role"):
                said = {w.lower() for w in _WORDS.findall(_CAMEL.sub(" ", value))}
                is_article = bool(said & ARTICLE_WORDS)
                hit = said & AROUND_WORDS
                if hit and not (hit <= {"header", "meta"} and (is_article or inside)):
                    around = max(around, 1)
                elif is_article and tag in ("div", "section", "td", "main", "article"):
                    article = True
    return around, article


def blocks(page: str) -> list[Block]:
    """The page's flat text blocks in order."""
    out: list[Block] = []
    stack: list[_Open] = []
    parts: list[tuple[str, bool]] = []
    link = loose = heading = False
    at, n = 0, len(page)

    def flush() -> None:
        nonlocal parts
        if not parts:
            return
        raw = "".join(p for p, _ in parts)
        text = _SPACE.sub(" ", entities.unescape(raw) if "&" in raw else raw).strip()
        if text:
            linked = sum(len(p.split()) for p, inner in parts if inner)
            top = stack[-1] if stack else _Open("", 0, False)
            out.append(Block(text, text.count(" ") + 1, linked, top.around, top.inside, heading))
        parts = []

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            parts.append((page[at:], link))
            break
        if lt > at:
            parts.append((page[at:lt], link))
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 2 if page.startswith("<!-->", lt) else lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = None if loose else _TAG.match(page, lt)
        if m is None and lt + 1 < n and (page[lt + 1].isalpha() or page[lt + 1] == "/"):
            m = _LOOSE.match(page, lt)
            loose = loose or m is not None
            if m is None and page.find(">", lt) < 0:  # an open tag at the end of the page
                break
        if m is None:
            parts.append(("<", link))
            at = lt + 1
            continue
        tag, attributes, closing = m[1].lower(), m[2], page[lt + 1] == "/"
        at = m.end()
        if tag in INLINE:
            if tag == "a":
                link = not closing
            continue
        flush()
        link = False
        if tag in RAW:
            if not closing and not attributes.endswith("/"):
                end = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
                if end is None and tag == "head":
                    end = re.compile(r"(?=<body\b)", re.I).search(page, at)
                at = end.end() if end else (at if tag == "head" else n)
            continue
        heading = tag in HEADINGS and not closing
        if tag in VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k].tag == tag:
                    del stack[k:]
                    break
            continue
        if stack and stack[-1].tag == "p":
            stack.pop()
        if tag in OWN_KIND and stack and stack[-1].tag == tag:
            stack.pop()
        top = stack[-1] if stack else _Open("", 0, False)
        around, article = _says(tag, attributes, top.inside)
        stack.append(_Open(tag, max(top.around, around), (top.inside or article) and not around))
    flush()
    return out


FEATURES = ("words", "density", "words_before", "density_before", "words_behind", "density_behind", "words_near", "density_near", "heading", "around", "marked_alike", "place")


def features(found: list[Block]) -> np.ndarray:
    """A row of FEATURES for each block; place: 1 inside an article, -1 outside one that the page has, 0 on pages without."""
    n = len(found)
    words, linked = (np.array([getattr(b, k) for b in found], float) for k in ("words", "linked"))
    linked = np.minimum(words, linked)
    around = np.array([b.around for b in found], int)
    inside = np.array([b.inside for b in found], bool)
    pad = lambda x: np.concatenate([[0, 0], x, [0, 0]])
    w, k = pad(words), pad(linked)
    share = lambda a, b: np.divide(a, b, out=np.zeros(n), where=b > 0)
    near_w, near_k = (sum(x[i : i + n] for i in (0, 1, 3, 4)) for x in (w, k))
    plain = np.bincount(around, words - linked, 3)
    alike = plain[around] / max(1.0, plain.sum())
    place = np.where(inside, 1, -1 if inside.any() else 0)
    columns = (words, share(linked, words), w[1 : n + 1], share(k[1 : n + 1], w[1 : n + 1]), w[3 : n + 3], share(k[3 : n + 3], w[3 : n + 3]), near_w, share(near_k, near_w), [b.heading for b in found], around, alike, place)
    return np.column_stack(columns).astype(float).reshape(n, len(FEATURES))


# ---- the decision tree ------------------------------------------------------------------------------------------------


@dataclass
class Tree:
    """A node: a leaf's verdict, or a feature, its cut and what lies below it and from it on."""

    verdict: bool
    feature: int = -1
    cut: float = 0.0
    below: Tree | None = None
    above: Tree | None = None

    @classmethod
    def grow(cls, rows: np.ndarray, keep: np.ndarray, depth: int = 12, least: int = 3) -> Tree:
        """CART by Gini impurity, with ``least`` rows in a leaf; ties go to the first feature and the lowest cut."""
        verdict = bool(keep.mean() >= 0.5)
        if depth == 0 or keep.all() or not keep.any():
            return cls(verdict)
        best, n = None, len(keep)
        for f in range(rows.shape[1]):
            order = np.argsort(rows[:, f], kind="stable")
            value, kept = rows[order, f], np.cumsum(keep[order])
            a = np.arange(1, n)  # rows below each cut
            p, q = kept[:-1] / a, (kept[-1] - kept[:-1]) / (n - a)
            impurity = (a * p * (1 - p) + (n - a) * q * (1 - q)) / n
            impurity[(value[1:] == value[:-1]) | (a < least) | (n - a < least)] = np.inf
            if len(impurity) and impurity.min() < (np.inf if best is None else best[0] - 1e-12):
                i = int(np.argmin(impurity))
                best = (impurity[i], f, float(value[i] + value[i + 1]) / 2)
        if best is None:
            return cls(verdict)
        _, f, c = best
        low = rows[:, f] < c
        return cls(verdict, f, c, cls.grow(rows[low], keep[low], depth - 1, least), cls.grow(rows[~low], keep[~low], depth - 1, least))

    def judge(self, rows: np.ndarray) -> np.ndarray:
        if self.below is None:
            return np.full(len(rows), self.verdict)
        out, low = np.zeros(len(rows), bool), rows[:, self.feature] < self.cut
        out[low], out[~low] = self.below.judge(rows[low]), self.above.judge(rows[~low])
        return out


# ---- the labelled table -----------------------------------------------------------------------------------------------

#: Pages of the labelled table and the seed that they are made from.
PAGES, SEED = 240, 4
_SAID = "the keeper of northern light wrote what sea had brought to rocks below tower and took away again nobody counted boats that winter she said it rained salt rope oil harbour press".split()

Part = tuple[int, str]


class _Writer:
    """Labelled parts of made-up pages: (1 if it belongs to the article, html of one block with what opens and closes around it)."""

    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def words(self, low: int, high: int) -> list[str]:
        return self.rng.choices(_SAID, k=self.rng.randint(low, high))

    def plain(self, low: int, high: int) -> str:
        return " ".join(self.words(low, high)).capitalize() + "."

    def link(self, low: int = 1, high: int = 3) -> str:
        return f'<a href="/{self.rng.randrange(99)}">{" ".join(self.words(low, high))}</a>'

    def links(self, n: int, low: int = 1, high: int = 3, shell: str = "li") -> list[Part]:
        return [(0, f"<{shell}>{self.link(low, high)}</{shell}>") for _ in range(n)]

    def paragraph(self) -> str:
        """Long mostly; now and then short, with a link in it, or nothing but a link."""
        roll = self.rng.random()
        if roll < 0.2:
            return self.plain(1, 9)
        text = self.plain(10, 90)
        if roll < 0.35:
            text += f" {self.link(1, 6)} {self.plain(1, 12)}"
        return self.link(2, 6) if roll > 0.97 else text

    def article(self, shell: str = "p") -> list[Part]:
        n = self.rng.choice((1, 1, 2, 3, 5, 8, 12))
        out = [(1, f"<h1>{' '.join(self.words(1, 14))}</h1>")] if self.rng.random() < 0.8 else []
        for _ in range(n):
            if out and self.rng.random() < 0.15:
                out.append((1, f"<h2>{' '.join(self.words(1, 6))}</h2>"))
            out.append((1, f"<{shell}>{self.paragraph()}</{shell}>"))
        if n > 4 and self.rng.random() < 0.3:
            out += [(1, f"<li>{self.plain(2, 14)}</li>") for _ in range(3)]
        return out

    def around(self, text: list[Part], opening: str, closing: str) -> list[Part]:
        """The parts within one element."""
        (k, first), *rest = text
        text = [(k, opening + first), *rest]
        k, last = text[-1]
        return [*text[:-1], (k, last + closing)]

    def side(self, opening: str, closing: str) -> list[Part]:
        """What reads like an article and is none."""
        return self.around([(0, f"<p>{self.plain(3, 60)}</p>") for _ in range(self.rng.randint(1, 4))], opening, closing)

    def maybe(self, share: float, parts: list[Part]) -> list[Part]:
        return parts if self.rng.random() < share else []

    def small_print(self) -> list[Part]:
        return [(0, f"<div>&copy; {self.plain(2, 12)}</div>")]

    def with_elements(self) -> list[Part]:
        """An article or main element; navigation, footer and side columns in elements or named divisions."""
        name = self.rng.choice(("article", "main"))
        body = self.around(self.article(), f"<{name}>", f"</{name}>")
        at = self.rng.randrange(1, len(body)) if len(body) > 2 else 0
        if at:  # links and adverts within it
            inner = self.rng.choice((self.links(self.rng.randint(3, 6), 2, 8), self.side('<div class="advert">', "</div>"), self.side("<aside>", "</aside>"), []))
            body = [*body[:at], *inner, *body[at:]]
        return [
            *self.maybe(0.9, self.around(self.links(self.rng.randint(2, 8)), "<nav><ul>", "</ul></nav>")),
            *self.maybe(0.3, [(0, f"<header><p>{self.plain(3, 16)}</p></header>")]),
            *self.maybe(0.5, [(0, f'<div class="ad">{self.plain(4, 20)}</div>')]),
            *body,
            *self.maybe(0.3, self.side('<section id="comments">', "</section>")),
            *self.maybe(0.3, self.side("<aside>", "</aside>")),
            *self.maybe(0.2, [(0, f"<form><p>{self.plain(3, 14)}</p></form>")]),
            *self.maybe(0.2, self.side("<div>", "</div>")),
            *self.maybe(0.8, [(0, f"<footer>&copy; {self.plain(3, 20)}</footer>")]),
        ]

    def with_names(self) -> list[Part]:
        """Divisions named by class or id alone."""
        name = self.rng.choice(('class="post-content"', 'id="content"', 'class="entry"', 'class="story"'))
        return [
            *self.around(self.links(self.rng.randint(2, 8)), '<ul id="menu">', "</ul>"),
            *self.maybe(0.4, self.side('<div class="cookie-notice">', "</div>")),
            *self.around(self.article(), f"<div {name}>", "</div>"),
            *self.maybe(0.4, self.side('<div id="comments">', "</div>")),
            *self.maybe(0.4, self.side('<div class="sidebar">', "</div>")),
            *self.maybe(0.3, [(0, f'<div class="share">{self.plain(2, 5)}</div>')]),
            *self.maybe(0.5, [(0, f'<div class="footer">&copy; {self.plain(2, 12)}</div>')]),
        ]

    def without(self, shell: str = "p") -> list[Part]:
        """No containers: links in front and behind, small print at the end."""
        return [
            *self.maybe(0.8, self.links(self.rng.randint(3, 9), shell=self.rng.choice(("li", "div", "td")))),
            *self.article(shell),
            *self.maybe(0.6, self.links(self.rng.randint(3, 8), 1, 6, self.rng.choice(("li", "div")))),
            *self.maybe(0.4, self.small_print()),
        ]

    def misnamed(self) -> list[Part]:
        """All of a page within a wrapper that is named after a part of it."""
        name = self.rng.choice(('class="with-sidebar"', 'class="page widget"', 'id="search-page"', 'class="no-comments banner"'))
        return self.around(self.without(), f"<div {name}>", "</div>")

    def bare(self) -> list[Part]:
        shell = self.rng.choice(("p", "div"))
        return [(1, f"<{shell}>{self.plain(1, 60)}</{shell}>") for _ in range(self.rng.randint(1, 4))]


def labelled_pages(pages: int = PAGES, seed: int = SEED) -> list[list[Part]]:
    """The labelled table: the blocks of made-up pages of five kinds in turn."""
    w = _Writer(seed)
    kinds = (w.with_elements, w.without, w.with_names, w.with_elements, w.misnamed, w.bare)
    return [kinds[i % len(kinds)]() for i in range(pages)]


def labelled_rows(pages: list[list[Part]]) -> tuple[np.ndarray, np.ndarray]:
    """(features, keep) of the blocks of labelled pages."""
    rows, keep = [], []
    for page in pages:
        found = blocks("".join(part for _, part in page))
        if len(found) != len(page):
            raise ValueError("the labelled table must have one block a part")
        rows.append(features(found))
        keep += [k == 1 for k, _ in page]
    return np.vstack(rows), np.array(keep)


@functools.cache
def tree() -> Tree:
    """The tree grown on the labelled table."""
    return Tree.grow(*labelled_rows(labelled_pages()))


def main_text(page: str | None, judge: Tree | None = None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    keep = (judge or tree()).judge(features(found))
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every row of ``pages`` (page_id, url, html)."""
    judge = tree()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x.as_py(), judge) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return only(pages, "page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")
