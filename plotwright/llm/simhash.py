"""SimHash near-duplicates by anchor-point covering (operator 10).

Fingerprints of 64 bits are linked when they differ in at most four bits.  The 64 bits are two halves of 32, and one of the
halves then differs in at most two bits.  For each half the anchors are the words of a covering code: the perfect binary Golay
code on 23 bits (every word is within 3 of exactly one code word), for large tables times the Hamming code on 7 more bits
(within 1).  A fingerprint's home is its nearest anchor, and it is also sent to every anchor within covering radius plus two.
Of two linked fingerprints the second is thus sent to the first one's home, and all comparisons are made per anchor.

Copies first collapse to one row per distinct fingerprint.  Anchors with many fingerprints are dealt over a grid of cells
(home part x visitor part), so that no task gets a hot group whole; cells give a star of links for what they find connected,
never all pairs.  Only the counts per anchor (at most ``2 * 2**16`` numbers) reach the driver.

Null text and text without a word have fingerprint zero and link like any other.  Repeated rows and repeated doc_ids get a row
each.  A null doc_id keeps its row and never names a component unless it stands alone (component null).  Very long texts are counted
in parts.  Extra columns, also ones whose names clash, are ignored or kept as they are.  Empty table: no rows.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import numbered, only, position, written

SHINGLE, BITS, SEED = 4, 4, 42
#: Fingerprints above which the larger code is used; both are exact.
LARGE = 20_000_000
#: Homes or visitors of an anchor in one cell.
CELL = 4096
#: Rows of cells that a task takes, about.
TASK_ROWS = 400_000
ROUND = 200_000


def fingerprints_of(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each text, as unsigned 64-bit."""
    import xxhash

    hash64 = functools.partial(xxhash.xxh64_intdigest, seed=SEED)
    out = np.zeros(len(texts), np.uint64)
    hashes: list[int] = []
    spans: list[tuple[int, int]] = []

    def settle() -> None:
        if not hashes:
            return
        bits = np.unpackbits(np.asarray(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        starts = np.cumsum([0, *(n for _, n in spans)])[:-1]
        ones = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        over = 2 * ones > np.array([n for _, n in spans])[:, None]
        out[[i for i, _ in spans]] = np.packbits(over, axis=1, bitorder="little").view("<u8")[:, 0]
        hashes.clear()
        spans.clear()

    for i, text in enumerate(texts):
        words = text.encode().lower().split() if text else ()
        if not words:
            continue
        if len(words) <= shingle:
            got = [hash64(b" ".join(words))]
        else:
            line = b" ".join(words)
            ends = np.cumsum([len(w) + 1 for w in words]).tolist()
            starts = [0, *ends]
            got = [hash64(line[a : b - 1]) for a, b in zip(starts, ends[shingle - 1 :], strict=False)]
        if len(got) > ROUND:  # a very long text's bits are counted in parts
            ones = np.zeros(64, np.int64)
            for k in range(0, len(got), ROUND):
                part = np.asarray(got[k : k + ROUND], "<u8").view(np.uint8).reshape(-1, 8)
                ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0)
            out[i] = np.packbits(2 * ones > len(got), bitorder="little").view("<u8")[0]
            continue
        hashes += got
        spans.append((i, len(got)))
        if len(hashes) > ROUND:
            settle()
    settle()
    return out


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, h (the text's hash) and fp (the fingerprint's bits as a signed long) of every row of ``docs`` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = fingerprints_of(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(found.view(np.int64))], names=["doc_id", "h", "fp"])

    return only(docs, "doc_id", "text").withColumn("h", F.xxhash64("text")).mapInArrow(run, "doc_id long, h long, fp long")


# ---- the covering code -------------------------------------------------------------------------------------------------


def _syndromes(columns: list[int]) -> list[np.ndarray]:
    """For a parity check with these columns: of each byte of a word, the part of the syndrome that it gives."""
    tables = []
    for at in range(0, len(columns), 8):
        part = columns[at : at + 8]
        tables.append(np.array([functools.reduce(lambda s, i: s ^ (part[i] if x >> i & 1 else 0), range(len(part)), 0) for x in range(1 << len(part))], np.int64))
    return tables


def _columns(n: int, generator: int, degree: int) -> list[int]:
    """Parity-check columns of the cyclic code with this generator polynomial: the remainders of x**i."""
    out, r = [], 1
    for _ in range(n):
        out.append(r)
        r <<= 1
        if r >> degree & 1:
            r ^= generator
    return out


def _patterns(columns: list[int], most: int) -> list[list[tuple[int, int]]]:
    """By syndrome: the error patterns of weight up to ``most`` that have it, as (weight, pattern)."""
    from itertools import combinations

    width = max(columns).bit_length()
    out: list[list[tuple[int, int]]] = [[] for _ in range(1 << width)]
    for w in range(most + 1):
        for c in combinations(range(len(columns)), w):
            out[functools.reduce(lambda s, i: s ^ columns[i], c, 0)].append((w, sum(1 << i for i in c)))
    return out


#: Generator polynomials: x^11+x^9+x^7+x^6+x^5+x+1 for the Golay code on 23 bits (radius 3), x^3+x+1 for Hamming on 7 (radius 1).
GOLAY, HAMMING = (23, 0b101011100011, 11, 3), (7, 0b1011, 3, 1)


class Anchors:
    """Home anchor and all anchors within radius plus ``reach`` of words, for a product of perfect cyclic codes."""

    def __init__(self, codes: tuple[tuple[int, int, int, int], ...], reach: int):
        self.codes, self.reach = codes, reach
        self.width = sum(n for n, *_ in codes)
        self.tables = []
        for n, generator, degree, radius in codes:
            columns = _columns(n, generator, degree)
            found = _patterns(columns, radius + reach)
            self.tables.append((n, degree, radius, _syndromes(columns), found))
        most = max(map(len, self._all()))
        self.errors = np.zeros((len(self._all()), most), np.int64)
        self.used = np.zeros((len(self._all()), most), bool)
        for s, patterns in enumerate(self._all()):
            self.errors[s, : len(patterns)], self.used[s, : len(patterns)] = patterns, True

    @functools.cache  # noqa: B019  (one object a worker)
    def _all(self) -> list[list[int]]:
        """By joint syndrome: joint error patterns whose excess over the radii is at most ``reach`` in all; the home's first."""
        joint = [[(0, 0)]]
        shift = 0
        for n, _, radius, _, found in self.tables:
            joint = [[(x + max(0, w - radius), p | q << shift) for x, p in have for w, q in new if x + max(0, w - radius) <= self.reach] for new in found for have in joint]
            shift += n
        return [[p for _, p in sorted(have, key=lambda e: e[0])] for have in joint]

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        total, shift, up = np.zeros(len(words), np.int64), 0, 0
        for n, degree, _, tables, _ in self.tables:
            part = words >> shift & ((1 << n) - 1)
            s = np.zeros(len(words), np.int64)
            for k, t in enumerate(tables):
                s ^= t[part >> 8 * k & (len(t) - 1)]
            total |= s << up
            shift, up = shift + n, up + degree
        return total

    def compact(self, anchors: np.ndarray) -> np.ndarray:
        """A small number for each code word: its information bits (the code is systematic in its high bits)."""
        out, shift, up = np.zeros(len(anchors), np.int64), 0, 0
        for n, _, degree, _ in self.codes:
            out |= (anchors >> (shift + degree) & ((1 << (n - degree)) - 1)) << up
            shift, up = shift + n, up + n - degree
        return out

    def __call__(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home of each word; index of the word and anchor of each visit, the home's included)."""
        words = words & ((1 << self.width) - 1)
        s = self.syndrome(words)
        home = self.compact(words ^ self.errors[s, 0])
        index, k = np.nonzero(self.used[s])
        return home, index, self.compact(words[index] ^ self.errors[s[index], k])

    @property
    def size(self) -> int:
        return 1 << sum(n - degree for n, _, degree, _ in self.codes)


@functools.cache
def anchors_for(large: bool) -> Anchors:
    return Anchors((GOLAY, HAMMING) if large else (GOLAY,), BITS // 2)


def _visits(fps: np.ndarray, large: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each half: homes, and visits as (index, anchor); anchors of the halves have different numbers."""
    code, bits = anchors_for(large), fps.view(np.uint64)
    for half in range(2):
        home, index, anchor = code((bits >> np.uint64(32 * half) & np.uint64(0xFFFFFFFF)).astype(np.int64))
        yield home + half * code.size, index, anchor + half * code.size


def _count_anchors(large: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 2 * anchors_for(large).size
        homes, guests = np.zeros(size, np.int64), np.zeros(size, np.int64)
        for batch in batches:
            for home, _, anchor in _visits(batch.column(0).to_numpy(), large):
                homes += np.bincount(home, minlength=size)
                guests += np.bincount(anchor, minlength=size)
        at = np.nonzero(guests)[0]
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(homes[at]), pa.array(guests[at])], names=["anchor", "homes", "guests"])

    return run


def _mix(x: np.ndarray) -> np.ndarray:
    x = x.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9) >> np.uint64(33)


def _cells(large: bool, split: dict[int, tuple[int, int]]):
    """Rows (cell, home 0 or 1, fp); split: parts of homes and of visitors of the anchors with many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = 2 * anchors_for(large).size
        parts = np.ones((size, 2), np.int64)
        for a, p in split.items():
            parts[a] = p
        for whole in batches:
            for k in range(0, whole.num_rows, 20_000):
                fps = whole.column(0).slice(k, 20_000).to_numpy()
                for home, index, anchor in _visits(fps, large):
                    for at, who, is_home in ((home, np.arange(len(fps)), 1), (anchor, index, 0)):
                        mine, other = parts[at, 1 - is_home], parts[at, is_home]
                        own = _mix(fps[who]).astype(np.int64) % mine
                        row = np.repeat(np.arange(len(at)), other)
                        k2 = np.arange(len(row)) - np.repeat(np.cumsum(other) - other, other)
                        h, g = (own[row], k2) if is_home else (k2, own[row])
                        cell = at[row] << 40 | h << 20 | g
                        yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.full(len(row), is_home == 1)), pa.array(fps[who[row]])], names=["cell", "home", "fp"])

    return run


def links_in_cell(homes: np.ndarray, guests: np.ndarray, most: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Star links (fingerprint, least fingerprint connected with it here) for what is linked between homes and guests.

    A home's own guest copy need not be here: where guests are split, it is in the home's own part of them alone.
    """
    every = np.unique(np.concatenate([homes, guests]))
    label = np.arange(len(every))
    at_home, at_guest = np.searchsorted(every, homes), np.searchsorted(every, guests)
    h, g = homes.view(np.uint64), guests.view(np.uint64)
    step = max(1, 2_000_000 // max(1, len(g)))
    for k in range(0, len(h), step):
        apart = h[k : k + step, None] ^ g[None, :]
        near = (np.bitwise_count(apart) <= most) & (apart != 0)
        for i in np.nonzero(near.any(axis=1))[0]:
            met = label[np.append(at_guest[near[i]], at_home[k + i])]
            least = met.min()
            if (met != least).any():
                label[np.isin(label, met)] = least
    moved = np.nonzero(label != np.arange(len(every)))[0]
    return every[moved], every[label[moved]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [(b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy()) for b in batches if b.num_rows]
    if not rows:
        return
    cell, home, fp = (np.concatenate(x) for x in zip(*rows, strict=True))
    del rows
    order = np.lexsort((home, cell))
    cell, home, fp = cell[order], home[order], fp[order]
    bounds = np.flatnonzero(np.diff(cell)) + 1
    homes = np.add.reduceat(home.astype(np.int64), np.concatenate([[0], bounds]))
    left, right = [], []
    for a, b, n in zip(np.concatenate([[0], bounds]), np.concatenate([bounds, [len(cell)]]), homes, strict=True):
        if n and b - a > n and (b - a > 2 or fp[a] != fp[a + 1]):
            x, y = links_in_cell(fp[b - n : b], fp[a : b - n])
            if len(x):
                left.append(x)
                right.append(y)
    if left:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], names=["a", "b"])


def fingerprint_links(distinct: DataFrame, large: bool | None = None) -> DataFrame:
    """(fp) distinct fingerprints -> (a, b) links whose components are those of all pairs within ``BITS`` bits."""
    n = distinct.count()
    large = n > LARGE if large is None else large
    counted = distinct.mapInArrow(_count_anchors(large), "anchor long, homes long, guests long")
    full = counted.groupBy("anchor").agg(F.sum("homes").alias("homes"), F.sum("guests").alias("guests")).where(F.col("guests") > CELL).collect()  # at most a row for each anchor of the code
    split = {r.anchor: (max(1, -(-r.homes // CELL)), max(1, -(-r.guests // CELL))) for r in full}
    tasks = max(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n * (90 if large else 50) // TASK_ROWS))
    cells = distinct.mapInArrow(_cells(large, split), "cell long, home boolean, fp long").repartition(tasks, "cell")
    return cells.mapInArrow(_compare, "a long, b long")


def _classes(marked: DataFrame) -> DataFrame:
    """(fp, least_doc, root) of every different fingerprint of ``marked``."""
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("least_doc"), F.min(_preferred()).alias("first")), "classes")
    roots = components(fingerprint_links(classes.select("fp")))
    return classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "least_doc", "first", F.coalesce("root", "fp").alias("root"))


def _preferred():
    """Of several rows, the least of these stays: rows with an id first, then the least id, then the text's hash."""
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "h")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row of ``docs`` (doc_id, text)."""
    marked = written(fingerprints(docs), "fingerprints")
    classes = _classes(marked)
    named = classes.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    placed = classes.select("fp", "root").join(named, "root").select("fp", "component_id")
    return marked.join(placed, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, with all columns, of which one document of each group of near-duplicates is left: that with the least id.

    Of rows that share the least id, the one with the least text hash stays, and of repeated rows one.
    """
    marked = written(fingerprints(docs), "fingerprints")
    stay = _classes(marked).groupBy("root").agg(F.min("first").alias("x")).select(F.col("x.doc_id").alias("s_id"), F.col("x.h").alias("s_h"))
    same = F.col("s_id").eqNullSafe(F.col("doc_id")) & F.col("s_h").eqNullSafe(F.col("h"))
    stay = written(stay.join(marked.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("times")), same).select("s_id", "s_h", "times"), "stay")
    rows = numbered(docs)
    names = rows.columns
    rows = rows.withColumns({"doc_id": F.col(f"c{position(docs, 'doc_id')}"), "h": F.xxhash64(f"c{position(docs, 'text')}")})
    kept = rows.join(stay.where("times = 1"), same, "left_semi").select(*names)
    if stay.where("times > 1").limit(1).count():
        again = rows.join(stay.where("times > 1"), same, "left_semi").dropDuplicates(["doc_id", "h"])
        kept = kept.unionByName(again.select(*names))
    return kept.toDF(*docs.columns)
