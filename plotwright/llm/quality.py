"""Quality rules: an isolation forest on rule statistics (operator 5).

Every text's rule statistics are counted whole.  An isolation forest (Liu, Ting and Zhou, 2008) is grown on the statistics of the
labelled rows; a document that random splits part from the rest after few steps is anomalous.  The forest sees
the rates themselves (on one logarithmic scale), not limits set by hand.

All labelled ids count (least quality where an id has several), one row an id (of an id's several texts the one with the least
rates).  Ids of even hash grow the forest, ids of odd hash calibrate its threshold, so no row does both.  As the method has it,
every tree's cuts come from a draw of ``SUBSAMPLE`` rows, here over all growing rows; how many rows end in each leaf, and so
every path length, is then counted over all growing rows.  Anomalies must be few where a forest is grown, or they hide each
other: bad rows (quality 0) weigh ``FEW_BAD`` as much as the good ones in all.  The threshold is the score that best parts all
calibrating bad rows from all good ones (scores counted in steps of 1 / ``STEPS``), a lost good row counting as ``WEIGHT`` kept bad
ones and at most ``clean_loss`` of the good rows being lost; it lies midway between the steps it parts.  Where one of the halves has
no good row, all rows do both.  The driver gets no more than the drawn rows, the leaves and the steps, whatever the tables' size.
Without labelled rows of quality 1 the threshold is ``DEFAULT_THRESHOLD``; with fewer than two rows there is no forest and only
the base rules judge.

Null text has no words and fails the base rules.  Repeated rows and ids are judged each.  Ties in score get one verdict.  Very
long texts are counted whole.  Extra columns, also ones whose names clash, are ignored or kept as they are.  Empty table: no rows.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import numbered, only, position, written

TREES, SUBSAMPLE, SEED = 200, 256, 20
CLEAN_LOSS, WEIGHT, FEW_BAD = 0.005, 5, 0.01
DEFAULT_THRESHOLD = 0.62
STEPS = 1 << 20
MIN_WORDS, MAX_REPEATED = 50, 50

SYMBOLS = "#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER, _PUNCTUATION, _DIGITS = string.ascii_uppercase.encode(), string.punctuation.encode(), string.digits.encode()
#: From a word's first symbol to its end.
_MARKED = re.compile(rb"[#*$%&|<>][^\x20\x09-\x0D]*")

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: What the forest sees: rates, so that a text's length alone is no anomaly.
RATES = ("mean_word", "symbol_rate", "marked_rate", "dup_line_rate", "repeat_rate", "upper_rate", "punctuation_rate", "letter_rate")


def _less(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window which the text has twice or more."""
    if len(words) < 4:
        return 0
    codes: dict[bytes, int] = {}
    code = np.fromiter((codes.setdefault(w, len(codes)) for w in words), np.int64, len(words))
    if len(codes) == len(words):
        return 0
    pair = np.unique(code[:-1] * len(codes) + code[1:], return_inverse=True)[1]
    _, window, times = np.unique(pair[:-1] * len(codes) + code[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    inside = np.zeros(len(words), bool)
    for k in range(3):
        inside[k : len(words) - 2 + k] |= again
    return int(inside.sum())


def statistics(text: str | None) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base counts of a whole text, and the rates made of them."""
    text = text or ""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    word_chars = len(text) - _less(raw, _SPACE)
    symbols = _less(raw, SYMBOLS.encode())
    lines = [x for x in raw.split(b"\n") if x.strip(_SPACE)]
    dup = len(lines) - len(set(lines))
    repeated = repeated_words(words)
    per = 1 / max(1, word_chars)
    marked = len(_MARKED.findall(raw)) if symbols else 0
    punctuation = _less(raw, _PUNCTUATION)
    rates = (
        word_chars / max(1, n),
        symbols / max(1, n),
        marked / max(1, n),
        dup / max(1, len(lines)),
        repeated / max(1, n),
        _less(raw, _UPPER) * per,
        punctuation * per,
        1 - (punctuation + _less(raw, _DIGITS)) * per,
    )
    return (n, word_chars, symbols, dup, repeated), rates


def scaled(rates: np.ndarray) -> np.ndarray:
    """Rates on one logarithmic scale: random cuts between a cluster's middle and far values then fall near the cluster too."""
    return np.log1p(20 * rates)


@dataclass
class IsolationForest:
    """Trees as arrays: feature (-1 in a leaf), cut, left child (right: the next), depth and a leaf's path length; rows drawn a tree."""

    feature: np.ndarray
    cut: np.ndarray
    child: np.ndarray
    depth: np.ndarray
    length: np.ndarray
    roots: np.ndarray
    drawn: int

    @staticmethod
    def usual(n: float) -> float:
        """Mean path length of an unsuccessful search in a binary tree of n rows."""
        return 0.0 if n < 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    @classmethod
    def grow(cls, rows: np.ndarray, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = SEED) -> IsolationForest:
        rng = np.random.default_rng(seed)
        m = min(subsample, len(rows))
        deepest = int(np.ceil(np.log2(max(2, m)))) + 2
        feature, cut, child, depth, length, roots = [], [], [], [], [], []

        def node(d: int = 0) -> int:
            for x, v in ((feature, -1), (cut, 0.0), (child, 0), (depth, d), (length, 0.0)):
                x.append(v)
            return len(feature) - 1

        for _ in range(trees):
            roots.append(node())
            todo = [(roots[-1], rows[rng.choice(len(rows), m, replace=False)], 0)]
            while todo:
                at, part, d = todo.pop()
                low, high = (part.min(axis=0), part.max(axis=0)) if len(part) else (np.zeros(rows.shape[1]),) * 2
                wide = np.nonzero(high > low)[0]
                if d >= deepest or len(part) < 2 or not len(wide):
                    length[at] = d + cls.usual(len(part))
                    continue
                f = int(rng.choice(wide))
                c = rng.uniform(low[f], high[f])
                left, right = node(d + 1), node(d + 1)
                feature[at], cut[at], child[at] = f, c, left
                below = part[:, f] < c
                todo += [(left, part[below], d + 1), (right, part[~below], d + 1)]
        return cls(np.array(feature), np.array(cut), np.array(child), np.array(depth), np.array(length), np.array(roots), m)

    @property
    def scale(self) -> float:
        return self.usual(self.drawn) or 1.0

    def leaves(self, rows: np.ndarray) -> Iterator[np.ndarray]:
        """For each tree the leaf of every row."""
        every = np.arange(len(rows))
        for root in self.roots:
            at = np.full(len(rows), root)
            while (inner := self.feature[at] >= 0).any():
                i = every[inner]
                a = at[i]
                at[i] = self.child[a] + (rows[i, self.feature[a]] >= self.cut[a])
            yield at

    def settled(self, share: np.ndarray) -> IsolationForest:
        """The same trees with path lengths by each leaf's share of all rows instead of the drawn ones."""
        usual = np.array([self.usual(self.drawn * x) if f < 0 else 0.0 for x, f in zip(share, self.feature, strict=True)])
        return replace(self, length=np.where(self.feature < 0, self.depth + usual, 0.0))

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; the higher, the sooner random splits isolate the row."""
        total = np.zeros(len(rows))
        for at in self.leaves(rows):
            total += self.length[at]
        return 2.0 ** (-total / len(self.roots) / self.scale)


def failed_base(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEATED * counts[:, 0])


@dataclass
class Judge:
    forest: IsolationForest | None
    threshold: float

    def __call__(self, counts: np.ndarray, rates: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(base_failed, kept, score) of rows of COUNTS and RATES."""
        failed = failed_base(counts)
        score = self.forest.score(scaled(rates)) if self.forest and len(rates) else np.zeros(len(rates))
        return failed, ~failed & (score < self.threshold), score


def threshold_of(score: np.ndarray, good: np.ndarray, clean_loss: float = CLEAN_LOSS, times: np.ndarray | None = None) -> float:
    """The cut between two scores that parts good from bad ones best; of several equal ones the highest.  times: rows of each score."""
    times = np.ones(len(score)) if times is None else times
    at = np.append(np.unique(score), 1.1)
    place = np.searchsorted(at, score)

    def above(which: np.ndarray) -> np.ndarray:
        each = np.bincount(place[which], times[which], len(at))
        return 1 - (np.cumsum(each) - each) / max(1, each.sum())

    lost, caught = above(good), above(~good)
    gain = np.where(lost <= clean_loss, caught * bool((~good).any()) - WEIGHT * lost, -1.0)
    best = len(at) - 1 - int(np.argmax(gain[::-1]))
    return float((at[best - 1] + at[best]) / 2 if 0 < best < len(at) - 1 else at[best])


def _measured(batch: pa.RecordBatch, text: int) -> tuple[np.ndarray, np.ndarray]:
    got = [statistics(t) for t in batch.column(text).to_pylist()]
    return (np.array([g[0] for g in got], np.int64).reshape(-1, len(COUNTS)), np.array([g[1] for g in got], float).reshape(-1, len(RATES)))


_RATES = ", ".join(f"{r} double" for r in RATES)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts and the rates of every row of ``docs``, measured where the texts lie."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, rates = _measured(batch, 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), *(pa.array(counts[:, k]) for k in range(len(COUNTS))), *(pa.array(rates[:, k]) for k in range(len(RATES)))], names=["doc_id", *COUNTS, *RATES]
            )

    return only(docs, "doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + f", {_RATES}")


def _drawn(rows: DataFrame, most: int, there: int) -> np.ndarray:
    """Rates of at most ``most`` of the rows, drawn over all of them by hash: where there are more, one of each of as many slots."""
    if there > most:
        slot = F.expr(f"pmod(xxhash64(doc_id, 1), {most})")
        rows = rows.groupBy(slot.alias("slot")).agg(F.min(F.struct(F.xxhash64("doc_id", F.lit(2)).alias("by"), "doc_id", "hash", *RATES)).alias("x")).select("x.*")
    found = rows.select("hash", "doc_id", *RATES).toPandas().sort_values(["hash", "doc_id"], kind="stable")
    return found[list(RATES)].to_numpy(float)


def _populations(rows: DataFrame, forest: IsolationForest) -> tuple[np.ndarray, np.ndarray]:
    """How many good and how many bad ones of all rows (quality, RATES) end in each node."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, len(forest.feature)), np.int64)
        for batch in batches:
            x = batch.to_pandas()
            good = x["quality"].to_numpy() == 1
            for at in forest.leaves(scaled(x[list(RATES)].to_numpy(float))):
                count += [np.bincount(at[g], minlength=count.shape[1]) for g in (good, ~good)]
        full = np.flatnonzero(count.any(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(count[0, full]), pa.array(count[1, full])], names=["node", "good", "bad"])

    found = rows.select("quality", *RATES).mapInArrow(run, "node long, good long, bad long").groupBy("node").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).toPandas()
    out = np.zeros((2, len(forest.feature)))
    out[:, found["node"]] = found["good"], found["bad"]
    return out[0], out[1]


def _threshold(rows: DataFrame, forest: IsolationForest, clean_loss: float) -> float:
    """The threshold that parts all good ones of the rows from all bad ones best."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.to_pandas()
            score = forest.score(scaled(x[list(RATES)].to_numpy(float)))
            yield pa.RecordBatch.from_arrays([pa.array((score * STEPS).astype(np.int64)), pa.array(x["quality"].to_numpy() == 1)], names=["step", "good"])

    found = rows.select("quality", *RATES).mapInArrow(run, "step long, good boolean").groupBy("step", "good").count().toPandas()
    return threshold_of((found["step"].to_numpy(float) + 0.5) / STEPS, found["good"].to_numpy(bool), clean_loss, found["count"].to_numpy(float))


def judge_from_measured(rows: DataFrame, labels: DataFrame, clean_loss: float = CLEAN_LOSS) -> Judge:
    """Grow and calibrate on all labelled rows of :func:`measured` ones that pass the base rules; no text is moved."""
    known = only(labels, "doc_id", "quality").where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.min("quality").cast("long").alias("quality"))
    passing = rows.where(f"n_words >= {MIN_WORDS} and 100 * n_repeat_words <= {MAX_REPEATED} * n_words")
    one = passing.join(known, "doc_id").groupBy("doc_id").agg(F.min(F.struct("quality", *RATES)).alias("x"))
    labelled = written(one.select("doc_id", F.xxhash64("doc_id").alias("hash"), "x.*"), "quality-labelled")
    grows = F.col("hash") % 2 == 0
    count = {(r.grows, r.good): r["count"] for r in labelled.groupBy(grows.alias("grows"), (F.col("quality") == 1).alias("good")).count().collect()}
    if sum(count.values()) < 2:
        return Judge(None, DEFAULT_THRESHOLD)
    growing, testing = labelled.where(grows), labelled.where(~grows)
    if not ((True, True) in count and (False, True) in count):
        growing = testing = labelled
        count = {(True, g): count.get((True, g), 0) + count.get((False, g), 0) for g in (True, False)}
    good, bad = count.get((True, True), 0), count.get((True, False), 0)
    clean = _drawn(growing.where("quality = 1"), TREES * SUBSAMPLE, good)
    few = max(1, round(FEW_BAD * len(clean))) if good else TREES * SUBSAMPLE
    forest = IsolationForest.grow(scaled(np.concatenate([clean, _drawn(growing.where("quality <> 1"), few, bad)])), TREES, SUBSAMPLE)
    weight = min(1.0, max(1.0, FEW_BAD * good) / bad) if good and bad else 1.0
    there = _populations(growing, forest)
    forest = forest.settled((there[0] + weight * there[1]) / (good + weight * bad))
    return Judge(forest, _threshold(testing, forest, clean_loss) if good else DEFAULT_THRESHOLD)


def judge_from_labels(docs: DataFrame, labels: DataFrame, clean_loss: float = CLEAN_LOSS) -> Judge:
    """:func:`judge_from_measured` of documents (doc_id, text)."""
    return judge_from_measured(measured(docs), labels, clean_loss)


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and anomaly of every row of ``docs`` (doc_id, text)."""
    rows = written(measured(docs), "quality-measured")
    judge = judge_from_measured(rows, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, rates = (np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names]) for names in (COUNTS, RATES))
            failed, kept, score = judge(counts, rates)
            yield pa.RecordBatch.from_arrays([*batch.columns[: 1 + len(COUNTS)], pa.array(failed), pa.array(kept), pa.array(score)], names=["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, anomaly double"
    return rows.mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    judge = judge_from_labels(docs, labels)
    text = position(docs, "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, kept, _ = judge(*_measured(batch, text))
            yield batch.filter(pa.array(kept))

    rows = numbered(docs)
    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
