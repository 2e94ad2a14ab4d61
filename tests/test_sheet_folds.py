"""Folds of many pages at once against the plain folds, item for item; their queries move texts, never items."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plotwright import catalogue
from plotwright.fixtures import ocr_sheet
from plotwright.operators import folds, sheet_folds
from plotwright.plans.page import finished
from test_folds import page

WORDS = ["alpha", "alph", "alpha ", "beta", "DS1", "DS12", "CB", "x", "12", "BB1", "a-", "-b", "7.", ".5", "é", "…", "чертеж", "черте", "\t", "gamma delta", "gammadelta", "beta.", "ΑΣ", "4 DS9", "sel 3O1", "ſ2", "--"]


def odd_pages(seed, n=90, pages=3):
    """Pages of the tests of the plain folds, with more kinds of text, part of them crowded, in halves of pixels, or upside down."""
    rng = random.Random(seed)
    out = []
    for p in range(pages):
        own = page(seed * 10 + p, n)
        if seed % 2:
            own = [folds.replace(i, text=rng.choice(WORDS), center=(i.center[0] + rng.randint(-9, 9), i.center[1])) for i in own]
        if seed % 3 == 0:
            own = [folds.replace(i, box=(i.box[0] / 2, i.box[1], i.box[2] / 2 + 0.5, i.box[3])) for i in own]
        if seed % 7 == 6:
            own = [folds.replace(i, box=(i.box[2], *i.box[1:])) if rng.random() < 0.1 else i for i in own]
        out.append(own)
    return out


def marked(pages):
    empty = sheet_folds.marks(ocr_sheet([3, 1, 8], [[""], [""], [""]]), *[np.zeros(0)] * 2, np.zeros(0, bool))
    return sheet_folds._of_items(empty, np.repeat(np.arange(len(pages)), list(map(len, pages))), [i for own in pages for i in own])


def rows(m):
    return list(zip(*(c.tolist() for c in sheet_folds.columns(m)), strict=True))


def held_to(fast, slow):
    for seed in range(14):
        m = marked(odd_pages(seed))
        assert rows(fast(m)) == rows(sheet_folds._by_page(m, slow))


def test_suppression():
    held_to(sheet_folds.suppress, folds.suppress)


def whole_texts(spark, where):
    texts = [(1, "alpha be c\n\n gamma deltaepsilon ce 12\nalpha"), (2, ""), (3, None), (4, " "), (5, "x " * 90 + "\n" + "wide" * 60 + " y\nz чертежник чертежник два"), (-7, "é ß 𝒜𝒜𝒜𝒜 Đd.\n-b a- DS1 DS1 sel 3O1 CE")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{where}/documents.parquet")
    spark.createDataFrame([(i, f"http://a/{i}") for i in (1, 2, 5, 8)], "page_id long, url string").write.parquet(f"{where}/pages.parquet")


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    where = str(tmp_path_factory.mktemp("odd"))
    whole_texts(spark, where)
    return where


def plain_rows(spark, where, step):
    """What the plain fold makes of the table of detections."""
    half = lambda a, b: F.floor((F.col(a) + F.col(b)) / 2)
    from plotwright.operators.mapping import near_lattice

    items = catalogue.ocr_raw(spark, where).withColumns({"cx": half("x0", "x1"), "cy": half("y0", "y1"), "cut": near_lattice(F.col("x0"), F.col("x1"), F.lit(1126)) <= 6})
    return sorted(map(tuple, folds.per_page(items, step, ["l", "w", "k"]).collect()))


def check_query(spark, odd, name, step):
    query = catalogue.QUERIES[name](spark, odd)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan and "FlatMapGroups" not in plan
    got = sorted(map(tuple, query.collect()))
    assert got == plain_rows(spark, odd, step) and got


def test_nms_query(spark, odd):
    check_query(spark, odd, "nms", folds.suppress)


def test_line_merging():
    held_to(sheet_folds.merge_lines, folds.merge_lines)
    held_to(lambda m: sheet_folds.merge_lines(sheet_folds.suppress(m)), lambda items: folds.merge_lines(folds.suppress(items)))


def test_line_merge_query(spark, odd):
    check_query(spark, odd, "line_merge", lambda items: folds.merge_lines(folds.suppress(items)))


def test_page_result_query(spark, odd):
    """As the plan of single items has it, in one pass over the texts."""
    from plotwright.plans.page import page_results

    query = catalogue.QUERIES["page_result"](spark, odd)
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "FlatMapGroups" not in plan
    items = spark.createDataFrame(plain_rows(spark, odd, finished), f"page_id long, seq long, {folds.SCHEMA}")
    out = page_results(spark.read.parquet(f"{odd}/pages.parquet").select("page_id", F.col("url").alias("path")), items, items)
    want = out.select("page_id", "path", F.to_json("voltage_level").alias("voltage_level"), F.size("ocr").alias("n_items"), F.sha2(F.to_json("ocr"), 256).alias("ocr_sha256"))
    assert sorted(map(tuple, query.collect())) == sorted(map(tuple, want.collect())) and query.dtypes == want.dtypes


def test_dedupe():
    held_to(sheet_folds.dedupe, folds.dedupe)
    held_to(sheet_folds.finished, finished)


def test_dedupe_query(spark, odd):
    check_query(spark, odd, "dedupe_substrings", folds.dedupe)


def test_reconciliation():
    for seed in range(14):
        rng = random.Random(seed)
        m, w = marked(odd_pages(seed)), marked([own[:: 1 + n] for n, own in enumerate(odd_pages(seed + 14, 50))])
        w = w.take(np.flatnonzero(w.page != 1))  # a page without words is not swept
        # Some words stand where items stand, a little off.
        for n in range(0, len(w), 3):
            i = rng.choice(np.flatnonzero(m.page == w.page[n]).tolist())
            off = rng.choice([0.0, 3.0, 13.5, 60.0])
            w.x0[n], w.x1[n], w.y0[n], w.y1[n] = m.x0[i] + off, m.x1[i] + off, m.y0[i], m.y1[i]
            w.t[n] = w.texts.held.index(m.texts.held[m.t[i]]) if m.texts.held[m.t[i]] in w.texts.held else w.t[n]
        want = []
        for p in range(3):
            items, words = ([x.item(n) for n in np.flatnonzero(x.page == p).tolist()] for x in (m, w))
            want += [(p, i) for i in (folds.reconcile(items, [(x.text, x.box) for x in words]) if words else items)]
        assert rows(sheet_folds.reconcile(m, w)) == rows(sheet_folds._of_items(m, np.array([p for p, _ in want]), [i for _, i in want]))


def test_reconcile_pdf_query(spark, odd):
    from plotwright.plans.page import with_document_words

    query = catalogue.QUERIES["reconcile_pdf"](spark, odd)
    assert query._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    items = spark.createDataFrame(plain_rows(spark, odd, finished), f"page_id long, seq long, {folds.SCHEMA}")
    want = with_document_words(items, catalogue._words(spark, odd).withColumn("word_id", F.col("l") * 1_000_000 + F.col("w")))
    assert sorted(map(tuple, query.collect())) == sorted(map(tuple, want.collect())) and query.dtypes == want.dtypes


def test_texts_are_judged_by_their_characters(monkeypatch):
    """As the plain rules judge them, which are asked only where characters leave it open."""
    from plotwright.functions import plain

    rng = random.Random(5)
    odd = ["", *WORDS, *("".join(rng.choice("DdSsEeLlCcGgBb8tV019OI -_.,éſßŉﬆıД\n\x1f…") for _ in range(rng.randint(1, 7))) for _ in range(20_000))]
    texts = sheet_folds.Texts(odd)
    for got, rule in ((texts.normal(), plain.normal), (texts.invalid.tolist(), plain.invalid), (texts.guarded.tolist(), plain.guarded)):
        assert got == list(map(rule, odd))
    ordinary = sheet_folds.Texts(["word", "слово", "naïve,", "don't", "open2"])
    for name in ("normal", "invalid", "guarded"):
        monkeypatch.delattr(plain, name)
    assert ordinary.normal() == ordinary.held and not ordinary.invalid.any() and not ordinary.guarded.any()


@pytest.mark.parametrize("tall", [9, 400])
def test_meetings_are_swept_once(tall):
    """Areas that meet, by bands from the left; areas too unlike for bands go by cells."""
    rng = np.random.default_rng(tall)
    n = 300
    x0, y0 = rng.integers(-200, 900, n) / 2, rng.integers(0, 300, n) * 1.0
    x1, y1 = x0 + rng.integers(0, 90, n), y0 + rng.integers(0, 9, n)
    y1[::2] += rng.integers(0, tall * 10, (n + 1) // 2) * (tall > 9)
    m = marked([[folds.Item("a", (0, 0, 1, 1), (0, 0), 1.0)] * (n // 3)] * 3)
    swept = sheet_folds._swept(m.page, x0, y0, x1, y1)
    assert (swept is None) == (tall > 9)
    got = [p for a, b in sheet_folds.met(m, x0, y0, x1, y1) for p in zip(a.tolist(), b.tolist(), strict=True)]
    meet = lambda i, j: m.page[i] == m.page[j] and x0[i] <= x1[j] and x0[j] <= x1[i] and y0[i] <= y1[j] and y0[j] <= y1[i]
    assert sorted(got) == [(i, j) for i in range(n) for j in range(i + 1, n) if meet(i, j)]


def test_words_that_meet_several_items_are_settled_by_number(monkeypatch):
    """Crowds of items and words, also surer than sure ones: the plain fold's result, without the plain fold."""
    rng = random.Random(11)

    def crowd(n, confidence):
        return [folds.Item(rng.choice(WORDS[:14]), (x := rng.randint(0, 60), y := rng.randint(0, 30), x + rng.randint(1, 60), y + rng.randint(5, 18)), (x + rng.randint(0, 40), y + 5), rng.choice(confidence)) for _ in range(n)]

    tries = [[(crowd(rng.randint(1, 9), [0.2, 0.9, 1.0, 1.5]), crowd(rng.randint(1, 9), [1.0])) for _ in range(3)] for _ in range(40)]
    want = [rows(marked([folds.reconcile(items, [(x.text, x.box) for x in words]) for items, words in pages])) for pages in tries]
    monkeypatch.delattr(folds, "settle")
    for pages, rows_wanted in zip(tries, want, strict=True):
        m, w = (marked([p[n] for p in pages]) for n in (0, 1))
        assert rows(sheet_folds.reconcile(m, w)) == rows_wanted
