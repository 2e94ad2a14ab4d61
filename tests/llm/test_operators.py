"""Each training-data operator against a brute-force form, on odd rows: nulls, empty and long texts, ties, repeated rows, extra columns."""

import hashlib
import html
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from plotwright.llm import ann, bpe, components, html_text, license_scan, lm_score, packing, quality, secret_scan, simhash, tokens, url_filter

SMALL = "/root/testdata/sf0.001"
ODD = [
    (1, "one two three four five six seven"),
    (2, None),
    (3, ""),
    (3, ""),
    (4, " \n\t "),
    (5, "One two THREE four five six seven"),
    (None, "a text without an id, password=abcdefghijklmnop"),
    (7, "é ß Đ 😀 <|endoftext|> 日本 \x85 x  y   z \n\n w "),
    (8, "word " * 3000),
    (8, "another text of the same id AKIA" + "A" * 16),
    (9, "x" * 5000),
    (10, "1e9c654e721b4f812088970e token = 'abcdefghijkl'"),
]
#: Extra columns whose names clash with the operators' own, or with these in other letter case.
EXTRA = "h string, TEXT string, Doc_Id string, c0 string, fp string, word string"
SCHEMA = f"doc_id long, text string, {EXTRA}"


def with_extra(rows):
    return [(i, t, "h", "other", "9", "c", "f", "w") for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(with_extra(ODD), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def real(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


def table(spark, name):
    return spark.read.parquet(f"{SMALL}/{name}.parquet")


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


# ---- 1 and 6: tokens ------------------------------------------------------------------------------------------------------


def ids_of(text):
    return tokens.library(tokens.default_tokenizer()).encode(text or "", add_special_tokens=False).ids


def packed_right(rows, texts, size=1024):
    by_bin, by_doc = {}, {}
    for r in rows:
        by_bin.setdefault(r.sequence_id, []).append((r.offset, r.length))
        by_doc.setdefault(r.doc_id, []).append((r.piece, r.start, r.length, r.ids_crc32))
    for places in by_bin.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= size
    want = Counter()
    for i, t in texts:
        ids = [*ids_of(t), 2]
        raw = struct.pack(f"<{len(ids)}I", *ids)
        for k, (start, n) in enumerate(packing.cut(len(ids), size)):
            want[i, k, start, n, zlib.crc32(raw[4 * start : 4 * (start + n)])] += 1
    assert want == Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows)
    return len(by_bin)


def test_packing(spark, docs, none, real):
    packed_right(packing.pack(docs).collect(), ODD)
    bins = packed_right(packing.pack(table(spark, "documents")).collect(), real.items())
    least = -(-sum(len(ids_of(t)) + 1 for t in real.values()) // 1024)
    assert bins <= least + 4
    assert packing.pack(none).collect() == []


LONG_RUNS = [" " * 2_000_000, "\n" * 2_000_000, "\t" * 2_000_000 + "x", "a" * 2_000_000, "123" * 700_000]


def test_very_long_runs(spark):
    """Texts of one kind of character alone: the same ids as the library's, and nothing fails."""
    rows = list(enumerate(LONG_RUNS))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(len(rows))
    packed_right(packing.pack(docs).collect(), rows)
    for r in bpe.round_trip(docs).collect():
        ids = ids_of(LONG_RUNS[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in secret_scan.scan(docs).collect()) == Counter((i, *brute_secrets(t)) for i, t in rows)
    assert all(r.n_matches == 0 for r in license_scan.scan(docs).collect())
    assert {r.doc_id: r.n_tokens for r in lm_score.score(docs).collect()} == {0: 1, 1: 1, 2: 2, 3: 2, 4: 2}
    prints = {r.doc_id: r.fingerprint for r in simhash.near_duplicates(docs).collect()}
    assert prints == {i: f"{brute_fingerprint(t):016x}" for i, t in rows}


def test_best_fit_takes_the_tightest_bin():
    bins, offsets, fills = packing.pack_lengths([6, 5, 4, 3, 2], 10)
    assert sorted(fills) == [10, 10] and bins[0] == bins[2] and offsets[2] == 6
    assert packing.cut(2500, 1024) == [(0, 452), (452, 1024), (1476, 1024)] and packing.cut(1024, 1024) == [(0, 1024)] and packing.cut(1, 1024) == [(0, 1)]


def test_round_trip(spark, docs, none):
    tok = tokens.library(tokens.default_tokenizer())
    rng = random.Random(1)
    parts = ["a", "b", "1", " ", "  ", "\n", "\t", "'s", "é", "ß", "<|endoftext|>", "²", "\xa0", "日本", "😀", "\x85", "-", "!!", "_", "the", "ing", " of", "՘", "२", "İ"]
    texts = [t for _, t in ODD] + ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(1500)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in bpe.round_trip(rows).collect():
        ids = ids_of(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(tok.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.round_trip(docs).count() == len(ODD) and bpe.round_trip(none).count() == 0


def test_every_old_character_is_classed_alike():
    tok, coder, quick = tokens.library(tokens.default_tokenizer()), bpe.coder(tokens.default_tokenizer()), packing.Tokeniser(tokens.default_tokenizer())
    chars = [chr(c) for c in range(0x3400) if not tokens.in_doubt(chr(c))]
    probes = [f"a{c}1{c}-{c} -" for c in chars]
    for p, e in zip(probes, tok.encode_batch(probes, add_special_tokens=False), strict=True):
        assert coder.encode(p) == e.ids and np.frombuffer(quick(p), "<u4").tolist() == e.ids


# ---- 2 --------------------------------------------------------------------------------------------------------------------


def test_nearest(spark):
    rng = np.random.default_rng(3)
    some = [rng.standard_normal(16).astype(np.float32).tolist() for _ in range(400)]
    rows = [(i, v) for i, v in enumerate(some)] + [(1000 + i, some[0]) for i in range(60)] + [(2000, None), (2020, [0.0] * 16), (2040, [1.0] * 15 + [None]), (2060, [float("nan")] * 16), (2080, [1.0, 2.0]), (None, some[1]), (40, some[40]), (2100, [])]
    got = {}
    for r in ann.nearest(spark.createDataFrame([(i, v, "z") for i, v in rows], "vec_id long, embedding array<float>, Vec string"), 20, 20).collect():
        got.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    usable = {(i, tuple(v)) for i, v in rows if i is not None and v and None not in v and all(map(math.isfinite, v)) and any(v)}
    asked = {(i, v) for i, v in usable if i % 20 == 0}
    hit = total = 0
    for q, v in asked:
        want = sorted((-float(np.dot(np.array(v, float), np.array(u, float))), i) for i, u in usable if i != q and len(u) == len(v))[:20]
        mine = [got.get(q, {})[k] for k in range(1, len(want) + 1)]
        assert len(got.get(q, {})) == len(want)
        hit += sum(a[0] == b[1] for a, b in zip(mine, want, strict=True))
        total += len(want)
        assert all(abs(a[1] + b[0]) < 1e-9 for a, b in zip(mine, want, strict=True) if a[0] == b[1])
    assert hit >= 0.98 * total
    assert 2080 not in got and 2020 not in got
    assert ann.nearest(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_nearest_is_the_same_for_any_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    some = [rng.standard_normal(8 + 8 * (i % 2)).astype(np.float32).tolist() for i in range(300)]
    rows = spark.createDataFrame([(i, some[i % 250]) for i in range(600)] + [(40, some[40])] * 3, "vec_id long, embedding array<float>")
    want = sorted(ann.nearest(rows, 5, 3).collect())
    for size, merge, step in ((4096, 3, 7), (700, 64, 1)):
        monkeypatch.setattr(ann, "BLOCK_BYTES", size)
        monkeypatch.setattr(ann, "MERGE", merge)
        monkeypatch.setattr(ann, "STEP", step)
        got = sorted(ann.nearest(rows, 5, 3).collect())
        assert [r[:3] for r in got] == [r[:3] for r in want] and np.allclose([r[3] for r in got], [r[3] for r in want])


def test_estimates_keep_their_bound():
    rng = np.random.default_rng(5)
    v, q = rng.standard_normal((800, 64)), rng.standard_normal((50, 64))
    codes, _, along = ann.encode(v)
    cos, bound = ann.estimates(codes, along, q)
    true = (q / np.linalg.norm(q, axis=1)[:, None]) @ (v / np.linalg.norm(v, axis=1)[:, None]).T
    assert (np.abs(cos - true) <= bound).mean() > 0.995


# ---- 3 --------------------------------------------------------------------------------------------------------------------


def test_url_rules(spark):
    urls = [None, "no scheme", "http://Example.ORG/es/1?x", "https://a.b.org", "http://a.org/x#y", "ftp://x.com/fr/", "http://x.com:80/fr/", "http://y.example.org/en/12", "://?", "http://x.com/de/é/", "http://notorg/", "http://q.net/?a://b", "a://b://c/d"]
    rows = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, URL2 int")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: tuple(r)[1:5] for r in url_filter.judge(rows, labels).collect()}
    want = [("", "", None, "allow"), ("", "", None, "allow"), ("example.org", "/es/1", "example.org/es/", "block"), ("a.b.org", "", None, "allow"), ("a.org", "/x", "org/", "allow"), ("x.com", "/fr/", "com/fr/", "allow"), ("x.com:80", "/fr/", None, "allow"), ("y.example.org", "/en/12", "example.org/en/1", "block"), ("", "", None, "allow"), ("x.com", "/de/é/", "com/de/", "block"), ("notorg", "/", None, "allow"), ("q.net", "/", None, "allow"), ("b:", "//c/d", None, "allow")]
    assert [got[i] for i in range(len(urls))] == want
    assert url_filter.judge(rows.limit(0), labels).count() == 0


def judged_urls(spark, pages, labels):
    """page -> (verdict, posterior, bound), and the same by plain loops over hosts, domains and suffixes."""
    rows = spark.createDataFrame([(i, u, "x", 1) for i, u in pages], "page_id long, url string, URL string, host int")
    got = {r.page_id: (r.verdict, r.posterior, r.bound) for r in url_filter.judge(rows, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    marks = {}
    for i, q, t in labels:
        if i is not None:
            marks[i] = max(marks.get(i, 0), int(q == 0 or t == 1))
    host = {i: re.search("://([^/?#]*)", u)[1] for i, u in pages}
    keys = lambda h: (h, ".".join(h.split(".")[-2:]), h.split(".")[-1])
    n = [Counter(), Counter(), Counter()]
    bad = [Counter(), Counter(), Counter()]
    for i, _ in pages:
        if i in marks:
            for k, x in enumerate(keys(host[i])):
                n[k][x] += 1
                bad[k][x] += marks[i]
    mean = (sum(bad[2].values()) + 1) / (sum(n[2].values()) + 2)
    parent, strength = {x: mean for x in n[2]}, [0.0] * 3
    post = [{}, {}, {}]
    for level in (2, 1, 0):
        total, squares = sum(n[level].values()), sum(v * v for v in n[level].values())
        spread = sum(v * (bad[level][x] / v - parent[x]) ** 2 for x, v in n[level].items())
        within = sum(v * parent[x] * (1 - parent[x]) for x, v in n[level].items()) / total
        k = 1000.0
        if total * total != squares and (between := (spread - (len(n[level]) - 1) * within) / (total - squares / total)) > 0:
            k = min(1000.0, max(1.0, within / between - 1))
        strength[level] = k
        post[level] = {x: (k * parent[x] + bad[level][x]) / (k + v) for x, v in n[level].items()}
        if level:
            parent = {x: post[level][keys(x)[level]] for x in n[level - 1]}
    want = {}
    for i, _ in pages:
        h, d, s = keys(host[i])
        if h in post[0]:
            p, m = post[0][h], strength[0] + n[0][h]
        elif d in post[1]:
            p, m = post[1][d], strength[0]
        elif s in post[2]:
            p, m = post[2][s], strength[1]
        else:
            p, m = mean, strength[2]
        low = p - url_filter.DEVIATIONS * math.sqrt(p * (1 - p) / (m + 1))
        want[i] = ("block" if round(low, 6) > url_filter.LIMIT else "allow", p, low)
    return got, want


def test_host_domain_and_suffix_decide(spark):
    """Labelled hosts by their own outcomes; others by their domain's, and those of unknown domains by their suffix's."""
    pages, labels = [], [(None, 0, 1), (99_999, 0, 1)]
    for h, share in (("bad.mixed.net", 0.95), ("good.mixed.net", 0.05), *((f"h{k}.vile.info", 0.95) for k in range(6)), *((f"h{k}.fine.info", 0.02) for k in range(6)), *((f"a{k}.d{k}.junk", 1.0) for k in range(12))):
        for k in range(40):
            labels.append((len(pages), int(k >= share * 40), 0))
            pages.append((len(pages), f"http://{h}/{k}"))
    first = len(pages)
    pages += [(first + i, f"http://{h}/new") for i, h in enumerate(("bad.mixed.net", "good.mixed.net", "new.mixed.net", "new.vile.info", "new.fine.info", "new.unknown.junk", "new.unknown.info", "x.nowhere"))]
    got, want = judged_urls(spark, pages, labels)
    assert {i: g[0] for i, g in got.items()} == {i: w[0] for i, w in want.items()}
    assert all(abs(got[i][k] - want[i][k]) < 2e-6 for i in want for k in (1, 2))
    assert [got[first + i][0] for i in range(8)] == ["block", "allow", "allow", "block", "allow", "block", "allow", "allow"]


def test_repeated_pages_are_judged_each(spark):
    rows = spark.createDataFrame([(1, "http://a.net/"), (1, "http://a.net/"), (None, None)], "page_id long, url string")
    labels = spark.createDataFrame([(1, 0, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    got = sorted((str(r.page_id), r.host, r.verdict, r.posterior) for r in url_filter.judge(rows, labels).collect())
    assert len(got) == 3 and got[0] == got[1] and got[0][3] > 0.5


# ---- 4 --------------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("<article><p>a < b &amp; c&lt;p&gt;  d\n e<b>f</b></p><!-- no --><script>if (a<b) {}</script><p>g</article><footer>x</footer>", "a < b & c<p> d ef\ng"),
        ("<nav><a href=x>Menu</a></nav><main><h1>T</h1><aside>side note</aside><form>name</form><p>One.</p><div class='comments'><p>so true</p></div></main>", "T\nOne."),
        ("<p>plain only", "plain only"),
        ('<div "open <p>hello world</p>', "hello world"),
        ("<!-- never closed <p>x</p>", ""),
    ],
)
def test_main_text(page, text):
    assert html_text.main_text(page) == text


def test_extract(spark):
    rows = spark.createDataFrame([(1, "u", None, "x"), (1, "u", None, "x"), (2, None, "<article><p>hé</p></article>", "y")], "page_id long, url string, html string, HTML string")
    got = sorted(tuple(r) for r in html_text.extract(rows).collect() if r.page_id == 2) + [html_text.extract(rows).count(), html_text.extract(rows.limit(0)).count()]
    assert got == [(2, None, "hé", 2), 3, 0]


def brute_text(page):
    """The blocks between an article's tags, by expressions alone; the test pages have one article each."""
    found = re.search("<article>(.*?)</article>", page, re.S)
    parts = re.split(r"</?(?:p|h1|br|div|li|ul)\b[^>]*>", found[1]) if found else []
    cleaned = [" ".join(html.unescape(re.sub("<[^>]+>", "", x)).split()) for x in parts]
    return "\n".join(x for x in cleaned if x)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_articles_of_the_test_pages(spark, scale):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"/root/testdata/{scale}/pages.parquet").collect()}
    got = {r.page_id: (r.text, r.n_chars) for r in html_text.extract(spark.read.parquet(f"/root/testdata/{scale}/pages.parquet")).collect()}
    assert got == {i: (t := brute_text(p), len(t)) for i, p in pages.items()}


def test_blocks_of_pages_that_the_tree_has_not_seen():
    """Held-out accuracy; what tags and names alone would say is wrong far more often."""
    rows, keep = html_text.labelled_rows(html_text.labelled_pages(300, seed=99))
    said = html_text.tree().judge(rows)
    named = (rows[:, html_text.FEATURES.index("around")] == 0) & (rows[:, html_text.FEATURES.index("place")] >= 0)
    assert (said == keep).mean() > 0.985 and (named == keep).mean() < 0.9 and (named != said).mean() > 0.1


def test_features_and_tree_against_plain_loops():
    found = html_text.blocks("<nav><a href=x>one two</a></nav><div class=sidebar>a b <a href=y>c</a></div><main><h1>T</h1><p>d e f g</p></main>")
    rows = html_text.features(found)
    for i, b in enumerate(found):
        near = [x for k, x in enumerate(found) if k != i and abs(k - i) <= 2]
        side = lambda k: (found[k].words, found[k].linked / found[k].words) if 0 <= k < len(found) else (0, 0)  # noqa: E731, B023
        alike = sum(x.words - x.linked for x in found if x.around == b.around) / sum(x.words - x.linked for x in found)
        want = (b.words, b.linked / b.words, *side(i - 1), *side(i + 1), sum(x.words for x in near), sum(x.linked for x in near) / sum(x.words for x in near), b.heading, b.around, alike, 1 if b.inside else -1)
        assert np.allclose(rows[i], want)
    rng = np.random.default_rng(1)
    rows, keep = rng.integers(0, 6, (60, 3)).astype(float), rng.random(60) < 0.5

    def grown(rows, keep, depth, least):
        if depth == 0 or keep.all() or not keep.any():
            return bool(keep.mean() >= 0.5)
        best = None
        for f in range(rows.shape[1]):
            for low, high in zip(sorted(set(rows[:, f])), sorted(set(rows[:, f]))[1:], strict=False):
                below = rows[:, f] < (low + high) / 2
                if min(below.sum(), (~below).sum()) >= least:
                    impurity = sum(len(k) * k.mean() * (1 - k.mean()) for k in (keep[below], keep[~below])) / len(keep)
                    if best is None or impurity < best[0] - 1e-12:
                        best = (impurity, f, (low + high) / 2, below)
        if best is None:
            return bool(keep.mean() >= 0.5)
        _, f, c, below = best
        return f, c, grown(rows[below], keep[below], depth - 1, least), grown(rows[~below], keep[~below], depth - 1, least)

    def judged(t, row):
        while not isinstance(t, bool):
            t = t[2] if row[t[0]] < t[1] else t[3]
        return t

    for depth, least in ((3, 1), (8, 3)):
        t = grown(rows, keep, depth, least)
        assert html_text.Tree.grow(rows, keep, depth, least).judge(rows).tolist() == [judged(t, r) for r in rows]


# ---- 5 --------------------------------------------------------------------------------------------------------------------


def brute_counts(text):
    words = words_of(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), sum(x in lines[:i] for i, x in enumerate(lines)), len(inside)


def test_quality(spark, docs, none, real):
    labels = table(spark, "labels")
    good = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.judged(table(spark, "documents"), labels).collect()
    for r in rows:
        c = brute_counts(real[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == c
        assert r.base_failed == (c[0] < 50 or 100 * c[4] > 50 * c[0]) and not (r.base_failed and r.kept)
    fit = [(r.kept, good[r.doc_id]) for r in rows if r.doc_id in good and not r.base_failed]
    assert sum(k == (q == 1) for k, q in fit) >= 0.98 * len(fit)
    judge = quality.judge_from_labels(table(spark, "documents"), labels)
    for r in rows:
        counts, rates = quality.statistics(real[r.doc_id])
        failed, kept, score = judge(np.array([counts]), np.array([rates]))
        assert (r.base_failed, r.kept) == (failed[0], kept[0]) and abs(r.anomaly - score[0]) < 1e-12
    odd = quality.judged(docs, labels).collect()
    assert sorted(map(str, (tuple(r)[:6] for r in odd))) == sorted(map(str, ((i, *brute_counts(t)) for i, t in ODD)))
    assert quality.judged(none, labels).count() == 0 == quality.judged(none, labels.limit(0)).count()
    assert quality.keep_good(table(spark, "documents"), labels).count() == sum(r.kept for r in rows)


def test_rates():
    counts, rates = quality.statistics("Ab1 c#d $$ x\n\nx\nx")
    chars = 3 + 3 + 2 + 1 + 1 + 1
    assert counts == (6, chars, 3, 1, 0)
    assert np.allclose(rates, (chars / 6, 3 / 6, 2 / 6, 1 / 3, 0, 1 / chars, 3 / chars, 1 - 4 / chars))


def test_path_lengths_against_a_plain_walk():
    rng = np.random.default_rng(8)
    rows = np.vstack([rng.normal(0, 1, (300, 4)), rng.normal(12, 1, (3, 4))])
    f = quality.IsolationForest.grow(rows, trees=50, subsample=128, seed=1)
    usual = lambda n: 0.0 if n < 2 else 2 * (sum(1 / k for k in range(1, n))) - 2 * (n - 1) / n
    score = f.score(rows)
    for i in rng.choice(len(rows), 20):
        total = 0.0
        for root in f.roots:
            at, steps = int(root), 0
            while f.feature[at] >= 0:
                at = int(f.child[at]) + int(rows[i, f.feature[at]] >= f.cut[at])
                steps += 1
            assert steps <= f.length[at] <= steps + usual(128) + 0.1
            total += f.length[at]
        assert abs(score[i] - 2 ** (-total / 50 / f.scale)) < 1e-12
    assert abs(f.scale - usual(128)) < 0.02 and score[300:].min() > np.sort(score[:300])[-4]


def test_threshold_against_every_cut():
    rng = np.random.default_rng(9)
    for _ in range(30):
        score, good = rng.integers(0, 12, 40) / 12, rng.random(40) < 0.8
        if not good.any():
            continue
        gain = lambda t: -1.0 if (lost := (score[good] >= t).mean()) > 0.1 else (score[~good] >= t).mean() * (not good.all()) - quality.WEIGHT * lost if (~good).any() else -quality.WEIGHT * lost  # noqa: E731, B023
        cuts = [*sorted(set(score)), 1.1]
        assert abs(gain(quality.threshold_of(score, good, 0.1)) - max(map(gain, cuts))) < 1e-12


def test_every_labelled_row_counts_in_the_forest(spark, monkeypatch):
    """With few draws the trees' cuts are as few, but path lengths and threshold are those of all labelled rows."""
    monkeypatch.setattr(quality, "TREES", 3)
    monkeypatch.setattr(quality, "SUBSAMPLE", 4)
    docs, labels = table(spark, "documents"), table(spark, "labels")
    seen = {}
    settled, threshold = quality.IsolationForest.settled, quality.threshold_of
    monkeypatch.setattr(quality.IsolationForest, "settled", lambda self, share: seen.setdefault("forest", settled(self, seen.setdefault("share", share))))
    monkeypatch.setattr(quality, "threshold_of", lambda score, good, loss, times: (seen.update(tested=times.sum()), threshold(score, good, loss, times))[1])
    judge = quality.judge_from_labels(docs, labels)
    rows = [(r.doc_id, r.quality, r.h, *quality.statistics(r.text)) for r in docs.join(labels, "doc_id").selectExpr("doc_id", "quality", "text", "xxhash64(doc_id) h").collect()]
    rows = [r for r in rows if not quality.failed_base(np.array([r[3]]))[0]]
    grown = [r for r in rows if r[2] % 2 == 0]
    assert seen["tested"] == len(rows) - len(grown) and len(grown) > 3 * 4
    good = np.array([r[1] == 1 for r in grown])
    weight = np.where(good, 1.0, min(1.0, max(1.0, quality.FEW_BAD * good.sum()) / max(1, (~good).sum())))
    for at in judge.forest.leaves(quality.scaled(np.array([r[4] for r in grown]))):
        want = np.bincount(at, weight, len(judge.forest.feature)) / weight.sum()
        assert np.allclose(seen["share"][np.unique(at)], want[np.unique(at)])


def test_no_row_both_grows_and_calibrates(spark):
    """Held-out rows: bad ones are caught, good ones left alone."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for n in ("documents", "labels"))
    known = labels.where("pmod(doc_id, 2) = 0")
    quality_of = {r.doc_id: r.quality for r in labels.where("pmod(doc_id, 2) = 1").collect()}
    odd = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    rows = [(r.kept, quality_of[r.doc_id]) for r in quality.judged(odd, known).collect() if r.doc_id in quality_of and not r.base_failed]
    kept = [k for k, q in rows if q == 1]
    caught = [not k for k, q in rows if q == 0]
    assert sum(kept) >= 0.985 * len(kept) and sum(caught) >= 0.97 * len(caught)


# ---- 7 --------------------------------------------------------------------------------------------------------------------

_BRUTE = (
    ("assign", re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A), lambda m: len(m[2]) >= 12),
    ("access", re.compile("AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 18),
    ("hex", re.compile("[0-9a-f]+"), lambda m: len(m[0]) >= 16),
)


def brute_secrets(text):
    found = sorted((m.start(), k, m.end(), name) for k, (name, p, fit) in enumerate(_BRUTE) for m in p.finditer(text or "") if fit(m))
    said = ",".join(f"{n}:{a}:{b}" for a, _, b, n in found)
    return *(sum(f[1] == k for f in found) for k in range(3)), hashlib.sha256(said.encode()).hexdigest()


def test_secrets(spark, docs, none):
    rng = random.Random(3)
    parts = ["password", "Secret", "token", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "0123456789ab", "AKIA", "ABCDEFG", "deadbeef", "\n", "é", "😀", "+/_.", "z"]
    rows = ODD + [(100 + i, "".join(rng.choices(parts, k=rng.randint(0, 25)))) for i in range(800)] + [(1, "secret=token:abcdefghijklmnop")]
    got = secret_scan.scan(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == Counter((i, *brute_secrets(t)) for i, t in rows)
    clean = secret_scan.redact(docs)
    assert clean.columns == docs.columns and clean.count() == len(ODD)
    assert all(brute_secrets(r.text)[:3] == (0, 0, 0) for r in clean.collect())
    assert secret_scan.scan(none).count() == secret_scan.redact(none).count() == 0


def brute_spans(text, rules):
    found = []
    for k, rule in enumerate(rules):
        flags = re.A | (re.I if rule.ignore_case else 0)
        found += [(m.start(), k, m.end()) for m in re.finditer(rule.pattern, text or "", flags) if not rule.value or re.fullmatch(rule.value, m[0], flags)]
    return sorted(found)


def test_spans_of_all_rules(spark):
    """Every rule's spans against all matches in all texts; with more rules than one mask of trigrams can hold too."""
    rng = random.Random(17)
    parts = [
        "-----BEGIN ", "RSA ", "EC ", "PRIVATE KEY-----", "ghp_", "gho_", "A1b2C3d4E5f6" * 3, "xoxb-", "xoxp-", "123456-abcDEF", "eyJ", "hbGciOiJ9_-x", ".", "AIza", "Sy_-7" * 7,
        "postgres", "https", "://", "user", ":", "pass!w0rd", "@", "/", " ", "\n", "AKIA", "ABCDEFGHIJ0123456", "token", "=", "0123456789abcdef", "é", "😀", "x",
    ]
    whole = ["-----BEGIN PRIVATE KEY-----", "-----BEGIN EC PRIVATE KEY-----", "ghs_" + "aB3" * 13, "xoxa-1234567890", "eyJabcdefgh.ijklmnop_.qrstuvwx-", "AIza" + "a1_-B" * 7, "ftp://me:secret=1@host"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(600)]
    texts += ["".join(x for _ in range(4) for x in (rng.choice(parts), rng.choice(whole), rng.choice([" ", "\n", ""]))) for _ in range(300)] + [None, ""]
    more = [secret_scan.Rule(f"word{i}", "".join(rng.choices("abcdefgh", k=7)) + "[0-9]{2,}") for i in range(30)]
    texts += [" ".join(r.pattern[:7] + str(rng.randint(0, 999)) for r in rng.sample(more, 5)) for _ in range(100)]
    rows = [(i // 2, t) for i, t in enumerate(texts)] + [(0, texts[0]), (None, texts[1]), (None, texts[601])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    kinds = [r.kind for r in secret_scan.RULES]
    want = [(i, ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in brute_spans(t, secret_scan.RULES))) for i, t in rows]
    assert Counter((r.doc_id, r.spans) for r in secret_scan.scan(docs).collect()) == Counter(want)
    assert {k for k in kinds if any(f"{k}:" in s for _, s in want)} == set(kinds)

    rules = (*secret_scan.RULES, *more)
    assert len(set().union(*(secret_scan.trigrams(secret_scan.trigram_query(r)) for r in rules))) > 2 * secret_scan.MASK
    got = {(r.doc_id, r.rule, r.start, r.end) for r in secret_scan.spans(docs, rules).collect()}
    assert got == {(i, k, a, b) for i, t in rows for a, k, b in brute_spans(t, rules)}


def test_trigram_queries():
    for rule in secret_scan.RULES:
        query = secret_scan.trigram_query(rule)
        assert (query is True) == (rule.kind == "hex")
    assert {"aki", "kia"} == secret_scan.trigrams(secret_scan.trigram_query(secret_scan.BASE[1]))


# ---- 8 --------------------------------------------------------------------------------------------------------------------


def test_licenses(spark, docs, none, real):
    known = license_scan.templates()
    for t, (_, text) in enumerate(license_scan.TEMPLATES):
        words = license_scan.words_of(text)
        near = " ".join([*words[: len(words) // 2], "changed", *words[len(words) // 2 + 1 :]]) if len(words) > 60 else text
        assert t in {m[0] for m in known.find(f"some words before {near} and some behind")}
    lines = [x for n, x in license_scan.TEMPLATES if len(x) < 90]
    for text in real.values():
        assert bool(known.find(text)) == any(x in text for x in lines)
    assert all(r.n_matches == 0 for r in license_scan.scan(docs).collect()) and license_scan.scan(none).count() == 0
    assert 1 - (1 - license_scan.SIMILAR**license_scan.ROWS) ** license_scan.BANDS > 0.999


def test_license_bands_follow_from_containment():
    """A window of the template's size that holds 0.8 of its shingles has a Jaccard similarity of 0.8 / 1.2."""
    assert 1 - (1 - (0.8 / 1.2) ** license_scan.ROWS) ** license_scan.BANDS > 0.9999


def test_license_windows_against_all_windows():
    """Changed templates among other words: every window of every template's size, by exact containment."""
    known, rng = license_scan.templates(), random.Random(8)
    missed = total = 0
    for _ in range(25):
        parts = []
        for t in rng.sample(range(len(license_scan.TEMPLATES)), 2):
            words = license_scan.words_of(license_scan.TEMPLATES[t][1])
            for _ in range(rng.randint(0, max(1, len(words) // 30))):
                words[rng.randrange(len(words))] = "changed"
            parts += [*(f"w{rng.randrange(50)}" for _ in range(rng.randint(0, 9))), *words]
        text = " ".join(parts)
        words, found = license_scan.words_of(text), known.find(text)
        for t, (_, template) in enumerate(license_scan.TEMPLATES):
            want = known.shingles[t]
            n = len(license_scan.words_of(template))
            shares = [len(want & set(license_scan.shingles(words[a : a + n]))) / len(want) for a in range(max(1, len(words) - n + 1))]
            mine = [(a, m, s) for x, a, m, s in found if x == t]
            assert all(abs(shares[a] - s) < 1e-12 and s >= 0.8 for a, _, s in mine)
            assert all(abs(a - b) >= n for i, (a, _, _) in enumerate(mine) for b, _, _ in mine[:i])
            if max(shares) >= 0.8:
                total += 1
                missed += not mine or max(s for *_, s in mine) < max(shares) - 1e-12
    assert total > 40 and missed == 0


def test_a_line_repeated_many_times():
    assert len(license_scan.templates().find("Released under the MIT License.\n" * 5000)) == 5000


# ---- 9 --------------------------------------------------------------------------------------------------------------------


def brute_base(rows):
    cut = [(i, [w.encode() for w in words_of(lowered(t))] + [b"\n"]) for i, t in rows]
    counts = Counter(w for i, ws in cut if zlib.crc32(b"" if i is None else str(i).encode()) % 10 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return [(i, len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)) for i, ws in cut]


def test_lm_score(spark, docs, none, real):
    key = lambda r: (str(r[0]), r[1], r[2], r[3], round(r[4], 6))
    got = lm_score.score(docs).collect()
    assert sorted(key((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in got) == sorted(map(key, brute_base(ODD)))
    rows = lm_score.score(table(spark, "documents")).collect()
    assert sorted(key((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score)) for r in rows) == sorted(map(key, brute_base(real.items())))
    assert lm_score.score(none).count() == 0
    held = [r for r in rows if r.held_out]
    bits = -sum(r.score for r in held) / math.log10(2) / sum(r.n_bytes for r in held)
    assert bits < order_two_bits(real) - 0.1 and sum(r.score > r.base_score for r in held) > 0.3 * len(held)


def order_two_bits(texts):
    """Bits per byte of the held-out texts under counts of the last two bytes, interpolated with those of one and none."""
    flat = lambda t: b" ".join([w.encode() for w in words_of(lowered(t))] + [b"\n"])
    seen = [Counter(), Counter(), Counter()]
    tops = [Counter(), Counter(), Counter()]
    total = n = 0
    for held in (False, True):
        for i, t in texts.items():
            if (zlib.crc32(str(i).encode()) % 10 == 0) != held:
                continue
            x = b"\n\n" + flat(t)
            for at in range(2, len(x)):
                p = 1 / 256
                for k in range(3):
                    c = x[at - k : at]
                    if held:
                        p = (seen[k][c, x[at]] + 4 * p) / (tops[k][c] + 4)
                    else:
                        seen[k][c, x[at]] += 1
                        tops[k][c] += 1
                total -= math.log2(p) if held else 0
            n += len((t or "").encode()) if held else 0
    return total / n


def spelled(word):
    return word if word == b"\n" else word + b" "


def brute_scores(rows, weights, refined):
    """Scores by plain loops over texts, bytes and bits, with contexts as they are instead of hashed."""
    docs = [(i, [w.encode() for w in words_of(lowered(t))] + [b"\n"]) for i, t in rows]

    def contexts(before, token, p):
        tail = b"\0\0\n" if before is None else before[-3:].rjust(3, b"\0")
        if p < 3:
            seq = tail + b" " + token[:p]
            return [*((k, seq[-k:]) for k in range(1, 5)), ("across", p, tail, token[:p]), ("opening", token[:p])]
        seq = b" " + token[:p]
        return [*((k, seq[-k:]) for k in range(1, 5)), None, ("whole", token[:p]) if p < lm_score.HEAD else ("none",)]

    def steps(words):
        for before, word in zip([None, *words], words, strict=False):
            token = spelled(word)
            yield [(contexts(before, token, p), p, token[p]) for p in range(len(token))]

    counts = Counter()
    for i, words in docs:
        if zlib.crc32(b"" if i is None else str(i).encode()) % 10:
            for token in steps(words):
                for cs, _, byte in token:
                    for k in range(8):
                        for c in cs:
                            if c not in (None, ("none",)):
                                counts[c, byte >> 8 - k, k, byte >> 7 - k & 1] += 1
    out = []
    for _, words in docs:
        met, again, total = Counter(), 0, 0.0
        for at, (word, token) in enumerate(zip(words, steps(words), strict=True)):
            ln_word = 0.0
            for cs, p, byte in token:
                for k in range(8):
                    bit, logits, sure = byte >> 7 - k & 1, [], []
                    for c in cs:
                        pair = [counts[c, byte >> 8 - k, k, v] for v in (0, 1)]
                        if c is not None and c[0] not in ("whole", "none"):
                            pair = [2 ** (min(255, round(8 * math.log2(1 + n))) / 8) - 1 for n in pair]
                        logits.append(0.0 if c is None else math.log((pair[1] + lm_score.PRIOR) / (pair[0] + lm_score.PRIOR)))
                        sure.append((sum(pair) > 0.5) + (sum(pair) > 6))
                    gate = ((min(p, 3) * 3 + sure[3]) * 3 + sure[4 if p < 3 else 5]) * 8 + k
                    x = max(-12.0, min(12.0, sum(w * v for w, v in zip(weights[gate], logits, strict=True))))
                    place = max(0.0, min(lm_score.BUCKETS - 1.001, (x + 8) * 2))
                    low = int(place)
                    said = refined[gate, low] * (low + 1 - place) + refined[gate, low + 1] * (place - low)
                    one = max(1e-6, min(1 - 1e-6, 0.75 / (1 + math.exp(-x)) + 0.25 * said))
                    ln_word += math.log(one if bit else 1 - one)
            share = lm_score.CACHE * again / (at + lm_score.CACHE_PRIOR)
            own = share * met[word] / max(at, 1)
            total += math.log10((1 - share) * math.exp(ln_word) + own) if own or ln_word > -600 else (math.log1p(-share) + ln_word) / math.log(10)
            again += met[word] > 0
            met[word] += 1
        out.append(total)
    return out


def test_scores_against_plain_loops(spark, monkeypatch):
    """Given weights and map, with groups and shares of a few words and long tokens in pieces."""
    monkeypatch.setattr(lm_score, "GROUP_WORDS", 7)
    monkeypatch.setattr(lm_score, "SHARE_OPENINGS", 9)
    monkeypatch.setattr(lm_score, "TABLES", tuple((name, 21, 21) for name, _, _ in lm_score.TABLES))  # next to no slot is shared
    rng = np.random.default_rng(6)
    weights = rng.normal(0.3, 0.2, (lm_score.GATES, lm_score.INPUTS))
    refined = np.sort(rng.uniform(0.01, 0.99, (lm_score.GATES, lm_score.BUCKETS)), axis=1)
    monkeypatch.setattr(lm_score, "_fit", lambda *_: (weights, refined))
    words = ["a", "ab", "abc", "abcd", "abca", "b" * 31, "b" * 32, "b" * 33, "bbbbbc", "c" * 150, "é", "ßx", "abcdefghijkl", "The", "of"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 14)))) for i in range(40)] + [(60, "d" * 33_000 + " of"), (None, "ab of"), (3, None), (50, "x\0y \0")]
    got = lm_score.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    want = sorted((str(i), round(x, 3)) for (i, _), x in zip(rows, brute_scores(rows, weights, refined), strict=True))
    off = [abs(a[1] / b[1] - 1) if a[0] == b[0] else 1 for a, b in zip(sorted((str(r.doc_id), r.score) for r in got), want, strict=True)]
    assert max(off) < 0.01 and sum(x > 0.0005 for x in off) <= 0.1 * len(off), off


def test_scores_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "GROUP_WORDS", 1500)
    docs, said = table(spark, "documents"), []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in (4, 16, 211):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            said.append({r.doc_id: r.score for r in lm_score.score(docs.repartition(min(n, 16))).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for other in said[1:]:
        assert all(math.isclose(x, other[i], rel_tol=1e-9) for i, x in said[0].items())


def test_order_of_words_counts(spark, real):
    """Contexts reach across words: a text with its words shuffled scores worse."""
    rng = random.Random(2)
    known = {i: t for i, t in real.items() if len(words_of(t)) > 100}
    rows = list(known.items()) + [(10_000 + 10 * i, " ".join(rng.sample(words_of(t), len(words_of(t))))) for i, t in known.items()]
    got = {r.doc_id: (r.held_out, r.score) for r in lm_score.score(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    pairs = [(got[i][1], got[10_000 + 10 * i][1]) for i in known if not got[i][0] and got[10_000 + 10 * i][0]]
    assert len(pairs) > 5 and sum(a > b for a, b in pairs) == len(pairs)


def test_bits_per_byte(spark, docs):
    rows = lm_score.score(docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes) for r in rows) == sorted((str(i), len((t or "").encode())) for i, t in ODD)
    for r in rows:
        assert (r.bits_per_byte is None) == (r.n_bytes == 0)
        assert not r.n_bytes or math.isclose(r.bits_per_byte * r.n_bytes, -r.score / math.log10(2))


def packed_words(spark, times, n_parts):
    cuts = sorted(w for w in times if zlib.crc32(w) % max(1, len(times) // n_parts) == 0)
    rows = spark.createDataFrame([(bytearray(w), c) for w, c in times.items()], "word binary, c long").repartition(3)
    return lm_score.packed(rows.mapInArrow(lm_score._numbered(cuts), "part int, value binary, n long"), len(cuts) + 1, "value", "binary", "groups")


def test_whole_beginnings_are_counted_exactly(spark):
    """Words met once count, and groups of a few words know what the others hold of a beginning that they share."""
    rng = np.random.default_rng(2)
    times = {bytes(rng.choice(list(b"abc"), rng.integers(1, 7))): int(rng.integers(0, 4)) for _ in range(60)} | {lm_score.END: 3}
    rows = packed_words(spark, times, 12)
    none = spark.createDataFrame([], "vals array<bigint>, times array<long>")
    shared, _ = lm_score.edges(rows, none)
    groups = [lm_score.Words([bytes(w) for w in r.vals], np.array(r.times)) for r in rows.collect()]
    assert len(groups) > 4 and sorted(w for g in groups for w in g.words) == sorted(times)
    ended = {spelled(w): c for w, c in times.items()}
    for g in groups:
        g.count_whole(shared)
        for j, (w, p) in enumerate(zip(g.owner, g.place, strict=True)):
            x = spelled(g.words[w])
            for k in range(8):
                like = [(y[p] >> 7 - k & 1, c) for y, c in ended.items() if y[:p] == x[:p] and len(y) > p and y[p] >> 8 - k == x[p] >> 8 - k]
                assert g.counts[k][g.back[j]].tolist() == [sum(c for b, c in like if b == v) for v in (0, 1)]


def test_tables_grow_with_the_corpus(spark):
    rng = np.random.default_rng(4)
    words = sorted({bytes(x) for x in rng.integers(128, 256, (60_000, 8), np.uint8)})
    rows = spark.createDataFrame([([bytearray(w) for w in words], [1] * len(words))], "vals array<binary>, times array<long>")
    _, bits = lm_score.edges(rows, spark.createDataFrame([], "vals array<bigint>, times array<long>"))
    assert bits[3] > lm_score.TABLES[3][1] and all(b <= high for b, (_, _, high) in zip(bits, lm_score.TABLES, strict=True))
    assert abs(lm_score.sketched(lm_score.sketch(np.arange(200_000, dtype=np.uint64))) / 200_000 - 1) < 0.1


def test_model_is_a_distribution():
    rng = np.random.default_rng(0)
    mixer = lm_score.Mixer(rng.integers(0, 40, (sum(1 << b for b in lm_score.least_bits()), 2)).astype(np.uint8))
    tail = int.from_bytes(b"xyz", "big") << 24
    # All bytes behind "ab", one of them the closing space; and all behind an opening, with whole beginnings met 3 and 5 times.
    keys = np.array([tail | int.from_bytes(b"ab" + bytes([c]), "big") for c in range(256)])
    places = list(lm_score.Openings(keys).places())
    assert abs((10 ** mixer.log10(places[2][2], places[2][3], 2)).sum() - 1) < 1e-9
    flat, place = np.frombuffer(b"".join(b"abc" + bytes([c]) for c in range(256)), np.uint8), np.tile(np.arange(4), 256)
    at = np.flatnonzero(place == 3)
    own = [lm_score._said(np.full(256, 3.0), np.full(256, 5.0), None)] * 8
    assert abs((10 ** mixer.log10(flat[at], lm_score._last_four(flat, place, at), 3, own)).sum() - 1) < 1e-9
    # A text's own words: the shares come to one over the vocabulary.
    codes, firsts = np.array([0, 1, 0, 2, 0]), np.array([0])
    total = 0.0
    for last in range(4):
        said = np.log10(np.array([0.4, 0.3, 0.2, 0.1]))
        with_last = np.append(codes[:-1], last)
        total += 10 ** lm_score.with_own_words(with_last, firsts, said[with_last])[-1]
    assert abs(total - 1) < 1e-12


# ---- 10 -------------------------------------------------------------------------------------------------------------------


def brute_fingerprint(text):
    words = words_of(lowered(text))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    ones = Counter(b for g in grams for b in range(64) if xxhash.xxh64_intdigest(g.encode(), seed=42) >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def brute_components(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return Counter((d, f"{p:016x}", least.get(find(i))) for i, ((d, _), p) in enumerate(zip(rows, prints, strict=True)))


def test_near_duplicates(spark, docs, none, real):
    for df, rows in ((docs, ODD), (table(spark, "documents"), list(real.items()))):
        assert Counter(map(tuple, simhash.near_duplicates(df).collect())) == brute_components(rows)
    assert simhash.near_duplicates(none).count() == 0
    left = simhash.one_of_each(docs)
    assert left.columns == docs.columns and left.count() == 8  # 1 and 5; 2, 3 and 4; no id; 7; two of id 8; 9; 10


@pytest.mark.parametrize("large", [False, True])
def test_anchors_bring_linked_fingerprints_together(spark, large):
    rng = np.random.default_rng(7)
    code = simhash.anchors_for(large)
    x = rng.integers(0, 1 << 32, 1500)
    y = x.copy()
    for i in range(len(y)):
        for b in rng.choice(32, rng.integers(0, 3), replace=False):
            y[i] ^= 1 << int(b)
    home, _, _ = code(x)
    _, index, anchor = code(y)
    sent = set(zip(index.tolist(), anchor.tolist(), strict=True))
    assert all((i, h) in sent for i, h in enumerate(home.tolist()))
    # A dense group and far ones, dealt over several cells, give the components of all pairs.
    cell, simhash.CELL = simhash.CELL, 64
    try:
        base = int(rng.integers(1, 1 << 62))
        fps = {base ^ sum(1 << int(b) for b in rng.choice(30, rng.integers(0, 5), replace=False)) for _ in range(300)} | {int(f) for f in rng.integers(0, 1 << 62, 100)}
        found = components.components(simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long"), large)).collect()
    finally:
        simhash.CELL = cell
    group = {f: f for f in fps}

    def find(f):
        while group[f] != f:
            f = group[f]
        return f

    for a in fps:
        for b in fps:
            if a < b and (a ^ b).bit_count() <= 4 and find(a) != find(b):
                group[max(find(a), find(b))] = min(find(a), find(b))
    assert {(r.node, r.root) for r in found} == {(f, find(f)) for f in fps if find(f) != f}


@pytest.mark.parametrize("large", [False, True])
def test_lone_pairs_of_a_split_anchor_are_linked(spark, monkeypatch, large):
    """Pairs that have no other neighbour, with a few rows a cell."""
    rng = np.random.default_rng(3)
    monkeypatch.setattr(simhash, "CELL", 4)
    first = rng.integers(0, 1 << 62, 200)
    pairs = {tuple(sorted((int(f), int(f) ^ 1 << int(b)))) for f, b in zip(first, rng.integers(0, 62, len(first)), strict=True)}
    fps = [f for pair in pairs for f in pair]
    found = components.components(simhash.fingerprint_links(spark.createDataFrame([(f,) for f in fps], "fp long"), large)).collect()
    assert {(r.root, r.node) for r in found} == pairs


def test_components(spark):
    chain = [(i, i + 1) for i in range(50)] + [(200, 100), (100, 150), (7, 7), (None, 3), (3, None), (3, 4)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 51)}, 150: 100, 200: 100}


def test_ends_of_words_and_numbers():
    """Both by arrays and lookups alone, as byte by byte."""
    words = [lm_score.END, b"a", b"ab", b"abc", b"abcd", "чё".encode(), b"\0", b"x" * 99, b"\xff\xfe"]

    def ends(word):
        opening = (word if word == lm_score.END else word + lm_score.SPACE)[: lm_score.OPEN].ljust(lm_score.OPEN, b"\0")
        return int.from_bytes(word[-lm_score.TAIL :] if word != lm_score.END else bytes([lm_score._START]), "big") << 8 * lm_score.OPEN | int.from_bytes(opening, "big")

    assert lm_score.ends_of(words).tolist() == list(map(ends, words)) and lm_score.ends_of([]).tolist() == []
    numbers = lm_score.Numbers()
    assert [numbers[w] for w in (b"b", b"a", b"b", b"c")] == [0, 1, 0, 2] and list(numbers) == [b"b", b"a", b"c"]


def test_equal_beginnings_are_asked_once(monkeypatch):
    """What shares its contexts and bits is mixed once, with the scores of every byte by itself."""
    rng = np.random.default_rng(3)
    mixer = lm_score.Mixer(rng.integers(0, 40, (sum(1 << b for b in lm_score.least_bits()), 2)).astype(np.uint8))
    asked, inputs = [], lm_score.Mixer.inputs
    monkeypatch.setattr(lm_score.Mixer, "inputs", lambda self, contexts, node, *rest: (asked.append(len(node)), inputs(self, contexts, node, *rest))[1])
    keys = np.unique(np.array([int.from_bytes(b"xyz" + (bytes(rng.choice(list(b"abcdef"), rng.integers(1, 4)).tolist()) + b" ")[:3].ljust(3, b"\0"), "big") for _ in range(900)]))
    want = np.zeros(len(keys))
    for p, at, byte, contexts in lm_score.Openings(keys).places():
        want[at] += mixer.log10(byte, contexts, p)
    plainly, asked[:] = sum(asked), []
    assert np.allclose(mixer.opening_scores(keys), want, rtol=1e-12) and sum(asked) < plainly / 4

    words = sorted({bytes(rng.choice(list(b"ab\x01"), rng.integers(1, 9)).tolist()) for _ in range(500)} | {lm_score.END, b"a" * 40, b"a" * 31, b"a" * 33 + b"b"})
    group = lm_score.Words(words, rng.integers(0, 3, len(words)))
    begun = {(w[:p], (w + b" ")[p]) for w in words if w != lm_score.END for p in range(3, min(len(w) + 1, lm_score.HEAD))}
    assert len(group.keys) == len(begun) and (np.diff(group.keys) > 0).all()
    group.count_whole((np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0)))
    want = np.bincount(group.owner, mixer.log10(group.byte, group.last, 3, [(x[group.back], y[group.back]) for x, y in group.said]), len(words))
    behind = 0
    for owner, byte, contexts, own in group.rest(50, False):
        behind += len(byte)
        want += np.bincount(owner, mixer.log10(byte, contexts, 3, own), len(words))
    asked[:] = []
    assert np.allclose(mixer.word_scores(group), want, rtol=1e-12) and sum(asked) <= 8 * (len(begun) + behind) < 8 * len(group.byte)
    learned = [(k, n) for keys, _, _, times in group.learned(1 << 17) for k, n in zip(keys.tolist(), times.tolist(), strict=True)]
    assert sum(n for _, n in learned) == sum(int(n) * max(0, len(w) + 1 - 3) for w, n in zip(words, group.times, strict=True) if w != lm_score.END)


def test_texts_are_coded_in_slices(monkeypatch):
    """Tokens by arrays are those of plain cutting, also of slices, nulls and other white space; blocks close behind the same texts."""
    rng = random.Random(4)
    texts = [None, "", " \t\n\x0b\x0c\r ", "Ab aB\x1cÀÉ x y İ \0 \x85", *("".join(rng.choice("aBcÀ \n\tЖ") for _ in range(rng.randrange(90))) for _ in range(300))]
    column = pa.array(["x" * 99, *texts]).slice(1)
    plain = [(t or "").encode().lower().split() + [lm_score.END] for t in texts]
    for part, want in ((column, plain), (column.slice(7, 40), plain[7:47])):
        size, codes, words, firsts = lm_score.coded(part)
        assert [[words[c].as_py() for c in x] for x in np.split(codes, firsts[1:])] == want and [c for c in dict.fromkeys(codes.tolist())] == list(range(len(words)))
        assert size.tolist() == [len((t.as_py() or "").encode()) for t in part]

    monkeypatch.setattr(lm_score, "TaskContext", type("T", (), {"get": classmethod(lambda cls: cls()), "partitionId": lambda self: 0}))
    monkeypatch.setattr(lm_score, "BLOCK_WORDS", 40)
    monkeypatch.setattr(lm_score, "BLOCK_TOKENS", 60)
    blocks, numbers, tokens = [[]], {}, 0
    for i, ws in enumerate(plain):
        blocks[-1].append((i, [numbers.setdefault(w, len(numbers)) for w in ws]))
        tokens += len(ws)
        if len(numbers) >= 40 or tokens >= 60:
            blocks, numbers, tokens = [*blocks, []], {}, 0
    rows = pa.Table.from_batches(lm_score._blocks(iter([pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), column], names=["doc_id", "text"])]))).to_pylist()
    got = [[] for _ in range(len(blocks))]
    for r in rows:
        if r["codes"] is not None:
            got[r["block"]].append((r["doc_id"], np.frombuffer(pa.decompress(r["codes"], 4 * r["n_tokens"], "zstd", asbytes=True), np.int32).tolist()))
    assert got == blocks and len(blocks) > 20
    assert sum(r["n"] for r in rows if r["word"] is not None) == sum(len(ws) for i, ws in enumerate(plain) if not lm_score.held_out(i))
