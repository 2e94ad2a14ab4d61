"""Folds against plain quadratic forms of the same rules."""

import random

from plotwright.functions import plain
from plotwright.operators import folds
from plotwright.operators.folds import Item


def item(text, x0, y0, w=40, h=18, confidence=0.9, cut=False):
    box = (x0, y0, x0 + w, y0 + h)
    return Item(text, box, folds.floor_center(box), confidence, cut)


def page(seed, n=120):
    rng = random.Random(seed)
    words = ["alpha", "alph", "beta", "DS1", "DS12", "CB", "x", "12", "BB1", "a-", "-b", "7.", ".5", "é", "…", "gamma delta", "gammadelta", "beta."]
    return [item(rng.choice(words), rng.randint(0, 500), 22 * rng.randint(0, 9) + rng.randint(0, 6), rng.randint(5, 90), rng.randint(8, 26), rng.random(), rng.random() < 0.2) for _ in range(n)]


def test_suppression_is_greedy_and_maximal():
    for seed in range(12):
        items = page(seed)
        kept = folds.suppress(items)
        std = [Item(plain.one_space(i.text), folds.rounded(i.box), i.center, i.confidence, i.cut) for i in items]
        reach = folds.Reach.of(i.box[3] - i.box[1] for i in std)

        def cells(b):
            return {(x, y) for x in range(b[0] // reach.cell, max(0, b[2] - 1) // reach.cell + 1) for y in range(b[1] // reach.cell, max(0, b[3] - 1) // reach.cell + 1)}

        def close(a, b):
            return any(abs(x - u) <= 1 and abs(y - v) <= 1 for x, y in cells(a) for u, v in cells(b))

        slow = []
        for i in sorted(std, key=lambda i: -i.quality):
            if not any(close(i.box, k.box) and folds.conflict(i, k, reach) for k in slow):
                slow.append(i)
        assert kept == slow


def test_dedupe_against_all_pairs():
    for seed in range(12):
        items = page(seed)
        slow = []
        for i in sorted(items, key=lambda i: -i.quality):
            if plain.one_space(i.text) and not any(folds.same_again(i, k) for k in slow):
                slow.append(i)
        assert folds.dedupe(items) == slow


def test_lines_against_all_lines():
    for seed in range(12):
        items = page(seed)
        slow = []
        for i in sorted(items, key=lambda i: (i.center[1], i.box[1], i.box[0])):
            shares = [(folds.side_by_side(b, i.box), -n) for n, (b, _) in enumerate(slow)]
            best = max((s for s in shares if s[0] >= 0.55), default=None)
            if best is None:
                slow.append((i.box, [i]))
            else:
                n = -best[1]
                slow[n] = (folds.around(slow[n][0], i.box), [*slow[n][1], i])
        assert folds.lines(items) == [m for _, m in slow]


def test_reconcile_against_all_pairs():
    for seed in range(8):
        items, rng = page(seed, 40), random.Random(seed)
        words = [(rng.choice(["alpha", "DS1", "new", "--", "beta", ""]), (x := rng.random() * 500, y := rng.random() * 200, x + 40.0, y + 15.0)) for _ in range(40)]
        fast = folds.reconcile(items, words)
        whole = folds._Near.of
        try:
            folds._Near.of = lambda self, item, s: sorted({n for held in self.index.held.values() for n in held})
            assert folds.reconcile(items, words) == fast
        finally:
            folds._Near.of = whole


def test_merge_keeps_the_better_part_by_default():
    a, b = item("abc-", 0, 0, 30), item("cd", 32, 0, 30)
    assert [i.text for i in folds.merge_lines([a, b])] == ["abc-"]
    assert [i.text for i in folds.merge_lines([a, b], mode="concat")] == ["abc-cd"]


def test_numbers_never_join_devices():
    assert [i.text for i in folds.merge_lines([item("DS9", 0, 0, 30, cut=True), item("4", 31, 0, 8, cut=True)])] == ["DS9", "4"]


def test_missing_word_is_added_and_known_one_is_not():
    have = [item("alpha", 0, 0)]
    out = folds.reconcile(have, [("alpha", (1.0, 1.0, 40.0, 18.0)), ("beta", (300.0, 0.0, 340.0, 18.0))])
    assert [i.text for i in out] == ["alpha", "beta"] and out[1].confidence == 1.0


def test_far_but_different_text_needs_a_small_threshold():
    have, word = [item("alpha", 0, 0, 200, 100)], ("beta", (190.0, 90.0, 400.0, 200.0))
    assert len(folds.reconcile(have, [word])) == 2
    assert [i.text for i in folds.reconcile(have, [word], threshold=0.002)] == ["alpha", "beta"]


def test_empty():
    assert folds.suppress([]) == folds.merge_lines([]) == folds.dedupe([]) == folds.reconcile([], []) == []
