"""Hard negatives against all pairs."""
import math
import random

import numpy as np
import pytest

from peerscope.llm import hardneg

SCHEMA = "vec_id long, embedding array<float>, label int, qid string, leaf int"


def brute(rows, is_anchor, n_pos=5, n_neg=10):
    ok = {(i, v if v is None else tuple(v), y) for i, v, y in rows}
    ok = [(i, tuple(math.floor(256 * float(np.float32(x))) for x in v), y) for i, v, y in ok
          if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i, v, y in set(ok):
        if not is_anchor(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w, strict=False)), j, z) for j, w, z in set(ok)))
        for s, p, _ in [r for r in scored if r[2] == y and r[1] != i][:n_pos]:
            hits = [r for r in scored if r[2] != y and 30 * -s <= 100 * -r[0] <= 90 * -s][:n_neg]
            out += [(i, p, k, r[1], -s, -r[0]) for k, r in enumerate(hits, 1)]
    return sorted(out)


def mined(spark, rows, anchors="id % 10 = 0", **options):
    df = spark.createDataFrame([(*r, "q", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, hardneg.hard_negatives(df, anchors, **options).collect()))


def vectors(n, dim, seed, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dim))
    out = []
    for i in range(n):
        y = int(rng.integers(labels))
        v = centres[y] + 0.8 * rng.normal(size=dim)
        out.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], y))
    return out


@pytest.mark.parametrize("dim", [2, 16])
def test_equals_all_pairs(spark, monkeypatch, dim):
    monkeypatch.setattr(hardneg, "BLOCK_ROWS", 50)  # leaves of several blocks
    rows = vectors(700, dim, dim)
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_hot_vector_ties_and_repeats(spark):
    rows = vectors(300, 8, 3)
    hot = rows[7][1]
    rows += [(1000 + i, hot, i % 2) for i in range(200)]  # a third of all rows
    rows += rows[:20] + [(10, rows[5][1], 3), (10, rows[6][1], 3)]  # repeated rows, an id of several rows
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_nulls_empty_short_and_not_finite(spark):
    rows = vectors(60, 4, 5) + [
        (None, [1.0, 0.0, 0.0, 0.0], 1), (100, None, 1), (110, [1.0, None, 0.0, 0.0], 1), (120, [float("nan"), 0.0, 0.0, 0.0], 1),
        (130, [float("inf"), 0.0, 0.0, 0.0], 1), (140, [1.0, 0.5], 1), (150, [], 1), (160, [0.0] * 4, 2), (170, [0.1] * 4, None),
        (180, [0.2, 0.1, 0.3, 0.4, 0.5, 0.6], 2),
    ]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, []) == []
    assert mined(spark, [(0, [1.0], 1)]) == []  # an anchor alone


def test_other_counts_and_large_components(spark):
    rng = random.Random(1)
    rows = [(i, [rng.uniform(-9e5, 9e5) for _ in range(3)], i % 3) for i in range(200)]  # sums beyond 2**53
    assert mined(spark, rows, n_positives=2, n_negatives=3) == brute(rows, lambda i: i % 10 == 0, 2, 3)


def test_ranges_rule_leaves_out_and_lose_none():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 6)) * 300
    x = np.round(centres[rng.integers(30, size=4000)] + rng.normal(size=(4000, 6)) * 20)
    tree = hardneg.Tree(x[:1000])
    for node, _, d in tree.walk(x, tree.nearest):
        if d is not None:
            own = d[:, :-1].argmin(1)
            for j in np.unique(own):
                node.lo[:, j], node.hi[:, j] = d[own == j].min(0), d[own == j].max(0)
    leaf, q = tree.leaf_of(x), x[:50]
    s = hardneg.scores(q, x)
    best = np.sort(s, axis=1)[:, -10].astype(float)
    got = tree.reached(q, best, np.full(50, 1e18))
    seen = np.zeros((50, tree.n_leaves), bool)
    for n, r in got:
        seen[r, n] = True
    for i in range(50):
        assert seen[i, leaf[s[i] >= best[i]]].all()
    assert seen.mean() < 0.4
