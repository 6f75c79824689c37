"""Packed products against plain ones, and mined rows against scoring all pairs."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import hard_negatives as hn

LONG = (1 << 63) - 1


def clip(v):
    return max(-LONG - 1, min(LONG, v))


def brute(rows, is_anchor, k=5, low=80, high=100):
    usable = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        usable.append((i, label, [math.floor(256 * x) for x in v]))
    last = 1 << 70
    out = Counter()
    for n, (i, label, v) in enumerate(usable):
        if i is None or not is_anchor(i):
            continue
        scored = [
            (-sum(a * b for a, b in zip(v, w)), last if j is None else j, other)
            for m, (j, other, w) in enumerate(usable) if m != n
        ]
        scored.sort(key=lambda s: s[:2])
        for p, pid, _ in [s for s in scored if s[2] == label][:k]:
            near = [s for s in scored if s[2] != label and low * -p <= high * -s[0] <= high * -p][:k]
            for rank, (s, nid, _) in enumerate(near, 1):
                out[i, None if pid == last else pid, rank, None if nid == last else nid, clip(-p), clip(-s)] += 1
    return out


def mined(spark, rows, kind="float", **options):
    table = spark.createDataFrame(rows, f"vec_id long, label int, embedding array<{kind}>").repartition(3)
    found = hn.mine(table, F.col("vec_id") % 5 == 0, **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r) for r in found.collect())


def some_rows(seed, n=60, size=6, scale=1.0):
    rng = random.Random(seed)
    centre = [[rng.gauss(0, scale) for _ in range(size)] for _ in range(3)]
    rows = []
    for i in range(n):
        c = rng.choice(centre)
        v = [float(np.float32(x + rng.gauss(0, scale / 4))) for x in c]
        rows.append((i, rng.randrange(3), v))
    return rows


@pytest.mark.parametrize(("low", "high"), [(-3, 3), (-300, 300), (0, 900), (-(2**20), 2**20), (-(2**45), 2**45)])
def test_packed_products_are_exact(low, high):
    rng = np.random.default_rng(1)
    a, c = rng.integers(low, high + 1, (7, 9)), rng.integers(low, high + 1, (13, 9))
    packed = hn.pack(c, hn._extent(a)[1])
    assert packed.fields > 1 or packed.width > 32
    want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in c] for u in a]
    assert hn.scores(a, packed).tolist() == want


def test_several_candidates_share_a_word():
    packed = hn.pack(np.full((10, 64), 100), 512)
    assert packed.fields == 2 and packed.words.shape == (64, 5)


def test_empty_vectors_score_zero():
    assert hn.scores(np.zeros((2, 0), np.int64), hn.pack(np.zeros((3, 0), np.int64), 0)).tolist() == [[0] * 3] * 2


def test_best_keeps_the_first_of_equal_values():
    values = np.array([[5, 7, 7, 1, 7], [0, 0, 0, 0, 0]])
    allowed = np.array([[True, True, True, True, False], [False] * 5])
    for kind in (np.int64, object):
        rows, columns = hn.best(values.astype(kind), allowed, 2)
        assert rows.tolist() == [0, 0] and sorted(columns.tolist()) == [1, 2]
    huge = np.array([[1 << 80, 3, 1 << 81]], object)
    assert sorted(hn.best(huge, np.ones((1, 3), bool), 2)[1].tolist()) == [0, 2]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("options", [{}, {"k": 2, "low": 50, "block_rows": 4}])
def test_against_all_pairs(spark, monkeypatch, seed, options):
    monkeypatch.setattr(hn, "CANDIDATES", 16)
    monkeypatch.setattr(hn, "_CELLS", 100)
    rows = some_rows(seed)
    want = brute(rows, lambda i: i % 5 == 0, options.get("k", 5), options.get("low", 80))
    assert mined(spark, rows, **options) == want and len(want) > 20


def test_unusable_rows_ties_and_repeats(spark):
    rows = some_rows(7, 40)
    rows += [
        (100, None, rows[0][2]), (105, 1, None), (110, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (115, 1, [float("nan")] * 6),
        (120, 1, [float("inf")] * 6), (125, 2, []), (130, 0, [1.0, 2.0]), (None, 1, rows[3][2]), (None, 0, rows[5][2]),
        rows[10], rows[10], (10, 1, rows[3][2]), (-5, 0, rows[0][2]), (0, 0, rows[0][2]),
    ]
    rows += [(200 + i, i % 2, rows[1][2]) for i in range(12)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 5 == 0)


def test_large_components_are_exact(spark):
    """Scores of over 64 bits: order and band are exact, the reported score is the nearest long."""
    rows = [(i, i % 2, [x * 2.0**40 for x in v]) for i, _, v in some_rows(8, 40, 4)]
    rows += [(300, 0, [3e38, 1.0, 1.0, 1.0]), (305, 1, [-3e38, 1e30, 5.0, 0.0])]
    assert mined(spark, rows, "double") == brute(rows, lambda i: i % 5 == 0)


def test_nothing(spark):
    assert mined(spark, []) == Counter()
    assert mined(spark, [(1, 1, [1.0])]) == Counter()
    assert mined(spark, [(0, 1, [1.0]), (5, 2, [1.0])]) == Counter()
