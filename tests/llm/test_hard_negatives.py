"""Exact scores and hard negatives against Python's whole numbers."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import hard_negatives as hn

SCHEMA = "id long, label long, vector array<double>"


@pytest.mark.parametrize("most, width", [(1, 1), (180, 64), (500, 300), (1 << 20, 70), (1 << 28, 100)])
def test_scores_are_exact(most, width):
    dice = np.random.default_rng(width)
    a, b = dice.integers(-most, most + 1, (7, width)), dice.integers(-most, most + 1, (9, width))
    exact = [[sum(x * y for x, y in zip(p, q)) for q in b.tolist()] for p in a.tolist()]
    assert hn.scores(a, b).tolist() == exact


def test_extreme_scores():
    a = np.full((1, 64), -(1 << 28))
    assert hn.scores(a, -a).tolist() == [[-(1 << 62)]] and hn.scores(a, a).tolist() == [[1 << 62]]
    assert hn.scores(np.empty((2, 0), np.int64), np.empty((3, 0), np.int64)).tolist() == [[0] * 3] * 2
    with pytest.raises(OverflowError):
        hn.scores(np.full((1, 64), 1 << 40), np.full((1, 64), 1 << 40))


def brute(rows: list[tuple], anchor) -> list[tuple]:
    own = []
    for key, label, vector in rows:
        if None in (key, label, vector) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        own.append((key, label, [math.floor(256 * x) for x in vector]))
    out = []
    for a, label, v in {(k, n, tuple(v)) for k, n, v in own if anchor(k)}:
        scored = sorted(((-sum(x * y for x, y in zip(v, w)), k, n) for k, n, w in own))
        for s, p in [(-s, k) for s, k, n in scored if n == label and k != a][:5]:
            found = [(-t, k) for t, k, n in scored if n != label and 30 * s <= -100 * t <= 90 * s][:10]
            out += [(a, p, i + 1, k, s, t) for i, (t, k) in enumerate(found)]
    return sorted(out)


def mined(spark, rows: list[tuple], every: int) -> list[tuple]:
    table = spark.createDataFrame(rows, SCHEMA + "").withColumn("rank", F.lit("clash")).repartition(5)
    got = hn.hard_negatives(table, F.col("id") % every == 0)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("blocks", [(3, 4, 5), (hn.ANCHORS, hn.ROWS, hn.STEP)])
def test_random_rows(spark, monkeypatch, blocks):
    monkeypatch.setattr(hn, "ANCHORS", blocks[0])
    monkeypatch.setattr(hn, "ROWS", blocks[1])
    dice = random.Random(7)
    rows = [(k, dice.randrange(4), [dice.uniform(-1, 1) + 0.3 for _ in range(8)]) for k in range(400)]
    rows += [(k, dice.randrange(2), [0.5] * 8) for k in range(400, 460)]  # equal vectors: ties
    got = mined(spark, rows, 20)
    assert got and got == brute(rows, lambda k: k % 20 == 0)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (10, 1, [0.0, 0.0]), (-10, 2, [1.0, 1.0, 5.0]), (20, 2, []), (30, 9, [3.0]),
        (1, 1, [0.9, 0.5]), (1, 1, [0.9, 0.5]), (2, 2, [0.5, 0.3]), (3, 2, [0.5, 0.3, 7.0]), (4, None, [1.0]), (None, 1, [1.0]),
        (5, 1, None), (6, 1, [None, 1.0]), (7, 2, [nan, 1.0]), (8, 2, [inf]), (40, 1, [-1.0, 2.0]),
    ]
    assert mined(spark, rows, 10) == brute(rows, lambda k: k % 10 == 0)
    assert mined(spark, [], 10) == []
    assert mined(spark, [(0, 1, [1.0]), (1, 1, [1.0])], 10) == []


def test_half_of_all_rows_are_one_vector(spark):
    rows = [(k, k % 3, [1.0, 0.25] if k % 2 else [k / 100, 0.1]) for k in range(600)]
    assert mined(spark, rows, 50) == brute(rows, lambda k: k % 50 == 0)


def test_large_components_are_an_error(spark):
    with pytest.raises(Exception, match="64 bits"):
        mined(spark, [(0, 1, [1e300]), (1, 1, [1.0])], 10)
