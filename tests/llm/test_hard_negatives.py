"""Hard negatives against all pairs, and the tree's elimination against exact scores."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockpond.llm import hard_negatives as H

DDL = "vec_id bigint, embedding array<double>, label int, v string, row int"


def expected(rows: list[tuple], scale: int = 256) -> list[tuple]:
    whole = []
    for vec, x, label, *_ in rows:
        if vec is None or label is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        whole.append((vec, (label + 1) % 10 if vec % 7 == 0 else label, [math.floor(c * scale) for c in x]))
    out = []
    for a, label, v in whole:
        if a % 50:
            continue
        scored = sorted(((-sum(p * q for p, q in zip(v, x)), vec, other == label) for vec, other, x in whole if vec != a))
        for s, p, _ in [r for r in scored if r[2]][:5]:
            good = [r for r in scored if not r[2] and 50 * -s <= 100 * -r[0] <= 95 * -s][:3]
            out += [(a, p, k + 1, r[1], -s, -r[0]) for k, r in enumerate(good)]
    return sorted(out)


def mined(spark, rows: list[tuple], **options) -> list[tuple]:
    df = spark.createDataFrame([(*r[:3], "mine", 1) for r in rows], DDL)
    moved = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    return sorted(map(tuple, H.mine(df, F.col("vec_id") % 50 == 0, moved, **options).collect()))


def test_against_all_pairs(spark):
    rng = random.Random(2)

    def vector() -> list[float]:
        return [rng.uniform(-1, 1) for _ in range(5)]

    rows = [(k, vector(), rng.randrange(4)) for k in range(0, 500)]
    rows += [(k, [0.5, 0.5, 0.5, 0.5, 0.5], k % 3) for k in range(500, 700)]           # one vector for many rows: ties
    rows += [(50, rows[50][1], rows[50][2]), (100, vector(), 3), (77, vector(), 1)]     # repeated ids, also of anchors
    rows += [(None, vector(), 1), (801, None, 1), (802, [1.0, None, 0.0, 0.0, 0.0], 1), (803, vector(), None),
             (804, [float("nan")] * 5, 1), (805, [float("inf")] * 5, 1), (806, [1.0, -0.5], 1), (850, [], 2), (900, [0.0] * 5, 0),
             (950, [-1.0] * 5, 9)]                                                     # an anchor alone with its label
    want = expected(rows)
    assert len(want) > 100
    assert mined(spark, rows, fanout=3, sample=64, bin_rows=100, group=4) == want


def test_large_components(spark):
    rng = random.Random(4)
    rows = [(k, [float(rng.randrange(-10**7, 10**7)) for _ in range(3)], k % 3) for k in range(0, 120)]
    want = expected(rows)
    assert want and max(abs(r[4]) for r in want) > 1 << 53
    assert mined(spark, rows) == want


def test_empty_table(spark):
    df = spark.createDataFrame([], DDL)
    got = H.mine(df, F.col("vec_id") % 50 == 0)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.collect() == []


def _tree(rows: np.ndarray, fanout: int) -> tuple[H.Tree, np.ndarray]:
    tree = H.Tree(rows[::3], fanout)
    leaf, far = tree.descend(rows)
    norm = (rows.astype(float) ** 2).sum(axis=1)
    tree.learn([{"leaf": k, "low": far[leaf == k].min(axis=0), "high": far[leaf == k].max(axis=0),
                 "norm_low": norm[leaf == k].min(), "norm_high": norm[leaf == k].max()} for k in np.unique(leaf)])
    return tree, leaf


@pytest.mark.parametrize("spread", [5, 300])
def test_no_leaf_with_a_result_is_left_out(spread):
    draw = np.random.default_rng(spread)
    centres = draw.integers(-400, 400, (30, 8))
    rows = (centres[draw.integers(0, 30, 3000)] + draw.integers(-spread, spread, (3000, 8))).astype(np.int64)
    tree, leaf = _tree(rows, 6)
    anchors = rows[:200]
    score = anchors @ rows.T
    least = np.percentile(score, 97, axis=1)
    most = np.percentile(score, 99, axis=1)
    seen = tree.survivors(anchors, least, most)
    inside = (score >= least[:, None]) & (score <= most[:, None])
    who, which = np.nonzero(inside)
    assert seen[who, leaf[which]].all()
    if spread == 5:  # tight clusters: most leaves are ruled out
        assert seen.sum() < 0.5 * len(anchors) * len(np.unique(leaf))


def test_every_bound_is_safe_for_pages():
    draw = np.random.default_rng(1)
    rows = draw.integers(-50, 50, (64, 4)).astype(np.int64)
    points = rows[:5]
    far = H._distances(rows, points)
    norms = (rows ** 2).sum(axis=1)
    anchors = draw.integers(-50, 50, (300, 4)).astype(np.int64)
    score = anchors @ rows.T
    for least, most in ((0, 500), (1000, 1200), (3000, 9000)):
        held = H.may_hold(anchors, np.full(300, float(least)), np.full(300, float(most)), H._distances(anchors, points),
                          far.min(axis=0), far.max(axis=0), (norms.min(), norms.max()))
        assert (held | ~((score >= least) & (score <= most)).any(axis=1)).all()
