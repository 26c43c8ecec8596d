"""Distributed description-length cuts against a plain recursive search."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import supervised_cuts as S
from lodestar.plans import experiments as X

from core_helpers import features_from


def entropy(y):
    n = len(y)
    return -sum(c / n * math.log2(c / n) for c in np.unique(y, return_counts=True)[1]) if n else 0.0


def plain_cuts(v, y, depth=None):
    """Cut points by trying every boundary of the sorted values, recursively."""
    if depth == 0 or len(v) < 2:
        return []
    order = np.argsort(v, kind="stable")
    v, y = v[order], y[order]
    at = [i for i in range(1, len(v)) if v[i] > v[i - 1]]
    if not at:
        return []
    left = np.cumsum(y[:, None] == np.unique(y)[None], axis=0)[np.array(at) - 1]
    cost = sum(-np.where(c > 0, c * np.log2(np.maximum(c, 1) / c.sum(axis=1, keepdims=True)), 0).sum(axis=1) for c in (left, (y[:, None] == np.unique(y)[None]).sum(axis=0) - left))
    i = at[int(np.flatnonzero(cost <= cost.min() + S.TIE * len(v))[0])]
    n, k = len(v), [len(set(p)) for p in (y, y[:i], y[i:])]
    gain = entropy(y) - (i * entropy(y[:i]) + (n - i) * entropy(y[i:])) / n
    delta = math.log2(3 ** k[0] - 2) - (k[0] * entropy(y) - k[1] * entropy(y[:i]) - k[2] * entropy(y[i:]))
    if gain * n <= math.log2(n - 1) + delta:
        return []
    a, b = float(v[i - 1]), float(v[i])
    mid = a + (b - a) / 2
    more = None if depth is None else depth - 1
    return plain_cuts(v[:i], y[:i], more) + [a if mid >= b else mid] + plain_cuts(v[i:], y[i:], more)


def features(n, classes, seed):
    """Features that follow the class in one or several steps, heavy tails, ties, noise, a constant."""
    rng = np.random.default_rng(seed)
    y = rng.integers(0, classes, n)
    cols = [y + 0.4 * rng.normal(size=n), np.round(2 * (y % 3) + rng.normal(size=n)), np.exp(4 * rng.normal(size=n) + (y == 1)), rng.normal(size=n),
            np.where(rng.random(n) < 0.6, 0.0, (y % 2) + rng.random(n)), np.full(n, 2.5), rng.integers(0, 4, n).astype(float), -1.0 * (y == 0) * rng.random(n),
            np.where(y > 0, np.nextafter(1.0, 2.0), 1.0), 1e12 + y.astype(float)]
    return np.stack(cols, axis=1), y


def spark_frame(spark, M, y):
    return features_from(spark, M, [int(c) for c in y]).withColumnRenamed("label", "label_ix").repartition(4)


@pytest.mark.parametrize("n,classes,seed", [(60, 2, 0), (500, 9, 2)])
def test_cuts_equal_a_plain_search(spark, n, classes, seed, monkeypatch):
    monkeypatch.setattr(S, "PARTS", 40)
    monkeypatch.setattr(S, "FETCH_ROWS", 10)
    M, y = features(n, classes, seed)
    got = S.entropy_cuts(spark_frame(spark, M, y), classes)
    want = [plain_cuts(M[:, j], y) for j in range(M.shape[1])]
    assert [list(c) for c in got] == want
    assert len(got[5]) == 0 and (n < 100 or len(got[0]) > 0)


def test_first_cuts_and_scan_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "CELLS_PER_SCAN", 700)
    M, y = features(500, 4, 3)
    got = S.entropy_cuts(spark_frame(spark, M, y), 4, depth=1)
    assert [list(c) for c in got] == [plain_cuts(M[:, j], y, 1) for j in range(M.shape[1])]


def test_bounds_hold_for_every_cut_of_a_window():
    rng = np.random.default_rng(5)
    for _ in range(300):
        k = int(rng.integers(2, 6))
        L, B, R = (rng.integers(0, 12, k) * (rng.random(k) < 0.8) for _ in range(3))
        if not B.sum() or not (L + B + R).sum():
            continue
        T = (L + B + R).astype(float)
        bound = S.lower_bounds(L[None], B[None], T, np.inf)[0]
        inside = [np.array(d) for d in np.ndindex(*(B + 1))]
        assert bound <= min(S.bits(L + d) + S.bits(T - L - d) for d in inside) + 1e-9


def test_windows_that_cannot_matter_are_dropped(spark, monkeypatch):
    counted = []
    count = S._count
    monkeypatch.setattr(S, "_count", lambda df, x, ix, k, todo: (counted.append(len(todo)), count(df, x, ix, k, todo))[1])
    rng = np.random.default_rng(6)
    n = 4_000
    y = rng.integers(0, 2, n)
    M = np.stack([y + rng.normal(size=n), rng.normal(size=n)], axis=1)
    got = S.entropy_cuts(spark_frame(spark, M, y), 2, depth=1)
    assert [list(c) for c in got] == [plain_cuts(M[:, j], y, 1) for j in range(2)]
    assert sum(counted) < 100  # of 2 x 4,000 possible cuts


def test_no_rows_one_class_nulls_and_bins(spark):
    M, y = features(40, 2, 1)
    df = spark_frame(spark, M, y)
    assert S.entropy_cuts(df.where("id < 0"), 2) == []
    assert [list(c) for c in S.entropy_cuts(df.withColumn("label_ix", F.lit(0)), 2)] == [[]] * 10
    nan = df.withColumn("x", F.when(F.col("id") == 3, F.array(*[F.lit(float("nan"))] * 10)).otherwise(F.col("x")))
    with pytest.raises(ValueError, match="NaN"):
        S.entropy_cuts(nan, 2)
    binned = S.discretize_by(df, [np.array([0.5])] + [np.zeros(0)] * 9, keep=("id",))
    assert {r["id"]: r["bins"][0] for r in binned.collect()} == {i + 1: 1.0 + (M[i, 0] > 0.5) for i in range(40)}
    assert {b for r in binned.collect() for b in r["bins"][1:]} == {1.0}


def test_selection_runs_on_supervised_bins(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 4, 600)
    M = np.stack([(y % 2) + 0.2 * rng.normal(size=600), (y // 2) + 0.2 * rng.normal(size=600), (y % 2) + 0.25 * rng.normal(size=600), rng.normal(size=600)], axis=1)
    df = features_from(spark, M, [f"c{c}" for c in y])
    keep = X.cfs_subset(df, 4)
    assert 1 in keep and (0 in keep or 2 in keep) and 3 not in keep
