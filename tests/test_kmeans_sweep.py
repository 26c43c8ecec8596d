"""Carried bounds against plain Lloyd passes; exchange steps against a single-machine search."""

import numpy as np
import pytest

from lodestar.operators import kmeans as KM
from lodestar.operators import kmeans_sweep as KS

from core_helpers import features_from


def blobs(n=400, p=5, c=6, seed=0, spread=0.5):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(c, p))[rng.integers(0, c, n)] * 3 + spread * rng.normal(size=(n, p))


def cost(X, labels, k):
    return sum(((X[labels == c] - X[labels == c].mean(axis=0)) ** 2).sum() for c in range(k) if (labels == c).any())


def test_same_centres_as_plain_lloyd_with_fewer_distances(spark):
    X = blobs()
    df = features_from(spark, X).repartition(4)
    starts = KM.hashed_starts(df, 8, 3, range(4))
    starts = [s[:k] for s in starts for k in (2, 5, 8)]
    plain = KM.lloyd(df, starts, max_iter=100)
    fast = KS.bounded_lloyd(df, starts, max_iter=100)
    for a, b in zip(plain, fast):
        assert a.converged and b.converged
        assert np.allclose(a.centers, b.centers, atol=1e-9) and (a.sizes == b.sizes).all() and a.cost == pytest.approx(b.cost, rel=1e-12)
        assert abs(a.iterations - b.iterations) <= 1
    passes = max(m.iterations for m in fast)
    assert fast[0].history and sum(fast[np.argmax([m.iterations for m in fast])].history) < 0.6 * passes * len(X) * sum(len(s) for s in starts)


def test_stopped_passes_ties_empty_clusters_and_chunks(spark, monkeypatch):
    X = np.round(blobs(n=120, p=2, seed=4))  # ties and repeated rows
    df = features_from(spark, X).repartition(3)
    starts = [X[:4] + 0.0, np.array([[0.0, 0.0], [0.0, 0.0], [1e6, 1e6]]), X[:1] + 0.0]
    for passes in (1, 2, 3, 100):
        plain = KM.lloyd(df, starts, max_iter=passes)
        for most in (64, 1):
            monkeypatch.setattr(KS, "STATE_MODELS", most)
            for a, b in zip(plain, KS.bounded_lloyd(df, starts, max_iter=passes)):
                assert np.allclose(a.centers, b.centers, atol=1e-9) and (a.sizes == b.sizes).all()
    none = KS.bounded_lloyd(df.where("id < 0"), [X[:2] + 0.0], max_iter=5)[0]
    assert (none.centers == X[:2]).all() and none.sizes.sum() == 0


def plain_exchange(X, C):
    """Lloyd to its end, then the best move out of every cluster (no cluster twice), until none is left."""
    C = C.copy()
    while True:
        while True:
            at = ((X[:, None] - C[None]) ** 2).sum(axis=2).argmin(axis=1)
            new = np.stack([X[at == c].mean(axis=0) if (at == c).any() else C[c] for c in range(len(C))])
            if np.abs(new - C).max() <= 1e-12:
                break
            C = new
        n, moves = np.bincount(at, minlength=len(C)), []
        for c in range(len(C)):
            if n[c] > 1:
                own = [(n[c] / (n[c] - 1) * ((X[i] - C[c]) ** 2).sum() - n[b] / (n[b] + 1) * ((X[i] - C[b]) ** 2).sum(), -i, b)
                       for i in np.flatnonzero(at == c) for b in range(len(C)) if b != c]
                gain, i, b = max(own)
                if gain > 1e-9:
                    moves.append((-gain, c, b, -i))
        if not moves:
            return C, cost(X, at, len(C))
        used = set()
        for _, c, b, i in sorted(moves):
            if c not in used and b not in used:
                used |= {c, b}
                C[c], C[b] = (n[c] * C[c] - X[i]) / (n[c] - 1), (n[b] * C[b] + X[i]) / (n[b] + 1)


def test_exchange_equals_a_single_machine_search_and_never_costs_more(spark):
    X = blobs(n=90, p=3, c=9, seed=7, spread=1.5)
    df = features_from(spark, X).repartition(4)
    starts = [s[:7] for s in KM.hashed_starts(df, 7, 5, range(6))]
    lloyd = KS.bounded_lloyd(df, starts)
    before = [m.cost for m in lloyd]
    better = KS.exchange(df, lloyd)
    want = [plain_exchange(X, s) for s in starts]
    assert [m.cost for m in better] == pytest.approx([w[1] for w in want], rel=1e-9)
    assert all(m.cost <= b + 1e-9 for m, b in zip(better, before)) and any(m.cost < b - 1e-6 for m, b in zip(better, before))
    for m in better:
        assert m.converged
        at = ((X[:, None] - m.centers[None]) ** 2).sum(axis=2).argmin(axis=1)
        base = cost(X, at, 7)
        for i in range(len(X)):  # no single move lowers the cost
            for b in range(7):
                other = at.copy()
                other[i] = b
                assert cost(X, other, 7) >= base - 1e-6


def test_sweep_takes_the_best_start_of_every_k(spark):
    X = blobs(n=150, seed=2)
    df = features_from(spark, X)
    best = KS.sweep(df, [2, 4], 1, runs=5, finalists=None)
    plain = KS.sweep(df, [2, 4], 1, runs=5)
    grid = KM.kmeans_grid(df, [2, 4], 1, runs=5, max_iter=100)
    for k in (2, 4):
        assert plain[k].cost == pytest.approx(grid[k].cost, rel=1e-9) and best[k].cost <= plain[k].cost + 1e-9 and best[k].converged


def test_many_rows_are_measured_without_a_state(spark, monkeypatch):
    """for many rows the state of models with few centres took longer to write and read than the distances."""
    X = np.round(blobs(n=300, p=3, seed=5))  # ties and repeated rows
    df = features_from(spark, X).repartition(3)
    starts = [s[:k] for s in KM.hashed_starts(df, 9, 3, range(2)) for k in (1, 4, 9)] + [np.array([[0.0] * 3, [0.0] * 3, [1e6] * 3])]
    plain = KM.lloyd(df, starts, max_iter=100)
    written = []
    monkeypatch.setattr(KS, "_written", lambda df, x, centres, of=KS._written: written.append(len(centres)) or of(df, x, centres))
    for few, entries, kept in ((10 ** 6, 10 ** 6, {7}), (0, 10 ** 6, set()), (0, 20, {2})):  # all, none, models of more than 20 entries
        monkeypatch.setattr(KS, "STATE_ENTRIES", few)
        monkeypatch.setattr(KS, "PLAIN_ENTRIES", entries)
        monkeypatch.setattr(KS, "GRID_ENTRIES", 200 if entries == 20 else 1 << 16)
        written.clear()
        got = KS.bounded_lloyd(df, starts, max_iter=100)
        assert set(written) == kept
        for a, b in zip(plain, got):
            assert b.converged and np.allclose(a.centers, b.centers, atol=1e-9) and (a.sizes == b.sizes).all() and a.cost == pytest.approx(b.cost, rel=1e-12)


def test_measured_rows_equal_exact_distances_and_refuse_nan():
    X = np.round(blobs(n=200, p=3, seed=6))
    C = np.stack([X[:5], X[5:10], np.repeat(X[:1], 5, axis=0)])
    for part, hit, gap in KS._measured(X, C):
        apart = gap()
        for r in range(3):
            near, _ = KM.nearest(X[part], C[r])
            d = np.sort(np.sqrt(KM._direct_d2(X[part], C[r])), axis=1)
            assert (hit[r].sum(axis=0) == 1).all() and (hit[r].argmax(axis=0) == near).all() and (KS._nearest_few(X[part], C[r]) == near).all()
            assert np.allclose(apart[r], d[:, 1] - d[:, 0], atol=1e-6)
    bad = np.concatenate((X, [[np.nan, 0.0, 0.0]]))
    with pytest.raises(IndexError):
        KM.nearest(bad, C[0])
    with pytest.raises(IndexError):
        list(KS._measured(bad, C))
