"""Agglomerative starts against Ward's method on all rows; mixtures started from them."""

import numpy as np
import pytest

from lodestar.operators import cftree as T
from lodestar.operators import mixture as MX
from lodestar.plans import experiments as X

from core_helpers import features_from


def plain_ward(X_, g):
    """Merges single rows by the least rise of the within-cluster squares, trying every pair."""
    groups = [[i] for i in range(len(X_))]
    ss = lambda ix: ((X_[ix] - X_[ix].mean(axis=0)) ** 2).sum()
    while len(groups) > g:
        best = min(((ss(groups[a] + groups[b]) - ss(groups[a]) - ss(groups[b]), a, b) for a in range(len(groups)) for b in range(a + 1, len(groups))))
        _, a, b = best
        groups[a] += groups.pop(b)
    return sorted(sorted(ix) for ix in groups)


def test_merges_equal_wards_method():
    rng = np.random.default_rng(0)
    for p in (1, 3):
        M = rng.normal(size=(24, p)) + 4 * rng.integers(0, 3, (24, 1))
        _, _, _, kept = T.agglomerate(np.ones(24), M, 1, {1, 2, 5, 9, 24})
        for g, (n, s) in kept.items():
            want = [(len(ix), M[ix].sum(axis=0)) for ix in plain_ward(M, g)]
            assert sorted(map(int, n)) == sorted(w[0] for w in want)
            assert np.allclose(sorted(s[:, 0]), sorted(w[1][0] for w in want))


def blobs(n, c, seed, p=4):
    rng = np.random.default_rng(seed)
    return 8 * rng.normal(size=(c, p))[rng.integers(0, c, n)] + rng.normal(size=(n, p))


def test_leaves_keep_totals_and_stay_bounded(spark):
    M = blobs(3000, 12, 1)
    df = features_from(spark, M).repartition(5)
    n, s = T.leaves(df, most=40)
    assert len(n) <= 40 and n.sum() == 3000 and np.allclose(s.sum(axis=0), M.sum(axis=0))
    same = T.leaves(features_from(spark, np.repeat(M[:3], 200, axis=0)), most=40)
    assert sorted(same[0]) == [200, 200, 200]
    with pytest.raises(ValueError, match="distinct"):
        T.tree_starts(features_from(spark, np.repeat(M[:3], 5, axis=0)), [4])
    assert len(T.leaves(df.where("id < 0"))[0]) == 0


def test_one_tree_finds_groups_for_every_number(spark):
    M = blobs(1200, 10, 3)
    starts = T.tree_starts(features_from(spark, M).repartition(4), [2, 10], most=60)
    w, means = starts[10]
    assert w.sum() == pytest.approx(1.0) and starts[2][1].shape == (2, 4)
    centres = np.unique(np.round(8 * np.random.default_rng(3).normal(size=(10, 4)), 9), axis=0)
    assert all(np.sqrt(((means - c) ** 2).sum(axis=1)).min() < 0.6 for c in centres)


def test_mixtures_from_the_tree_are_no_worse_than_from_kmeans(spark):
    M = blobs(900, 8, 5)
    df = features_from(spark, M).repartition(3)
    tree = X.mixture_grid(df, [4, 8], ["VII", "VVI"], 1)
    km = X.mixture_grid(df, [4, 8], ["VII", "VVI"], 1, start="kmeans")
    for a, b in zip(tree, km):
        if a.G == 8:
            assert a.loglik >= b.loglik - 1e-3
    assert isinstance(tree[0], MX.Mixture) and [m.G for m in tree] == [4, 4, 8, 8]


def dense_log(X_, m):
    """Log densities of all components, one by one."""
    out = np.empty((len(X_), m.G))
    for g in range(m.G):
        S = m.full(g)
        d = X_ - m.means[g]
        out[:, g] = np.log(m.weights[g]) - 0.5 * (m.p * np.log(2 * np.pi) + np.linalg.slogdet(S)[1] + np.einsum("ij,ij->i", d, np.linalg.solve(S, d.T).T))
    return out


@pytest.mark.parametrize("family", MX.FAMILIES)
def test_sparse_densities_equal_dense_ones_within_the_stated_tail(family):
    rng = np.random.default_rng(7)
    G, p = 50, 5
    M = blobs(600, G, 9, p=p)
    m = MX.init_from_centers(8 * rng.normal(size=(G, p)), family, 1.0)
    m.weights = rng.dirichlet(np.full(G, 0.4)) + 1e-6
    m.weights /= m.weights.sum()
    if m.diagonal:
        m.covs = m.covs * rng.uniform(0.05, 20, (G, p))
    else:
        A = rng.normal(size=(G, p, p))
        m.covs = np.einsum("gij,gkj->gik", A, A) + 0.01 * np.eye(p)
    evaluated = []
    dens = MX.Densities(m)
    one = dens.one
    dens.one = lambda X_, g: (evaluated.append(len(X_)), one(X_, g))[1]
    z, ll = MX.responsibilities(M, m, dens)
    L = dense_log(M, m)
    top = L.max(axis=1, keepdims=True)
    want = np.exp(L - top)
    total = want.sum(axis=1, keepdims=True)
    assert np.abs(z - want / total).max() < 1e-9 and np.allclose(ll, (top + np.log(total)).ravel(), rtol=1e-10, atol=1e-9)
    assert (want / total)[z == 0].max(initial=0.0) < MX.TAIL
    assert (dens.bounds(M) >= L - 1e-9).all()
    assert sum(evaluated) < len(M) * G if m.diagonal else True


def test_mixtures_of_many_components_fit(spark):
    M = blobs(1500, 40, 11)
    m = X.mixture_grid(features_from(spark, M).repartition(3), [60], ["VII"], 1, iters=15)[0]
    assert not m.failed and m.weights.sum() == pytest.approx(1.0) and m.history[-1] >= m.history[0]
    assert np.mean((np.exp(dense_log(M, m) - dense_log(M, m).max(axis=1, keepdims=True)) > 1e-6).sum(axis=1)) < 20
