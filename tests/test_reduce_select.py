import numpy as np
import pytest
from pyspark.sql import functions as F

from core_helpers import collect_matrix, features_from
from lodestar.operators import kmeans as KM
from lodestar.operators import linalg as LA
from lodestar.operators import reduce as RD
from lodestar.operators import select as SEL
from lodestar.operators import silhouette as SH


def test_pca_invariants(std_e):
    p = 64
    model = RD.pca_fit(std_e, p)
    lam = model.eigenvalues
    assert np.isclose(lam.sum(), p, rtol=1e-9)                       # Σλ = p on standardised data
    assert np.allclose(model.rotation.T @ model.rotation, np.eye(p), atol=1e-9)
    mo = LA.moments(std_e, p, shift=model.mean)
    errs = dict(RD.recon_errors(mo.g, model.rotation, [1, 5, 20]))
    for d, e in errs.items():                                        # error(d) = (n−1) Σ_{j>d} λ_j
        assert np.isclose(e, (model.n - 1) * lam[d:].sum(), rtol=1e-8)
    contrib = RD.contributions(model.rotation)
    assert np.allclose([v for i, j, v in contrib if j == p], 1.0)    # contributions end at 1
    assert RD.min_dimension(lam, 0.9) == int(np.argmax(np.cumsum(lam) > 0.9 * lam.sum())) + 1


def test_pca_scores_match_numpy(std_e):
    model = RD.pca_fit(std_e, 64)
    ids, Z = collect_matrix(RD.pca_transform(std_e, model, 3))
    _, X = collect_matrix(std_e)
    assert np.allclose(Z, (X - X.mean(0)) @ model.rotation[:, :3], atol=1e-9)


def test_ica_error_equals_pca_and_sources_white(std_e):
    p = 64
    pca = RD.pca_fit(std_e, p)
    mo = LA.moments(std_e, p, shift=pca.mean)
    ica = RD.ica_fit(std_e, p, 5, seed=1, max_iter=30)
    e_ica = RD.ica_recon_error(mo.g, ica)
    e_pca = dict(RD.recon_errors(mo.g, pca.rotation, [5]))[5]
    assert np.isclose(e_ica, e_pca, rtol=1e-7)
    _, S = collect_matrix(RD.ica_sources(std_e, ica))
    C = np.cov(S.T, ddof=0)
    assert np.allclose(C, np.eye(5), atol=1e-8)


def test_projection_running_best_and_pca_bound(spark, std_e):
    p = 64
    S = LA.gram(std_e, p)
    errs = RD.running_best(RD.projection_errors(spark, S, [4], 15, 7, family="haar")).orderBy("run")
    rows = errs.collect()
    best = [r["best_err"] for r in rows]
    assert all(b <= a for a, b in zip(best, best[1:]))
    pca = RD.pca_fit(std_e, p)
    mo = LA.moments(std_e, p, shift=pca.mean)
    e_pca = dict(RD.recon_errors(mo.g, pca.rotation, [4]))[4]
    assert min(r["err"] for r in rows) >= e_pca - 1e-6               # no projector beats PCA
    assert np.array_equal(RD.sign_matrix(8, 3, 1, 2), RD.sign_matrix(8, 3, 1, 2))


def test_gram_identity_direct(spark, std_e):
    _, X = collect_matrix(std_e)
    M = RD.sign_matrix(64, 4, 42, 0)
    S = LA.gram(std_e, 64)
    direct = ((X - X @ M @ M.T) ** 2).sum()
    assert np.isclose(LA.recon_error(S, M @ M.T), direct, rtol=1e-10)


def test_silhouette_exact_vs_numpy_and_blocks(spark, std_e):
    C = KM.first_rows(std_e, 3)
    a = KM.assign(std_e, C, passthrough=("id", "x")).persist()
    one = SH.silhouette_exact(a).toPandas().sort_values("id")
    many = SH.silhouette_exact(a, grid=3).toPandas().sort_values("id")
    assert np.allclose(one["s"].to_numpy(), many["s"].to_numpy(), atol=1e-12)
    rows = a.orderBy("id").collect()
    X = np.array([r["x"] for r in rows])
    cl = np.array([r["cluster"] for r in rows])
    D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(2))
    s = []
    for i in range(len(X)):
        own = cl == cl[i]
        ai = D[i, own].sum() / (own.sum() - 1) if own.sum() > 1 else 0.0
        bi = min(D[i, cl == c].mean() for c in set(cl) if c != cl[i])
        s.append(0.0 if own.sum() == 1 else (bi - ai) / max(ai, bi))
    assert np.allclose(one["s"].to_numpy(), s, atol=1e-9)


def test_silhouette_singleton_is_zero(spark):
    X = np.array([[0.0, 0.0], [0.1, 0.0], [5.0, 5.0]])
    a = KM.assign(features_from(spark, X), X[[0, 2]], passthrough=("id", "x"))
    s = {r["id"]: r["s"] for r in SH.silhouette_exact(a).collect()}
    assert s[3] == 0.0 and s[1] > 0.9


def test_silhouette_squared_vs_numpy(spark, std_e):
    C = KM.first_rows(std_e, 3)
    a = KM.assign(std_e, C, passthrough=("id", "x"))
    got = SH.silhouette_squared(a).toPandas().sort_values("id")["s"].to_numpy()
    rows = a.orderBy("id").collect()
    X = np.array([r["x"] for r in rows])
    cl = np.array([r["cluster"] for r in rows])
    D = ((X[:, None] - X[None]) ** 2).sum(2)
    s = []
    for i in range(len(X)):
        own = cl == cl[i]
        ai = D[i, own].sum() / (own.sum() - 1)
        bi = min(D[i, cl == c].mean() for c in set(cl) if c != cl[i])
        s.append((bi - ai) / max(ai, bi))
    assert np.allclose(got, s, atol=1e-8)


def test_su_properties_and_label_copy_chosen(spark):
    rng = np.random.default_rng(3)
    n = 400
    lab = rng.integers(0, 5, n)
    X = np.column_stack([lab + 0.001 * rng.random(n), rng.random(n), rng.random(n)])
    df = features_from(spark, X, labels=[int(v) for v in lab])
    binned = SEL.discretize(df, 5)
    su_c = np.zeros(3)
    for r in SEL.su_feature_class(binned).collect():
        su_c[r["j"]] = r["su"]
    assert np.all((su_c >= 0) & (su_c <= 1 + 1e-12))
    assert su_c[0] > 0.95                                   # a numeric copy of the label
    su_ff = SEL.su_feature_pairs(binned, 3, 5)
    assert np.allclose(su_ff, su_ff.T) and np.all(su_ff <= 1 + 1e-12)
    assert SEL.best_first(su_c, su_ff)[0] == 0


@pytest.mark.parametrize("shape", ["smooth", "ties", "constant", "few", "far"])
def test_discretize_is_exact_ntile(spark, monkeypatch, shape):
    monkeypatch.setattr(SEL, "PARTS", 4)          # many narrowing passes
    monkeypatch.setattr(SEL, "COLLECT_ROWS", 3)
    rng = np.random.default_rng(9)
    n = 3 if shape == "few" else 257
    X = {"smooth": rng.normal(size=(n, 2)), "ties": rng.integers(0, 3, (n, 2)).astype(float), "constant": np.full((n, 2), 7.0),
         "few": rng.normal(size=(n, 2)), "far": 1e8 + rng.integers(0, 9, (n, 2)) * 1e-7}[shape]
    df = features_from(spark, X, ids=rng.permutation(n) * 3 - 50).repartition(3)
    got = {r["id"]: r["bins"] for r in SEL.discretize(df, 5).collect()}
    rows = df.select("id", "x").collect()
    for j in range(2):
        order = sorted(rows, key=lambda r: (r["x"][j], r["id"]))
        q, rem = divmod(n, 5)
        want = [b + 1 for b in range(5) for _ in range(q + (b < rem))]
        assert [got[r["id"]][j] for r in order] == want


def test_cfs_shuffles_no_exploded_rows(std_e):
    binned = SEL.discretize(std_e, 5)
    plan = SEL.su_feature_class(binned)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert "Exchange" not in binned._jdf.queryExecution().executedPlan().toString()


def test_moments_far_from_the_origin(spark):
    """sd 1 around 1e8: class scatter and both silhouettes agree with numpy on centred data."""
    from lodestar.operators import prep
    rng = np.random.default_rng(6)
    X = rng.normal(size=(300, 3))
    lab = rng.integers(0, 3, 300)
    far = features_from(spark, X + 1e8, labels=[int(v) for v in lab])
    X = (X + 1e8) - 1e8                            # what a double keeps
    sc = RD.class_scatter(prep.with_label_ix(far, prep.levels(far)), 3, 3)
    W = sum((X[lab == k] - X[lab == k].mean(0)).T @ (X[lab == k] - X[lab == k].mean(0)) for k in range(3))
    assert np.allclose(sc.within, W, rtol=1e-6, atol=1e-4)
    a = far.withColumn("cluster", F.col("label"))
    for fn, power in ((SH.silhouette_exact, 1), (SH.silhouette_squared, 2)):
        got = fn(a).toPandas().sort_values("id")["s"].to_numpy()
        D = np.sqrt(((X[:, None] - X[None]) ** 2).sum(2)) ** power
        s = []
        for i in range(len(X)):
            own = lab == lab[i]
            ai = D[i, own].sum() / (own.sum() - 1)
            bi = min(D[i, lab == c].mean() for c in range(3) if c != lab[i])
            s.append((bi - ai) / max(ai, bi))
        assert np.allclose(got, s, atol=1e-6)


def test_one_distance_pass_serves_all_clusterings(std_e):
    many = SH.silhouette_many(KM.assign_many(std_e, {k: KM.first_rows(std_e, k) for k in (2, 5)}, passthrough=("id", "x"))).toPandas()
    for k in (2, 5):
        one = SH.silhouette_exact(KM.assign(std_e, KM.first_rows(std_e, k), passthrough=("id", "x"))).toPandas().sort_values("id")
        got = many[many["model"] == k].sort_values("id")
        assert np.allclose(one["s"], got["s"], atol=1e-12) and (one["cluster"].to_numpy() == got["cluster"].to_numpy()).all()


def test_silhouette_groups_stay_small_however_many_rows(spark, std_e, monkeypatch):
    for n in (10, 10 ** 6, 10 ** 9):
        for width in (66, 5_000):
            block = -(-n // SH.grid_for(n, 200, width))
            assert 2 * block * width <= 1.01 * SH.GROUP_DOUBLES or block == 1
    a = KM.assign(std_e, KM.first_rows(std_e, 4), passthrough=("id", "x"))
    one = SH.silhouette_exact(a, grid=1).toPandas().sort_values("id")
    seen = []
    monkeypatch.setattr(SH, "GROUP_DOUBLES", 10 * 2 * 68)
    monkeypatch.setattr(SH, "grid_for", lambda *args, f=SH.grid_for: seen.append(f(*args)) or seen[-1])
    many = SH.silhouette_exact(a).toPandas().sort_values("id")
    assert seen == [-(-len(one) // 10)]
    assert np.allclose(one["s"], many["s"], atol=1e-9) and (one["neighbour"].to_numpy() == many["neighbour"].to_numpy()).all()


def test_wide_pca_equals_the_full_decomposition(spark, std_e):
    full = RD.pca_fit(std_e, 64)
    wide = RD.pca_wide(std_e, 6, 1)
    assert wide.converged and wide.n == full.n and wide.total == pytest.approx(full.eigenvalues.sum())
    assert np.allclose(wide.eigenvalues, full.eigenvalues[:6], rtol=1e-9) and np.allclose(wide.rotation, full.rotation[:, :6], atol=1e-7)
    assert np.allclose(wide.mean, full.mean)


def test_wide_pca_of_a_wide_low_rank_and_constant_table(spark):
    rng = np.random.default_rng(3)
    M = rng.normal(size=(60, 3)) * [9, 5, 2] @ np.linalg.qr(rng.normal(size=(3000, 3)))[0].T + 7
    df = features_from(spark, M).repartition(3)
    w = RD.pca_wide(df, 5, 1)
    _, s, vt = np.linalg.svd(M - M.mean(axis=0), full_matrices=False)
    assert w.converged and len(w.eigenvalues) == 3 and w.passes <= 4
    assert np.allclose(w.eigenvalues, s[:3] ** 2 / 59) and np.allclose(np.abs((vt[:3] @ w.rotation)), np.eye(3), atol=1e-8)
    flat = RD.pca_wide(features_from(spark, np.ones((5, 4))), 2, 1)
    assert len(flat.eigenvalues) == 0 and flat.converged and flat.total == 0
    assert RD.pca_wide(df.where("id < 0"), 2, 1).n == 0
