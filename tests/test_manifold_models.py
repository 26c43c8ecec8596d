"""Landmark scaling and kernel PCA against the full matrices; the model store's round trips."""

import dataclasses

import numpy as np
import pytest

from lodestar.operators import kmeans as KM
from lodestar.operators import manifold as MF
from lodestar.operators import mixture as MX
from lodestar.operators import reduce as RD
from lodestar.sources import models as ST

from core_helpers import collect_matrix, features_from


def data(n=120, p=5, seed=0):
    return np.random.default_rng(seed).normal(size=(n, p)) * np.arange(p, 0, -1) + 3


def same_up_to_sign(A, B, tol=1e-8):
    assert A.shape == B.shape
    for j in range(A.shape[1]):
        assert min(np.abs(A[:, j] - B[:, j]).max(), np.abs(A[:, j] + B[:, j]).max()) < tol * max(1.0, np.abs(B[:, j]).max()), j


def plain_landmarks(X, m):
    picked = [X[0]]
    while len(picked) < m:
        d = np.stack([((X - r) ** 2).sum(axis=1) for r in picked]).min(axis=0)
        if d.max() <= 0:
            break
        picked.append(X[int(d.argmax())])
    return np.array(picked)


def test_landmarks_are_farthest_first_with_few_passes(spark, monkeypatch):
    X = np.round(data(300, 3), 1)
    df = features_from(spark, X).repartition(4)
    want = plain_landmarks(X, 40)
    for fetched in (256, 12):
        monkeypatch.setattr(MF, "FARTHEST", fetched)
        assert (MF.landmarks(df, 40) == want).all()
    assert len(MF.landmarks(features_from(spark, np.repeat(X[:4], 5, axis=0)), 10)) == len(np.unique(X[:4], axis=0))
    assert len(MF.landmarks(df.where("id < 0"), 5)) == 0


def test_scaling_equals_the_full_distance_matrix(spark):
    X = data()
    df = features_from(spark, X).repartition(3)
    m = MF.mds_fit(df, 12)
    _, Z = collect_matrix(MF.place(df, m, 5), "z")
    D = ((X[:, None] - X[None]) ** 2).sum(axis=2)
    J = np.eye(len(X)) - 1 / len(X)
    lam, vec = np.linalg.eigh(-0.5 * J @ D @ J)
    lam, vec = lam[::-1][:5], vec[:, ::-1][:, :5]
    assert np.allclose(m.eigenvalues, lam) and m.share(2) == pytest.approx(lam[:2].sum() / lam.sum())
    same_up_to_sign(Z, vec * np.sqrt(lam))
    pca = RD.pca_fit(df, 5)
    _, S = collect_matrix(RD.pca_transform(df, pca), "x")
    same_up_to_sign(Z, S)


def test_degenerate_and_repeated_rows(spark):
    flat = features_from(spark, np.repeat(np.array([[1.0, 2.0], [3.0, 2.0]]), 6, axis=0))
    m = MF.mds_fit(flat, 5)
    _, Z = collect_matrix(MF.place(flat, m, 2), "z")
    assert Z.shape == (12, 1) and sorted(set(np.round(Z[:, 0], 9))) == [-1.0, 1.0] and m.share(2) == 1.0
    one = features_from(spark, np.ones((4, 3)))
    assert collect_matrix(MF.place(one, MF.mds_fit(one, 5), 2), "z")[1].shape == (4, 0)
    assert len(MF.mds_fit(one.where("id < 0"), 3).eigenvalues) == 0


def test_kernel_pca_equals_the_full_kernel_matrix(spark):
    X = data(300, 4, 1) / 4
    df = features_from(spark, X).repartition(3)
    K = np.exp(-0.3 * ((X[:, None] - X[None]) ** 2).sum(axis=2))
    J = np.eye(len(X)) - 1 / len(X)
    lam, vec = np.linalg.eigh(J @ K @ J)
    lam, vec = lam[::-1][:3], vec[:, ::-1][:, :3]
    whole = MF.kernel_pca_fit(df, 300, 0.3)
    same_up_to_sign(collect_matrix(MF.place(df, whole, 3), "z")[1], vec * np.sqrt(lam), 1e-6)
    assert whole.residual < 1e-8
    few = MF.kernel_pca_fit(df, 40, 0.3)
    L = few.points
    Kl = np.exp(-0.3 * ((X[:, None] - L[None]) ** 2).sum(axis=2))
    Kll = np.exp(-0.3 * ((L[:, None] - L[None]) ** 2).sum(axis=2))
    assert few.residual == pytest.approx(1 - np.einsum("ij,ji->", Kl @ np.linalg.pinv(Kll), Kl.T) / len(X), abs=1e-6)
    assert 0 < few.residual < MF.kernel_pca_fit(df, 10, 0.3).residual


def test_stored_models_come_back_bit_for_bit(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ST, "PART", 7)
    X = data(90)
    df = features_from(spark, X)
    mix = MX.em(df, [MX.init_from_centers(X[:2], "VVV", 4.0)], max_iter=3)[0]
    some = [mix, RD.pca_fit(df, 5), RD.ica_fit(df, 5, 2, 1, max_iter=5), KM.kmeans(df, 3, 1, max_iter=4), MF.mds_fit(df, 8),
            ST.CutPoints([np.array([0.1, 1 / 3]), np.zeros(0), np.array([np.nextafter(1.0, 2.0)])]), ST.CutPoints([])]
    for k, m in enumerate(some):
        back = ST.load(spark, ST.save(spark, m, str(tmp_path / f"m{k}")))
        assert type(back) is type(m)
        for f in dataclasses.fields(m):
            a, b = getattr(m, f.name), getattr(back, f.name)
            if isinstance(a, np.ndarray):
                assert a.dtype == b.dtype and a.shape == b.shape and a.tobytes() == b.tobytes(), f.name
            elif isinstance(a, list) and a and isinstance(a[0], np.ndarray):
                assert [v.tobytes() for v in a] == [v.tobytes() for v in b]
            else:
                assert (a == b or (a != a and b != b)) and type(a) is type(b), f.name
    ST.save(spark, some[1], str(tmp_path / "m0"))  # replaces the mixture
    assert isinstance(ST.load(spark, str(tmp_path / "m0")), RD.PCAModel)


def test_unknown_models_and_formats_are_refused(spark, tmp_path):
    from pyspark.sql import functions as F
    with pytest.raises(ValueError, match="no model store"):
        ST.save(spark, object(), str(tmp_path / "x"))
    df = spark.createDataFrame(ST.model_rows(ST.CutPoints([])), ST._SCHEMA)
    for bad in (df.withColumn("format", F.lit(2)), df.withColumn("kind", F.lit("os.system"))):
        with pytest.raises(ValueError, match="not one model"):
            ST.from_frame(bad)
