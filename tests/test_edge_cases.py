"""FIXTURES §6 edge cases not covered elsewhere: k = 1, d = p, duplicate rows,
exactly collinear columns."""

import numpy as np

from core_helpers import features_from
from lodestar.operators import kmeans as KM
from lodestar.operators import linalg as LA
from lodestar.operators import mixture as MX
from lodestar.operators import reduce as RD
from lodestar.operators import silhouette as SH


def test_k_equals_one(spark):
    rng = np.random.default_rng(1)
    X = rng.normal(size=(40, 3))
    df = features_from(spark, X)
    m = KM.lloyd(df, [X[:1]], max_iter=5)[0]
    assert np.allclose(m.centers[0], X.mean(0))
    assert np.isclose(m.cost, ((X - X.mean(0)) ** 2).sum())
    a = KM.assign(df, m.centers, passthrough=("id", "x"))
    s = SH.silhouette_exact(a).toPandas()
    assert (s["s"] == 0.0).all()        # no other cluster: width 0 by definition


def test_projection_with_d_equal_p_is_lossless(spark):
    rng = np.random.default_rng(2)
    X = rng.normal(size=(60, 5))
    df = features_from(spark, X)
    S = LA.gram(df, 5)
    Q = RD.haar_matrix(5, 5, 7, 0)
    assert LA.recon_error(S, Q @ Q.T) < 1e-9
    model = RD.pca_fit(df, 5)
    mo = LA.moments(df, 5, shift=model.mean)
    assert dict(RD.recon_errors(mo.g, model.rotation, [5]))[5] < 1e-9


def test_duplicate_rows(spark):
    X = np.array([[1.0, 1.0]] * 5 + [[4.0, 4.0]] * 5)
    df = features_from(spark, X)
    m = KM.lloyd(df, [X[[0, 5]]], max_iter=3)[0]
    assert sorted(m.sizes.tolist()) == [5.0, 5.0] and m.cost == 0.0
    a = KM.assign(df, m.centers, passthrough=("id", "x"))
    s = SH.silhouette_exact(a).toPandas()
    assert np.allclose(s["s"], 1.0)       # a = 0 inside identical copies


def test_collinear_columns(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(80, 2))
    X = np.column_stack([base, base[:, 0] + base[:, 1]])   # rank 2 of 3
    df = features_from(spark, X)
    model = RD.pca_fit(df, 3)
    assert model.eigenvalues[2] < 1e-10 * model.eigenvalues[0]
    ica = RD.ica_fit(df, 3, 3, seed=1, max_iter=20)
    assert ica.W.shape == (2, 2)           # whitening stops at the numerical rank
    start = MX.init_from_centers(X[[0, 1]], "VVV", var=1.0)
    fit = MX.em(df, [start], max_iter=5, reg=1e-6)[0]
    assert not fit.failed and np.isfinite(fit.loglik)   # the variance floor keeps it positive definite


def test_ntile_expr_property(spark):
    from hypothesis import given, settings, strategies as st
    from pyspark.sql import functions as F
    from lodestar.functions.ranking import ntile_expr

    def reference(n, b):
        q, rem = divmod(n, b)
        out = []
        for bucket in range(1, b + 1):
            out += [bucket] * (q + (1 if bucket <= rem else 0))
        return out

    @settings(max_examples=25, deadline=None)
    @given(st.integers(min_value=1, max_value=60), st.integers(min_value=1, max_value=12))
    def check(n, b):
        df = spark.range(n).select(F.col("id").alias("r"), F.lit(n).alias("gn"))
        got = [r["t"] for r in df.select(ntile_expr("r", "gn", b).alias("t")).orderBy("r").collect()]
        assert got == reference(n, b)

    check()


def test_letters_shaped_pipeline(spark, tmp_path):
    """Synthetic rows with the letter-recognition schema (its data file is not
    shipped): scan → standardise → k-means → scoring."""
    from lodestar.operators import prep, scoring
    from lodestar.sources import text
    rng = np.random.default_rng(11)
    letters = [chr(ord("A") + i) for i in range(26)]
    proto = rng.integers(0, 16, size=(26, 16))
    lines = []
    for i in range(26 * 30):
        c = i % 26
        v = np.clip(proto[c] + rng.integers(-2, 3, 16), 0, 15)
        lines.append(",".join([letters[c]] + [str(int(t)) for t in v]))
    path = tmp_path / "letter-recognition.data"
    path.write_text("\n".join(lines) + "\n")
    df = text.letters_features(text.read_letters(spark, str(path)))
    s = prep.standardize(df).persist()
    assert s.count() == 780
    m = KM.kmeans(s, 26, seed=5, runs=2, max_iter=20)
    lv = prep.levels(s)
    err = scoring.label_error(KM.assign(s, m.centers), lv).collect()[0]["err"]
    assert err < 0.5                      # well separated prototypes: clusters recover letters
    conf = scoring.cluster_confusion(KM.assign(s, m.centers), lv, 26)
    assert conf.agg({"n": "sum"}).collect()[0][0] == 780
