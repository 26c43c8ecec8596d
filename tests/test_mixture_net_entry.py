import duckdb
import numpy as np
import pytest

from core_helpers import SF0001, collect_matrix, features_from
from lodestar.operators import kmeans as KM
from lodestar.operators import mixture as MX
from lodestar.operators import prep
from lodestar.operators import reduce as RD


@pytest.fixture(scope="module")
def small(std_e):
    model = RD.pca_fit(std_e, 64)
    return RD.pca_transform(std_e, model, 4).persist()


def test_em_loglik_non_decreasing_and_posterior(small):
    for fam in MX.FAMILIES:
        start = MX.init_from_centers(KM.first_rows(small, 3), fam, var=1.0)
        m = MX.em(small, [start], max_iter=8, tol=0.0, reg=0.0)[0]
        h = m.history
        assert not m.failed and all(b >= a - 1e-6 * abs(a) for a, b in zip(h, h[1:])), fam
        assert np.isclose(m.weights.sum(), 1.0)
    z = MX.posterior(small, m).toPandas()
    assert np.allclose([sum(r) for r in z["z"]], 1.0)


def test_em_matches_numpy_reference(small):
    _, X = collect_matrix(small)
    start = MX.init_from_centers(KM.first_rows(small, 2), "EII", var=1.0)
    m = MX.em(small, [start], max_iter=3, tol=0.0, reg=0.0)[0]
    mu, var, pi = X[[0, 1]].copy(), 1.0, np.array([0.5, 0.5])
    n, p = X.shape
    for _ in range(3):
        d2 = ((X[:, None] - mu[None]) ** 2).sum(2)
        lg = np.log(pi) - 0.5 * (p * np.log(2 * np.pi * var)) - d2 / (2 * var)
        r = np.exp(lg - lg.max(1, keepdims=True))
        r /= r.sum(1, keepdims=True)
        nk = r.sum(0)
        mu = (r.T @ X) / nk[:, None]
        var = (r * ((X[:, None] - mu[None]) ** 2).sum(2)).sum() / (n * p)
        pi = nk / n
    assert np.allclose(m.means, mu) and np.isclose(m.covs[0, 0], var) and np.allclose(m.weights, pi)


def test_bic_df_and_failed_fit_is_null(small):
    assert MX.n_params("VVV", 3, 4) == 2 + 12 + 30
    assert MX.n_params("EII", 3, 4) == 2 + 12 + 1
    # the published counts for G = 3, p = 4
    want = dict(EII=1, VII=3, EEI=4, VEI=6, EVI=10, VVI=12, EEE=10, EVE=16, VEE=12, VVE=18, EEV=22, VEV=24, EVV=28, VVV=30)
    assert {f: MX.n_params(f, 3, 4) - 14 for f in MX.FAMILIES} == want
    bad = MX.init_from_centers(np.zeros((2, 4)), "VVV", var=1.0)
    bad.covs[0] = -np.eye(4)                    # not positive definite → failed, null BIC
    m = MX.em(small, [bad], max_iter=2)[0]
    assert m.failed and m.bic() is None


def test_entry_and_catalogue(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and set(df.columns) == {"cluster", "argmax", "size", "err", "err_rate"}
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(sql) >= 40


@pytest.mark.parametrize("name", ["cluster_label_error", "kmeans_lloyd", "pairwise_silhouette",
                                  "symmetric_uncertainty", "em_spherical", "orders_split",
                                  "distance_histogram", "train_test_split", "cfs_merit_greedy",
                                  "delimited_round_trip", "em_spherical_bic", "silhouette_squared_e"])
def test_oracle_parity_sf0001(spark, name):
    import __spark_entry__ as entry
    from lodestar.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    sp = entry.queries()[name](spark, SF0001).toPandas()
    du = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(sp.columns) == sorted(du.columns)
    cols = sorted(sp.columns)
    a = sorted(map(tuple, sp[cols].round(6).astype(str).values.tolist()))
    b = sorted(map(tuple, du[cols].round(6).astype(str).values.tolist()))
    assert a == b


def test_streaming_scoring_matches_batch(spark, tmp_path):
    from lodestar.operators import prep
    from lodestar.sources import tables
    from lodestar.streaming import scoring as ST
    e = tables.features_embeddings(spark, SF0001)
    stats = prep.column_stats(e)
    s = prep.standardize(e, stats=stats)
    C = KM.first_rows(s, 4)
    batch = {r["cluster"]: r["n"] for r in KM.cost_table(KM.assign(s, C)).collect()}
    stream = ST.standardize_stream(ST.embeddings_stream(spark, SF0001), stats.mean, stats.sd)
    q = ST.run_to_memory(ST.running_cluster_sizes(ST.assign_stream(stream, C)), "lodestar_sizes",
                         str(tmp_path / "ckpt"))
    try:
        got = {r["cluster"]: r["n"] for r in spark.sql("SELECT * FROM lodestar_sizes").collect()}
    finally:
        q.stop()
    assert got == batch


def test_streaming_batches_sink_is_idempotent(spark, tmp_path):
    from lodestar.operators import prep
    from lodestar.sources import tables
    from lodestar.streaming import scoring as ST
    e = tables.features_embeddings(spark, SF0001)
    stats = prep.column_stats(e)
    C = KM.first_rows(prep.standardize(e, stats=stats), 3)
    scored = ST.assign_stream(ST.standardize_stream(ST.embeddings_stream(spark, SF0001),
                                                    stats.mean, stats.sd), C)
    out, ck = str(tmp_path / "scored"), str(tmp_path / "ck")
    ST.write_batches(scored, out, ck).awaitTermination(120)
    first = spark.read.parquet(out).count()
    ST.write_batches(scored, out, ck).awaitTermination(120)   # restart from the checkpoint
    assert first == e.count() == spark.read.parquet(out).count()


def test_project_stream_and_hard_assign(spark, tmp_path, small):
    from lodestar.operators import prep
    from lodestar.sources import tables
    from lodestar.streaming import scoring as ST
    e = tables.features_embeddings(spark, SF0001)
    M = RD.haar_matrix(64, 3, 1, 0)
    stream = ST.project_stream(ST.embeddings_stream(spark, SF0001), M)
    q = ST.run_to_memory(stream.groupBy().count(), "lodestar_proj", str(tmp_path / "ck"))
    try:
        assert spark.sql("SELECT * FROM lodestar_proj").collect()[0][0] == e.count()
    finally:
        q.stop()
    m = MX.em(small, [MX.init_from_centers(KM.first_rows(small, 3), "VVI", 1.0)], max_iter=3)[0]
    hard = MX.hard_assign(MX.posterior(small, m)).toPandas()
    assert (hard["cluster"] == [int(np.argmax(z)) for z in hard["z"]]).all()


def test_families_keep_their_structure(small):
    """Shared parts are equal across components, and a fit far from the origin is the same fit."""
    from pyspark.sql import functions as F
    far = small.withColumn("x", F.transform("x", lambda v: v + 1e6))
    for fam in ("EII", "VEI", "EVI", "EEE", "EVE", "VEE", "EEV", "VEV", "EVV"):
        c = KM.first_rows(small, 2)
        a = MX.em(small, [MX.init_from_centers(c, fam)], max_iter=3, tol=0.0)[0]
        b = MX.em(far, [MX.init_from_centers(c + 1e6, fam)], max_iter=3, tol=0.0)[0]
        assert np.isclose(a.loglik, b.loglik, rtol=1e-6) and np.allclose(a.covs, b.covs, rtol=1e-4, atol=1e-6), fam
        S = np.stack([a.full(g) for g in range(2)])
        vol = np.exp(np.linalg.slogdet(S)[1] / a.p)
        assert fam[0] == "V" or np.isclose(vol[0], vol[1], rtol=1e-3), fam
        lam = np.linalg.eigvalsh(S) / vol[:, None]
        assert fam[1] == "V" or np.allclose(lam[0], lam[1], rtol=1e-2), fam
        if fam[2] == "E":  # one orientation: the matrices commute
            assert np.allclose(S[0] @ S[1], S[1] @ S[0], atol=1e-3 * np.abs(S).max() ** 2), fam


def test_em_flags_convergence(small):
    start = lambda: [MX.init_from_centers(KM.first_rows(small, 2), "EII")]
    assert not MX.em(small, start(), max_iter=1)[0].converged
    assert MX.em(small, start(), max_iter=200, tol=1e-4)[0].converged
