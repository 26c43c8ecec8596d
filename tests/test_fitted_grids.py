"""The rows-only fitted queries keep their whole grids."""

import numpy as np

from lodestar.operators import mixture as MX
from lodestar.plans import experiments as X
from lodestar.plans import queries as Q

from core_helpers import SF0001


def grid_only(asked):
    """Stands in for ``mixture_grid``: unfitted models of the grid asked for."""
    def grid(df, Gs, families, seed, iters=100):
        asked.append((list(Gs), list(families)))
        models = [MX.init_from_centers(np.zeros((G, 3)), f) for G in Gs for f in families]
        for m in models:
            m.loglik, m.n = float(m.G), 10
        return models
    return grid


def test_mixture_queries_fit_their_whole_grids(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(X, "mixture_grid", grid_only(asked))
    cells = {(r["numClusters"], r["family"]) for r in Q.gmm_bic_curve(spark, SF0001).collect()}
    assert cells == {(G, f) for G in (2, 3, 4) for f in MX.FAMILIES}
    assert {r["numClusters"] for r in Q.gmm_best_bic(spark, SF0001).collect()} == {2, 3, 4}
    assert [len(r["cov"]) for r in Q.gmm_components(spark, SF0001).collect()] == [9] * 3
    assert asked[-1] == ([3], ["VVV"])


def test_net_errors_cover_all_dims_and_runs(spark, monkeypatch):
    asked = []

    def errors(spark, df, dims, seeds, seed, steps):
        asked.append((list(dims), len(seeds), steps))
        return spark.createDataFrame([], "dims INT, algo STRING, stage STRING, error DOUBLE, error_sd DOUBLE, ica_converged BOOLEAN")

    monkeypatch.setattr(X, "net_error_by_dims", errors)
    Q.mlp_error_by_dims(spark, SF0001).collect()
    assert asked == [([2, 5, 10, 15, 20, 25], 20, 15)]


def test_fits_run_to_their_tolerance_and_tables_tell(spark, std_e, monkeypatch):
    caps, em, ica = [], MX.em, X.RD.ica_fit

    def short_em(df, starts, max_iter=100, **kw):
        caps.append(("em", max_iter))
        return em(df, starts, max_iter=2, **kw)

    def short_ica(*args, max_iter=200, **kw):
        caps.append(("ica", max_iter))
        return ica(*args, max_iter=1, **kw)

    monkeypatch.setattr(MX, "em", short_em)
    monkeypatch.setattr(X.RD, "ica_fit", short_ica)
    monkeypatch.setattr(Q, "std_e", lambda *_: std_e)
    monkeypatch.setattr(X, "cfs_subset", lambda df, p: [0, 1, 2])
    rows = {r["reduction"]: r for r in Q.reduced_error_table(spark, SF0001).collect()}
    assert set(caps) == {("em", 100), ("ica", 200)}
    assert not any(r["converged"] for r in rows.values())
    assert {a: r["ica_converged"] for a, r in rows.items()} == {"N/A": None, "PCA": None, "ICA": False, "RCA": None, "CFS": None}
    assert {r["ica_converged"] for r in Q.ica_sources(spark, SF0001).collect()} == {False}
    assert {r["converged"] for r in Q.em_confusion(spark, SF0001).collect()} == {False}
    caps.clear()
    with X.net_split(std_e, X.prep.levels(std_e), 1) as rows:
        told = {kind: settled for kind, _, _, settled in X.cluster_net_inputs(spark, rows, 3, 1)[1]}
    assert told == {"kmeans": None, "em": False, "raw": None} and caps == [("em", 100)]


def test_best_bic_tells_whether_its_mixture_converged(spark, monkeypatch):
    monkeypatch.setattr(X, "mixture_grid", grid_only([]))
    assert [r["converged"] for r in Q.gmm_best_bic(spark, SF0001).collect()] == [False] * 3
    assert not any(r["converged"] for r in Q.gmm_components(spark, SF0001).collect())
