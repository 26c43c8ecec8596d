import numpy as np
import pytest
from pyspark.sql import functions as F

from core_helpers import SF0001, collect_matrix, features_from
from lodestar.operators import kmeans as KM
from lodestar.operators import prep, scoring
from lodestar.operators import histogram as H

BLOBS = np.array([[0.0] * 3, [0.1] * 3, [0.2] * 3, [9.0] * 3, [9.1] * 3, [9.2] * 3])


def test_toy_blobs_k2(spark):
    df = features_from(spark, BLOBS)
    m = KM.lloyd(df, [BLOBS[[0, 3]]], max_iter=10)[0]
    assert sorted(m.sizes.tolist()) == [3.0, 3.0]
    assert np.isclose(m.cost, 0.12)
    assert np.allclose(sorted(m.centers[:, 0]), [0.1, 9.1])


def test_cost_never_rises_and_sizes_sum(std_e):
    m = KM.lloyd(std_e, [KM.first_rows(std_e, 6)], max_iter=8)[0]
    h = m.history
    assert all(b <= a + 1e-9 for a, b in zip(h, h[1:]))
    assert int(m.sizes.sum()) == std_e.count()


def test_multi_model_equals_single(std_e):
    c4, c7 = KM.first_rows(std_e, 4), KM.first_rows(std_e, 7)
    both = KM.lloyd(std_e, [c4, c7], max_iter=3)
    one = KM.lloyd(std_e, [c7], max_iter=3)[0]
    assert np.allclose(both[1].centers, one.centers)
    assert np.isclose(both[1].cost, one.cost)


def test_repartition_invariance(std_e):
    a = KM.lloyd(std_e, [KM.first_rows(std_e, 5)], max_iter=3)[0]
    b = KM.lloyd(std_e.repartition(7), [KM.first_rows(std_e, 5)], max_iter=3)[0]
    assert np.allclose(a.centers, b.centers) and np.isclose(a.cost, b.cost)


def test_more_starts_never_worse(std_e):
    one = KM.kmeans(std_e, 5, seed=3, runs=1, max_iter=5)
    three = KM.kmeans(std_e, 5, seed=3, runs=3, max_iter=5)
    assert three.cost <= one.cost + 1e-9


def test_empty_cluster_keeps_center(spark):
    df = features_from(spark, BLOBS)
    far = np.array([[100.0] * 3])
    m = KM.lloyd(df, [np.vstack([BLOBS[[0, 3]], far])], max_iter=3)[0]
    assert m.sizes[2] == 0 and np.allclose(m.centers[2], far[0])


def test_assign_matches_numpy(std_e):
    C = KM.first_rows(std_e, 4)
    a = KM.assign(std_e, C, passthrough=("id", "x"))
    rows = a.orderBy("id").collect()
    X = np.array([r["x"] for r in rows])
    D = ((X[:, None, :] - C[None]) ** 2).sum(2)
    assert (np.array([r["cluster"] for r in rows]) == D.argmin(1)).all()
    assert np.allclose([r["d2"] for r in rows], D.min(1))


def test_mllib_cross_check(std_e):
    model, cost = KM.mllib_kmeans(std_e, 4, seed=1, max_iter=20)
    assert cost > 0 and len(model.clusterCenters()) == 4


# --- scoring on hand-made assignments ------------------------------------------

def _assigned(spark, pairs):
    rows = [(i, lab, cl) for i, (lab, cl) in enumerate(pairs)]
    return spark.createDataFrame(rows, "id BIGINT, label STRING, cluster INT")


def test_cluster_predict_err_and_confusion(spark):
    # cluster 0: a,a,b ; cluster 1: b,b ; cluster 2: c (singleton); label d wins nothing
    a = _assigned(spark, [("a", 0), ("a", 0), ("b", 0), ("b", 1), ("b", 1), ("c", 2), ("d", 1)])
    lv = prep.levels(a)
    t = {r["cluster"]: r for r in scoring.cluster_predict_err(a, lv).collect()}
    assert t[0]["argmax"] == "a" and t[0]["size"] == 3 and np.isclose(t[0]["err"], 1.0)
    assert t[1]["argmax"] == "b" and np.isclose(t[1]["err_rate"], 1 / 3)
    assert t[2]["err"] == 0.0
    conf = scoring.cluster_confusion(a, lv, 4)
    assert conf.select("predicted").distinct().count() == 3  # 'd' wins no cluster → no row
    assert conf.agg(F.sum("n")).collect()[0][0] == 7          # totals n
    err = scoring.confusion_error(conf).collect()[0]["err"]
    total_err = sum(r["err"] for r in t.values()) / 7
    assert np.isclose(err, total_err)                          # Σerr/n = 1 − trace/total


def test_majority_tie_lowest_index(spark):
    a = _assigned(spark, [("b", 0), ("a", 0)])
    lv = prep.levels(a)
    assert scoring.cluster_predict_err(a, lv).collect()[0]["argmax"] == "a"


def test_nearest_wrong_and_spectrum(spark):
    a = _assigned(spark, [("a", 0), ("a", 0), ("b", 0), ("b", 1), ("b", 1), ("c", 1)])
    lv = prep.levels(a)
    conf = scoring.cluster_confusion(a, lv, 3, square=True)
    nw = {r["target"]: r for r in scoring.nearest_wrong(conf).collect()}
    assert nw["b"]["nearest"] == "a" and np.isclose(nw["b"]["nearest_ratio"], 1 / 3)
    sp = scoring.cluster_spectrum(a).orderBy("idx").collect()
    assert [r["size"] for r in sp] == [3, 3] and [r["cluster"] for r in sp] == [0, 1]


def test_label_variance_matches_numpy(spark):
    a = _assigned(spark, [("a", 0), ("a", 0), ("b", 0), ("c", 1)])
    got = {r["cluster"]: r["label_var"] for r in scoring.cluster_label_variance(a).collect()}
    Y = np.array([[1, 0, 0], [1, 0, 0], [0, 1, 0]])
    assert np.isclose(got[0], Y.var(0, ddof=1).sum()) and got[1] == 0.0  # one-row cluster → 0


def test_best_bic_skips_null(spark):
    t = spark.createDataFrame([(2, "EII", -10.0), (2, "VVV", None), (3, "EII", float("nan")),
                               (3, "VII", -5.0)], "numClusters INT, family STRING, bic DOUBLE")
    got = {r["numClusters"]: (r["bic"], r["family"]) for r in scoring.best_bic(t, 10).collect()}
    assert got == {2: (-1.0, "EII"), 3: (-0.5, "VII")}


def test_histogram_brute_force(spark):
    rng = np.random.default_rng(0)
    d = rng.gamma(2.0, 1.0, 300)
    cls = rng.integers(0, 3, 300)
    df = spark.createDataFrame([(int(c), float(v)) for c, v in zip(cls, d)], "class INT, d DOUBLE")
    got = H.cumulative_histogram(df, bins=50).toPandas()
    w = 2 * d.mean() / 49
    for c in range(3):
        dc = d[cls == c]
        b = np.where(dc <= 2 * d.mean(), np.clip(np.ceil(dc / w), 1, 49), 50)
        want = np.cumsum([np.sum(b == k) for k in range(1, 50)]) / len(dc)
        g = got[got["class"] == c].sort_values("bin")["cum_prob"].to_numpy()
        assert np.allclose(g, want)


def test_toy_file_golden(spark, tmp_path):
    from lodestar.sources import text
    path = tmp_path / "blobs.txt"
    path.write_text("".join(" ".join(map(str, r)) + "\n" for r in BLOBS))
    df = text.read_space_vectors(spark, str(path))
    _, X = collect_matrix(df)
    m = KM.lloyd(df, [X[[0, 3]]], max_iter=10)[0]
    assert sorted(m.sizes.tolist()) == [3.0, 3.0] and m.converged
    assert np.allclose(sorted(m.centers[:, 0]), [0.1, 9.1]) and np.isclose(m.cost, 0.12)
    assert np.allclose(sorted(m.sse), [0.06, 0.06])


def test_starts_are_distinct_points(spark):
    X = np.repeat(np.array([[0.0, 0.0], [5.0, 5.0], [9.0, 0.0]]), [8, 7, 5], axis=0)
    df = features_from(spark, X)
    m = KM.kmeans(df, 3, seed=4, runs=2, max_iter=20)
    assert m.cost == 0.0 and sorted(m.sizes.tolist()) == [5.0, 7.0, 8.0] and m.converged
    with pytest.raises(ValueError, match="distinct"):
        KM.kmeans(df, 4, seed=4)
    with pytest.raises(ValueError, match="rows"):
        KM.first_rows(features_from(spark, X[:2]), 5)


def test_starts_follow_the_hash_order(spark, std_e):
    import hashlib
    ids, X = collect_matrix(std_e)
    for r, got in enumerate(KM.hashed_starts(std_e, 6, 42, range(3))):
        order = sorted(range(len(ids)), key=lambda i: (hashlib.md5(f"42-{r}:{ids[i]}".encode()).hexdigest(), ids[i]))
        assert np.allclose(got, X[order[:6]])


def test_sweep_jobs_do_not_grow_with_k(spark, std_e):
    from lodestar.plans import experiments
    lv = prep.levels(std_e)
    centres = {k: KM.first_rows(std_e, k) for k in range(2, 10)}
    tracker, sc = spark.sparkContext.statusTracker(), spark.sparkContext

    def jobs(models):
        sc.setJobGroup("count", "jobs of one scoring call")
        before = len(tracker.getJobIdsForGroup("count"))
        experiments.label_errors(std_e, models)
        return len(tracker.getJobIdsForGroup("count")) - before
    one, many = jobs({2: centres[2]}), jobs(centres)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert many == one
    err = experiments.label_errors(std_e, centres)
    for k in (2, 9):
        want = scoring.label_error(KM.assign(std_e, centres[k]), lv).first()["err"]
        assert np.isclose(err[k], want)
