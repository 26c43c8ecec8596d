"""The code paths taken only on large inputs, forced on small data and
compared with the small-input paths."""

import numpy as np

from lodestar.functions import arrowkit
from lodestar.operators import kmeans as KM
from lodestar.operators import linalg as LA
from lodestar.operators import mixture as MX


def test_tree_summed_statistics_equal_direct(std_e, monkeypatch):
    direct = LA.gram(std_e.repartition(5), 64)
    monkeypatch.setattr(arrowkit, "DRIVER_SUM_ENTRIES", 0)   # every tree level
    monkeypatch.setattr(arrowkit, "FANIN", 2)                # 5 → 3 → 2 → 1 partitions
    monkeypatch.setattr(arrowkit, "CHUNK", 100)              # 4,161 entries in 42 chunks
    tree = LA.gram(std_e.repartition(5), 64)
    assert np.allclose(direct, tree, rtol=1e-12, atol=1e-12)


def test_lloyd_chunked_scans_equal_one_scan(std_e, monkeypatch):
    starts = [KM.first_rows(std_e, k) for k in (3, 5, 7)]
    one = KM.lloyd(std_e, starts, max_iter=3)
    monkeypatch.setattr(KM, "MAX_CENTER_ENTRIES_PER_SCAN", 1)  # one model per scan
    many = KM.lloyd(std_e, starts, max_iter=3)
    for a, b in zip(one, many):
        assert np.allclose(a.centers, b.centers) and np.isclose(a.cost, b.cost)


def test_em_chunked_scans_equal_one_scan(std_e, monkeypatch):
    from lodestar.operators import reduce as RD
    z = RD.pca_transform(std_e, RD.pca_fit(std_e, 64), 4).persist()
    starts = lambda: [MX.init_from_centers(KM.first_rows(z, g), f, 1.0)
                      for g, f in ((2, "VVI"), (3, "VVV"), (2, "EEE"))]
    one = MX.em(z, starts(), max_iter=4, tol=0.0)
    monkeypatch.setattr(MX, "MAX_STATS_PER_SCAN", 1)
    many = MX.em(z, starts(), max_iter=4, tol=0.0)
    for a, b in zip(one, many):
        assert np.allclose(a.means, b.means) and np.isclose(a.loglik, b.loglik)


def test_group_sums_matches_add_at():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(1000, 7))
    g = rng.integers(0, 13, 1000)
    want = np.zeros((15, 7))
    np.add.at(want, g, X)
    assert np.allclose(arrowkit.group_sums(X, g, 15), want)


def test_nearest_matches_direct():
    rng = np.random.default_rng(5)
    for k in (1, 10, 200):
        for off in (0.0, 1e8):
            X = np.round(rng.normal(size=(2000, 2)), 1) + off      # coarse values: many near-ties
            C = np.round(rng.normal(size=(k, 2)), 1) + off
            C[k // 2] = C[0]                                       # two equal centres
            a, d = KM.nearest(X, C)
            D = KM._direct_d2(X, C)
            assert (a == np.argmin(D, axis=1)).all() and np.array_equal(d, D.min(1))


def test_partition_count_and_width_do_not_change_values(spark):
    from core_helpers import collect_matrix, features_from
    from lodestar.operators import prep
    rng = np.random.default_rng(8)
    for p in (10, 2000):
        X = rng.normal(3.0, 2.0, size=(60, p))
        X[:, 2] = 1.0
        want = (X - X.mean(0)) / np.where(X.std(0, ddof=1) > 0, X.std(0, ddof=1), 1.0)
        for parts in (1, 50):
            _, Z = collect_matrix(prep.standardize(features_from(spark, X).repartition(parts)))
            assert np.allclose(Z, want, atol=1e-9)


def test_statistics_read_their_input_once(spark, tmp_path):
    """Rows read by one statistics pass over a shuffled frame, counted at the source."""
    src = spark.range(1000).repartition(4)
    seen = spark.sparkContext.accumulator(0)

    def tap(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    from pyspark.sql import functions as F
    df = src.mapInArrow(tap, "id BIGINT").groupBy("id").agg(F.first("id").alias("v")).select("id", F.array(F.col("v").cast("double")).alias("x"))
    assert LA.moments(df, 1).n == 1000
    assert seen.value == 1000
