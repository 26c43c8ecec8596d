"""Rows in numpy blocks, and the fits that pass over them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.functions import arrowkit
from lodestar.functions import blocks as B
from lodestar.operators import backprop as BP
from lodestar.operators import kmeans as KM
from lodestar.operators import kmeans_sweep as KS
from lodestar.operators import mixture as MX
from lodestar.operators import reduce as RD

from core_helpers import features_from

X = np.random.default_rng(3).normal(size=(300, 4)) ** 3


def test_blocks_hold_every_row_and_add_up(spark, monkeypatch):
    df = features_from(spark, X).coalesce(1).withColumn("k", F.col("id").cast("int"))
    monkeypatch.setattr(B, "BLOCK_ROWS", 11)
    with B.blocks(df, ["x", "id", "k"]) as held:
        got = held.rdd.collect()
        assert held.rows == 300 and max(len(b["id"]) for b in got) <= 11
        assert all(b["x"].shape == (len(b["id"]), 4) and (b["k"] == b["id"]).all() for b in got)
        ids = np.concatenate([b["id"] for b in got])
        assert sorted(ids) == sorted(r["id"] for r in df.select("id").collect())
        assert (np.bincount(held.rdd.glom().map(lambda p: sum(len(b["id"]) for b in p)).collect()) > 0).sum() <= 2  # dealt evenly
        whole = held.sums(lambda b: b["x"].sum(axis=0), 4)
        monkeypatch.setattr(arrowkit, "DRIVER_SUM_ENTRIES", 0)  # one chunk an entry, added by tasks
        assert (held.sums(lambda b: b["x"].sum(axis=0), 4) == whole).all() and np.allclose(whole, X.sum(axis=0))
        with B.blocks(held, ["x"]) as same:
            assert same is held
    with B.blocks(df.where("id < 0"), ["x"]) as none:
        assert none.rows == 0 and (none.sums(lambda b: b["x"].sum(axis=0), 4) == 0).all()
    for bad in (F.when(F.col("id") > 5, F.col("x")), F.array(F.lit(1.0), F.lit(None).cast("double"))):
        with pytest.raises(Exception, match="null"):
            with B.blocks(df.withColumn("x", bad), ["x"]):
                pass


def nets(df, steps):
    return BP.train(df.select("x", (F.col("id") % 2).alias("label_ix"), (F.col("id") % 5 == 0).cast("int").alias("fold")),
                    [BP.Net((), 1, (0, 1, 2, 3))], 2, steps, hidden=3)


FITS = {
    "F5, F6, F7: k-means": lambda df, n: KM.lloyd(df, [X[:7]], max_iter=n),
    "F1: carried bounds": lambda df, n: KS.bounded_lloyd(df, [X[:7]], max_iter=n),
    "F4, F5: mixtures": lambda df, n: MX.em(df, [MX.init_from_centers(X[:3], "VVI")], max_iter=n, tol=0.0),
    "F3, F6, F7: FastICA": lambda df, n: RD.ica_fit_many(df, 4, [3], 1, max_iter=n, tol=0.0),
    "F2, F8, F9: nets": nets,
}


@pytest.mark.parametrize("name", FITS)
def test_a_further_pass_is_one_stage_over_all_cores(spark, name):
    """Whatever the partitions of the input: they were one task and a shuffle a pass before."""
    df, sc = features_from(spark, X).coalesce(1), spark.sparkContext

    def tasks(passes):
        sc.setJobGroup(f"{name} {passes}", name)
        try:
            FITS[name](df, passes)
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)
        status = sc.statusTracker()
        jobs = [status.getJobInfo(j).stageIds for j in sorted(status.getJobIdsForGroup(f"{name} {passes}"))]
        most = [max((status.getStageInfo(s).numTasks for s in stages if status.getStageInfo(s)), default=0) for stages in jobs]
        return len(jobs), sum(m == sc.defaultParallelism for m in most)  # stages whose shuffle is there already are listed too

    few, many = tasks(2), tasks(5)
    assert (many[0] - few[0], many[1] - few[1]) == (3, 3)


def test_sweeps_in_parts_equal_one(spark, monkeypatch):
    df = features_from(spark, X).repartition(3)
    whole = KS.sweep(df, [2, 5], 1, runs=3, finalists=None)
    for name, most in (("STATE_ENTRIES", 0), ("STATE_MODELS", 1), ("MOVES_AT_DRIVER", 0)):
        monkeypatch.setattr(KS, name, most)
    parts = KS.sweep(df, [2, 5], 1, runs=3, finalists=None)
    for k in (2, 5):
        assert np.allclose(whole[k].centers, parts[k].centers) and whole[k].cost == pytest.approx(parts[k].cost, rel=1e-12)
