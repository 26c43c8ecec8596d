"""Many-net trainer against a plain single-machine one."""

from functools import partial

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestar.operators import backprop as BP
from lodestar.plans import experiments as X

from core_helpers import features_from


def plain_errors(X_, y, fold, net, classes, steps, hidden, rule):
    """Squared error and wrong rows of both stages after every step, one net, row loops and no stacking."""
    d = len(net.cols)
    w = BP.start_weights(net.seed, (d + 1) * hidden + (hidden + 1) * classes)
    out = []
    for step in range(steps + 1):
        W1, W2 = w[:(d + 1) * hidden].reshape(d + 1, hidden), w[(d + 1) * hidden:].reshape(hidden + 1, classes)
        g1, g2, marks = np.zeros_like(W1), np.zeros_like(W2), np.zeros((2, 2))
        for x, c, s in zip(X_[:, list(net.cols)], y, fold):
            a = np.append(x, 1.0)
            h = 1 / (1 + np.exp(-a @ W1))
            b = np.append(h, 1.0)
            o = 1 / (1 + np.exp(-b @ W2))
            e = o - np.eye(classes)[c]
            marks[s] += e @ e, o.argmax() != c
            if s == 0:
                d2 = e * o * (1 - o)
                g2 += np.outer(b, d2)
                g1 += np.outer(a, (W2[:-1] @ d2) * h * (1 - h))
        out.append(marks)
        w = w + rule.update(np.concatenate((g1.ravel(), g2.ravel())), float((np.asarray(fold) == 0).sum()))
    return out


def data(n=90, p=6, seed=0):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 3, n)
    return rng.normal(size=(n, p)) + np.eye(3)[y] @ rng.normal(size=(3, p)) * 2, y, (np.arange(n) % 4 == 0).astype(int)


def frame(spark, X_, y, fold):
    df = features_from(spark, X_, [int(v) for v in y])
    test = [i + 1 for i, f in enumerate(fold) if f]
    return df.withColumnRenamed("label", "label_ix").withColumn("fold", F.col("id").isin(test).cast("int")).repartition(5)


@pytest.mark.parametrize("method", ["descent", "resilient"])
def test_curves_equal_a_plain_trainer(spark, method):
    X_, y, fold = data()
    nets = [BP.Net(("all",), 1, tuple(range(6))), BP.Net(("few",), 1, (4, 0)), BP.Net(("all",), 2, tuple(range(6)))]
    fits = BP.train(frame(spark, X_, y, fold), nets, 3, 4, hidden=5, method=method)
    assert [f.net for f in fits] == nets
    for f in fits:
        rule = BP.Descent(0.6) if method == "descent" else BP.Resilient((len(f.net.cols) + 1) * 5 + 18)
        want = plain_errors(X_, y, fold, f.net, 3, 4, 5, rule)
        for step, stage, sse, wrong, n in f.curve:
            s = 0 if stage == "Train" else 1
            assert sse == pytest.approx(want[step][s, 0], rel=1e-9) and wrong == want[step][s, 1] and n == (fold == s).sum()


def test_chunks_layout_and_batches_do_not_change_a_fit(spark, monkeypatch):
    X_, y, fold = data()
    nets = [BP.Net((k,), k, tuple(range(6))) for k in range(3)]
    whole = BP.train(frame(spark, X_, y, fold), nets, 3, 3, hidden=4)
    monkeypatch.setattr(BP, "WEIGHTS_PER_SCAN", 50)
    monkeypatch.setattr(BP, "ROWS", 7)
    parts = BP.train(frame(spark, X_, y, fold).repartition(2), nets, 3, 3, hidden=4)
    for a, b in zip(whole, parts):
        assert np.allclose(a.hidden, b.hidden, atol=1e-9) and [c[3] for c in a.curve] == [c[3] for c in b.curve]


def test_nets_learn_classes_that_lie_apart(spark):
    X_, y, fold = data(n=240)
    fit = BP.train(frame(spark, X_, y, fold), [BP.Net((), 3, tuple(range(6)))], 3, 30)[0]
    run = BP.final_errors([fit])
    assert [r[1] for r in run] == ["Train", "Test"] and run[0][2] <= 0.05 and run[1][2] <= 0.15
    assert (fit.classes(X_[fold == 1]) != y[fold == 1]).mean() == pytest.approx(run[1][2])
    curve = [r for r in BP.stacked([fit]) if r[2] == "Train"]
    assert [r[1] for r in curve] == list(range(1, 31)) and curve[-1][3] < curve[0][3]


def test_ties_repeats_empty_stages_and_nulls(spark):
    same = BP.train(frame(spark, np.zeros((6, 2)), [0, 1, 2] * 2, [0] * 6), [BP.Net((), 1, (0, 1))], 3, 1, hidden=2)[0]
    assert BP.final_errors([same])[1][2] is None  # no test rows
    none = frame(spark, np.zeros((1, 2)), [0], [0]).where("id < 0")
    assert [r[2:] for r in BP.train(none, [BP.Net((), 1, (0, 1))], 3, 1, hidden=2)[0].curve] == [(0.0, 0, 0)] * 4
    bad = frame(spark, np.zeros((2, 2)), [0, 1], [0, 0]).withColumn("label_ix", F.when(F.col("id") > 1, F.col("label_ix")))
    with pytest.raises(Exception, match="null"):
        BP.train(bad, [BP.Net((), 1, (0, 1))], 3, 1, hidden=2)


def test_reductions_for_nets_lie_side_by_side(spark, monkeypatch):
    monkeypatch.setattr(X.RD, "ica_fit_many", partial(X.RD.ica_fit_many, max_iter=5))
    rng = np.random.default_rng(4)
    df = features_from(spark, rng.normal(size=(120, 5)) * [5, 4, 3, 2, 1], [int(v) for v in rng.integers(0, 3, 120)])
    from lodestar.operators import prep, reduce as RD
    with X.net_split(df, prep.levels(df), 1) as rows:
        assert rows.is_cached and rows.where("fold = 0").count() == 96
        for fit_on in ("all", "train"):
            wide, cells = X.reduced_net_inputs(spark, rows, [2, 3], 1, fit_on=fit_on)
            assert [(c[0], c[1]) for c in cells[:-1]] == [("N/A", 5), ("PCA", 2), ("PCA", 3), ("ICA", 2), ("ICA", 3), ("RCA", 2), ("RCA", 3)]
            model = RD.pca_fit(rows if fit_on == "all" else rows.where("fold = 0"), 5)
            got = {r["id"]: np.array(r["x"]) for r in wide.collect()}
            want = {r["id"]: (np.array(r["x"]) - model.mean) @ model.rotation[:, :3] for r in rows.collect()}
            assert all(np.allclose(got[i][list(cells[2][2])], want[i]) for i in want)
        with pytest.raises(ValueError):
            X.reduced_net_inputs(spark, rows, [2], 1, fit_on="test")


def test_repeated_nets_report_mean_and_spread(spark, std_e, monkeypatch):
    monkeypatch.setattr(X.RD, "ica_fit_many", partial(X.RD.ica_fit_many, max_iter=5))
    e = X.net_error_by_dims(spark, std_e, [4], [1, 2, 3], 1, 2).collect()
    assert {(r["algo"], r["stage"]) for r in e} == {(a, s) for a in ("N/A", "PCA", "ICA", "RCA", "CFS") for s in ("Train", "Test")}
    assert all(0 <= r["error"] <= 1 and r["error_sd"] is not None for r in e)
    c = X.net_cluster_learning_curve(spark, std_e, 3, [1, 2], 1, iters=2).collect()
    assert {(r["algo"], r["inputs"]) for r in c} == {("kmeans", "Clusters"), ("kmeans", "Both"), ("em", "Clusters"), ("em", "Both"), ("raw", "N/A")}
    assert {r["idx"] for r in c} == {1, 2} and {r["converged"] for r in c if r["algo"] != "em"} == {None}


def test_stacked_nets_equal_single_ones_on_ties_and_saturated_units():
    """A stack's arrays are used again by parts of any length; of equal outputs the first is the answer."""
    rng = np.random.default_rng(2)
    W1, W2, rows = rng.normal(size=(3, 5, 4)) * 300, rng.normal(size=(3, 5, 6)) * 300, rng.normal(size=(11, 4))
    W2[1] = 0.0  # all outputs 1/2
    target = rng.integers(0, 6, 11)
    room = BP._Room()
    stack = BP._Stack(W1, W2, room)
    for lo, hi in ((0, 7), (7, 11), (0, 11)):
        A, goal = BP._inputs(rows[lo:hi], [3, 0, 1, 2]), np.eye(6)[target[lo:hi]].T
        O = stack.forward(A)
        E, sse, wrong = stack.errors(O, goal, target[lo:hi])
        stack.backward(A, E)
        G1, G2 = np.zeros(W1.shape), np.zeros(W2.shape)
        stack.take(G1, G2)
        for r in range(3):
            H = 1 / (1 + np.exp(-np.clip(A @ W1[r], -500, 500)))
            P = 1 / (1 + np.exp(-np.clip(H @ W2[r, :-1] + W2[r, -1], -500, 500)))
            D2 = (P - goal.T) * P * (1 - P)
            want = np.concatenate((H.T @ D2, D2.sum(axis=0)[None]))
            assert np.allclose(G2[r], want) and np.allclose(G1[r], A.T @ ((D2 @ W2[r, :-1].T) * H * (1 - H)))
            assert sse[r] == pytest.approx(((P - goal.T) ** 2).sum()) and wrong[r] == (P.argmax(axis=1) != target[lo:hi]).sum()


def test_gradients_of_a_hundred_nets_are_added_without_a_shuffle(spark):
    """twelve tasks of 174,000 numbers each went through a shuffle in every step before."""
    from lodestar.functions.blocks import Blocks
    sc = spark.sparkContext
    held = Blocks(sc.parallelize([{"x": np.full((1, 1), float(k))} for k in range(12)], 12), 12)
    sc.setJobGroup("gradients", "gradients")
    try:
        total = held.sums(lambda b: np.full(174_000, b["x"][0, 0]), 174_000)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        held.unpersist()
    status = sc.statusTracker()
    assert (total == 66).all() and [len(status.getJobInfo(j).stageIds) for j in status.getJobIdsForGroup("gradients")] == [1]
