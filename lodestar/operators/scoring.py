"""Cluster / label scoring.

Inputs are long assignment frames ``(id, label, cluster)`` or soft ones
``(id, label, z ARRAY<DOUBLE>)`` plus the level dictionary
``(label_ix, label)``.  Every step first reduces to counts per
(cluster, label) — partially aggregated, so a giant cluster or label costs no
more than a small one — and the remaining work runs on those k x c cells.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import map_rows
from lodestar.operators.prep import with_label_ix


def label_counts(assigned: DataFrame, lv: DataFrame, cluster: str = "cluster",
                 label: str = "label") -> DataFrame:
    """(cluster, label_ix, label, n) for every non-empty cell (A2)."""
    c = assigned.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("n"))
    return with_label_ix(c, lv, label).withColumnRenamed(cluster, "cluster")


def _winners(counts: DataFrame) -> DataFrame:
    """Per cluster: majority label index (ties → lowest index), its count, the size."""
    return counts.groupBy("cluster").agg(
        F.max_by("label_ix", F.struct(F.col("n"), -F.col("label_ix"))).alias("win_ix"),
        F.max("n").alias("win_n"),
        F.sum("n").alias("size"))


def cluster_predict_err(assigned: DataFrame, lv: DataFrame, cluster: str = "cluster",
                        label: str = "label") -> DataFrame:
    """(cluster, argmax, size, err, err_rate) — each cluster predicts its mean label."""
    w = _winners(label_counts(assigned, lv, cluster, label))
    rate = F.lit(1.0) - F.col("win_n") / F.col("size")
    out = w.join(lv.select(F.col("label_ix").alias("win_ix"), F.col(label).alias("argmax")), "win_ix")
    return out.select("cluster", "argmax", F.col("size").cast("bigint").alias("size"),
                      (rate * F.col("size")).alias("err"), rate.alias("err_rate"))


def label_error(assigned: DataFrame, lv: DataFrame, cluster: str = "cluster",
                label: str = "label") -> DataFrame:
    """Σ err / n over all clusters (C9 cell, A16)."""
    t = cluster_predict_err(assigned, lv, cluster, label)
    return t.agg((F.sum("err") / F.sum("size")).alias("err"))


def _name(lv: DataFrame, ix: str, out: str, label: str = "label") -> DataFrame:
    return lv.select(F.col("label_ix").alias(ix), F.col(label).alias(out))


def cluster_confusion(assigned: DataFrame, lv: DataFrame, n_levels: int,
                      cluster: str = "cluster", label: str = "label",
                      square: bool = False) -> DataFrame:
    """(predicted, actual, n) — each cluster takes its majority label.

    Rows exist for every label that wins at least one cluster (all labels when
    ``square``), each against every actual label, zero-filled (D3).
    """
    counts = label_counts(assigned, lv, cluster, label)
    win = _winners(counts).select("cluster", "win_ix")
    cells = (counts.join(win, "cluster")
             .groupBy(F.col("win_ix").alias("p_ix"), F.col("label_ix").alias("a_ix"))
             .agg(F.sum("n").alias("n")))
    if square:
        preds = lv.select(F.col("label_ix").alias("p_ix"))
    else:
        preds = win.select(F.col("win_ix").alias("p_ix")).distinct()
    grid = preds.select("p_ix", F.explode(F.sequence(F.lit(0), F.lit(n_levels - 1))).alias("a_ix"))
    full = grid.join(cells, ["p_ix", "a_ix"], "left").fillna(0, ["n"])
    full = (full.join(_name(lv, "p_ix", "predicted", label), "p_ix")
            .join(_name(lv, "a_ix", "actual", label), "a_ix"))
    return full.select("p_ix", "a_ix", "predicted", "actual", F.col("n").cast("bigint").alias("n"))


def confusion_error(conf: DataFrame, p: str = "predicted", a: str = "actual") -> DataFrame:
    """1 − trace / total, matching rows to columns by label (D3)."""
    return conf.agg((F.lit(1.0) - F.sum(F.when(F.col(p).eqNullSafe(F.col(a)), F.col("n")).otherwise(0))
                     / F.sum("n")).alias("err"))


def nearest_wrong(conf_sq: DataFrame) -> DataFrame:
    """Per target (column), the most frequent wrong prediction and its share.

    The diagonal is zeroed first (P18); argmax runs over all rows in level
    order with the first maximum winning, as R's ``which.max`` does.
    """
    z = conf_sq.withColumn("nw", F.when(F.col("p_ix") == F.col("a_ix"), 0).otherwise(F.col("n")))
    g = z.groupBy("a_ix", "actual").agg(
        F.max("nw").alias("mx"),
        F.max_by("predicted", F.struct(F.col("nw"), -F.col("p_ix"))).alias("nearest"),
        F.sum("n").alias("tot"))
    return g.select(F.col("actual").alias("target"), "nearest",
                    F.try_divide(F.col("mx").cast("double"), F.col("tot")).alias("nearest_ratio"))


def cluster_spectrum(assigned: DataFrame, cluster: str = "cluster", algo: str | None = None) -> DataFrame:
    """Cluster sizes, largest first (ties → lower cluster id), with share of total.

    The windows run over k cluster rows, not over data rows.
    """
    sizes = assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("size"))
    part = [algo] if algo else []
    if algo:
        sizes = assigned.groupBy(algo, cluster).agg(F.count(F.lit(1)).alias("size"))
    w = Window.partitionBy(*part).orderBy(F.col("size").desc(), F.col(cluster))
    tot = Window.partitionBy(*part)
    return sizes.select(*part, F.row_number().over(w).cast("int").alias("idx"),
                        F.col(cluster).alias("cluster"), F.col("size").cast("bigint").alias("size"),
                        (F.col("size") / F.sum("size").over(tot)).alias("share"))


def cluster_label_variance(assigned: DataFrame, cluster: str = "cluster",
                           label: str = "label") -> DataFrame:
    """Per cluster n and Σ over labels of the sample variance of the
    one-hot label column: Σ m(n−m) / (n(n−1)); 0 for a one-row cluster."""
    c = assigned.groupBy(cluster, label).agg(F.count(F.lit(1)).alias("m"))
    n = F.sum("m").over(Window.partitionBy(cluster))
    c = c.withColumn("nn", n)
    term = F.when(F.col("nn") > 1, F.col("m") * (F.col("nn") - F.col("m")) /
                  (F.col("nn") * (F.col("nn") - 1))).otherwise(F.lit(0.0))
    return c.groupBy(cluster).agg(F.first("nn").cast("bigint").alias("n"),
                                  F.sum(term).alias("label_var")) \
        .withColumnRenamed(cluster, "cluster")


def soft_class_sums(soft: DataFrame, k: int, label: str = "label", z: str = "z") -> DataFrame:
    """Σ_i z_ic per (label, cluster) = zᵀL in long form (J9 on soft assignments)."""
    long = soft.select(label, F.posexplode(z).alias("cluster", "s"))
    return long.groupBy(label, "cluster").agg(F.sum("s").alias("s")).withColumn("cluster", F.col("cluster").cast("int"))


def soft_class_matrix(soft: DataFrame, k: int, label: str = "label", z: str = "z") -> DataFrame:
    """Row-normalised zᵀL → (cluster, label, p)."""
    s = soft_class_sums(soft, k, label, z)
    return s.select("cluster", label, (F.col("s") / F.sum("s").over(Window.partitionBy("cluster")))
                    .alias("p"))


def soft_label_confusion(soft: DataFrame, lv: DataFrame, k: int, n_levels: int,
                         label: str = "label", z: str = "z") -> DataFrame:
    """C6 + C7: predicted = argmax of z · classMatrix, against the actual label;
    full c x c table, zero-filled (R ``confusionMatrix`` keeps every level)."""
    cm = with_label_ix(soft_class_matrix(soft, k, label, z), lv, label)
    M = np.zeros((k, n_levels))
    for r in cm.collect():  # k x c cells
        M[r["cluster"], r["label_ix"]] = r["p"]

    def fn(b):
        P = b[z] @ M  # n x c label probabilities (C6)
        return {"p_ix": np.argmax(P, axis=1).astype(np.int32)}

    labelled = with_label_ix(soft, lv, label).withColumnRenamed("label_ix", "a_ix")
    rows = map_rows(labelled, [z], fn, "a_ix INT, p_ix INT", passthrough=["a_ix"])
    cells = rows.groupBy("p_ix", "a_ix").agg(F.count(F.lit(1)).alias("n"))
    grid = lv.select(F.col("label_ix").alias("p_ix"),
                     F.explode(F.sequence(F.lit(0), F.lit(n_levels - 1))).alias("a_ix"))
    full = grid.join(cells, ["p_ix", "a_ix"], "left").fillna(0, ["n"])
    full = (full.join(_name(lv, "p_ix", "predicted", label), "p_ix")
            .join(_name(lv, "a_ix", "actual", label), "a_ix"))
    return full.select("p_ix", "a_ix", "predicted", "actual", F.col("n").cast("bigint").alias("n"))


def best_bic(bic: DataFrame, n: int, g: str = "numClusters") -> DataFrame:
    """Per G the largest BIC over families (nulls and NaN skipped), / n."""
    clean = bic.withColumn("bic", F.when(F.isnan("bic"), None).otherwise(F.col("bic")))
    return clean.groupBy(g).agg((F.max("bic") / F.lit(float(n))).alias("bic"),
                                F.max_by("family", "bic").alias("family"))
