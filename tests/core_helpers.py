"""Tables and small frames that the core tests share."""

import numpy as np

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def features_from(spark, X, labels=None, ids=None):
    """Small Features(id, x, label) frame from numpy (test fixtures only)."""
    X = np.asarray(X, dtype=float)
    n = X.shape[0]
    ids = list(range(1, n + 1)) if ids is None else list(ids)
    labels = [0] * n if labels is None else list(labels)
    rows = [(int(i), [float(v) for v in x], lab) for i, x, lab in zip(ids, X, labels)]
    lt = "STRING" if isinstance(labels[0], str) else "INT"
    return spark.createDataFrame(rows, f"id BIGINT, x ARRAY<DOUBLE>, label {lt}")


def collect_matrix(df, x="x", id_col="id"):
    rows = df.orderBy(id_col).select(id_col, x).collect()
    return np.array([r[id_col] for r in rows]), np.array([r[x] for r in rows], dtype=float)
