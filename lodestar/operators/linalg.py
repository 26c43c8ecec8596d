"""Matrix contractions over tall data (J8, J9, A5, §4.3 Gram identity).

Tall matrices stay as ``x ARRAY<DOUBLE>`` rows; everything that reaches the
driver is p x p or smaller.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import local_frame, map_rows, partial_sums


@dataclass
class Moments:
    """n, column sums and the cross-product matrix XᵀX (optionally shifted)."""
    n: int
    s: np.ndarray
    g: np.ndarray
    shift: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.shift + self.s / self.n

    def covariance(self, ddof: int = 1) -> np.ndarray:
        d = self.s / self.n
        return (self.g - self.n * np.outer(d, d)) / (self.n - ddof)

    def gram(self) -> np.ndarray:
        """Unshifted XᵀX."""
        c = self.shift
        return self.g + np.outer(c, self.s) + np.outer(self.s, c) + self.n * np.outer(c, c)


def moments(df: DataFrame, p: int, x: str = "x", shift: np.ndarray | None = None) -> Moments:
    """One pass: n, Σ(x−c), Σ(x−c)(x−c)ᵀ (J9).  ``shift`` c guards precision
    when means dwarf spreads (pass the column means)."""
    c = np.zeros(p) if shift is None else np.asarray(shift, dtype=float)

    def fn(b):
        X = b[x] - c
        return np.concatenate([[X.shape[0]], X.sum(0), (X.T @ X).ravel()])

    v = partial_sums(df, [x], fn, 1 + p + p * p)
    return Moments(int(round(v[0])), v[1:1 + p], v[1 + p:].reshape(p, p), c)


def gram(df: DataFrame, p: int, x: str = "x") -> np.ndarray:
    """S = XᵀX."""
    return moments(df, p, x).g


def matrix_frame(spark: SparkSession, m: np.ndarray, value: str = "v") -> DataFrame:
    """Small matrix → long ``Matrix(i, j, v)`` (0-based)."""
    m = np.asarray(m, dtype=float)
    i, j = np.indices(m.shape)
    return local_frame(spark, {"i": i.ravel(), "j": j.ravel(), value: m.ravel()}, f"i INT, j INT, {value} DOUBLE")


def transpose_long(m_long: DataFrame) -> DataFrame:
    """Tᵀ in the long form: swap (i, j)."""
    return m_long.select(F.col("j").alias("i"), F.col("i").alias("j"), *[c for c in m_long.columns
                                                                       if c not in ("i", "j")])


def project(df: DataFrame, m: np.ndarray, x: str = "x", out: str = "x",
            passthrough: tuple = ("id",), center: np.ndarray | None = None) -> DataFrame:
    """Tall × small: x ← (x − center) @ M, batched GEMM in Arrow."""
    m = np.asarray(m, dtype=float)
    c = None if center is None else np.asarray(center, dtype=float)
    keep = [k for k in passthrough if k != out]

    def fn(b):
        X = b[x] if c is None else b[x] - c
        return {out: X @ m}

    schema = ", ".join([_ddl(df, k) for k in keep] + [f"{out} ARRAY<DOUBLE>"])
    return map_rows(df, [x], fn, schema, passthrough=keep)


def project_long(df: DataFrame, m: np.ndarray, x: str = "x", id_col: str = "id") -> DataFrame:
    """Projection scores as (id, j, v)."""
    p = project(df, m, x, out="_z", passthrough=(id_col,))
    return p.select(id_col, F.posexplode("_z").alias("j", "v")).withColumn("j", F.col("j").cast("int"))


def recon_error(S: np.ndarray, M: np.ndarray) -> float:
    """Σ‖x − xM‖² = tr((I−M)ᵀ S (I−M)) for a p x p map M (§4.3), floored at 0."""
    p = S.shape[0]
    R = np.eye(p) - M
    return max(float(np.einsum("ij,ij->", R, S @ R)), 0.0)


def _ddl(df: DataFrame, name: str) -> str:
    return f"{name} {df.schema[name].dataType.simpleString()}"
