"""Classical scaling (M31) and kernel PCA (M32) through landmarks, never an n x n matrix.

Landmarks are chosen farthest first: each is the row with the greatest distance to those before it.
A pass fetches the FARTHEST rows of greatest distance; rows it leaves behind are at most as
far as the last one fetched, so landmarks are taken from the fetched rows, without another pass, as long as
they are farther than that.

Both maps place every row from its distances (or kernel values) to the landmarks in the space that
they span, and then turn that space to its principal axes over all rows, which takes one moments pass.  For
landmarks that span the data the result is that of the full matrix.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import map_rows, partial_sums
from lodestar.functions.caching import cached
from lodestar.operators.reduce import fix_signs

FARTHEST = 256   # rows fetched per pass of the landmark choice
RANK = 1e-10     # eigenvalues below this share of the greatest are rank deficiency


def _squares(X: np.ndarray, L: np.ndarray) -> np.ndarray:
    """(rows, landmarks) squared distances, by differences: equal rows are at exactly 0."""
    return np.stack([((X - r) ** 2).sum(axis=1) for r in L], axis=1)


def landmarks(df: DataFrame, m: int, x: str = "x", id_col: str = "id") -> np.ndarray:
    """Up to ``m`` rows, farthest first, starting at the smallest id; ties: the smaller id.  Fewer
    when there are fewer distinct rows; none for an empty frame."""
    with cached(df.select(id_col, x)) as df:
        picked = [np.array(r[x]) for r in df.orderBy(id_col).limit(1).collect()]
        while picked and len(picked) < m:
            L = np.array(picked)
            far = map_rows(df, [x], lambda b, L=L: {"far": _squares(b[x], L).min(axis=1)}, f"{id_col} {df.schema[id_col].dataType.simpleString()}, {x} ARRAY<DOUBLE>, far DOUBLE",
                           passthrough=[id_col, x])
            rows = far.orderBy(F.desc("far"), id_col).limit(FARTHEST).collect()
            X, d = np.array([r[x] for r in rows]), np.array([r["far"] for r in rows])
            left = d[-1] if len(rows) == FARTHEST else 0.0  # no row that was not fetched is farther
            more = 0
            while len(picked) < m:
                at = int(d.argmax())  # fetched rows stand by distance and id, so the first of equals has the smaller id
                if d[at] <= 0 or (more and d[at] <= left):
                    break
                picked.append(X[at])
                d = np.minimum(d, ((X - X[at]) ** 2).sum(axis=1))
                more += 1
            if not more:
                break
    return np.array(picked)


@dataclass
class LandmarkMap:
    """Rows go through ``(f(squared distances) - shift) @ back``; eigenvalues are sums over all rows."""
    points: np.ndarray       # m x p
    back: np.ndarray         # m x r, to the principal axes
    shift: np.ndarray        # m
    centre: np.ndarray       # r
    eigenvalues: np.ndarray  # r, descending
    sigma: float             # 0: squared distances as they are; else the kernel exp(-sigma d^2)
    residual: float          # mean kernel mass that the landmarks do not span; 0 for scaling

    def features(self, X: np.ndarray) -> np.ndarray:
        D = _squares(X, self.points)
        return np.exp(-self.sigma * D) if self.sigma else D

    def scores(self, X: np.ndarray, d: int) -> np.ndarray:
        return (self.features(X) - self.shift) @ self.back[:, :d] - self.centre[:d]

    def share(self, d: int) -> float:
        """Goodness of fit: the first ``d`` eigenvalues over all positive ones."""
        total = self.eigenvalues.sum()
        return float(self.eigenvalues[:d].sum() / total) if total > 0 else 1.0


def _turned(df: DataFrame, x: str, model: LandmarkMap, mass: bool) -> LandmarkMap:
    """The map with its space turned to the principal axes of all rows."""
    r = model.back.shape[1]

    def fn(b):
        Z = model.scores(b[x], r)
        out = np.empty(2 + r + r * r)
        out[0], out[1] = len(Z), (1.0 - (Z * Z).sum(axis=1)).clip(0).sum() if mass else 0.0
        out[2:2 + r], out[2 + r:] = Z.sum(axis=0), (Z.T @ Z).ravel()
        return out

    v = partial_sums(df, [x], fn, 2 + r + r * r)
    n, s, g = v[0], v[2:2 + r], v[2 + r:].reshape(r, r)
    if n:
        lam, vec = np.linalg.eigh(g - np.outer(s, s) / n)
        order = np.argsort(lam)[::-1]
        vec = vec[:, order]
        own = model.back @ vec
        sign = np.sign(own[np.abs(own).argmax(axis=0), np.arange(r)])
        sign[sign == 0] = 1.0
        model.back, model.centre = own * sign, (s / n) @ vec * sign
        model.eigenvalues, model.residual = np.maximum(lam[order], 0.0), float(v[1] / n)
    return model


def mds_fit(df: DataFrame, m: int, x: str = "x", id_col: str = "id") -> LandmarkMap:
    """Classical scaling of all rows from ``m`` landmarks.

    The landmarks' squared distances are double-centred and decomposed (m x m).  Rows that
    repeat are placed alike; data of lower rank (one distinct row: none at all) have that many axes.
    """
    L = landmarks(df, m, x, id_col)
    if not len(L):
        return LandmarkMap(np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), np.zeros(0), np.zeros(0), 0.0, 0.0)
    D = _squares(L, L)
    J = np.eye(len(L)) - 1.0 / len(L)
    lam, vec = np.linalg.eigh(-0.5 * J @ D @ J)
    good = lam > RANK * max(lam.max(), 1e-300)
    back = -0.5 * fix_signs(vec[:, good]) / np.sqrt(lam[good]) if good.any() else np.zeros((len(L), 0))
    return _turned(df, x, LandmarkMap(L, back, D.mean(axis=0), np.zeros(back.shape[1]), np.zeros(back.shape[1]), 0.0, 0.0), False)


def kernel_pca_fit(df: DataFrame, m: int, sigma: float, x: str = "x", id_col: str = "id") -> LandmarkMap:
    """Kernel PCA of exp(-sigma |x - y|^2) by the Nystroem map of ``m`` landmarks.

    ``residual`` is the mean over all rows of k(x, x) less its part in the landmarks' span: the
    trace-norm error of the kernel matrix over n.  With all distinct rows as landmarks it is 0 and the
    scores are those of the full kernel matrix.
    """
    L = landmarks(df, m, x, id_col)
    if not len(L):
        return LandmarkMap(np.zeros((0, 0)), np.zeros((0, 0)), np.zeros(0), np.zeros(0), np.zeros(0), sigma, 0.0)
    lam, vec = np.linalg.eigh(np.exp(-sigma * _squares(L, L)))
    good = lam > RANK * lam.max()
    back = vec[:, good] / np.sqrt(lam[good])
    return _turned(df, x, LandmarkMap(L, back, np.zeros(len(L)), np.zeros(back.shape[1]), np.zeros(back.shape[1]), sigma, 0.0), True)


def place(df: DataFrame, model: LandmarkMap, d: int, x: str = "x", passthrough=("id", "label")) -> DataFrame:
    """(passthrough..., z ARRAY<DOUBLE>): coordinates on the first ``d`` axes (fewer if there are fewer)."""
    keep = [c for c in passthrough if c in df.columns]
    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep] + ["z ARRAY<DOUBLE>"])
    return map_rows(df, [x], lambda b: {"z": model.scores(b[x], d)}, schema, passthrough=keep)
