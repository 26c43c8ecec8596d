"""Dimension reduction.

Each fit makes one or a few passes that return p x p sufficient statistics
(Gram / covariance / class scatter); the eigen-solves run on the driver over
those small matrices, and the projection back onto the rows is a batched GEMM
in Arrow.  Reconstruction errors for every dims / run come from the Gram
identity Σ‖x − xM‖² = tr((I−M)ᵀ S (I−M)) without touching the rows again.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import group_sums, map_rows, partial_sums
from lodestar.functions.blocks import blocks
from lodestar.functions.caching import cached
from lodestar.operators import linalg as LA


# --- PCA ---------------------------------------------------------------------

@dataclass
class PCAModel:
    mean: np.ndarray
    sdev: np.ndarray           # sqrt of eigenvalues, descending
    rotation: np.ndarray       # p x p, columns = loadings
    n: int

    @property
    def eigenvalues(self) -> np.ndarray:
        return self.sdev ** 2


def fix_signs(v: np.ndarray) -> np.ndarray:
    """Deterministic orientation: the largest-magnitude entry of each column is positive."""
    idx = np.argmax(np.abs(v), axis=0)
    s = np.sign(v[idx, np.arange(v.shape[1])])
    s[s == 0] = 1.0
    return v * s


def pca_fit(df: DataFrame, p: int, x: str = "x") -> PCAModel:
    """``prcomp``: centred, unscaled; one covariance pass + driver eigh."""
    from lodestar.operators.prep import column_stats
    st = column_stats(df, x, p)
    mo = LA.moments(df, p, x, shift=np.nan_to_num(st.mean))
    cov = mo.covariance()
    w, v = np.linalg.eigh(cov)
    order = np.argsort(w)[::-1]
    w, v = np.clip(w[order], 0.0, None), fix_signs(v[:, order])
    return PCAModel(mo.mean, np.sqrt(w), v, mo.n)


@dataclass
class WidePCA:
    """The first components of a wide table; no p x p matrix stands behind them."""
    mean: np.ndarray        # p
    eigenvalues: np.ndarray  # d, descending
    rotation: np.ndarray    # p x d
    total: float            # sum of all eigenvalues
    n: int
    passes: int
    residual: float         # greatest |S v - lambda v| of the components, over the first eigenvalue
    converged: bool


def _orthonormal(B: np.ndarray, K: list[np.ndarray]) -> np.ndarray:
    """An orthonormal basis of what the columns of B add to the span of the blocks K."""
    scale = np.linalg.norm(B, axis=0).max(initial=0.0)
    for _ in range(2):  # twice is enough for full orthogonality
        for Q in K:
            B = B - Q @ (Q.T @ B)
    Q, R = np.linalg.qr(B)
    return Q[:, np.abs(np.diag(R)) > 1e-10 * max(scale, 1e-300)]


def pca_wide(df: DataFrame, d: int, seed: int, x: str = "x", oversample: int = 8, max_passes: int = 60, tol: float = 1e-10) -> WidePCA:
    """First ``d`` principal components by block Krylov iteration (M13, M14 for wide tables).

    A pass returns S Q for the newest block Q (p x (d + oversample)), S the covariance about the mean;
    the blocks together span a Krylov space, in which the components are those of a small matrix
    (Rayleigh-Ritz).  It stops when every component's residual is below ``tol`` of the first eigenvalue, or the
    space is exhausted, in which case the components are exact.  The driver holds p x (blocks' columns)
    numbers.  Signs are fixed as in :func:`pca_fit`; a constant table has no component.
    """
    with cached(df.select(x)) as df:
        first = df.select(F.size(x).alias("p")).limit(1).collect()
        p = first[0]["p"] if first else 0
        s = partial_sums(df, [x], lambda b: np.concatenate(([len(b[x])], b[x].sum(axis=0))), p + 1) if p else np.zeros(1)
        n, mean = int(s[0]), s[1:] / max(s[0], 1.0)
        K, images = [], []
        block = _orthonormal(np.random.default_rng([seed, p]).standard_normal((p, min(p, d + oversample))), []) if p else np.zeros((0, 0))
        lam, V, residual, total, passes, settled = np.zeros(0), np.zeros((p, 0)), 0.0, 0.0, 0, True
        while block.shape[1] and passes < max_passes:
            width = block.shape[1]

            def fn(b, block=block, width=width):
                X = b[x] - mean
                return np.append((X.T @ (X @ block)).ravel(), np.einsum("ij,ij->", X, X))

            v = partial_sums(df, [x], fn, p * width + 1) / max(n - 1, 1)
            total, passes = float(v[-1]), passes + 1
            K.append(block)
            images.append(v[:-1].reshape(p, width))
            basis, image = np.concatenate(K, axis=1), np.concatenate(images, axis=1)
            small = basis.T @ image
            lam, U = np.linalg.eigh((small + small.T) / 2)
            keep = np.argsort(lam)[::-1][:d]
            lam, U = lam[keep], U[:, keep]
            V = basis @ U
            gaps = np.linalg.norm(image @ U - V * lam, axis=0)
            residual = float(gaps.max(initial=0.0) / max(lam.max(initial=0.0), 1e-300))
            settled = residual <= tol
            if settled:
                break
            block = _orthonormal(images[-1], K)
            settled = not block.shape[1]  # nothing left to add: the space is invariant
    good = lam > 1e-13 * max(total, 1e-300)
    return WidePCA(mean, lam[good], fix_signs(V[:, good]) if good.any() else V[:, good], total, n, passes, residual, settled)


def pca_transform(df: DataFrame, model: PCAModel, d: int | None = None, x: str = "x",
                  out: str = "x", passthrough=("id", "label")) -> DataFrame:
    """Scores on the first d components."""
    R = model.rotation[:, :d] if d else model.rotation
    keep = tuple(c for c in passthrough if c in df.columns)
    return LA.project(df, R, x, out, keep, center=model.mean)


def explained(model: PCAModel) -> list[tuple[int, float, float, float]]:
    """(component, eigenvalue, share, cumulative share)."""
    lam = model.eigenvalues
    tot = lam.sum()
    cum = np.cumsum(lam)
    return [(i + 1, float(lam[i]), float(lam[i] / tot), float(cum[i] / tot)) for i in range(len(lam))]


def min_dimension(eigenvalues: np.ndarray, energy: float = 0.90) -> int:
    """First d with cumsum(λ)[d] strictly above energy·Σλ."""
    lam = np.asarray(eigenvalues, dtype=float)
    hit = np.flatnonzero(np.cumsum(lam) > energy * lam.sum())
    return int(hit[0]) + 1 if len(hit) else len(lam)


def min_dimension_frame(ev: DataFrame, energy: float = 0.90) -> DataFrame:
    """Same on a (component, eigenvalue) frame with a running-sum window."""
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    c = ev.withColumn("cum", F.sum("eigenvalue").over(w)).withColumn(
        "tot", F.sum("eigenvalue").over(Window.partitionBy()))
    return c.filter(F.col("cum") > F.lit(energy) * F.col("tot")).agg(
        F.min("component").alias("dims"))


def recon_errors(S: np.ndarray, basis: np.ndarray, dims) -> list[tuple[int, float]]:
    """Σ‖x − x B_d B_dᵀ‖² for each d, B_d = first d columns."""
    return [(int(d), LA.recon_error(S, basis[:, :d] @ basis[:, :d].T)) for d in dims]


def contributions(rotation: np.ndarray) -> list[tuple[int, int, float]]:
    """Cumulative squared loadings per feature: (feature, ind 1-based, value)."""
    c = np.cumsum(rotation ** 2, axis=1)
    return [(i, j + 1, float(c[i, j])) for i in range(c.shape[0]) for j in range(c.shape[1])]


def contributions_frame(m_long: DataFrame) -> DataFrame:
    """M18 on a long matrix (i = feature, j = component, v): running Σ v² per feature."""
    w = Window.partitionBy("i").orderBy("j").rowsBetween(Window.unboundedPreceding, 0)
    return m_long.select(F.col("i").alias("feature"), (F.col("j") + 1).cast("int").alias("ind"),
                         F.sum(F.col("v") * F.col("v")).over(w).alias("value"))


# --- random projections ------------------------------------------------------

def sign_matrix(p: int, d: int, seed: int, run: int) -> np.ndarray:
    """Hashed ±1/√d projection: sign from the first hex digit of md5("seed:run:i:j").

    The rule is plain md5 text, so SQL engines can rebuild the same matrix.
    """
    m = np.empty((p, d))
    for i in range(p):
        for j in range(d):
            h = hashlib.md5(f"{seed}:{run}:{i}:{j}".encode()).hexdigest()[0]
            m[i, j] = 1.0 if h < "8" else -1.0
    return m / math.sqrt(d)


def haar_matrix(p: int, d: int, seed: int, run: int) -> np.ndarray:
    """Orthonormal p x d projection: QR of a seeded Gaussian (Haar measure)."""
    rng = np.random.default_rng([seed, run, p, d])
    q, r = np.linalg.qr(rng.standard_normal((p, d)))
    return q * np.sign(np.diag(r))


def projection_errors(spark: SparkSession, S: np.ndarray, dims, runs: int, seed: int,
                      family: str = "sign", run0: int = 0) -> DataFrame:
    """(dims, run, err) for every (d, run): the grid is a Spark range, each task
    rebuilds its projection from (seed, run) and evaluates the Gram identity
    with S shipped in the closure, so runs spread over the cluster and the
    data is never re-read (M22)."""
    p = S.shape[0]
    dims = [int(d) for d in dims]
    gen = sign_matrix if family == "sign" else haar_matrix
    grid = spark.range(len(dims) * runs).select(
        F.element_at(F.array(*[F.lit(d) for d in dims]),
                     (F.floor(F.col("id") / runs) + 1).cast("int")).alias("dims"),
        (F.col("id") % runs + run0).cast("int").alias("run"))

    def fn(b):
        errs = np.array([LA.recon_error(S, (lambda R: R @ R.T)(gen(p, int(d), seed, int(r))))
                         for d, r in zip(b["dims"], b["run"])])
        return {"err": errs}

    return map_rows(grid, ["dims", "run"], fn, "dims INT, run INT, err DOUBLE",
                    passthrough=["dims", "run"])


def running_best(errs: DataFrame, part=("dims",)) -> DataFrame:
    """Running minimum over runs (W2) — earlier run kept on ties — on the result table."""
    w = Window.partitionBy(*part).orderBy("run").rowsBetween(Window.unboundedPreceding, 0)
    return errs.withColumn("best_err", F.min("err").over(w))


def best_run(errs: DataFrame, part=("dims",)) -> DataFrame:
    """Winner per dims: min err, lowest run on ties (O3)."""
    return errs.groupBy(*part).agg(F.min_by("run", F.struct("err", "run")).alias("run"),
                                   F.min("err").alias("err"))


def pinv(m: np.ndarray) -> np.ndarray:
    """Pseudo-inverse by SVD."""
    return np.linalg.pinv(m)


# --- ICA (FastICA, symmetric, logcosh) ---------------------------------------

@dataclass
class ICAModel:
    mean: np.ndarray
    K: np.ndarray      # p x d whitening
    W: np.ndarray      # d x d unmixing rotation
    iterations: int
    converged: bool = False

    @property
    def unmixing(self) -> np.ndarray:
        """p x d map from centred x to sources: S = (x − mean) K Wᵀ."""
        return self.K @ self.W.T

    @property
    def mixing(self) -> np.ndarray:
        """d x p A with x − mean ≈ S A."""
        return np.linalg.pinv(self.unmixing)


def _sym_decorrelate(W: np.ndarray) -> np.ndarray:
    s, u = np.linalg.eigh(W @ W.T)
    s = np.clip(s, 1e-15, None)
    return (u * (1.0 / np.sqrt(s))) @ u.T @ W


def ica_fit(df: DataFrame, p: int, d: int, seed: int, x: str = "x", max_iter: int = 200,
            tol: float = 1e-4, alpha: float = 1.0) -> ICAModel:
    """FastICA with one data pass per iteration (M19); see :func:`ica_fit_many`."""
    return ica_fit_many(df, p, [d], seed, x, max_iter, tol, alpha)[0]


def ica_fit_many(df: DataFrame, p: int, dims, seed: int, x: str = "x", max_iter: int = 200,
                 tol: float = 1e-4, alpha: float = 1.0) -> list[ICAModel]:
    """Several FastICA fits (one per entry of ``dims``) sharing every data pass.

    Whitening comes from the covariance eigenpairs up to the numerical rank
    (λ ≤ 1e-13·λ₁ is dropped).  Each pass accumulates, for every unconverged model,
    E[g(Wz) zᵀ] and E[g'(Wz)] with the W's shipped to the tasks; the
    symmetric decorrelation runs on the driver.  Stops on
    max |abs(diag(W₁Wᵀ)) − 1| < tol, as the reference's package does.
    """
    with cached(df) as df:
        return _ica_fit_many(df, p, dims, seed, x, max_iter, tol, alpha)


def _ica_fit_many(df, p, dims, seed, x, max_iter, tol, alpha) -> list[ICAModel]:
    from lodestar.operators.prep import column_stats
    st = column_stats(df, x, p)
    mean = np.nan_to_num(st.mean)
    mo = LA.moments(df, p, x, shift=mean)
    lam, vec = np.linalg.eigh(mo.covariance(ddof=0))
    order = np.argsort(lam)[::-1]
    lam, vec = lam[order], vec[:, order]
    rank = int((lam > 1e-13 * lam[0]).sum())
    n = mo.n
    models = []
    for i, d in enumerate(dims):
        d = min(int(d), rank)
        K = vec[:, :d] / np.sqrt(lam[:d])
        rng = np.random.default_rng([seed, d])
        models.append(ICAModel(mean, K, _sym_decorrelate(rng.standard_normal((d, d))), 0))
    with blocks(df, [x]) as df:
        return _ica_rotate(df, models, mean, n, x, max_iter, tol, alpha)


def _ica_rotate(df, models: list[ICAModel], mean: np.ndarray, n: int, x: str, max_iter: int, tol: float, alpha: float) -> list[ICAModel]:
    active = list(range(len(models)))
    for it in range(1, max_iter + 1):
        if not active:
            break
        Ks = [models[i].K for i in active]
        Ws = [models[i].W.copy() for i in active]
        ds = [K.shape[1] for K in Ks]
        offs = np.cumsum([0] + [d * d + d for d in ds])

        def fn(b, Ks=Ks, Ws=Ws, ds=ds, offs=offs):
            Xc = b[x] - mean
            out = np.zeros(int(offs[-1]))
            for m, (K, W, d) in enumerate(zip(Ks, Ws, ds)):
                Z = Xc @ K
                G = np.tanh(alpha * (Z @ W.T))
                out[offs[m]:offs[m] + d * d] = (G.T @ Z).ravel()
                out[offs[m] + d * d:offs[m + 1]] = (alpha * (1.0 - G * G)).sum(0)
            return out

        v = partial_sums(df, [x], fn, int(offs[-1]))
        still = []
        for m, i in enumerate(active):
            d, W = ds[m], Ws[m]
            EgZ = v[offs[m]:offs[m] + d * d].reshape(d, d) / n
            Egp = v[offs[m] + d * d:offs[m + 1]] / n
            W1 = _sym_decorrelate(EgZ - Egp[:, None] * W)
            lim = np.max(np.abs(np.abs(np.einsum("ij,ij->i", W1, W)) - 1.0))
            models[i].W, models[i].iterations, models[i].converged = W1, it, bool(lim < tol)
            if lim >= tol:
                still.append(i)
        active = still
    return models


def ica_sources(df: DataFrame, model: ICAModel, x: str = "x", out: str = "x",
                passthrough=("id", "label")) -> DataFrame:
    keep = tuple(c for c in passthrough if c in df.columns)
    return LA.project(df, model.unmixing, x, out, keep, center=model.mean)


def ica_recon_error(S_centered: np.ndarray, model: ICAModel) -> float:
    """Σ‖(x−mean) − S A‖² via the Gram identity (M20); S_centered = centred Gram."""
    M = model.unmixing @ model.mixing
    return LA.recon_error(S_centered, M)


# --- LDA (M30) ---------------------------------------------------------------

@dataclass
class Scatter:
    within: np.ndarray
    between: np.ndarray
    means: np.ndarray
    counts: np.ndarray
    grand: np.ndarray


def class_scatter(df: DataFrame, p: int, n_classes: int, x: str = "x", ix: str = "label_ix") -> Scatter:
    """Within / between class scatter: one pass for the class means, one for the
    scatter about them (no difference of large second moments)."""

    def first(b):
        c = b[ix].astype(int)
        return np.concatenate([np.bincount(c, minlength=n_classes), group_sums(b[x], c, n_classes).ravel()])

    v = partial_sums(df, [x, ix], first, n_classes * (1 + p))
    n, sums = v[:n_classes], v[n_classes:].reshape(n_classes, p)
    means = np.where(n[:, None] > 0, sums / np.maximum(n[:, None], 1), 0.0)

    def about(b):
        X = b[x] - means[b[ix].astype(int)]
        return (X.T @ X).ravel()

    within = partial_sums(df, [x, ix], about, p * p).reshape(p, p)
    grand = (n[:, None] * means).sum(0) / max(n.sum(), 1)
    D = means - grand
    return Scatter(within, (n[:, None] * D).T @ D, means, n, grand)


def lda_directions(sc: Scatter, d: int = 2, ridge: float = 1e-9) -> np.ndarray:
    """Generalised eigenvectors of (Sb, Sw) with a ridge for rank-deficient Sw."""
    p = sc.within.shape[0]
    Sw = sc.within + ridge * np.trace(sc.within) / p * np.eye(p)
    lw, vw = np.linalg.eigh(Sw)
    Wh = vw / np.sqrt(np.clip(lw, 1e-300, None))
    B = Wh.T @ sc.between @ Wh
    lb, vb = np.linalg.eigh(B)
    order = np.argsort(lb)[::-1][:d]
    return fix_signs(Wh @ vb[:, order])


# --- kernel PCA re-aimed: random Fourier features (M32) ------------------------

def rff_map(df: DataFrame, p: int, n_features: int, sigma: float, seed: int, x: str = "x",
            out: str = "x", passthrough=("id", "label")) -> DataFrame:
    """z(x) = √(2/D) cos(xΩ + b), Ω ~ N(0, 2σ) — approximates exp(−σ‖x−y‖²)."""
    rng = np.random.default_rng(seed)
    omega = rng.normal(0.0, math.sqrt(2.0 * sigma), size=(p, n_features))
    phase = rng.uniform(0.0, 2 * math.pi, size=n_features)
    scale = math.sqrt(2.0 / n_features)
    keep = [c for c in passthrough if c in df.columns]

    def fn(b):
        return {out: scale * np.cos(b[x] @ omega + phase)}

    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep] +
                       [f"{out} ARRAY<DOUBLE>"])
    return map_rows(df, [x], fn, schema, passthrough=keep)
