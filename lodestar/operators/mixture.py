"""Gaussian mixtures by EM (M8), BIC (M9), parameter listing.

Fourteen families, named by volume / shape / orientation of the component
covariances (E equal, V varying, I identity): Σ_g = λ_g D_g A_g D_gᵀ with |A_g| = 1.
Each iteration is one pass: every task runs the E-step for its rows with the current
parameters shipped in the closure and returns the responsibility-weighted sums
Σr, Σr·d and Σr·d² (diagonal and spherical) or Σr·ddᵀ (the others) of
d = x − current mean, plus the log-likelihood; the M-step runs on the driver over those
G x p (x p) sums.  Sums about the current mean keep their digits however far the data lie from
the origin.  A component holding a third of the rows costs the same as any other: the
sums are combined inside each task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import map_rows, partial_sums
from lodestar.functions.blocks import blocks

FAMILIES = ("EII", "VII", "EEI", "VEI", "EVI", "VVI", "EEE", "EVE", "VEE", "VVE", "EEV", "VEV", "EVV", "VVV")
LOG2PI = math.log(2.0 * math.pi)
# Statistic entries per scan; larger grids take several scans per iteration.
MAX_STATS_PER_SCAN = 4_000_000
TAIL = 1e-14  # share of a row's density that components left out of the E-step may hold
_INNER = 30  # sweeps of the M-steps that alternate between volume, shape and orientation


@dataclass
class Mixture:
    """Covariances as their parameters: ``covs`` is (G, p) variances for families whose
    orientation is the identity, else (G, p, p)."""
    family: str
    weights: np.ndarray          # G
    means: np.ndarray            # G x p
    covs: np.ndarray             # G x p or G x p x p
    loglik: float = float("nan")
    history: list = field(default_factory=list)
    n: int = 0
    failed: bool = False
    converged: bool = False

    @property
    def G(self) -> int:
        return self.means.shape[0]

    @property
    def p(self) -> int:
        return self.means.shape[1]

    @property
    def diagonal(self) -> bool:
        return self.family[2] == "I"

    def full(self, g: int) -> np.ndarray:
        return np.diag(self.covs[g]) if self.diagonal else self.covs[g]

    def df(self) -> int:
        return n_params(self.family, self.G, self.p)

    def bic(self) -> float | None:
        """2·logLik − df·ln n: larger is better; None when the fit failed."""
        if self.failed or not np.isfinite(self.loglik):
            return None
        return 2.0 * self.loglik - self.df() * math.log(self.n)


def n_params(family: str, G: int, p: int) -> int:
    """Free parameters: weights, means, volumes, shapes, orientations."""
    each = {"E": 1, "V": G, "I": 0}
    return (G - 1) + G * p + each[family[0]] + each[family[1]] * (p - 1) + each[family[2]] * (p * (p - 1) // 2)


class Densities:
    """log w_g + log N(x | mu_g, S_g) of the components that matter for a row; -inf for the others.

    A component's log density is at most its value at the mean less half the squared Euclidean distance over
    its greatest variance, so one product of the rows with all means bounds every component.  Evaluated are
    those whose bound comes within TAIL / G of the density of the row's likeliest component by bounds: what
    is left out adds up to less than TAIL of what is kept.
    """

    def __init__(self, m: Mixture):
        self.m = m
        if m.diagonal:
            self.root, logdet, self.top = None, np.log(m.covs).sum(axis=1), m.covs.max(axis=1)
        else:
            self.root = np.linalg.cholesky(m.covs)
            logdet = 2.0 * np.log(np.einsum("gii->gi", self.root)).sum(axis=1)
            self.top = np.linalg.eigvalsh(m.covs)[:, -1]
        self.peak = np.log(m.weights) - 0.5 * (m.p * LOG2PI + logdet)

    def one(self, X: np.ndarray, g: int) -> np.ndarray:
        diff = X - self.m.means[g]
        if self.root is None:
            q = (diff * diff / self.m.covs[g]).sum(1)
        else:
            sol = np.linalg.solve(self.root[g], diff.T)
            q = (sol * sol).sum(0)
        return self.peak[g] - 0.5 * q

    def bounds(self, X: np.ndarray) -> np.ndarray:
        mid = self.m.means.mean(axis=0)
        A, B = X - mid, self.m.means - mid
        a, b = np.einsum("ij,ij->i", A, A)[:, None], np.einsum("ij,ij->i", B, B)[None]
        far = a - 2.0 * (A @ B.T) + b - 1e-12 * (a + b)  # never above the true distance
        return self.peak - 0.5 * np.maximum(far, 0.0) / self.top

    def __call__(self, X: np.ndarray) -> np.ndarray:
        most = self.bounds(X)
        first, floor = most.argmax(axis=1), np.empty(len(X))
        for g in np.unique(first):
            own = np.flatnonzero(first == g)
            floor[own] = self.one(X[own], g)
        near = most >= (floor + math.log(TAIL / self.m.G))[:, None]
        out = np.full(most.shape, -np.inf)
        for g in range(self.m.G):
            own = np.flatnonzero(near[:, g])
            if len(own):
                out[own, g] = self.one(X[own], g)
        return out


def responsibilities(X: np.ndarray, m: Mixture, dens: Densities | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Posterior z (rows sum to 1) and per-row log-likelihood, by log-sum-exp."""
    L = (dens or Densities(m))(X)
    mx = L.max(1, keepdims=True)
    e = np.exp(L - mx)
    s = e.sum(1, keepdims=True)
    return e / s, (mx + np.log(s)).ravel()


def _stats_size(m: Mixture) -> int:
    return m.G * (1 + m.p + (m.p if m.diagonal else m.p * m.p)) + 1


def _pass(df: DataFrame, x: str, models: list[Mixture]):
    """One scan for a chunk of models: per component Σr, Σr·d and Σr·d² or Σr·ddᵀ with
    d = x − mean, plus the log-likelihood."""
    offs = np.cumsum([0] + [_stats_size(m) for m in models])
    dens = [Densities(m) for m in models]

    def fn(b):
        X = b[x]
        out = np.zeros(int(offs[-1]))
        for o, m, own in zip(offs, models, dens):
            z, ll = responsibilities(X, m, own)
            parts = [z.sum(0)]
            first, second = [], []
            for g in range(m.G):
                some = np.flatnonzero(z[:, g])
                d = X[some] - m.means[g]
                rd = d * z[some, g:g + 1]
                first.append(rd.sum(0))
                second.append((rd * d).sum(0) if m.diagonal else (rd.T @ d).ravel())
            part = np.concatenate(parts + first + second + [[ll.sum()]])
            out[o:o + len(part)] = part
        return out

    v = partial_sums(df, [x], fn, int(offs[-1]))
    res = []
    for o, m in zip(offs, models):
        G, p = m.G, m.p
        s = v[o + G + G * p:o + _stats_size(m) - 1]
        res.append((v[o:o + G], v[o + G:o + G + G * p].reshape(G, p),
                    s.reshape(G, p) if m.diagonal else s.reshape(G, p, p), v[o + _stats_size(m) - 1]))
    return res


def _pass_chunked(df: DataFrame, x: str, models: list[Mixture]):
    out, cur, acc = [], [], 0
    for m in models:
        if cur and acc + _stats_size(m) > MAX_STATS_PER_SCAN:
            out += _pass(df, x, cur)
            cur, acc = [], 0
        cur.append(m)
        acc += _stats_size(m)
    return out + (_pass(df, x, cur) if cur else [])


def _scaled(v: np.ndarray) -> tuple[float, np.ndarray]:
    """(geometric mean, v over it) of positive numbers."""
    v = np.maximum(v, 1e-300)
    g = float(np.exp(np.log(v).mean()))
    return g, v / g


def _root_det(W: np.ndarray) -> float:
    """|W|^(1/p) of a positive definite matrix; 0 when it is not."""
    sign, logdet = np.linalg.slogdet(W)
    return float(np.exp(logdet / len(W))) if sign > 0 else 0.0


def _diagonal_step(fam: str, W: np.ndarray, nk: np.ndarray, n: int) -> np.ndarray:
    """(G, p) variances from diagonal scatters W (G, p)."""
    G, p = W.shape
    if fam == "EII":
        return np.full((G, p), W.sum() / (n * p))
    if fam == "VII":
        return np.repeat((W.sum(1) / (nk * p))[:, None], p, axis=1)
    if fam == "EEI":
        return np.repeat((W.sum(0) / n)[None, :], G, axis=0)
    if fam == "VVI":
        return W / nk[:, None]
    if fam == "EVI":
        parts = [_scaled(w) for w in W]
        return sum(g for g, _ in parts) / n * np.stack([a for _, a in parts])
    vol = W.sum(1) / (nk * p)  # VEI
    for _ in range(_INNER):
        shape = _scaled((W / vol[:, None]).sum(0))[1]
        vol = (W / shape[None, :]).sum(1) / (nk * p)
    return vol[:, None] * shape[None, :]


def _full_step(fam: str, W: np.ndarray, nk: np.ndarray, n: int) -> np.ndarray:
    """(G, p, p) covariances from scatters W (G, p, p), Celeux and Govaert's updates."""
    G, p = W.shape[0], W.shape[1]
    if fam == "EEE":
        return np.repeat((W.sum(0) / n)[None], G, axis=0)
    if fam == "VVV":
        return W / nk[:, None, None]
    if fam == "EVV":
        r = np.array([_root_det(w) for w in W])
        return r.sum() / n * W / np.maximum(r, 1e-300)[:, None, None]
    if fam == "VEE":
        vol = np.trace(W, axis1=1, axis2=2) / (nk * p)
        for _ in range(_INNER):
            C = (W / vol[:, None, None]).sum(0)
            C = C / max(_root_det(C), 1e-300)
            vol = np.einsum("gij,ji->g", W, np.linalg.inv(C)) / (nk * p)
        return vol[:, None, None] * C[None]
    if fam in ("EEV", "VEV"):
        lam, vec = np.linalg.eigh(W)
        lam, vec = np.maximum(lam[:, ::-1], 0), vec[:, :, ::-1]
        if fam == "EEV":
            g, shape = _scaled(lam.sum(0))
            vol = np.full(G, g / n)
        else:
            vol = lam.sum(1) / (nk * p)
            for _ in range(_INNER):
                shape = _scaled((lam / vol[:, None]).sum(0))[1]
                vol = (lam / shape[None, :]).sum(1) / (nk * p)
        return np.einsum("gij,gj,gkj->gik", vec, vol[:, None] * shape[None, :], vec)
    # EVE, VVE: one orientation for all, improved by majorise-minimise steps
    D = np.linalg.eigh(W.sum(0))[1]
    top = np.linalg.eigvalsh(W)[:, -1]
    for _ in range(_INNER):
        diag = np.maximum(np.einsum("ji,gjk,ki->gi", D, W, D), 1e-300)
        shape = np.stack([_scaled(d)[1] for d in diag]) if fam == "EVE" else diag / nk[:, None]
        F_ = sum((D.T @ W[g] - top[g] * D.T) / shape[g][:, None] for g in range(G))
        u, _, vt = np.linalg.svd(F_)
        D = (vt.T @ u.T)
        D = -D if np.einsum("ij,ji->", F_, D) > 0 else D
    diag = np.maximum(np.einsum("ji,gjk,ki->gi", D, W, D), 1e-300)
    if fam == "VVE":
        var = diag / nk[:, None]
    else:
        parts = [_scaled(d) for d in diag]
        var = sum(g for g, _ in parts) / n * np.stack([a for _, a in parts])
    return np.einsum("ij,gj,kj->gik", D, var, D)


def _m_step(m: Mixture, nk, first, second, n: int, reg: float) -> Mixture:
    safe = np.maximum(nk, 1e-300)
    step = first / safe[:, None]  # new mean − current mean
    if m.diagonal:
        W = np.maximum(second - nk[:, None] * step * step, 0.0)
        covs = _diagonal_step(m.family, W, safe, n) + reg
    else:
        W = second - nk[:, None, None] * np.einsum("gi,gj->gij", step, step)
        W = (W + W.transpose(0, 2, 1)) / 2 + reg * safe[:, None, None] * np.eye(m.p)
        covs = _full_step(m.family, W, safe, n)
    return Mixture(m.family, nk / n, m.means + step, covs, m.loglik, m.history, n)


def init_from_centers(centers: np.ndarray, family: str, var: float = 1.0) -> Mixture:
    G, p = centers.shape
    covs = np.full((G, p), float(var)) if family[2] == "I" else np.repeat((np.eye(p) * var)[None], G, axis=0)
    return Mixture(family, np.full(G, 1.0 / G), np.asarray(centers, dtype=float).copy(), covs)


def em(df: DataFrame, starts: list[Mixture], max_iter: int = 100, tol: float = 1e-6,
       x: str = "x", reg: float = 1e-6) -> list[Mixture]:
    """Fit several mixtures together; each iteration is one scan shared by all.

    ``reg`` is a variance floor added to every covariance (the data may be
    rank deficient).  ``converged`` tells whether the log-likelihood settled within
    ``tol`` before ``max_iter``.  A model whose covariance stops being positive definite
    is marked failed (its BIC is null) and leaves the scan.
    """
    with blocks(df, [x]) as df:
        return _em(df, list(starts), max_iter, tol, x, reg)


def _em(df: DataFrame, models: list[Mixture], max_iter: int, tol: float, x: str, reg: float) -> list[Mixture]:
    active = [i for i in range(len(models)) if _valid(models[i])]
    for i in range(len(models)):
        if i not in active:
            models[i].failed = True
    n = None
    for _ in range(max_iter):
        if not active:
            break
        stats = _pass_chunked(df, x, [models[i] for i in active])
        still = []
        for i, (nk, first, second, ll) in zip(active, stats):
            m = models[i]
            n = int(round(nk.sum()))
            prev = m.loglik
            m.history.append(float(ll))
            try:
                new = _m_step(m, nk, first, second, n, reg)
            except np.linalg.LinAlgError:
                m.failed = True
                continue
            new.loglik = float(ll)
            models[i] = new
            if not _valid(new):
                new.failed = True
                continue
            new.converged = bool(np.isfinite(prev) and abs(ll - prev) <= tol * abs(ll))
            if not new.converged:
                still.append(i)
        active = still
    # log-likelihood of the final parameters
    fin = [i for i, m in enumerate(models) if not m.failed]
    if n is not None and fin:
        for i, st in zip(fin, _pass_chunked(df, x, [models[i] for i in fin])):
            models[i].loglik = float(st[3])
    return models


def _valid(m: Mixture) -> bool:
    """Parameters usable for an E-step: finite, positive weights, PD covariances.
    Checked on the driver so a degenerate model never fails a task."""
    if not (np.all(np.isfinite(m.weights)) and np.all(m.weights > 0)
            and np.all(np.isfinite(m.means)) and np.all(np.isfinite(m.covs))):
        return False
    if m.diagonal:
        return bool((m.covs > 0).all())
    try:
        np.linalg.cholesky(m.covs)
    except np.linalg.LinAlgError:
        return False
    return True


def posterior(df: DataFrame, m: Mixture, x: str = "x", passthrough=("id", "label")) -> DataFrame:
    """SoftAssignment (id, [label,] z ARRAY<DOUBLE>)."""
    keep = [c for c in passthrough if c in df.columns]

    dens = Densities(m)

    def fn(b):
        z, _ = responsibilities(b[x], m, dens)
        return {"z": z}

    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep] + ["z ARRAY<DOUBLE>"])
    return map_rows(df, [x], fn, schema, passthrough=keep)


def components_frame(spark, m: Mixture) -> DataFrame:
    """(component, weight, mean, cov, converged) as a small table."""
    rows = [(g, float(m.weights[g]), [float(v) for v in m.means[g]],
             [float(v) for v in m.full(g).ravel()], m.converged) for g in range(m.G)]
    return spark.createDataFrame(rows, "component INT, weight DOUBLE, mean ARRAY<DOUBLE>, "
                                       "cov ARRAY<DOUBLE>, converged BOOLEAN")


def bic_table(spark, models: list[Mixture]) -> DataFrame:
    """(numClusters, family, bic nullable, converged)."""
    rows = [(m.G, m.family, m.bic(), m.converged) for m in models]
    return spark.createDataFrame(rows, "numClusters INT, family STRING, bic DOUBLE, converged BOOLEAN")


def hard_assign(soft: DataFrame) -> DataFrame:
    """argmax of z (first wins) → cluster."""
    return soft.withColumn("cluster", (F.array_position("z", F.array_max("z")) - 1).cast("int"))
