"""k-means: nearest centre (J7), cost (M4), multi-model Lloyd (M2, M5), MLlib (M3).

Lloyd here fits many models at once: every (k, run) keeps its centres in one
small driver-side list that is shipped with the task closure, and one scan of
the data per iteration returns, for every model, the per-cluster count, Σx and
Σd².  Those sums are combined inside each task before the shuffle, so the size
of a cluster (even a third of all rows) never concentrates work in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import group_sums, map_rows, partial_sums
from lodestar.functions.blocks import blocks
from lodestar.functions.caching import cached
from lodestar.operators.prep import split_order_key

# Models per scan are chunked so the shipped centres stay small.
MAX_CENTER_ENTRIES_PER_SCAN = 2_000_000


def _direct_d2(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    D = np.empty((X.shape[0], C.shape[0]))
    for c in range(C.shape[0]):
        diff = X - C[c]
        D[:, c] = np.einsum("ij,ij->i", diff, diff)
    return D


def nearest(X: np.ndarray, C: np.ndarray):
    """argmin_c ‖x−c‖² (first wins) and the exact squared distance to it.

    The expansion ‖x‖² − 2x·c + ‖c‖² about the mean centre picks, per row, every
    centre that could be nearest within its rounding error; those distances are then
    computed as Σ(x−c)², so near-ties resolve as an exact computation (and a SQL
    engine) resolves them.
    """
    n = X.shape[0]
    if n == 0:
        return np.zeros(0, dtype=np.int32), np.zeros(0)
    mid = C.mean(axis=0)
    Xc, Cc = X - mid, C - mid
    xx, cc = np.einsum("ij,ij->i", Xc, Xc), np.einsum("ij,ij->i", Cc, Cc)
    G = xx[:, None] - 2.0 * (Xc @ Cc.T) + cc[None, :]
    near = G <= (G.min(axis=1) + 1e-9 * (xx + cc.max()) + 1e-300)[:, None]
    row, col = np.nonzero(near)
    diff = X[row] - C[col]
    d = np.einsum("ij,ij->i", diff, diff)
    first = np.searchsorted(row, np.arange(n))
    best = np.minimum.reduceat(d, first)
    hit = np.flatnonzero(d == best[row])
    hit = hit[np.searchsorted(row[hit], np.arange(n))]
    return col[hit].astype(np.int32), best


def first_rows(df: DataFrame, k: int, x: str = "x", id_col: str = "id",
               order=None) -> np.ndarray:
    """Centres = x of the k first rows under ``order`` (default: smallest ids).

    A distributed top-k (``TakeOrderedAndProject``); only k rows move.  Fewer than k
    rows are refused: a model with fewer clusters must not pass as one with k.
    """
    order = order if order is not None else [F.col(id_col)]
    rows = df.orderBy(*order).select(x).limit(k).collect()
    if len(rows) < k:
        raise ValueError(f"{k} centres wanted, but there are only {len(rows)} rows")
    return np.array([r[x] for r in rows], dtype=float)


def hashed_starts(df: DataFrame, k: int, seed: int, runs, x: str = "x", id_col: str = "id") -> list[np.ndarray]:
    """For every run, the first k distinct points in the order md5(seed-run:id), then id.

    Independent of row layout.  One scan serves all runs: rows whose hash lies under
    a bound that should leave a few times k rows per run are collected; a run that finds too few
    distinct points there falls back to a grouped scan of the distinct points.
    """
    runs = list(runs)
    n = df.count()
    share = min(1.0, (4 * k + 64) / max(n, 1))
    bound = f"{int(share * 16 ** 12):013x}"[1:] if share < 1 else "g"
    hashes = F.array(*[F.struct(F.lit(r).alias("r"), split_order_key(f"{seed}-{r}", id_col).alias("h")) for r in runs])
    low = (df.select(F.col(id_col).alias("i"), F.col(x).alias("v"), F.explode(F.filter(hashes, lambda s: s["h"] < bound)).alias("s"))
           .select("s.r", "s.h", "i", "v").collect())
    by_run: dict = {r: [] for r in runs}
    for row in sorted(low, key=lambda q: (q["r"], q["h"], q["i"])):
        by_run[row["r"]].append(tuple(row["v"]))
    out = []
    for r in runs:
        points = list(dict.fromkeys(by_run[r]))[:k]
        if len(points) < k:
            key = F.struct(split_order_key(f"{seed}-{r}", id_col), F.col(id_col))
            rows = df.groupBy(x).agg(F.min(key).alias("o")).orderBy("o").limit(k).collect()
            points = [tuple(q[x]) for q in rows]
        if len(points) < k:
            raise ValueError(f"{k} centres wanted, but there are only {len(points)} distinct points")
        out.append(np.array(points, dtype=float))
    return out


def assign(df: DataFrame, centers: np.ndarray, x: str = "x",
           passthrough: tuple = ("id", "label")) -> DataFrame:
    """Nearest centre per row → (passthrough..., cluster INT, d2 DOUBLE)."""
    C = np.asarray(centers, dtype=float)
    keep = [c for c in passthrough if c in df.columns]

    def fn(b):
        a, d2 = nearest(b[x], C)
        return {"cluster": a, "d2": d2}

    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep] +
                       ["cluster INT", "d2 DOUBLE"])
    return map_rows(df, [x], fn, schema, passthrough=keep)


def assign_many(df: DataFrame, models: dict, x: str = "x", passthrough: tuple = ("id", "label")) -> DataFrame:
    """(passthrough..., model INT, cluster INT, d2) of every row under every model of
    ``{key: centres}`` in one scan, so a sweep is scored by one grouped pass."""
    keep = [c for c in passthrough if c in df.columns]
    keys, Cs = list(models), [np.asarray(c, dtype=float) for c in models.values()]

    def fn(b):
        got = [nearest(b[x], C) for C in Cs]
        return {"clusters": np.stack([a for a, _ in got], axis=1).astype(float), "d2s": np.stack([d for _, d in got], axis=1)}

    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep] + ["clusters ARRAY<DOUBLE>", "d2s ARRAY<DOUBLE>"])
    wide = map_rows(df, [x], fn, schema, passthrough=keep)
    long = wide.select(*keep, F.posexplode(F.arrays_zip("clusters", "d2s")).alias("at", "m"))
    name = F.element_at(F.array(*[F.lit(int(k)) for k in keys]), F.col("at") + 1)
    return long.select(*keep, name.alias("model"), F.col("m.clusters").cast("int").alias("cluster"), F.col("m.d2s").alias("d2"))


def center_distances(df: DataFrame, centers: np.ndarray, x: str = "x", metric: str = "sq",
                     passthrough: tuple = ("id", "label"), out: str = "d",
                     running_min: bool = False) -> DataFrame:
    """Distance of every row to every centre as ``d ARRAY<DOUBLE>`` (k entries).

    ``metric``: ``sq`` (squared Euclidean, exact differences) or ``l1``.
    ``running_min`` returns min over the first 1..k centres instead.
    """
    C = np.asarray(centers, dtype=float)
    keep = [c for c in passthrough if c in df.columns]

    def fn(b):
        X = b[x]
        D = np.empty((X.shape[0], C.shape[0]))
        for c in range(C.shape[0]):
            diff = X - C[c]
            D[:, c] = np.abs(diff).sum(1) if metric == "l1" else np.einsum("ij,ij->i", diff, diff)
        if running_min:
            D = np.minimum.accumulate(D, axis=1)
        return {out: D}

    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep] +
                       [f"{out} ARRAY<DOUBLE>"])
    return map_rows(df, [x], fn, schema, passthrough=keep)


def soft_assign(df: DataFrame, centers: np.ndarray, x: str = "x",
                passthrough: tuple = ("id", "label")) -> DataFrame:
    """Deterministic soft assignment z = softmax(−‖x − c‖²) per row (stable form)."""
    C = np.asarray(centers, dtype=float)
    keep = [c for c in passthrough if c in df.columns]

    def fn(b):
        X = b[x]
        D = np.empty((X.shape[0], C.shape[0]))
        for c in range(C.shape[0]):
            diff = X - C[c]
            D[:, c] = np.einsum("ij,ij->i", diff, diff)
        E = np.exp(D.min(1, keepdims=True) - D)
        return {"z": E / E.sum(1, keepdims=True)}

    schema = ", ".join([f"{c} {df.schema[c].dataType.simpleString()}" for c in keep] +
                       ["z ARRAY<DOUBLE>"])
    return map_rows(df, [x], fn, schema, passthrough=keep)


def cost_table(assigned: DataFrame) -> DataFrame:
    """(cluster, n, within_ss) (M4 per cluster, A14, A2)."""
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"),
                                           F.sum("d2").alias("within_ss"))


@dataclass
class LloydModel:
    centers: np.ndarray
    sizes: np.ndarray = None
    sse: np.ndarray = None
    iterations: int = 0
    history: list = field(default_factory=list)
    tag: tuple = ()
    converged: bool = False

    @property
    def cost(self) -> float:
        return float(self.sse.sum())


def pass_stats(df: DataFrame, x: str, centers: list[np.ndarray], p: int):
    """One scan: for every model, per-cluster (count, Σd², Σx)."""
    ks = [c.shape[0] for c in centers]
    offs = np.cumsum([0] + [k * (2 + p) for k in ks])
    size = int(offs[-1])
    Cs = [np.asarray(c, dtype=float) for c in centers]

    def fn(b):
        X = b[x]
        out = np.zeros(size)
        for m, C in enumerate(Cs):
            k = C.shape[0]
            a, d2 = nearest(X, C)
            o = offs[m]
            out[o:o + k] = np.bincount(a, minlength=k)
            out[o + k:o + 2 * k] = np.bincount(a, weights=d2, minlength=k)
            out[o + 2 * k:o + 2 * k + k * p] = group_sums(X, a, k).ravel()
        return out

    v = partial_sums(df, [x], fn, size)
    res = []
    for m, k in enumerate(ks):
        o = offs[m]
        res.append((v[o:o + k], v[o + k:o + 2 * k], v[o + 2 * k:o + 2 * k + k * p].reshape(k, p)))
    return res


def lloyd(df: DataFrame, starts: list[np.ndarray], max_iter: int = 100, x: str = "x",
          tol: float = 0.0, tags: list | None = None) -> list[LloydModel]:
    """Multi-model Lloyd: ``max_iter`` centre updates, then the final cost.

    Pass t measures every model against its current centres; the centres are
    then replaced by cluster means (an empty cluster keeps its centre).  A
    model whose centres stop moving is frozen and leaves the scan.
    """
    with blocks(df, [x]) as df:
        return _lloyd(df, starts, max_iter, x, tol, tags)


def _lloyd(df, starts, max_iter, x, tol, tags) -> list[LloydModel]:
    p = starts[0].shape[1]
    models = [LloydModel(np.asarray(s, dtype=float).copy(), tag=(tags[i] if tags else (i,)))
              for i, s in enumerate(starts)]
    active = list(range(len(models)))
    it = 0
    while active:
        groups = chunks(active, [models[i].centers.size for i in active])
        stats = {}
        for ch in groups:
            for i, st in zip(ch, pass_stats(df, x, [models[i].centers for i in ch], p)):
                stats[i] = st
        still = []
        for i in active:
            cnt, sse, sums = stats[i]
            m = models[i]
            m.sizes, m.sse = cnt, sse
            m.history.append(float(sse.sum()))
            if it >= max_iter:
                continue
            new = m.centers.copy()
            nz = cnt > 0
            new[nz] = sums[nz] / cnt[nz][:, None]
            moved = np.max(np.abs(new - m.centers)) if new.size else 0.0
            m.centers = new
            m.iterations = it + 1
            m.converged = bool(moved <= tol)
            if not m.converged:
                still.append(i)
            # else: the means equal the centres just measured, so the
            # sizes and within-SS of this pass are already final
        active = still
        it += 1
    return models


def chunks(ids, sizes, most: int | None = None):
    """Models in groups of MAX_CENTER_ENTRIES_PER_SCAN centre entries (and ``most`` models) at most."""
    out, cur, acc = [], [], 0
    for i, s in zip(ids, sizes):
        if cur and (acc + s > MAX_CENTER_ENTRIES_PER_SCAN or len(cur) == most):
            out.append(cur)
            cur, acc = [], 0
        cur.append(i)
        acc += s
    if cur:
        out.append(cur)
    return out


def kmeans(df: DataFrame, k: int, seed: int, runs: int = 1, max_iter: int = 100,
           x: str = "x", init: str = "hashed") -> LloydModel:
    """Best of ``runs`` seeded starts by total within-SS (M2); ties → lowest run."""
    return kmeans_grid(df, [k], seed, runs, max_iter, x, init)[k]


def kmeans_grid(df: DataFrame, ks, seed: int, runs: int = 1, max_iter: int = 100,
                x: str = "x", init: str = "hashed") -> dict:
    """All (k, run) fitted together; returns the best model per k (M5 grid)."""
    ks = list(ks)
    kmax = max(ks)
    with cached(df) as df:
        return _kmeans_grid(df, ks, kmax, seed, runs, max_iter, x, init)


def _kmeans_grid(df, ks, kmax, seed, runs, max_iter, x, init) -> dict:
    starts, tags = [], []
    bases = [first_rows(df, kmax, x)] * runs if init == "first" else hashed_starts(df, kmax, seed, range(runs), x)
    for r, base in enumerate(bases):
        for k in ks:
            starts.append(base[:k])
            tags.append((k, r))
    models = lloyd(df, starts, max_iter=max_iter, x=x, tags=tags)
    best = {}
    for m in models:
        k, r = m.tag
        if k not in best or m.cost < best[k].cost:
            best[k] = m
    return best


def sse_curve(df: DataFrame, ks, seed: int, runs: int = 1, max_iter: int = 100,
              x: str = "x", init: str = "hashed") -> DataFrame:
    """(k, within_ss_mean = tot.withinss / n) (M5)."""
    best = kmeans_grid(df, ks, seed, runs, max_iter, x, init)
    rows = [(int(k), float(m.cost / m.sizes.sum())) for k, m in sorted(best.items())]
    return df.sparkSession.createDataFrame(rows, "k INT, within_ss_mean DOUBLE")


def mllib_kmeans(df: DataFrame, k: int, seed: int, max_iter: int = 100, x: str = "x"):
    """``pyspark.ml`` KMeans (M3); returns (model, trainingCost = M4 cost)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    vec = df.withColumn("features", array_to_vector(x))
    model = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="features").fit(vec)
    return model, float(model.summary.trainingCost)
