"""Correlation-based feature selection (M25) and the error of dropping features.

1. Find each feature's exact equal-frequency cut points by counting: a few passes
   narrow a window around every cut, no value is sorted or shuffled.
2. Bin every row where it lies and count (feature, bin, class) and (feature_i,
   feature_j, bin_i, bin_j) cells: map-side combined counts, so only p·B·C and p²·B²
   cells are shuffled.
3. Symmetric uncertainty SU = 2(Hx + Hy − Hxy)/(Hx + Hy) from those counts.
4. Search over the p x p SU matrix on the driver (it is p x p, not n-sized).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import local_frame, map_rows, partial_sums
from lodestar.functions.caching import cached

PARTS = 512        # parts a window is cut into per pass
COLLECT_ROWS = 64  # rows of a window that are fetched instead of cut further


def _ranks(n: int, bins: int) -> list[int]:
    """Rows up to and including bin b, for b = 1 .. bins − 1 (SQL ``ntile`` sizes)."""
    q, rem = divmod(n, bins)
    return [b * q + min(b, rem) for b in range(1, bins)]


def _edges(lo: float, hi: float) -> np.ndarray:
    """PARTS + 1 ascending edges of [lo, hi]; fewer when no doubles lie between."""
    return np.unique(np.concatenate((lo + (hi - lo) * (np.arange(PARTS) / PARTS), [hi])))


def cut_points(df: DataFrame, bins: int = 5, x: str = "x", id_col: str = "id") -> np.ndarray:
    """(p, bins − 1, 2): for every feature the (value, id) of the last row of each bin
    but the last, in the order (value, id).  Exact, ties included.

    Every cut starts with the window [min, max].  A pass counts the rows in PARTS parts
    of every window and keeps the part that holds the wanted rank, until few
    rows (or one repeated value) are left; few rows are fetched, a repeated value's ids are searched alike.
    """
    with cached(df.select(x, id_col)) as df:
        return _cut_points(df, bins, x, id_col)


def _cut_points(df: DataFrame, bins: int, x: str, id_col: str) -> np.ndarray:
    first = df.select(F.posexplode(x).alias("j", "v")).groupBy("j").agg(F.count("v").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
    p = len(first)
    if not p:
        return np.zeros((0, bins - 1, 2))
    ends = df.agg(F.min(id_col).alias("lo"), F.max(id_col).alias("hi")).first()
    windows = {}
    for r in first:
        for b, rank in enumerate(_ranks(int(r["n"]), bins)):
            # [value lo, value hi, id lo, id hi], the rank in it (1-based), rows in it
            windows[int(r["j"]), b] = [r["lo"], r["hi"], float(ends["lo"]), float(ends["hi"]), max(rank, 1), int(r["n"])]
    found: dict = {}
    while windows:
        small = {k: w for k, w in windows.items() if w[5] <= COLLECT_ROWS or (w[0] == w[1] and w[2] == w[3])}
        for k, rows in _fetch(df, x, id_col, small).items():
            found[k] = sorted(rows)[min(int(small[k][4]), len(rows)) - 1]
            del windows[k]
        if windows:
            _narrow(df, x, id_col, windows)
    return np.array([[found[j, b] for b in range(bins - 1)] for j in range(p)]).reshape(p, bins - 1, 2)


def _inside(b, x, id_col, key, w):
    v = b[x][:, key[0]]
    ok = (v >= w[0]) & (v <= w[1])
    if w[0] == w[1]:
        ok &= (b[id_col] >= w[2]) & (b[id_col] <= w[3])
    return ok, v


def _fetch(df: DataFrame, x: str, id_col: str, windows: dict) -> dict:
    """The (value, id) rows of small windows."""
    if not windows:
        return {}

    def fn(b):
        at, vs, ids = [], [], []
        for k, (key, w) in enumerate(windows.items()):
            ok, v = _inside(b, x, id_col, key, w)
            at.append(np.full(ok.sum(), k))
            vs.append(v[ok])
            ids.append(b[id_col][ok])
        return {"k": np.concatenate(at).astype(np.int32), "v": np.concatenate(vs), "i": np.concatenate(ids).astype(np.int64)}

    out: dict = {k: [] for k in windows}
    keys = list(windows)
    for r in map_rows(df, [x, id_col], fn, "k INT, v DOUBLE, i BIGINT").collect():
        out[keys[r["k"]]].append((r["v"], r["i"]))
    return out


def _narrow(df: DataFrame, x: str, id_col: str, windows: dict) -> None:
    """One counting pass: every window becomes the part that holds its rank."""
    keys, edges = list(windows), []
    for k in keys:
        w = windows[k]
        edges.append(_edges(w[2], w[3]) if w[0] == w[1] else _edges(w[0], w[1]))
    offs = np.concatenate(([0], np.cumsum([len(e) for e in edges])))

    def fn(b):
        out = np.zeros(int(offs[-1]))
        for m, (key, e) in enumerate(zip(keys, edges)):
            w = windows[key]
            ok, v = _inside(b, x, id_col, key, w)
            at = np.searchsorted(e, (b[id_col] if w[0] == w[1] else v)[ok], side="right") - 1
            out[offs[m]:offs[m + 1]] += np.bincount(at, minlength=len(e))
        return out

    counts = partial_sums(df, [x, id_col], fn, int(offs[-1]))
    for m, key in enumerate(keys):
        w, e, c = windows[key], edges[m], counts[offs[m]:offs[m + 1]]
        at = int(np.searchsorted(np.cumsum(c), w[4]))  # part [e[at], e[at + 1])
        below = int(c[:at].sum())
        last = np.nextafter(e[at + 1], -np.inf) if at + 1 < len(e) else e[at]
        if w[0] == w[1]:
            w[2:4] = [np.ceil(e[at]), max(np.ceil(e[at]), np.floor(last))]
        else:
            w[0:2] = [e[at], max(e[at], last)]
        w[4], w[5] = w[4] - below, int(c[at])


def discretize(df: DataFrame, bins: int = 5, x: str = "x", id_col: str = "id", label: str | None = "label") -> DataFrame:
    """(id, [label,] bins ARRAY<DOUBLE>): for every feature ``ntile(bins) OVER (ORDER BY
    v, id)``, from exact cut points and one map over the rows."""
    cuts = cut_points(df, bins, x, id_col)
    keep = [id_col] + ([label] if label else [])

    def fn(b):
        v, i = b[x][:, :, None], b["_i"][:, None, None]
        above = (v > cuts[None, :, :, 0]) | ((v == cuts[None, :, :, 0]) & (i > cuts[None, :, :, 1]))
        return {"bins": above.sum(axis=2) + 1.0}

    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + ["bins ARRAY<DOUBLE>"])
    return map_rows(df.select(*keep, x, F.col(id_col).alias("_i")), [x, "_i"], fn, schema, passthrough=keep)


def _entropy(counts: DataFrame, keys: list[str], n_col: str = "c") -> DataFrame:
    """H per key group from a cell-count column."""
    tot = F.sum(n_col)
    return counts.groupBy(*keys).agg(
        (F.log(tot) - F.sum(F.col(n_col) * F.log(n_col)) / tot).alias("h"))


def su_feature_class(binned: DataFrame, label: str = "label") -> DataFrame:
    """(j, su) — symmetric uncertainty of each discretised feature with the class."""
    long = binned.select(label, F.posexplode("bins").alias("j", "bin"))
    cells = long.groupBy("j", "bin", label).agg(F.count(F.lit(1)).alias("c"))
    hx = _entropy(cells.groupBy("j", "bin").agg(F.sum("c").alias("c")), ["j"]).withColumnRenamed("h", "hx")
    hy = _entropy(cells.groupBy("j", label).agg(F.sum("c").alias("c")), ["j"]).withColumnRenamed("h", "hy")
    hxy = _entropy(cells, ["j"]).withColumnRenamed("h", "hxy")
    t = hx.join(hy, "j").join(hxy, "j")
    den = F.col("hx") + F.col("hy")
    return t.select("j", F.when(den > 0, F.lit(2.0) * (den - F.col("hxy")) / den)
                    .otherwise(F.lit(0.0)).alias("su"))


def su_feature_pairs(binned: DataFrame, p: int, bins: int) -> np.ndarray:
    """p x p SU matrix between discretised features: each task counts all (i, j,
    bin_i, bin_j) cells of its rows and only those p²·B² counts are shuffled."""
    size = p * p * bins * bins

    def fn(b):
        B = b["bins"].astype(np.int64) - 1
        out = np.zeros((p, p, bins * bins))
        for i in range(p):
            for j in range(i, p):
                out[i, j] = np.bincount(B[:, i] * bins + B[:, j], minlength=bins * bins)
        return out.ravel()

    v = partial_sums(binned, ["bins"], fn, size).reshape(p, p, bins, bins)
    su = np.eye(p)
    for i in range(p):
        for j in range(i + 1, p):
            su[i, j] = su[j, i] = _su_from_joint(v[i, j])
    return su


def _h(c: np.ndarray) -> float:
    c = c[c > 0]
    n = c.sum()
    return float(np.log(n) - (c * np.log(c)).sum() / n) if n > 0 else 0.0


def _su_from_joint(joint: np.ndarray) -> float:
    hx, hy, hxy = _h(joint.sum(1)), _h(joint.sum(0)), _h(joint.ravel())
    return 2.0 * (hx + hy - hxy) / (hx + hy) if hx + hy > 0 else 0.0


def su_pairs_frame(spark: SparkSession, su: np.ndarray) -> DataFrame:
    p = su.shape[0]
    i, j = np.triu_indices(p, 1)
    return local_frame(spark, {"i": i, "j": j, "su": su[i, j]}, "i INT, j INT, su DOUBLE")


def merit(subset, su_c: np.ndarray, su_ff: np.ndarray) -> float:
    """k·r̄cf / √(k + k(k−1)·r̄ff) = Σ rcf / √(k + 2 Σ_pairs rff)."""
    s = list(subset)
    k = len(s)
    num = su_c[s].sum()
    pairs = sum(su_ff[a, b] for ai, a in enumerate(s) for b in s[ai + 1:])
    den = np.sqrt(k + 2.0 * pairs)
    return float(num / den) if den > 0 else 0.0


def greedy_forward(su_c: np.ndarray, su_ff: np.ndarray, steps: int) -> list[tuple[int, int, float]]:
    """(step, feature, merit) — best single addition per step, ties → lowest index."""
    chosen, out = [], []
    for step in range(1, steps + 1):
        best = None
        for j in range(len(su_c)):
            if j in chosen:
                continue
            m = merit(chosen + [j], su_c, su_ff)
            if best is None or m > best[1]:
                best = (j, m)
        if best is None:
            break
        chosen.append(best[0])
        out.append((step, best[0], best[1]))
    return out


def best_first(su_c: np.ndarray, su_ff: np.ndarray, max_stale: int = 5) -> list[int]:
    """Best-first search over subsets (forward), stop after ``max_stale`` expansions
    without improvement; returns the best subset found (sorted indices)."""
    p = len(su_c)
    start = frozenset()
    open_list = [(0.0, start)]
    seen = {start}
    best_set, best_m, stale = start, 0.0, 0
    while open_list and stale < max_stale:
        open_list.sort(key=lambda t: (-t[0], sorted(t[1])))
        m, s = open_list.pop(0)
        improved = False
        for j in range(p):
            if j in s:
                continue
            t = s | {j}
            if t in seen:
                continue
            seen.add(t)
            mt = merit(sorted(t), su_c, su_ff)
            open_list.append((mt, t))
            if mt > best_m + 1e-12:
                best_m, best_set, improved = mt, t, True
        stale = 0 if improved else stale + 1
    return sorted(best_set)


def dropped_feature_error(S_diag: np.ndarray, keep, n: int) -> tuple[float, float]:
    """Σ x² over the dropped features (total, as the reference) and per row."""
    mask = np.ones(len(S_diag), dtype=bool)
    mask[list(keep)] = False
    tot = float(S_diag[mask].sum())
    return tot, tot / n
