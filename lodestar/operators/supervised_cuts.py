"""Supervised cut points for feature selection (M25): recursive entropy splits by description length.

A feature is cut where the class entropy of both sides is least; the cut stands if it shortens
the description of the classes (Fayyad & Irani 1993), and both sides are cut again.  Only counts
move: a pass counts (part, class) cells of windows on all features and all segments at once, so no value is
sorted or shuffled.

The search is exact without looking at every value.  With class counts L before a window, B
inside it and T in all, the bits G(S) = F(S) + F(T - S) needed behind a cut are a concave function of the
counts S left of it, and F grows with every count.  Hence for all cuts inside the window G >= F(L) + F(T - L - B),
and a second-order bound about L holds where every class of the window also stands before and after it.  Windows
whose bound exceeds the best cut so far, or what an accepted cut may need at most, are dropped; the others
are cut into parts again until a window holds few rows, which are fetched.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import map_rows, partial_sums, to_numpy
from lodestar.functions.caching import cached
from lodestar.session import ship_package

PARTS = 128             # parts a window is cut into
FETCH_ROWS = 128        # rows of a window that are fetched instead of cut further
CELLS_PER_SCAN = 2_000_000
SPECIAL = 4             # classes missing on one side of a window that the second-order bound enumerates
TIE = 1e-9              # cuts whose bits differ by less (per row) are equal: the first one wins


def bits(c: np.ndarray) -> np.ndarray:
    """F(c): rows times class entropy, in bits, of count vectors along the last axis."""
    c = np.asarray(c, dtype=np.float64)
    xlogx = lambda v: np.where(v > 0, v * np.log2(np.where(v > 0, v, 1.0)), 0.0)
    return xlogx(c.sum(axis=-1)) - xlogx(c).sum(axis=-1)


def _naming(k: float) -> float:
    """log2(3 ** k - 2), for any number of classes."""
    return k * np.log2(3.0) + np.log2(1 - 2 * 3.0 ** -k)


def accepted(left: np.ndarray, total: np.ndarray) -> bool:
    """The description-length test: the bits saved pay for naming the cut and the classes of both sides."""
    right, n = total - left, total.sum()
    classes = [float((c > 0).sum()) for c in (total, left, right)]
    entropy = [bits(c) / c.sum() for c in (total, left, right)]
    delta = _naming(classes[0]) - (classes[0] * entropy[0] - classes[1] * entropy[1] - classes[2] * entropy[2])
    return bool(bits(total) - bits(left) - bits(right) > np.log2(n - 1) + delta)


def most_bits(total: np.ndarray) -> float:
    """G that no accepted cut exceeds: the test without what the two sides' own entropies add."""
    k, n = float((total > 0).sum()), total.sum()
    if n < 2 or k < 1:
        return -np.inf
    return float(bits(total) - (np.log2(n - 1) + _naming(k) - k * bits(total) / n))


def _second_order(L: np.ndarray, B: np.ndarray, T: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Least G over S = L + d, 0 <= d <= B in the classes ``move``, by gradient and bounded curvature."""
    R = T - L
    after = R - B
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = np.log2(L.sum(-1, keepdims=True) / L) - np.log2(R.sum(-1, keepdims=True) / R)
        curve = (1 / L + 1 / after) / np.log(2)
        own = np.minimum(0.0, slope * B - 0.5 * B ** 2 * curve)
    return bits(L) + bits(R) + np.where(move & (B > 0), own, 0.0).sum(-1)


def lower_bounds(L: np.ndarray, B: np.ndarray, T: np.ndarray, enough: float) -> np.ndarray:
    """A value that G exceeds nowhere inside each window (rows of L and B); windows already
    above ``enough`` are not bounded any closer."""
    L, B, T = (np.asarray(v, dtype=np.float64) for v in (L, B, T))
    out = bits(L) + bits(T - L - B)
    special = (B > 0) & ((L == 0) | (T - L - B == 0))
    todo = out <= enough
    plain = todo & ~special.any(axis=1)
    if plain.any():
        out[plain] = np.maximum(out[plain], _second_order(L[plain], B[plain], T, B[plain] > 0))
    for r in np.flatnonzero(todo & special.any(axis=1) & (special.sum(axis=1) <= SPECIAL)):
        at = np.flatnonzero(special[r])
        base = np.repeat(L[r][None], 1 << len(at), axis=0)
        base[:, at] += np.array(list(product((0.0, 1.0), repeat=len(at)))) * B[r, at]  # G is concave: its least value lies on such a face
        rest = np.where(special[r], 0.0, B[r])
        out[r] = max(out[r], float(_second_order(base, np.repeat(rest[None], len(base), axis=0), T, np.repeat(~special[r][None], len(base), axis=0)).min()))
    return out


class _Segment:
    """A range of one feature that may be cut: [lo, hi], class counts and the search's state."""

    def __init__(self, j: int, lo: float, hi: float, total: np.ndarray):
        self.j, self.lo, self.hi, self.total = j, lo, hi, np.asarray(total, dtype=np.float64)
        self.limit = most_bits(self.total)
        self.tie = TIE * max(self.total.sum(), 1.0)
        self.seen: list[tuple[float, float, np.ndarray]] = []  # (G, first value right of the cut or a bound below it, counts left)
        self.windows = [(lo, hi, np.zeros_like(self.total), self.total)] if lo < hi and (self.total > 0).sum() > 1 else []

    def record(self, edges: np.ndarray, left: np.ndarray) -> None:
        n = left.sum(axis=1)
        ok = (n > 0) & (n < self.total.sum())
        for g, e, c in zip(bits(left[ok]) + bits(self.total - left[ok]), edges[ok], left[ok]):
            if not self.seen or g <= self.seen[0][0] + self.tie:
                self.seen = [s for s in self.seen if s[0] <= g + self.tie] + [(float(g), float(e), c)]
                self.seen.sort(key=lambda s: s[0])

    def enough(self) -> float:
        return min(self.limit, self.seen[0][0] if self.seen else np.inf) + self.tie

    def best(self):
        return min(self.seen, key=lambda s: s[1], default=None)


def _ordinal(v):
    """Doubles as integers of the same order (and back)."""
    i = np.asarray(v, dtype=np.float64).view(np.int64)
    return i ^ ((i >> 63) & np.int64(0x7FFF_FFFF_FFFF_FFFF))


def _edges(lo: float, hi: float) -> np.ndarray:
    """Ascending lower ends of at most PARTS parts of [lo, hi]: half of them of equal width, half with
    equally many doubles, so that a value that many rows share stands alone after a few rounds wherever it lies."""
    half = np.arange(PARTS // 2) / (PARTS // 2)
    a, b = int(_ordinal(lo)), int(_ordinal(hi))
    keys = np.array([a + int(f * (b - a)) for f in half], dtype=np.int64)
    even = (keys ^ ((keys >> 63) & np.int64(0x7FFF_FFFF_FFFF_FFFF))).view(np.float64)
    e = np.unique(np.concatenate((lo + (hi - lo) * half, even, [lo, hi])))
    return e[(e >= lo) & (e <= hi)]


def _count(df: DataFrame, x: str, ix: str, k: int, todo: list[tuple[_Segment, tuple]]) -> list[np.ndarray]:
    """(parts, classes) counts of every window, one scan; part e is [edges[e], edges[e + 1])."""
    edges = [_edges(w[0], w[1]) for _, w in todo]
    size = [len(e) * k for e in edges]
    offs = np.concatenate(([0], np.cumsum(size)))
    js = [s.j for s, _ in todo]

    def fn(b):
        out, X, c = np.zeros(int(offs[-1])), b[x], b[ix].astype(np.int64)
        for m, (j, e) in enumerate(zip(js, edges)):
            v = X[:, j]
            own = np.flatnonzero((v >= e[0]) & (v <= e[-1]))
            at = np.searchsorted(e, v[own], side="right") - 1
            out[offs[m]:offs[m + 1]] += np.bincount(at * k + c[own], minlength=len(e) * k)
        return out

    got = partial_sums(df, [x, ix], fn, int(offs[-1]))
    return [(e, got[a:b].reshape(-1, k)) for e, a, b in zip(edges, offs[:-1], offs[1:])]


def _fetch(df: DataFrame, x: str, ix: str, todo: list[tuple[_Segment, tuple]]) -> list[list[tuple[float, int]]]:
    """The sorted (value, class) rows of every (small) window."""
    spans = [(s.j, w[0], w[1]) for s, w in todo]

    def fn(b):
        at, vs, cs = [], [], []
        for m, (j, lo, hi) in enumerate(spans):
            v = b[x][:, j]
            own = np.flatnonzero((v >= lo) & (v <= hi))
            at.append(np.full(len(own), m, dtype=np.int32))
            vs.append(v[own])
            cs.append(b[ix][own].astype(np.int32))
        return {"m": np.concatenate(at), "v": np.concatenate(vs), "c": np.concatenate(cs)}

    out: list[list] = [[] for _ in todo]
    for r in map_rows(df, [x, ix], fn, "m INT, v DOUBLE, c INT").collect():  # FETCH_ROWS a window
        out[r["m"]].append((r["v"], r["c"]))
    return [sorted(rows) for rows in out]


def _scans(todo: list, cells: int):
    """Windows in groups of CELLS_PER_SCAN counted cells."""
    per = max(1, CELLS_PER_SCAN // cells)
    for a in range(0, len(todo), per):
        yield todo[a:a + per]


def _refine(df: DataFrame, x: str, ix: str, k: int, segments: list[_Segment]) -> None:
    """One round: every window of every segment is counted in parts, and parts that cannot
    hold a better cut are dropped."""
    todo = [(s, w) for s in segments for w in s.windows]
    for s in segments:
        s.windows = []
    small = [(s, w) for s, w in todo if w[3].sum() <= FETCH_ROWS]
    large = [(s, w) for s, w in todo if w[3].sum() > FETCH_ROWS]
    for part in _scans(small, FETCH_ROWS):
        for (s, w), rows in zip(part, _fetch(df, x, ix, part)):
            v = np.array([r[0] for r in rows])
            counts = np.eye(k)[[r[1] for r in rows]] if rows else np.zeros((0, k))
            new = np.flatnonzero(np.diff(v) > 0) + 1  # a cut lies before each new value
            s.record(v[new], (w[2] + np.cumsum(counts, axis=0))[new - 1])
    for part in _scans(large, PARTS * k):
        for (s, w), (edges, counts) in zip(part, _count(df, x, ix, k, part)):
            left = w[2] + np.cumsum(counts, axis=0)
            s.record(edges[1:], left[:-1])
            s.windows += [(edges[m], edges[m + 1] if m + 1 < len(edges) else edges[m], left[m] - counts[m], counts[m])
                          for m in np.flatnonzero(counts.sum(axis=1) > 1)]
    for s in segments:  # when all parts are known, so that the best cut so far bounds every one of them
        s.windows = [(lo, np.nextafter(hi, -np.inf) if hi > lo else hi, L, B) for lo, hi, L, B in s.windows]
        s.windows = [w for w in s.windows if w[0] < w[1] and (w[3] > 0).sum() > 0]
        if s.windows:
            bound = lower_bounds(np.array([w[2] for w in s.windows]), np.array([w[3] for w in s.windows]), s.total, s.enough())
            s.windows = [w for w, b in zip(s.windows, bound) if b <= s.enough()]


def _neighbours(df: DataFrame, x: str, wanted: list[tuple[int, float, float, float]]) -> list[tuple[float, float]]:
    """For every (feature, lo, edge, hi): the largest value in [lo, edge) and the smallest in [edge, hi]."""
    def run(batches):
        low, high = np.full(len(wanted), -np.inf), np.full(len(wanted), np.inf)
        for b in batches:
            X = to_numpy(b.column(x)) if b.num_rows else np.zeros((0, 1 + max(w[0] for w in wanted)))
            for m, (j, lo, edge, hi) in enumerate(wanted):
                v = X[:, j]
                below, above = v[(v >= lo) & (v < edge)], v[(v >= edge) & (v <= hi)]
                low[m] = max(low[m], below.max(initial=-np.inf))
                high[m] = min(high[m], above.min(initial=np.inf))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(wanted), dtype=np.int32)), pa.array(low), pa.array(high)], names=["m", "low", "high"])

    ship_package(df.sparkSession)
    rows = df.select(x).mapInArrow(run, "m INT, low DOUBLE, high DOUBLE").groupBy("m").agg(F.max("low").alias("low"), F.min("high").alias("high")).collect()
    got = {r["m"]: (r["low"], r["high"]) for r in rows}
    return [got[m] for m in range(len(wanted))]


def _middle(a: float, b: float) -> float:
    """A value v with a <= v < b, half way if doubles allow."""
    mid = a + (b - a) / 2
    return a if mid >= b else mid


def entropy_cuts(df: DataFrame, n_classes: int, x: str = "x", ix: str = "label_ix", depth: int | None = None) -> list[np.ndarray]:
    """Ascending cut points of every feature; a value <= a cut lies left of it.

    ``ix`` holds class numbers 0 .. n_classes - 1.  Of equal cuts the smallest wins; a cut lies half way between the
    values around it.  ``depth`` bounds the recursion (1: at most the first cut).  A constant feature, one class, or
    no rows give no cut; a null or NaN is refused.
    """
    with cached(df.select(x, F.col(ix).cast("int").alias(ix))) as df:
        return _entropy_cuts(df, n_classes, x, ix, depth)


def _entropy_cuts(df, k, x, ix, depth) -> list[np.ndarray]:
    ends = df.select(F.posexplode(x).alias("j", "v")).groupBy("j").agg(
        F.min("v").alias("lo"), F.max("v").alias("hi"), F.count_if(F.isnan("v") | F.col("v").isNull()).alias("bad")).orderBy("j").collect()
    if any(r["bad"] for r in ends):
        raise ValueError("a feature to be cut holds a null or NaN; fill or leave out such rows first")
    total = partial_sums(df, [ix], lambda b: np.bincount(b[ix].astype(np.int64), minlength=k).astype(float), k)
    cuts: list[list[float]] = [[] for _ in ends]
    segments, level = [_Segment(int(r["j"]), r["lo"], r["hi"], total) for r in ends], 0
    while segments and (depth is None or level < depth):
        while any(s.windows for s in segments):
            _refine(df, x, ix, k, segments)
        won = [(s, s.best()) for s in segments]
        won = [(s, b) for s, b in won if b is not None and accepted(b[2], s.total)]
        around = _neighbours(df, x, [(s.j, s.lo, b[1], s.hi) for s, b in won]) if won else []
        segments, level = [], level + 1
        for (s, b), (low, high) in zip(won, around):
            cuts[s.j].append(_middle(low, high))
            segments += [_Segment(s.j, s.lo, low, b[2]), _Segment(s.j, high, s.hi, s.total - b[2])]
    return [np.sort(np.array(c, dtype=np.float64)) for c in cuts]


def discretize_by(df: DataFrame, cuts: Sequence[np.ndarray], x: str = "x", keep: Sequence[str] = ("id", "label")) -> DataFrame:
    """(keep..., bins ARRAY<DOUBLE>): 1 + the number of cuts below every value."""
    cuts = [np.asarray(c, dtype=np.float64) for c in cuts]

    def fn(b):
        return {"bins": np.stack([np.searchsorted(c, b[x][:, j], side="left") + 1.0 for j, c in enumerate(cuts)], axis=1)}

    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + ["bins ARRAY<DOUBLE>"])
    return map_rows(df, [x], fn, schema, passthrough=list(keep))
