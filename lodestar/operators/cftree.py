"""Agglomerative starts for mixtures (M8): clustering-feature leaves, merged by Ward's criterion.

Hierarchical clustering of all rows needs every pair.  Here every task condenses its rows to a bounded
number of leaves, each kept as (rows, sum of vectors); leaves of several tasks are condensed again until LEAVES
are left for the driver, which merges them to one cluster and notes the partition at every wanted number of clusters.  A merge
of a and b adds n_a n_b / (n_a + n_b) |c_a - c_b|^2 to the within-cluster squares; the cheapest comes first, which for
mixtures of equal spherical components is the merge that lowers the classification likelihood least.  One tree
serves all numbers of components.  Leaves depend on the order in which tasks see the rows; totals do not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lodestar.functions.arrowkit import list_array, to_numpy
from lodestar.session import ship_package

LEAVES = 512   # leaves a task keeps, and those that reach the driver
FANIN = 16     # tasks whose leaves meet in one


EQUAL = 1e-12  # squared distance, relative to the points' size, up to which points are one


def agglomerate(n: np.ndarray, s: np.ndarray, least: int, wanted=(), free: float = -np.inf):
    """Merges clusters given by row counts and vector sums until ``least`` are left; with ``free`` only
    merges that cost no more.

    Returns (n, s, height of the last merge, {g: (n, s)} for every g in ``wanted`` that was passed).  Of equal
    merges the one with the lowest numbers comes first."""
    n, s, live = n.astype(np.float64).copy(), s.astype(np.float64).copy(), len(n)
    alive, kept, height = np.ones(len(n), dtype=bool), {}, 0.0

    def costs(i):
        c = s / n[:, None]
        out = n * n[i] / (n + n[i]) * ((c - c[i]) ** 2).sum(axis=1)
        out[~alive] = np.inf
        out[i] = np.inf
        return out

    def note():
        if live in wanted:
            kept[live] = (n[alive].copy(), s[alive].copy())

    note()
    if live > least:
        table = np.stack([costs(i) for i in range(len(n))])
        near = table.argmin(axis=1)
        far = table[np.arange(len(n)), near]
        while live > least:
            a = int(far.argmin())
            if free > -np.inf and far[a] > free:
                break
            b = int(near[a])
            a, b, height = min(a, b), max(a, b), float(far[a])
            n[a], s[a], alive[b] = n[a] + n[b], s[a] + s[b], False
            table[b], table[:, b], far[b] = np.inf, np.inf, np.inf
            row = costs(a)
            table[a], table[:, a] = row, row
            live -= 1
            note()
            stale = np.flatnonzero(alive & ((near == a) | (near == b)))
            stale = np.union1d(stale, [a])
            near[stale] = table[stale].argmin(axis=1)
            far[stale] = table[stale, near[stale]]
            closer = np.flatnonzero(alive & ((row < far) | ((row == far) & (a < near))))
            near[closer], far[closer] = a, row[closer]
    return n[alive], s[alive], height, kept


class Leaves:
    """A bounded set of clustering features that takes rows (or other features) in."""

    def __init__(self, p: int, most: int):
        self.n, self.s, self.most, self.reach = np.zeros(0), np.zeros((0, p)), most, 0.0

    def join_equal(self) -> None:
        """Leaves of equal points, seen by different tasks, become one."""
        if len(self.n) > 1:
            size = ((self.s / self.n[:, None]) ** 2).sum(axis=1).max()
            self.n, self.s, _, _ = agglomerate(self.n, self.s, 1, free=EQUAL * size)

    def add(self, n: np.ndarray, s: np.ndarray) -> None:
        for lo in range(0, len(n), self.most):
            m, t = n[lo:lo + self.most].astype(np.float64), s[lo:lo + self.most]
            if len(self.n):  # what costs no more than merges already made joins its leaf at once
                C, x = self.s / self.n[:, None], t / m[:, None]
                d = ((x * x).sum(1)[:, None] - 2 * x @ C.T + (C * C).sum(1)[None]) * (m[:, None] * self.n[None] / (m[:, None] + self.n[None]))
                at = d.argmin(axis=1)
                in_ = d[np.arange(len(m)), at] <= np.maximum(self.reach, EQUAL * (x * x).sum(1))
                np.add.at(self.n, at[in_], m[in_])
                np.add.at(self.s, at[in_], t[in_])
                m, t = m[~in_], t[~in_]
            same, first = np.unique(t / m[:, None], axis=0, return_inverse=True) if len(m) else (t, np.zeros(0, dtype=np.int64))
            own_n, own_s = np.zeros(len(same)), np.zeros_like(same)
            np.add.at(own_n, first.ravel(), m)
            np.add.at(own_s, first.ravel(), t)
            self.n, self.s = np.concatenate((self.n, own_n)), np.concatenate((self.s, own_s))
            if len(self.n) > self.most:
                self.n, self.s, height, _ = agglomerate(self.n, self.s, max(1, self.most * 3 // 4))
                self.reach = max(self.reach, height)


def leaves(df: DataFrame, x: str = "x", most: int = LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """(rows, sums) of at most ``most`` leaves of all rows of ``df``."""
    schema = "n DOUBLE, s ARRAY<DOUBLE>"

    def out(kept):
        if kept is not None and len(kept.n):
            yield pa.RecordBatch.from_arrays([pa.array(kept.n), list_array(kept.s)], names=["n", "s"])

    def build(batches):
        kept = None
        for b in batches:
            if b.num_rows:
                X = to_numpy(b.column(x))
                kept = kept or Leaves(X.shape[1], most)
                kept.add(np.ones(len(X)), X)
        yield from out(kept)

    def condense(batches):
        kept = None
        for b in batches:
            if b.num_rows:
                s = to_numpy(b.column("s"))
                kept = kept or Leaves(s.shape[1], most)
                kept.add(b.column("n").to_numpy(), s)
                kept.join_equal()
        yield from out(kept)

    ship_package(df.sparkSession)
    part = df.select(x).mapInArrow(build, schema)
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    while width > 1:
        width = -(-width // FANIN)
        part = part.repartition(width).mapInArrow(condense, schema)
    got = part.repartition(1).mapInArrow(condense, schema).toArrow().combine_chunks()
    if not got.num_rows:
        return np.zeros(0), np.zeros((0, 0))
    return got.column("n").to_numpy(), to_numpy(got.column("s"))


def tree_starts(df: DataFrame, Gs, x: str = "x", most: int = LEAVES) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{G: (weights, means)} of the merged leaves for every G, from one pass and one tree.

    Repeated points share a leaf; fewer leaves than G are refused, as there are fewer distinct points (or
    ``most`` is too small)."""
    Gs = sorted({int(g) for g in Gs})
    n, s = leaves(df, x, max(most, 2 * max(Gs, default=1)))
    if len(n) < max(Gs, default=0):
        raise ValueError(f"{max(Gs)} clusters wanted, but there are only {len(n)} distinct leaves")
    _, _, _, kept = agglomerate(n, s, min(Gs, default=1), set(Gs))
    return {g: (own / own.sum(), t / own[:, None]) for g, (own, t) in kept.items()}
