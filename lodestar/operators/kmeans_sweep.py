"""k-means sweeps to convergence (M2, X2): carried distance bounds and exchange steps.

:func:`bounded_lloyd` gives the centres of plain Lloyd passes for many models, but computes only
distances that can matter.  A state holds, for every row and model, the cluster and the gap: how much farther
at least than its centre all others are (Hamerly 2010).  Centres that have moved since the state was written use up
the gap by how far they moved; a row whose gap is not used up keeps its cluster and adds nothing to the pass, as sums
are carried as changes against the state.  The state is written again only when many rows had to be measured.
Models of equally many centres are measured together: one product of the rows with all their centres.  For many rows
that takes less than to write and read the gaps of models with few centres, so these are measured in every pass.

:func:`exchange` goes on where Lloyd stops: moving one row from a cluster of n rows to one of m
changes the cost by m/(m+1) d_to^2 - n/(n-1) d_from^2, so a partition that no reassignment improves can still
improve by a single move (Hartigan & Wong 1979).  A round takes the best move out of every cluster, applies those that
share no cluster (their gains add up exactly) to the centres, and lets Lloyd settle again.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.blocks import Blocks, blocks
from lodestar.functions.caching import cached
from lodestar.operators import kmeans as KM

STATE_MODELS = 256   # models whose gaps (5 bytes a row and model) the state holds for many rows,
STATE_ENTRIES = 1_000_000  # or as many as keep rows x models below this for few
PLAIN_ENTRIES = 4_096   # beyond that, gaps are kept for models of more centre entries than this alone
GRID_ENTRIES = 1 << 16  # distances a kernel holds at a time: they stay in the CPU's cache
DENSE_SHARE = 0.2    # a model with so many rows of a block to measure is measured on all of them
MOVES_AT_DRIVER = 10_000    # moves of all tasks together that the driver compares itself
REWRITE_SHARE = 0.25  # the state is written again when a pass measured so many of all distances
SLACK = 1e-7         # bounds closer than this, relative to the vectors' size, are measured


def _distances(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """Euclidean distances by the expanded square; off by less than SLACK times the vectors' size."""
    d = np.einsum("ij,ij->i", X, X)[:, None] - 2.0 * (X @ C.T) + np.einsum("ij,ij->i", C, C)[None]
    return np.sqrt(np.maximum(d, 0.0))


def _measured(X: np.ndarray, C: np.ndarray):
    """The rows a part at a time under R models C (R, k, p): (slice, hit, gap), where hit (R, k, rows) marks the
    centre that :func:`lodestar.operators.kmeans.nearest` finds and gap() (R, rows) is how much farther the nearest of all
    others is, by the expanded square (off by less than 2 SLACK times the vectors' size).

    Arrays lie centres by rows.  Rows whose least distances are within rounding of each other are told apart exactly.
    """
    (R, k, p), mid = C.shape, C.reshape(-1, C.shape[2]).mean(axis=0)
    A, B = X - mid, (C - mid).reshape(R * k, p)
    xx, cc = np.einsum("ij,ij->i", A, A), np.einsum("ij,ij->i", B, B)
    tol = 1e-9 * (xx + cc.max(initial=0.0)) + 1e-300
    B *= -2.0
    step = max(16, GRID_ENTRIES // (R * k))
    for lo in range(0, len(X), step):
        part = slice(lo, lo + step)
        G = B @ A[part].T
        G += cc[:, None]
        G = G.reshape(R, k, -1)
        least = G.min(axis=1)
        hit = G <= (least + tol[part])[:, None]
        if np.count_nonzero(hit) != least.size or not np.isfinite(least).all():
            several = hit.sum(axis=1) != 1
            for r in np.flatnonzero(several.any(axis=1)):
                some = np.flatnonzero(several[r])
                hit[r][:, some] = False
                hit[r, KM.nearest(X[part][some], C[r])[0], some] = True

        def far(d):
            return np.sqrt(np.maximum(d + xx[part], 0.0))

        def gap():
            np.copyto(G, np.inf, where=hit)
            return far(G.min(axis=1)) - far(least)

        yield part, hit, gap


def _nearest_few(X: np.ndarray, C: np.ndarray) -> np.ndarray:
    """The nearest centre as :func:`lodestar.operators.kmeans.nearest` finds it, for few rows and one model."""
    mid = C.mean(axis=0)
    A, B = X - mid, C - mid
    xx, cc = np.einsum("ij,ij->i", A, A), np.einsum("ij,ij->i", B, B)
    G = cc - 2.0 * (A @ B.T)
    at, least = G.argmin(axis=1), G.min(axis=1)
    close = G <= (least + 1e-9 * (xx + cc.max()) + 1e-300)[:, None]
    if np.count_nonzero(close) != len(X) or not np.isfinite(least).all():
        some = np.flatnonzero(close.sum(axis=1) != 1)
        at[some] = KM.nearest(X[some], C)[0]
    return at


def _alike(centres: dict[int, np.ndarray]) -> list[tuple[list[int], np.ndarray]]:
    """Models {number: centres} of equally many centres together, as (numbers, centres (R, k, p)); their parts have 16 rows at least."""
    by_k: dict[int, list[int]] = {}
    for m, C in centres.items():
        by_k.setdefault(len(C), []).append(m)
    out = []
    for k, own in by_k.items():
        most = max(1, GRID_ENTRIES // (16 * k))
        out += [(own[lo:lo + most], np.stack([centres[m] for m in own[lo:lo + most]])) for lo in range(0, len(own), most)]
    return out


def _written(df: Blocks, x: str, centres: list[np.ndarray]) -> Blocks:
    """The state: x and, per model and row, the cluster and the gap (rounded down)."""
    groups = _alike(dict(enumerate(centres)))
    kind = np.min_scalar_type(max(map(len, centres), default=1) - 1)

    def fn(b):
        X = b[x]
        a, gap = np.empty((len(centres), len(X)), dtype=kind), np.empty((len(centres), len(X)), dtype=np.float32)
        for own, C in groups:
            number = np.arange(C.shape[1], dtype=kind)[None, :, None]
            for part, hit, apart in _measured(X, C):
                a[own, part] = np.multiply(hit, number).sum(axis=1, dtype=kind)
                gap[own, part] = apart() * (1 - 1e-7)
        return {x: X, "a": a, "gap": gap}

    return df.map(fn)


class _Sums:
    """Where the models' counts and sums stand in one flat vector; the last entry counts distances."""

    def __init__(self, centres: list[np.ndarray]):
        self.shape = [c.shape for c in centres]
        self.offs = np.cumsum([0] + [k * (p + 1) for k, p in self.shape])
        self.size = int(self.offs[-1]) + 1

    def view(self, v: np.ndarray, m: int) -> np.ndarray:
        k, p = self.shape[m]
        return v[self.offs[m]:self.offs[m + 1]].reshape(k, p + 1)

    def add_members(self, v: np.ndarray, models: list[int], own: np.ndarray) -> None:
        """Adds counts and sums (R, k, p + 1) of models of equally many centres."""
        for r, m in enumerate(models):
            self.view(v, m)[:] += own[r]


def _ones_first(X: np.ndarray) -> np.ndarray:
    return np.concatenate((np.ones((len(X), 1)), X), axis=1)


def _added(members: np.ndarray, X1: np.ndarray) -> np.ndarray:
    """Counts and sums (R, k, p + 1) of rows X1 (1 before x) by their (signed) membership (R, k, n)."""
    R, k, n = members.shape
    return (members.reshape(R * k, n).astype(np.float64) @ X1).reshape(R, k, -1)


def _members(at: np.ndarray, k: int) -> np.ndarray:
    """(R, k, n): where a row is a member of the model's cluster."""
    return at[:, None] == np.arange(k, dtype=at.dtype)[None, :, None]


def _plain_sums(df: Blocks, x: str, lay: _Sums, centres: list[np.ndarray], models: list[int]) -> np.ndarray:
    """The models' counts and sums, all distances measured."""
    groups = _alike({m: centres[m] for m in models})

    def fn(b):
        out, X1 = np.zeros(lay.size), _ones_first(b[x])
        for own, C in groups:
            lay.add_members(out, own, sum(_added(hit, X1[part]) for part, hit, _ in _measured(b[x], C)))
        return out

    return df.sums(fn, lay.size)


def _state_sums(state: Blocks, x: str, lay: _Sums, models: list[int]) -> np.ndarray:
    alike = [(own, C.shape[1]) for own, C in _alike({m: np.empty(lay.shape[m]) for m in models})]

    def fn(b):
        out, X1 = np.zeros(lay.size), _ones_first(b[x])
        for own, k in alike:
            step = max(16, GRID_ENTRIES // (len(own) * k))
            lay.add_members(out, own, sum(_added(_members(b["a"][own, lo:lo + step], k), X1[lo:lo + step]) for lo in range(0, len(X1), step)))
        return out

    return state.sums(fn, lay.size)


def _changes(state: Blocks, x: str, lay: _Sums, old: list[np.ndarray], new: list[np.ndarray], models: list[int]) -> np.ndarray:
    """What the moved centres change in the models' counts and sums, and how many distances that took."""
    used, reach = {}, {m: np.abs(new[m]).max(initial=0.0) * new[m].shape[1] ** 0.5 + 1.0 for m in models}
    for m in models:
        move = np.sqrt(((new[m] - old[m]) ** 2).sum(axis=1))
        others = np.full(len(move), move.max())  # how far any other centre moved at most
        top = int(move.argmax())
        others[top] = np.delete(move, top).max(initial=0.0)
        used[m] = move + others

    def fn(b):
        out, X = np.zeros(lay.size), b[x]
        size, X1 = np.sqrt(np.einsum("ij,ij->i", X, X)), _ones_first(X)
        dense = {}
        for m in models:
            at = b["a"][m]
            todo = np.flatnonzero(~(b["gap"][m] > used[m][at] + 2 * SLACK * (size + reach[m])))
            if len(todo) > DENSE_SHARE * len(X):
                dense[m] = new[m]
            elif len(todo):
                C, was, some = new[m], at[todo], X1[todo]
                near = _nearest_few(some[:, 1:], C)
                out[-1] += len(todo) * len(C)
                gone = near != was
                moved = _members(near[None, gone], len(C)).view(np.int8) - _members(was[None, gone], len(C)).view(np.int8)
                lay.add_members(out, [m], _added(moved, some[gone]))
        for own, C in _alike(dense):
            out[-1] += len(X) * len(own) * C.shape[1]
            total = np.zeros((*C.shape[:2], C.shape[2] + 1))
            for part, hit, _ in _measured(X, C):
                total += _added(hit.view(np.int8) - _members(b["a"][own, part], C.shape[1]).view(np.int8), X1[part])
            lay.add_members(out, own, total)
        return out

    return state.sums(fn, lay.size)


def bounded_lloyd(df: DataFrame | Blocks, starts: list[np.ndarray], max_iter: int = 100, x: str = "x", tags: list | None = None) -> list[KM.LloydModel]:
    """:func:`lodestar.operators.kmeans.lloyd` with carried bounds: the same centres up to rounding.

    ``history`` holds the number of distances of every pass instead of its cost; sizes and within-SS come
    from one plain pass at the end.  Ties go to the first centre, an empty cluster keeps its centre.
    """
    models = [KM.LloydModel(np.asarray(s, dtype=float).copy(), tag=tags[i] if tags else (i,)) for i, s in enumerate(starts)]
    with blocks(df, [x]) as df:
        few = df.rows * len(models) <= STATE_ENTRIES
        keep = [i for i, m in enumerate(models) if few or m.centers.size > PLAIN_ENTRIES]
        plain = [i for i, m in enumerate(models) if not few and m.centers.size <= PLAIN_ENTRIES]
        for ids, most in ((keep, max(STATE_MODELS, STATE_ENTRIES // max(df.rows, 1))), (plain, None)):
            for chunk in KM.chunks(ids, [models[i].centers.size for i in ids], most):
                _settle(df, x, [models[i] for i in chunk], max_iter, ids is keep)
                for i, (count, sse, _) in zip(chunk, KM.pass_stats(df, x, [models[i].centers for i in chunk], models[chunk[0]].centers.shape[1])):
                    models[i].sizes, models[i].sse = count, sse
    return models


def _settle(df: Blocks, x: str, models: list[KM.LloydModel], max_iter: int, carry: bool) -> None:
    lay, n = _Sums([m.centers for m in models]), df.rows
    state, base, written, measured = None, None, None, np.inf
    active = list(range(len(models))) if n else []
    try:
        for it in range(max_iter):
            if not active:
                break
            full = n * sum(len(models[m].centers) for m in active)
            if not carry:
                sums, spent = _plain_sums(df, x, lay, [m.centers for m in models], active), full
            elif measured > REWRITE_SHARE * full:
                if state is not None:
                    state.unpersist()
                written = [m.centers for m in models]
                state = _written(df, x, written)
                base = _state_sums(state, x, lay, active)
                sums, measured = base, 0.0
                spent = full
            else:
                change = _changes(state, x, lay, written, [m.centers for m in models], active)
                sums, measured = base + change, change[-1]
                spent = measured
            still = []
            for m in active:
                own, model = lay.view(sums, m), models[m]
                new, some = model.centers.copy(), own[:, 0] > 0.5
                new[some] = own[some, 1:] / own[some, :1]
                moved = np.abs(new - model.centers).max() if new.size else 0.0
                scale = 1e-12 * max(1.0, np.abs(model.centers).max(initial=0.0))
                model.history.append(spent)
                model.iterations = it + 1
                model.converged = bool(moved <= scale)  # sums carried as changes round differently from fresh ones
                if not model.converged:
                    model.centers = new
                    still.append(m)
            active = still
    finally:
        if state is not None:
            state.unpersist()


def _moves(df: Blocks, x: str, id_col: str, models: list[KM.LloydModel]) -> list[dict[int, tuple]]:
    """Per model and cluster the most profitable move out of it: (gain, to, x); ties: the smallest id."""
    weights = [(np.where(m.sizes > 1, m.sizes / np.maximum(m.sizes - 1, 1), 0.0), m.sizes / (m.sizes + 1)) for m in models]
    centres = [m.centers for m in models]

    def best(rows):
        top: dict[tuple, tuple] = {}
        for b in rows:
            X, ids = b[x], b[id_col]
            for m, (C, (leave, join)) in enumerate(zip(centres, weights)):
                at, d2 = KM.nearest(X, C)
                D = _distances(X, C) ** 2 * join[None]
                D[np.arange(len(X)), at] = np.inf
                to = D.argmin(axis=1)
                gain = leave[at] * d2 - join[to] * ((X - C[to]) ** 2).sum(axis=1)
                good = np.flatnonzero(gain > 1e-9 * np.maximum(d2, 1e-300))
                order = good[np.lexsort((ids[good], -gain[good], at[good]))]
                for i in order[np.flatnonzero(np.diff(at[order], prepend=-1))]:
                    move = (float(gain[i]), -int(ids[i]), int(to[i]), X[i])
                    key = (m, int(at[i]))
                    if key not in top or move[:3] > top[key][:3]:
                        top[key] = move
        return iter(top.items())

    def better(p, q):
        return p if p[:3] >= q[:3] else q

    parts, clusters = df.rdd.getNumPartitions(), sum(len(C) for C in centres)
    moves = df.rdd.mapPartitions(best)
    if parts * clusters > MOVES_AT_DRIVER:
        moves = moves.reduceByKey(better, min(parts, clusters))
    top: dict[tuple, tuple] = {}
    for key, move in moves.collect():
        top[key] = better(top[key], move) if key in top else move
    out: list[dict[int, tuple]] = [{} for _ in models]
    for (m, c), (gain, _, to, own) in top.items():  # one entry per model and cluster
        out[m][c] = (gain, to, own)
    return out


def _apply(model: KM.LloydModel, moves: dict[int, tuple]) -> np.ndarray:
    """Centres after the moves, best first, that share no cluster with a better one."""
    new, used = model.centers.copy(), set()
    for c, (gain, to, x) in sorted(moves.items(), key=lambda kv: (-kv[1][0], kv[0])):
        if c in used or to in used:
            continue
        used |= {c, to}
        n, m = model.sizes[c], model.sizes[to]
        new[c] = (n * new[c] - x) / (n - 1)
        new[to] = (m * new[to] + x) / (m + 1)
    return new


def _numbered(df: DataFrame | Blocks, x: str, id_col: str):
    """Blocks of the vectors and ids; a null id counts as the greatest, as it may only lose ties."""
    if isinstance(df, Blocks):
        return blocks(df, [x, id_col])
    last = F.lit(2 ** 63 - 1)
    return blocks(df.select(x, F.coalesce(F.col(id_col).cast("bigint"), last).alias(id_col)), [x, id_col])


def exchange(df: DataFrame | Blocks, models: list[KM.LloydModel], max_rounds: int = 50, max_iter: int = 100, x: str = "x", id_col: str = "id") -> list[KM.LloydModel]:
    """Converged Lloyd models improved until no single move of a row lowers the cost (or ``max_rounds``).

    The cost of a model never rises: a round's moves lower it by the sum of their gains, and Lloyd passes from the new
    centres lower it again.  ``converged`` tells that no profitable move is left.
    """
    out = list(models)
    with _numbered(df, x, id_col) as df:
        active = [i for i, m in enumerate(out) if m.sizes is not None and m.sizes.sum() > 0]
        for i in active:
            out[i].converged = False
        for _ in range(max_rounds):
            if not active:
                break
            found = _moves(df, x, id_col, [out[i] for i in active])
            for i, moves in zip(active, found):
                out[i].converged = not moves
            todo = [(i, moves) for i, moves in zip(active, found) if moves]
            fitted = bounded_lloyd(df, [_apply(out[i], moves) for i, moves in todo], max_iter, x, [out[i].tag for i, _ in todo]) if todo else []
            active = []
            for (i, _), new in zip(todo, fitted):
                new.iterations += out[i].iterations
                if new.cost < out[i].cost:  # rounding aside it always is
                    new.converged = False
                    out[i] = new
                    active.append(i)
                else:
                    out[i].converged = True
    return out


def sweep(df: DataFrame, ks, seed: int, runs: int = 50, max_iter: int = 100, x: str = "x", id_col: str = "id",
          finalists: int | None = 0) -> dict[int, KM.LloydModel]:
    """Best of ``runs`` hashed starts for every k, all fitted together; ties: the lowest run.
    The ``finalists`` cheapest models of every k (None: all) go on by exchange steps."""
    ks = list(ks)
    with cached(df.select(id_col, x)) as df, _numbered(df, x, id_col) as rows:
        starts = KM.hashed_starts(df, max(ks), seed, range(runs), x, id_col)
        grid = [(k, r) for r in range(runs) for k in ks]
        models = bounded_lloyd(rows, [starts[r][:k] for k, r in grid], max_iter, x, grid)
        ranked = {k: sorted((m for m in models if m.tag[0] == k), key=lambda m: (m.cost, m.tag[1])) for k in ks}
        if finalists != 0:
            chosen = [m for k in ks for m in ranked[k][:finalists]]
            better = exchange(rows, chosen, max_iter=max_iter, x=x, id_col=id_col)
            ranked = {k: sorted((m for m in better if m.tag[0] == k), key=lambda m: (m.cost, m.tag[1])) for k in ks}
        return {k: ranked[k][0] for k in ks}
