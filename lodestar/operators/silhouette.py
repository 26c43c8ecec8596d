"""Silhouette widths.

``silhouette_exact`` is the package definition on Euclidean distances:
a(i) = mean distance to the other members of i's cluster, b(i) = smallest
mean distance to another cluster, s = (b − a) / max(a, b), 0 for singletons.
It needs every pair distance, so its work is quadratic by definition; the
state is not: rows are hashed by id into a grid of blocks of bounded size (at least as many pairs as
the session has tasks), each task takes one unordered block pair at a time in GEMM tiles (used in both
directions) and emits only per-(row, cluster) distance sums.  Hashing ids (unique)
keeps every task the same size no matter how lopsided the clusters are, and several
clusterings of the same rows share one distance pass.

``silhouette_squared`` uses squared Euclidean distances, whose cluster means
follow from per-cluster sufficient statistics (n, Σx, Σ‖x‖²): linear work, the
form to use on very large inputs.  It is a different statistic and is kept
under its own name.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import group_sums, list_array, map_rows, partial_sums, to_numpy
from lodestar.operators import prep
from lodestar.session import ship_package

GROUP_DOUBLES = 1 << 23  # numbers of one pair of blocks: vectors and sums per cluster (64 MB)
TILE = 2048  # rows of a distance tile


def _cluster_sizes(assigned: DataFrame, cluster: str) -> np.ndarray:
    rows = assigned.groupBy(cluster).count().collect()  # one row per cluster
    k = max(int(r[cluster]) for r in rows) + 1 if rows else 0
    n = np.zeros(k)
    for r in rows:
        n[int(r[cluster])] = r["count"]
    return n


def _finish(sums: np.ndarray, own: np.ndarray, sizes: np.ndarray, self_excl: bool):
    """a, b, neighbour, s from per-cluster distance sums (rows x k)."""
    k = sizes.shape[0]
    idx = np.arange(sums.shape[0])
    n_own = sizes[own]
    denom_a = n_own - 1 if self_excl else n_own
    with np.errstate(divide="ignore", invalid="ignore"):
        a = np.where(denom_a > 0, sums[idx, own] / np.maximum(denom_a, 1), 0.0)
        means = np.where(sizes[None, :] > 0, sums / np.maximum(sizes[None, :], 1), np.inf)
    means[idx, own] = np.inf
    nb = np.argmin(means, axis=1) if k > 1 else np.full(len(own), -1)
    b = means[idx, nb] if k > 1 else np.full(len(own), np.nan)
    mx = np.maximum(a, b)
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.where((n_own > 1) & (mx > 0) & np.isfinite(b), (b - a) / mx, 0.0)
    return a, b, nb, s


def silhouette_exact(assigned: DataFrame, x: str = "x", cluster: str = "cluster",
                     id_col: str = "id", grid: int | None = None) -> DataFrame:
    """Per-row (id, cluster, neighbour, a, b, s) on Euclidean distances (M7)."""
    one = assigned.withColumn("model", F.lit(0))
    return silhouette_many(one, x, cluster, id_col, grid=grid).drop("model")


def grid_for(n: int, tasks: int, width: int) -> int:
    """Blocks for ``n`` rows of ``width`` numbers each (vector and sums per cluster): enough pairs to
    occupy ``tasks``, and blocks so small that two of them make GROUP_DOUBLES numbers at most."""
    rows = max(1, GROUP_DOUBLES // (2 * max(width, 1)))
    return max(1, math.ceil(math.sqrt(2 * tasks)), math.ceil(n / rows))


def silhouette_many(assigned: DataFrame, x: str = "x", cluster: str = "cluster", id_col: str = "id",
                    model: str = "model", grid: int | None = None) -> DataFrame:
    """Silhouettes of several clusterings of the same rows: (model, id, cluster, neighbour, a, b, s).

    ``assigned`` has one row per (id, model).  Distances do not depend on the model, so
    each is computed once for all of them.  Rows are hashed by id into ``grid`` blocks; each
    unordered block pair is one group, which works through tiles of TILE rows, so a row is
    shuffled to ``grid`` groups.  A task holds one group at a time, and :func:`grid_for` keeps a group
    to GROUP_DOUBLES numbers whatever the number of rows.
    """
    spark = assigned.sparkSession
    ship_package(spark)
    counts = assigned.groupBy(model, cluster).count().collect()  # one row per (model, cluster)
    names = sorted({int(r[model]) for r in counts})
    ks = [max(int(r[cluster]) for r in counts if r[model] == m) + 1 for m in names]
    offs = np.concatenate(([0], np.cumsum(ks))).astype(int)
    sizes = np.zeros(int(offs[-1]))
    for r in counts:
        sizes[offs[names.index(int(r[model]))] + int(r[cluster])] = r["count"]
    total = int(offs[-1])
    first = np.array(prep.column_stats(assigned.where(F.col(model) == names[0]), x).mean) if names else np.zeros(0)
    if grid is None:
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        n = max((sum(r["count"] for r in counts if r[model] == m) for m in names), default=0)
        grid = grid_for(n, tasks, total + len(first))
    rows = assigned.groupBy(F.col(id_col).alias("id")).agg(
        F.first(x).alias("x"), F.array_sort(F.collect_list(F.struct(F.col(model).cast("int").alias("m"), F.col(cluster).cast("int").alias("c")))).alias("mc"))
    rows = rows.select("id", "x", F.transform("mc", lambda s: s["c"]).cast("array<double>").alias("cl"),
                       F.pmod(F.xxhash64("id"), F.lit(grid)).cast("int").alias("blk"))
    other = F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("b")
    spread = rows.select("id", "x", "cl", "blk", other).select(
        "id", "x", "cl", "blk", F.least("blk", "b").alias("lo"), F.greatest("blk", "b").alias("hi"))

    def pair(tbl: pa.Table) -> pa.Table:
        ids, blk = tbl.column("id").to_numpy(), tbl.column("blk").to_numpy()
        X = to_numpy(tbl.column("x")) - first
        cl = to_numpy(tbl.column("cl")).astype(int) + offs[:-1]
        lo, hi = tbl.column("lo")[0].as_py(), tbl.column("hi")[0].as_py()
        sums = np.zeros((len(ids), total))
        sq = np.einsum("ij,ij->i", X, X)

        def member(idx):
            m = np.zeros((len(idx), total))
            np.put_along_axis(m, cl[idx], 1.0, axis=1)
            return m

        left, right = np.flatnonzero(blk == lo), np.flatnonzero(blk == hi)
        for a in range(0, len(left), TILE):
            ai = left[a:a + TILE]
            for b in range(a if lo == hi else 0, len(right), TILE):
                bi = right[b:b + TILE]
                D = np.sqrt(np.maximum(sq[ai][:, None] + sq[bi][None, :] - 2.0 * (X[ai] @ X[bi].T), 0.0))
                if lo == hi and a == b:
                    np.fill_diagonal(D, 0.0)
                    sums[ai] += D @ member(bi)
                else:
                    sums[ai] += D @ member(bi)
                    sums[bi] += D.T @ member(ai)
        return pa.Table.from_arrays([pa.array(ids), list_array(sums)], names=["id", "s"])

    partial = spread.groupBy("lo", "hi").applyInArrow(pair, "id BIGINT, s ARRAY<DOUBLE>")
    summed = partial.select("id", F.posexplode("s").alias("j", "v")).groupBy("id", "j").agg(F.sum("v").alias("v"))
    summed = summed.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("j", "v"))).alias("jv")).select(
        "id", F.transform("jv", lambda s: s["v"]).alias("s"))
    joined = summed.join(rows.select("id", "cl"), "id")

    def finish(b):
        own, S = b["cl"].astype(int), b["s"]
        out = {"cluster": own.astype(float)}
        got = [_finish(S[:, offs[m]:offs[m + 1]], own[:, m], sizes[offs[m]:offs[m + 1]], True) for m in range(len(names))]
        for k, name in enumerate(("a", "b", "neighbour", "s")):
            out[name] = np.stack([g[k] for g in got], axis=1).astype(float)
        return out

    wide = map_rows(joined, ["cl", "s"], finish, "id BIGINT, cluster ARRAY<DOUBLE>, neighbour ARRAY<DOUBLE>, a ARRAY<DOUBLE>, b ARRAY<DOUBLE>, s ARRAY<DOUBLE>",
                    passthrough=["id"])
    long = wide.select("id", F.posexplode(F.arrays_zip("cluster", "neighbour", "a", "b", "s")).alias("at", "z"))
    tag = F.element_at(F.array(*[F.lit(m) for m in names]), F.col("at") + 1) if names else F.lit(0)
    return long.select(tag.alias("model"), "id", F.col("z.cluster").cast("int").alias("cluster"), F.col("z.neighbour").cast("int").alias("neighbour"),
                       F.col("z.a").alias("a"), F.col("z.b").alias("b"), F.col("z.s").alias("s"))


def silhouette_squared(assigned: DataFrame, x: str = "x", cluster: str = "cluster",
                       id_col: str = "id") -> DataFrame:
    """Per-row silhouette on squared Euclidean distances, from cluster moments."""
    sizes = _cluster_sizes(assigned, cluster)
    k = len(sizes)
    mid = prep.column_stats(assigned, x).mean  # moments about the mean: no cancellation far from the origin
    p = len(mid)

    def stats(b):
        X, c = b[x] - mid, b[cluster].astype(int)
        out = np.zeros(k * (p + 1))
        out[:k * p] = group_sums(X, c, k).ravel()
        out[k * p:] = np.bincount(c, weights=(X * X).sum(1), minlength=k)
        return out

    v = partial_sums(assigned.select(x, F.col(cluster).cast("int").alias(cluster)), [x, cluster],
                     stats, k * (p + 1))
    S, Qn = v[:k * p].reshape(k, p), v[k * p:]

    def fn(b):
        X, c = b[x] - mid, b[cluster].astype(int)
        sq = (X * X).sum(1)[:, None]
        tot = sizes[None, :] * sq - 2.0 * (X @ S.T) + Qn[None, :]
        a, bb, nb, s = _finish(np.maximum(tot, 0.0), c, sizes, self_excl=True)
        return {"neighbour": nb.astype(np.int32), "a": a, "b": bb, "s": s}

    base = assigned.select(F.col(id_col).alias("id"), F.col(cluster).cast("int").alias(cluster), x)
    return map_rows(base, [x, cluster], fn,
                    "id BIGINT, cluster INT, neighbour INT, a DOUBLE, b DOUBLE, s DOUBLE",
                    passthrough=["id", cluster])


def average_width(per_row: DataFrame) -> DataFrame:
    """M6: mean s(i) over all rows."""
    return per_row.agg(F.avg("s").alias("avg_width"))
