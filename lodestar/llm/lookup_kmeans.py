"""Centroid clustering (operator 12): k-means on integer vectors by scalar lookup tables.

Vectors become integers once and are kept in blocks: per dimension the occurring values and,
for every vector, the number of its value.  A round tabulates, for every dimension, occurring
value and centroid, the squared difference; a distance is then the sum of one gathered entry
per dimension.  All arithmetic is in 64-bit integers, so results do not depend on the order or
the layout of the rows.  Every task reduces its blocks to one (count, sum) row per centroid and
dimension before anything is shuffled, and only k x (dimensions + 1) sums reach the driver.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.llm.common import cut, map_arrow, record_batch
from lodestar.session import ensure_checkpoint_dir

SCALE = 1024        # an integer component is floor(SCALE * x)
MOST = 1 << 27      # larger components could overflow a 64-bit squared distance of 64 dimensions
BLOCK = "ids array<long>, n int, values array<long>, sizes array<int>, codes array<int>"


def _usable(vector: str, dims: int):
    """The vector has ``dims`` components, all finite."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) == dims) & finite, F.lit(False))


def _as_integers(x: np.ndarray, scale: int) -> np.ndarray:
    v = np.floor(scale * x)
    if len(v) and np.abs(v).max() >= MOST:
        raise ValueError(f"a component beyond {MOST // scale} cannot be clustered in 64-bit integers")
    return v.astype(np.int64)


def _matrix(col, dims: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), dims)


def encode(rows: DataFrame, dims: int, scale: int = SCALE) -> DataFrame:
    """(id, x) rows -> one row per Arrow batch: the ids, per dimension the sorted occurring integer
    values, and for every vector and dimension the number of its value."""
    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            v = _as_integers(_matrix(b.column("x"), dims), scale)
            values, codes = zip(*(np.unique(v[:, d], return_inverse=True) for d in range(dims)))
            one = lambda a, t: pa.array([a], pa.list_(t))
            yield record_batch(ids=pa.ListArray.from_arrays([0, b.num_rows], b.column("id")), n=pa.array([b.num_rows], pa.int32()),
                               values=one(np.concatenate(values), pa.int64()), sizes=one(np.array([len(u) for u in values], dtype=np.int32), pa.int32()),
                               codes=one(np.stack(codes).astype(np.int32).ravel(), pa.int32()))

    return map_arrow(rows, run, BLOCK)


class Block:
    """One encoded block: per dimension its occurring values and the vectors' numbers of them."""

    def __init__(self, row, dims: int):
        self.n = row.column("n")[0].as_py()
        self.ids = row.column("ids").flatten()
        part = lambda c: row.column(c).flatten().to_numpy()
        self.values = np.split(part("values"), np.cumsum(part("sizes"))[:-1])
        self.codes = part("codes").reshape(dims, self.n)

    def nearest(self, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(centroid, squared distance) of every vector; ties: the smaller number."""
        total = np.zeros((self.n, len(centres)), dtype=np.int64)
        for d, (values, code) in enumerate(zip(self.values, self.codes)):
            table = (values[:, None] - centres[None, :, d]) ** 2
            total += table[code]
        best = total.argmin(axis=1)
        return best, total[np.arange(self.n), best]

    def sums(self, best: np.ndarray, k: int) -> np.ndarray:
        """(k, dims) component sums, from counts of each (centroid, value)."""
        out = np.zeros((k, len(self.values)), dtype=np.int64)
        for d, (values, code) in enumerate(zip(self.values, self.codes)):
            out[:, d] = np.bincount(best * len(values) + code, minlength=k * len(values)).reshape(k, len(values)) @ values
        return out


def _blocks(batches, dims: int):
    for b in batches:
        for r in range(b.num_rows):
            yield Block(b.slice(r, 1), dims)


def _round(blocks: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(count, component sums) of every centroid's vectors."""
    k, dims = centres.shape

    def run(batches):
        count, sums = np.zeros(k, dtype=np.int64), np.zeros((k, dims), dtype=np.int64)
        for block in _blocks(batches, dims):
            best, _ = block.nearest(centres)
            count += np.bincount(best, minlength=k)
            sums += block.sums(best, k)
        full = np.flatnonzero(count)
        if len(full):
            yield record_batch(c=np.repeat(full, dims + 1), d=np.tile(np.arange(dims + 1), len(full)),
                               s=np.concatenate((sums[full], count[full, None]), axis=1).ravel())

    got = map_arrow(blocks, run, "c long, d long, s long").groupBy("c", "d").agg(F.sum("s").alias("s")).toArrow()
    out = np.zeros((k, dims + 1), dtype=np.int64)
    out[got.column("c").to_numpy(), got.column("d").to_numpy()] = got.column("s").to_numpy()
    return out[:, dims], out[:, :dims]


def starts(rows: DataFrame, k: int, salt: str, dims: int, scale: int = SCALE) -> np.ndarray:
    """The ``k`` vectors with the smallest sha256 of ``salt``:id, in that order, as integers; equal
    hashes (repeated ids) by their components, null ids last."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("id").cast("string")), 256)
    got = rows.orderBy(F.asc_nulls_last(key), "x").limit(k).select("x").collect()
    return _as_integers(np.array([r.x for r in got], dtype=np.float64).reshape(len(got), dims), scale)


def cluster(table: DataFrame, id_col: str = "vec_id", vector: str = "embedding", k: int = 8, rounds: int = 10, salt: str = "3",
            dims: int = 64, scale: int = SCALE) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256), one row per vector kept.

    Vectors that are null, not of ``dims`` components, or hold a null or non-finite component are
    left out.  Every round assigns each vector to the nearest centroid (ties: the smaller
    number) and replaces each centroid that has vectors by the floor of their mean; then vectors are assigned once
    more.  Repeated rows are vectors of their own; with fewer than ``k`` vectors each starts a centroid; an empty
    table gives an empty result.  Components that 64-bit sums could not hold are refused.
    """
    ensure_checkpoint_dir(table.sparkSession)
    rows = table.where(_usable(vector, dims)).select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("x"))
    centres = starts(rows, k, salt, dims, scale)
    blocks = cut(encode(rows, dims, scale))
    for _ in range(rounds if len(centres) else 0):
        count, sums = _round(blocks, centres)
        full = count > 0
        centres = centres.copy()
        centres[full] = sums[full] // count[full, None]

    def run(batches):
        for block in _blocks(batches, dims):
            best, far = block.nearest(centres)
            yield record_batch(vec_id=block.ids, cluster=best.astype(np.int32), distance=far)

    placed = cut(map_arrow(blocks, run, "vec_id long, cluster int, distance long"))
    inertia = {r.cluster: r.s for r in placed.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}  # k rows
    own = F.array(*[F.lit(inertia.get(c, 0)).cast("long") for c in range(len(centres))] or [F.lit(0).cast("long")])
    digest = F.array(*[F.lit(hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest()) for c in centres] or [F.lit("")])
    return placed.select("vec_id", "cluster", "distance", F.get(own, F.col("cluster")).alias("cluster_inertia"),
                         F.lit(sum(inertia.values())).cast("long").alias("inertia"), F.get(digest, F.col("cluster")).alias("centroid_sha256"))
