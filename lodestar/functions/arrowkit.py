"""Arrow-batched numpy kernels run inside Spark tasks.

Two shapes cover every GEMM-like step of the library:

* :func:`partial_sums` — a sufficient-statistics pass.  Each task folds all of
  its Arrow batches into one dense vector; vectors are summed by a tree of
  ``repartition`` + ``mapInArrow`` levels until few enough remain for the
  driver.  Only vectors bounded
  by the model size, never by n, reach the driver.
* :func:`map_rows` — a per-row transform (projection, nearest centre,
  posterior) that keeps the row id and any pass-through columns.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from lodestar.session import ship_package

# Numbers the driver adds up at most, beside one vector.
DRIVER_SUM_ENTRIES = 4_000_000
# A session's shuffle width times the statistic's size over this gives the reducers of the
# first level: one for a few hundred numbers, all of them for millions.
REDUCER_ENTRIES = 200_000


def to_numpy(col) -> np.ndarray:
    """Arrow column → numpy. ARRAY<DOUBLE> becomes an (n, p) float64 matrix.

    A null, or vectors of unequal length, would shift the values of one row into
    another, so both are refused here.
    """
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        raise ValueError("a numeric kernel was given a null; filter or fill such rows first")
    if pa.types.is_list(col.type) or pa.types.is_large_list(col.type):
        n = len(col)
        if n == 0:
            return np.zeros((0, 0))
        width = np.diff(col.offsets.to_numpy())
        if (width != width[0]).any():
            raise ValueError("a numeric kernel was given vectors of unequal length")
        flat = col.flatten()
        if flat.null_count:
            raise ValueError("a numeric kernel was given a vector with a null entry")
        return np.asarray(flat.to_numpy(zero_copy_only=False), dtype=np.float64).reshape(n, int(width[0]))
    return col.to_numpy(zero_copy_only=False)


def local_frame(spark, columns: dict, schema: str) -> DataFrame:
    """A small driver-side table as a local relation: the planner knows its exact size
    and picks broadcast or shuffle joins from it."""
    fields = StructType.fromDDL(schema)
    kind = to_arrow_schema(fields)
    return spark.createDataFrame(pa.Table.from_arrays([pa.array(columns[f.name], type=f.type) for f in kind], schema=kind), fields)


def list_array(m: np.ndarray, dtype=pa.float64()) -> pa.Array:
    """(n, d) numpy matrix → Arrow ARRAY column."""
    m = np.ascontiguousarray(m)
    n = m.shape[0]
    d = m.shape[1] if m.ndim == 2 else 0
    offsets = pa.array(np.arange(0, (n + 1) * d, d if d else 1, dtype=np.int32)[: n + 1]
                       if d else np.zeros(n + 1, dtype=np.int32))
    return pa.ListArray.from_arrays(offsets, pa.array(m.ravel(), type=dtype))


def group_sums(X: np.ndarray, g: np.ndarray, k: int) -> np.ndarray:
    """Row sums of X per group index g (0..k-1) as a k x p matrix: one stable
    sort plus ``np.add.reduceat`` (``np.add.at`` is an unbuffered slow path)."""
    out = np.zeros((k, X.shape[1]))
    if X.shape[0] == 0:
        return out
    order = np.argsort(g, kind="stable")
    gs = g[order]
    uniq, starts = np.unique(gs, return_index=True)
    out[uniq] = np.add.reduceat(X[order], starts, axis=0)
    return out


# Vectors travel as dense chunks of this many doubles (one Arrow list row each).
CHUNK = 1 << 18
# Tree reduction: each level sums this many task vectors per task.
FANIN = 64


def partial_sums(df, cols: Sequence[str],
                 fn: Callable[[dict], np.ndarray], size: int) -> np.ndarray:
    """Σ over all rows of ``fn(batch)``; returns a dense float64 vector.

    ``fn`` receives ``{col: numpy}`` for one Arrow batch and returns a vector
    of length ``size``.  Each task folds all of its batches into one vector
    and emits it as a few dense chunk rows.  A tree of ``repartition`` levels
    sums them, from up to ``spark.sql.shuffle.partitions`` reducers by ``FANIN``
    until the driver can add what is left; its shape follows the session and the
    statistic's size, never the data.  Only per-task vectors move, so a hot
    key or a skewed partition never funnels rows into one task.

    ``df`` may be :class:`lodestar.functions.blocks.Blocks`, for passes that are repeated.
    """
    if not isinstance(df, DataFrame):
        return df.sums(fn, size)
    ship_package(df.sparkSession)
    cols = list(cols)
    n_chunks = max(1, -(-size // CHUNK))
    schema = "c INT, v ARRAY<DOUBLE>"

    def emit(acc):
        for c in range(n_chunks):
            part = acc[c * CHUNK:(c + 1) * CHUNK]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c], type=pa.int32()), list_array(part[None, :])], names=["c", "v"])

    def run(batches):
        acc = None
        for b in batches:
            if b.num_rows == 0:
                continue
            if acc is None:
                acc = np.zeros(size)
            acc += fn({c: to_numpy(b.column(c)) for c in cols})
        if acc is not None:
            yield from emit(acc)

    def combine(batches):
        acc = np.zeros(size)
        seen = False
        for b in batches:
            cs = b.column("c").to_numpy()
            vs = b.column("v")
            for i, c in enumerate(cs):
                acc[c * CHUNK:c * CHUNK + len(vs[i])] += vs[i].values.to_numpy()
                seen = True
        if seen:
            yield from emit(acc)

    vecs = df.select(*cols).mapInArrow(run, schema)
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(1, min(width, -(-width * size // REDUCER_ENTRIES)))
    vecs = vecs.repartition(parts).mapInArrow(combine, schema)
    while parts > 1 and parts * size > DRIVER_SUM_ENTRIES:
        parts = max(1, -(-parts // FANIN))
        vecs = vecs.repartition(parts).mapInArrow(combine, schema)
    out = np.zeros(size)
    tbl = vecs.toArrow()
    cs = tbl.column("c").to_numpy()
    vs = tbl.column("v").combine_chunks() if tbl.num_rows else None
    for i, c in enumerate(cs):
        out[c * CHUNK:c * CHUNK + len(vs[i])] += vs[i].values.to_numpy()
    return out


def map_rows(df: DataFrame, in_cols: Sequence[str], fn: Callable[[dict], dict],
             out_schema: str, passthrough: Sequence[str] = ()) -> DataFrame:
    """Per-batch row transform: ``fn({col: numpy}) -> {out_col: numpy|Arrow}``.

    ``passthrough`` columns are copied from the input batch unchanged (ids,
    labels) and must be listed first in ``out_schema``.
    """
    ship_package(df.sparkSession)
    in_cols = list(in_cols)
    passthrough = list(passthrough)
    sel = list(dict.fromkeys(passthrough + in_cols))
    names = StructType.fromDDL(out_schema).names

    def run(batches):
        for b in batches:
            if b.num_rows == 0:
                continue
            res = fn({c: to_numpy(b.column(c)) for c in in_cols})
            arrays = []
            for name in names:
                if name in passthrough:
                    arrays.append(b.column(name))
                else:
                    v = res[name]
                    if isinstance(v, (pa.Array, pa.ChunkedArray)):
                        arrays.append(v)
                    elif isinstance(v, np.ndarray) and v.ndim == 2:
                        arrays.append(list_array(v))
                    else:
                        arrays.append(pa.array(v))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return df.select(*sel).mapInArrow(run, out_schema)
