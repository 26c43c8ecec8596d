"""Rows held as numpy blocks for operators that pass over them many times.

A pass over a cached frame turns every row into Arrow again and plans a query of its own.  An iterative fit
(k-means, mixtures, FastICA, nets) reads the same rows up to some hundred times, so its rows are turned into
numpy blocks once, dealt evenly over the cores, and kept as a cached RDD: a pass is then one stage whose tasks
stream their blocks and return one vector each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from lodestar.functions import arrowkit
from lodestar.functions.caching import cached
from lodestar.session import ship_package

BLOCK_BYTES = 1 << 20   # a block holds so many bytes of rows at most (one row at least)
BLOCK_ROWS = 2_048      # and so many rows
TASK_BYTES = 64 << 20   # a task's share of the rows, when that asks for more tasks than there are cores


class Blocks:
    """A cached RDD of blocks {column: numpy array}, one entry per row."""

    def __init__(self, rdd: RDD, rows: int):
        self.rdd, self.rows = rdd.persist(StorageLevel.MEMORY_AND_DISK), rows

    def map(self, fn: Callable[[dict], dict]) -> Blocks:
        """Blocks of ``fn(block)``, cached when first read; release them by :meth:`unpersist`."""
        return Blocks(self.rdd.map(fn), self.rows)

    def unpersist(self) -> None:
        self.rdd.unpersist()

    def sums(self, fn: Callable[[dict], np.ndarray], size: int) -> np.ndarray:
        """Σ over all blocks of ``fn(block)``, a vector of ``size`` numbers, added in the order of the tasks.

        The driver adds the tasks' vectors when they are few numbers together; else they are cut into chunks
        that tasks add, each holding one chunk of every vector at a time."""
        parts = self.rdd.getNumPartitions()
        step = max(1, arrowkit.DRIVER_SUM_ENTRIES // max(parts, 1))

        def fold(task: int, blocks: Iterator[dict]):
            acc = None
            for b in blocks:
                v = fn(b)
                acc = np.array(v, dtype=np.float64) if acc is None else np.add(acc, v, out=acc)
            if acc is not None:
                for c, lo in enumerate(range(0, size, step)):
                    yield c, (task, acc[lo:lo + step])

        def add(vecs) -> np.ndarray:
            ordered = sorted(vecs, key=lambda t: t[0])
            acc = ordered[0][1].copy()
            for _, v in ordered[1:]:
                acc += v
            return acc

        vecs, chunks = self.rdd.mapPartitionsWithIndex(fold), -(-size // step)
        out = np.zeros(size)
        if chunks <= 1:
            got = [v for _, v in vecs.collect()]
            return add(got) if got else out
        for c, v in vecs.groupByKey(min(parts, chunks)).mapValues(add).collect():
            out[c * step:c * step + len(v)] = v
        return out


def _packed(df: DataFrame, cols: Sequence[str]) -> RDD:
    """The rows as blocks: one binary value per column and block on the way out of Arrow."""
    def pack(batches):
        for b in batches:
            if not b.num_rows:
                continue
            data = [arrowkit.to_numpy(b.column(c)) for c in cols]
            wide = sum(a.nbytes for a in data) // b.num_rows
            rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // max(wide, 1)))
            for lo in range(0, b.num_rows, rows):
                own = [np.ascontiguousarray(a[lo:lo + rows]) for a in data]
                kinds = ",".join(a.dtype.str for a in own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(own[0])], type=pa.int32()), pa.array([kinds])] + [pa.array([a.tobytes()], type=pa.binary()) for a in own],
                    names=["n", "kinds"] + [f"c{k}" for k in range(len(own))])

    def unpack(row):
        own = [np.frombuffer(bytes(raw), dtype=kind) for kind, raw in zip(row[1].split(","), row[2:])]
        return {c: a.reshape(row[0], -1) if c in vectors else a for c, a in zip(cols, own)}

    vectors = {f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)}
    schema = ", ".join(["n INT", "kinds STRING"] + [f"c{k} BINARY" for k in range(len(cols))])
    return df.mapInArrow(pack, schema).rdd.map(unpack)


@contextmanager
def blocks(df: DataFrame | Blocks, cols: Sequence[str]):
    """The columns ``cols`` (numbers or vectors, no nulls) as :class:`Blocks` while the block of code runs; blocks are
    left as they are.

    Rows are dealt evenly over the cores, whatever the number of files or partitions they come from.
    """
    if isinstance(df, Blocks):
        yield df
        return
    spark = df.sparkSession
    ship_package(spark)
    cols = list(cols)
    with cached(df) as df:
        src = df.select(*cols)
        entries = [F.sum(F.size(f.name) if isinstance(f.dataType, ArrayType) else F.lit(1)) for f in src.schema.fields]
        n, *sizes = src.agg(F.count(F.lit(1)), *entries).first()
        cores = spark.sparkContext.defaultParallelism
        waves = max(1, -(-8 * sum(s or 0 for s in sizes) // (cores * TASK_BYTES)))
        held = Blocks(_packed(src.repartition(cores * waves), cols), int(n))
        held.rdd.count()
    try:
        yield held
    finally:
        held.unpersist()
