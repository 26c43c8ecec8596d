"""Helpers shared by the llm operators: tables, lineage cuts, stable hashing."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.session import ensure_checkpoint_dir, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it from there.

    Later steps (and retries after a lost executor) then start from those files.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def unused(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores after it as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shuffle_width(spark: SparkSession) -> int:
    """Partitions for CPU-heavy groups, which are too small in bytes for AQE to size."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with the package shipped to the workers."""
    ship_package(df.sparkSession)
    return df.mapInArrow(fn, schema)


def texts_of(col) -> list[bytes]:
    """UTF-8 bytes of an Arrow string column; null is empty."""
    return [b"" if t is None else t for t in col.cast(pa.binary()).to_pylist()]


def text_slices(col, most: int = 4 << 20):
    """Row ranges of a string column of about ``most`` bytes each, so that the
    arrays made for one range stay small; a longer single text is a range of its own."""
    n = len(col)
    if not n:
        return
    size = np.frombuffer(_lengths(col), dtype=np.int64)
    group = (np.cumsum(size) - size) // most
    cuts = np.flatnonzero(np.diff(group)) + 1
    edge = [0, *cuts.tolist(), n]
    yield from zip(edge[:-1], edge[1:])


def _lengths(col) -> bytes:
    import pyarrow.compute as pc
    return pc.fill_null(pc.binary_length(col), 0).cast(pa.int64()).to_numpy(zero_copy_only=False).tobytes()


def hash_sample(df: DataFrame, key_cols: list[str], rows: int, total: int) -> DataFrame:
    """A sample of about ``rows`` of ``total`` rows, chosen by hash of the key, so that
    a retry chooses the same rows.  For fitting indexes and models only."""
    if total <= rows:
        return df
    share = int(rows / total * (1 << 62))
    return df.where(F.shiftrightunsigned(F.xxhash64(F.lit("sample"), *[F.col(c) for c in key_cols]), 2) < F.lit(share))


def one_per_id(rows: DataFrame) -> DataFrame:
    """One row for each ``id``: the one whose ``text`` has the lowest hash (repeated texts are
    alike).  ``rows`` must hold a bounded number of ids, on any number of rows: hashes are reduced before the
    texts are looked at, so an id on very many rows is no hot group."""
    h = F.xxhash64("text")
    least = rows.groupBy("id").agg(F.min(h).alias("_least"))
    near = rows.join(F.broadcast(least), "id").where(h == F.col("_least")).drop("_least")
    return near.groupBy(*[c for c in near.columns if c != "text"]).agg(F.any_value("text").alias("text"))


FILTER_BITS = 24  # entries of a key filter: 2 MB of bits


def key_filter(keys: DataFrame, name: str):
    """A test for a key column of another table: false only where the key is surely not among ``keys``.

    The keys' hashes mark entries of a table of 2**FILTER_BITS bits, which alone reaches the driver and
    the tasks; with very many keys it fills up and says yes more often.  Null keys are never among them.
    """
    size = 1 << FILTER_BITS

    def spot(c):
        return F.pmod(F.xxhash64(c), F.lit(size)).cast("int")

    bits = np.zeros(size, dtype=bool)
    bits[keys.where(F.col(name).isNotNull()).select(spot(F.col(name)).alias("s")).distinct().toArrow().column("s").to_numpy()] = True
    packed = np.packbits(bits)
    ship_package(keys.sparkSession)

    @F.pandas_udf("boolean")
    def marked(s: pd.Series) -> pd.Series:
        at = s.to_numpy()
        return pd.Series((packed[at >> 3] >> (7 - (at & 7))) & 1).astype(bool)

    return lambda c: F.when(c.isNull(), False).otherwise(marked(spot(c)))


class Forest:
    """Union-find over hashable keys; ``join`` tells whether two trees were joined."""

    def __init__(self):
        self.up: dict = {}

    def root(self, x):
        up = self.up
        r = up.setdefault(x, x)
        while up[r] != r:
            r = up[r]
        while up[x] != r:
            up[x], x = r, up[x]
        return r

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        if a < b:
            self.up[b] = a
        else:
            self.up[a] = b
        return True


def record_batch(**cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v) for v in cols.values()], names=list(cols))
