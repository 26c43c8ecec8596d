"""Cumulative distance histogram per class.

Breaks: ``bins − 1`` equal bins on [0, 2·mean(d)] plus one catch-all bin up to
max(d).  Bins are right-closed with the lowest edge included; mass is divided
by the class size and accumulated; the catch-all bin is dropped on output.
Binning is a column expression and counting is a partially aggregated
``groupBy``; the zero fill and the running sum touch only classes x bins cells.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

import numpy as np

from lodestar.functions.arrowkit import map_rows


def distances_to_own_center(assigned: DataFrame, centers, x: str = "x",
                            metric: str = "l1", cluster: str = "cluster") -> DataFrame:
    """(class, d): distance of each row to its own centre (J2 + F1).

    ``metric='l1'`` is what the reference computes (D1); ``'sq'`` is the
    squared Euclidean distance its comment describes.  The centre lookup is
    an index into the k x p centre matrix shipped with the task.
    """
    C = np.asarray(centers, dtype=float)

    def fn(b):
        diff = b[x] - C[b[cluster].astype(int)]
        d = np.abs(diff).sum(1) if metric == "l1" else np.einsum("ij,ij->i", diff, diff)
        return {"class": b[cluster].astype(np.int32), "d": d}

    return map_rows(assigned, [x, cluster], fn, "class INT, d DOUBLE")


def cumulative_histogram(dist: DataFrame, bins: int = 500, cls: str = "class",
                         d: str = "d") -> DataFrame:
    """(class, bin, mid, cum_prob) for bins 1 .. bins−1.

    Two passes over the (class, d) rows: the mean (bin width), then the
    counts; class sizes come from the counts, not from another scan.
    """
    mean = dist.agg(F.avg(d).alias("m")).collect()[0]["m"]
    if mean is None:
        return dist.sparkSession.createDataFrame([], f"{cls} {dist.schema[cls].dataType.simpleString()}, "
                                                     "bin INT, mid DOUBLE, cum_prob DOUBLE")
    top = 2.0 * mean
    w = top / (bins - 1)
    if w > 0:
        inner = F.least(F.lit(bins - 1), F.greatest(F.lit(1), F.ceil(F.col(d) / F.lit(w))))
    else:
        inner = F.lit(1)
    b = F.when(F.col(d) <= F.lit(top), inner).otherwise(F.lit(bins)).cast("int")
    counts = dist.groupBy(cls, b.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    sizes = counts.groupBy(cls).agg(F.sum("c").alias("size"))
    grid = sizes.select(cls, "size", F.explode(F.sequence(F.lit(1), F.lit(bins - 1))).alias("bin"))
    full = grid.join(counts, [cls, "bin"], "left").fillna(0, ["c"])
    run = Window.partitionBy(cls).orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    return full.select(cls, F.col("bin").cast("int").alias("bin"),
                       ((F.col("bin") - F.lit(0.5)) * F.lit(w)).alias("mid"),
                       (F.sum("c").over(run) / F.col("size")).alias("cum_prob"))
