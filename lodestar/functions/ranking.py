"""Exact ranks without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no ``PARTITION BY`` moves every row
into one task; ``PARTITION BY g`` does the same for a hot group.  Here a
distributed range sort is written once to the checkpoint folder (so the layout
survives executor loss and is identical in both passes), per-partition row
counts give offsets, and each row's rank is ``offset[partition] + position``.
Only one integer per partition reaches the driver; offsets are joined back as a
local table.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestar.functions.arrowkit import local_frame
from lodestar.session import ensure_checkpoint_dir

_SHIFT = 33  # monotonically_increasing_id = partition << 33 | row-in-partition


def with_positional_index(df: DataFrame, name: str = "pos", start: int = 0) -> DataFrame:
    """Number rows by their current order (partition, then row), from ``start``."""
    ensure_checkpoint_dir(df.sparkSession)
    tagged = df.checkpoint(eager=True).withColumn("_mid", F.monotonically_increasing_id())
    tagged = tagged.withColumn("_pid", F.shiftright(F.col("_mid"), _SHIFT))
    counts = tagged.groupBy("_pid").count().orderBy("_pid").collect()
    n = np.array([r["count"] for r in counts], dtype=np.int64)
    offsets = local_frame(df.sparkSession, {"_pid": [r["_pid"] for r in counts], "_off": start + np.cumsum(n) - n}, "_pid BIGINT, _off BIGINT")
    local = F.col("_mid") - F.shiftleft(F.col("_pid"), _SHIFT)
    return tagged.join(offsets, "_pid").withColumn(name, F.col("_off") + local).drop("_mid", "_pid", "_off")


def with_line_numbers(scan: DataFrame, name: str = "id", start: int = 1) -> DataFrame:
    """Number the rows of a text-file scan in file order: by file path, then line.

    ``scan`` must be the scan itself.  A partition may hold splits of several files in
    any order, so positions are counted per (partition, file, split).
    """
    cols = scan.columns
    tagged = scan.select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_at"),
                         F.monotonically_increasing_id().alias("_mid"))
    tagged = tagged.withColumn("_pid", F.shiftright(F.col("_mid"), _SHIFT))
    splits = tagged.groupBy("_file", "_at", "_pid").agg(F.min("_mid").alias("_first"), F.count("*").alias("n")).collect()
    splits.sort(key=lambda r: (r["_file"], r["_at"]))
    n = np.array([r["n"] for r in splits], dtype=np.int64)
    table = {c: [r[c] for r in splits] for c in ("_file", "_at", "_pid", "_first")} | {"_off": start + np.cumsum(n) - n}
    offsets = local_frame(scan.sparkSession, table, "_file STRING, _at BIGINT, _pid BIGINT, _first BIGINT, _off BIGINT")
    return tagged.join(offsets, ["_file", "_at", "_pid"]).select((F.col("_off") + F.col("_mid") - F.col("_first")).alias(name), *cols)


def exact_rank(df: DataFrame, order: Sequence, name: str = "rank") -> DataFrame:
    """0-based global rank under ``order`` (which must be a total order)."""
    return with_positional_index(df.sort(*order), name=name, start=0)


def exact_group_rank(df: DataFrame, group: Sequence[str], order: Sequence,
                     name: str = "rank", size_name: str | None = "group_n") -> DataFrame:
    """0-based rank within each group (and the group's size), sort-based.

    Equivalent to ``row_number() OVER (PARTITION BY group ORDER BY order) - 1``
    but a hot group is spread over as many sort partitions as its size needs.
    """
    group = list(group)
    ranked = exact_rank(df, [F.col(g) for g in group] + list(order), name="_grank")
    firsts = ranked.groupBy(*group).agg(F.min("_grank").alias("_gstart"),
                                       F.count(F.lit(1)).alias("_gn"))
    out = ranked.join(firsts, group)
    out = out.withColumn(name, F.col("_grank") - F.col("_gstart"))
    if size_name:
        out = out.withColumn(size_name, F.col("_gn"))
    return out.drop("_grank", "_gstart", "_gn")


def ntile_expr(rank_col: str, n_col: str, buckets: int):
    """SQL ``ntile(b)`` bucket (1-based) from a 0-based rank and the group size.

    The first ``n mod b`` buckets hold ``n div b + 1`` rows, the rest ``n div b``.
    """
    r, n, b = F.col(rank_col), F.col(n_col), F.lit(buckets)
    q = F.floor(n / b)
    rem = n - q * b
    big = rem * (q + 1)
    return F.when(r < big, F.floor(r / (q + 1)) + 1).otherwise(
        F.floor((r - big) / F.greatest(q, F.lit(1))) + rem + 1).cast("int")
