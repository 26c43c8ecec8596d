"""Preparation operators: standardise, level dictionaries, one-hot, split (P*, A6, A19, M1)."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import vectors as V
from lodestar.functions.arrowkit import local_frame, map_rows
from lodestar.functions.ranking import exact_rank, with_positional_index
from lodestar.session import ensure_checkpoint_dir


@dataclass
class ColumnStats:
    n: int
    mean: np.ndarray
    sd: np.ndarray


def _long_stats(df: DataFrame, x: str) -> DataFrame:
    """(j, n, mean, sd) per dimension: ``posexplode`` feeds a map-side combined
    ``groupBy(j)`` (p partial rows per task); far cheaper to plan and compile
    than one aggregate expression per dimension."""
    return (df.select(F.posexplode(x).alias("j", "v")).groupBy("j")
            .agg(F.count("v").alias("n"), F.avg("v").alias("mean"),
                 F.stddev_samp("v").alias("sd")))


def column_stats(df: DataFrame, x: str = "x", p: int | None = None) -> ColumnStats:
    """Per-dimension mean and sample sd in one partially aggregated pass."""
    rows = _long_stats(df, x).collect()  # p rows
    p = max((r["j"] for r in rows), default=-1) + 1 if p is None else p
    mean, sd, n = np.full(p, np.nan), np.full(p, np.nan), 0
    for r in rows:
        mean[r["j"]] = r["mean"] if r["mean"] is not None else np.nan
        sd[r["j"]] = r["sd"] if r["sd"] is not None else np.nan
        n = max(n, int(r["n"]))
    return ColumnStats(n, mean, sd)


def stats_frame(df: DataFrame, x: str = "x") -> DataFrame:
    """(j, mean, sd) as a DataFrame, without a driver round trip."""
    return _long_stats(df, x).select(F.col("j").cast("int").alias("j"), "mean", "sd")


def standardize(df: DataFrame, x: str = "x", stats: ColumnStats | None = None,
                fit_on: DataFrame | None = None, out: str | None = None) -> DataFrame:
    """Mean 0, sample sd 1 per dimension (P9, R ``scale``).

    Statistics come from ``fit_on`` (default: the whole frame, as the
    reference does before its split).  A constant column maps to 0.0.
    """
    if stats is None:
        stats = column_stats(fit_on if fit_on is not None else df, x)
    mean = np.nan_to_num(stats.mean)
    ok = np.isfinite(stats.sd) & (stats.sd > 0)
    sd = np.where(ok, stats.sd, 1.0)
    out = out or x

    def fn(b):
        return {out: np.where(ok, (b[x] - mean) / sd, 0.0)}

    keep = [c for c in df.columns if c != out]
    schema = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep] + [f"`{out}` ARRAY<DOUBLE>"])
    return map_rows(df, [x], fn, schema, passthrough=keep)


def to_long(df: DataFrame, id_col: str = "id", x: str = "x", d: int | None = None) -> DataFrame:
    """Vector → long (id, j, v)."""
    src = V.head(x, d) if d else F.col(x)
    return df.select(id_col, F.posexplode(src).alias("j", "v")).withColumn(
        "j", F.col("j").cast("int"))


def levels(df: DataFrame, label: str = "label") -> DataFrame:
    """Level dictionary ``(label_ix, label)`` in sorted order (A19, R ``levels``).

    ``distinct`` is partially aggregated and one value per level reaches the driver.
    A null label is a level of its own, after the others, so that no row is lost.
    """
    vals = [r[label] for r in df.select(label).distinct().collect()]
    vals = sorted(v for v in vals if v is not None) + [None] * (None in vals)
    return local_frame(df.sparkSession, {"label_ix": list(range(len(vals))), label: vals},
                       f"label_ix INT, `{label}` {df.schema[label].dataType.simpleString()}")


def with_label_ix(df: DataFrame, lv: DataFrame, label: str = "label") -> DataFrame:
    """Adds the level index of every row's label, null included."""
    key = lv.select(F.col(label).alias("_level"), *[c for c in lv.columns if c != label])
    return df.join(key, F.col(label).eqNullSafe(F.col("_level"))).drop("_level")


def one_hot(df: DataFrame, n_levels: int, ix: str = "label_ix", out: str = "y") -> DataFrame:
    """label_ix → 0/1 vector of width ``n_levels`` (P10; keeps every level)."""
    return df.withColumn(out, F.array(*[F.when(F.col(ix) == i, 1).otherwise(0)
                                        for i in range(n_levels)]))


def one_hot_long(df: DataFrame, n_levels: int, id_col: str = "id", ix: str = "label_ix") -> DataFrame:
    """(id, label_ix, flag) for every level."""
    return df.select(id_col, F.col(ix).alias("_ix"),
                     F.explode(F.sequence(F.lit(0), F.lit(n_levels - 1))).alias("label_ix")
                     ).select(id_col, F.col("label_ix").cast("int"),
                              (F.col("label_ix") == F.col("_ix")).cast("int").alias("flag"))


def one_hot_decode(df: DataFrame, y: str = "y", out: str = "label_ix") -> DataFrame:
    """0/1 vector → 0-based index of the 1."""
    return df.withColumn(out, (F.array_position(y, 1) - 1).cast("int"))


def argmax_decode(df: DataFrame, v: str, out: str = "label_ix") -> DataFrame:
    """Vector → index of its maximum, first wins."""
    return df.withColumn(out, V.argmax_first(v))


def split_order_key(seed: int, id_col: str = "id"):
    """Seeded, layout-independent order: md5 of ``seed:id`` (identical in DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))


def train_test_split(df: DataFrame, f: float, seed: int, id_col: str = "id") -> DataFrame:
    """Exact ``floor(f*n)`` training rows without replacement (M1).

    Returns ``(id, is_train)``: the first ``floor(f*n)`` rows in the order
    md5(seed:id), then id.  No global sort: each pass counts rows per next 3 hex
    digits of the hash (map-side combined, at most 4,096 groups) inside the
    boundary bucket, until that bucket holds one hash value.  Rows that share it
    (a repeated id) are numbered where they lie, so the count stays exact.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keyed = df.select(id_col, split_order_key(seed, id_col).alias("_h")).checkpoint()
    prefix, need = "", None
    while True:
        head = F.substring("_h", 1, len(prefix) + 3)
        rows = keyed.where(F.col("_h").startswith(prefix)).groupBy(head.alias("b")).agg(
            F.count("*").alias("n"), F.min("_h").alias("lo"), F.max("_h").alias("hi")).orderBy("b").collect()
        if need is None:
            need = int(np.floor(f * sum(r["n"] for r in rows) + 1e-9))
        edge = None
        for r in rows:
            if r["n"] > need:
                edge = r
                break
            need -= r["n"]
        if edge is None or not need or edge["lo"] == edge["hi"]:
            break
        prefix = edge["b"]
    if edge is None:
        return keyed.select(id_col, F.lit(True).alias("is_train"))
    plain = keyed.where(F.col("_h") != edge["lo"]) if need else keyed
    out = plain.select(id_col, (F.col("_h") < edge["lo"]).alias("is_train"))
    if need:
        same = with_positional_index(keyed.where(F.col("_h") == edge["lo"]), "_r")
        out = out.union(same.select(id_col, (F.col("_r") < need).alias("is_train")))
    return out


def split_frames(df: DataFrame, split: DataFrame, id_col: str = "id") -> tuple[DataFrame, DataFrame]:
    """(train, test) by semi / anti join on the ids."""
    train_ids = split.filter("is_train").select(id_col)
    return (df.join(train_ids, id_col, "left_semi"), df.join(train_ids, id_col, "left_anti"))


def systematic_sample(df: DataFrame, every: int, id_col: str = "id") -> DataFrame:
    """Rows 1, 1+every, 1+2*every, ... in id order (P17), via an exact rank."""
    ranked = exact_rank(df, [F.col(id_col)], name="_r")
    return ranked.filter(F.col("_r") % every == 0).drop("_r")


def drop_vector_index(df: DataFrame, idx: int, x: str = "x", p: int | None = None) -> DataFrame:
    """Drop one coordinate by 0-based position (P4 on a vector column)."""
    if p is None:
        from lodestar.sources.tables import dims
        p = dims(df, x)
    keep = [i for i in range(p) if i != idx]
    return df.withColumn(x, V.select_idx(x, keep))


def report_table(long_df: DataFrame, row: str, col: str, value: str, col_values=None) -> DataFrame:
    """Named 2-D report table (P20): pivot long rows into one column per ``col``."""
    return long_df.groupBy(row).pivot(col, col_values).agg(F.first(value))
