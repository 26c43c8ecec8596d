"""Result sinks and sources (S7, S8, S9 re-aimed).

The reference saves named R objects to one file per experiment; here every
result table is one Parquet dataset under a run folder, and fitted
``pyspark.ml`` models use their own writers.  Writes are idempotent
(overwrite), so a re-run after a lost executor or a failed job replaces the
partial output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_result(df: DataFrame, run_dir: str, name: str, partition_by: list[str] | None = None) -> str:
    path = f"{run_dir.rstrip('/')}/{name}"
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_results(results: dict[str, DataFrame], run_dir: str) -> dict[str, str]:
    """``save(a, b, ..., file=)``: every named table to its own dataset."""
    return {name: write_result(df, run_dir, name) for name, df in results.items()}


def read_result(spark: SparkSession, run_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{run_dir.rstrip('/')}/{name}")


def write_model(model, run_dir: str, name: str) -> str:
    path = f"{run_dir.rstrip('/')}/{name}"
    model.write().overwrite().save(path)
    return path
