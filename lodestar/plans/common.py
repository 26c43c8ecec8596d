"""Shared building blocks for the driver queries (binding E unless noted)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import kmeans as KM
from lodestar.operators import prep
from lodestar.sources import tables

ROUND = 6
SEED = 42


def r6(c) -> "F.Column":
    """Round to 6 decimals; ``+ 0.0`` turns −0.0 into 0.0 (as in the oracles)."""
    return F.round(F.col(c) if isinstance(c, str) else c, ROUND) + F.lit(0.0)


def std_e(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardised embeddings: Features(id, x, label)."""
    return prep.standardize(tables.features_embeddings(spark, sf_dir))


def near(df: DataFrame, k: int) -> tuple[DataFrame, np.ndarray]:
    """Assignment to the first k rows (by id) used as centres: (id, label, cluster, d2)."""
    centers = KM.first_rows(df, k)
    return KM.assign(df, centers), centers


def e_levels(df: DataFrame) -> tuple[DataFrame, int]:
    lv = prep.levels(df)
    return lv, lv.count()
