"""Caching for the span of a block."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame


@contextmanager
def cached(df: DataFrame):
    """``df`` cached while the block runs and released after it; left alone when its
    plan is cached already."""
    level = df.storageLevel
    if level.useMemory or level.useDisk:
        yield df
        return
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()
