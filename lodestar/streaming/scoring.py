"""Structured Streaming use of fitted models.

The reference is batch only (whole-file reads; no watermark, window or state
code).  What carries over to a stream is applying what a batch fit produced
— centres, a projection — to rows as they arrive.  The per-row operators are
stateless Arrow maps, so the very same functions run on a streaming
DataFrame; the running cluster sizes are Spark's own stateful aggregation.
Nothing here adds analytics the batch side lacks.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestar.operators import kmeans as KM
from lodestar.operators import linalg as LA


def embeddings_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Stream the ``embeddings`` parquet files of a folder as Features(id, x, label)."""
    schema = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"
    raw = (spark.readStream.schema(schema).option("pathGlobFilter", "embeddings*.parquet")
           .option("maxFilesPerTrigger", 1).parquet(folder))
    return raw.select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("x"),
                      "label")


def standardize_stream(stream: DataFrame, mean: np.ndarray, sd: np.ndarray, x: str = "x") -> DataFrame:
    """Apply batch-fitted standardisation constants (P9) to arriving rows."""
    from lodestar.functions.vectors import affine
    return stream.withColumn(x, affine(x, mean, sd))


def assign_stream(stream: DataFrame, centers: np.ndarray, x: str = "x",
                  passthrough=("id", "label")) -> DataFrame:
    """Nearest fitted centre for every arriving row."""
    return KM.assign(stream, centers, x, passthrough)


def project_stream(stream: DataFrame, m: np.ndarray, x: str = "x",
                   passthrough=("id", "label")) -> DataFrame:
    """Fitted projection (PCA / ICA / RCA matrix) applied to arriving rows."""
    return LA.project(stream, m, x, x, passthrough)


def running_cluster_sizes(assigned: DataFrame) -> DataFrame:
    """Stateful per-cluster counts and within-SS (A14, M4); output mode update/complete."""
    return assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("d2").alias("within_ss"))


def run_to_memory(sdf: DataFrame, name: str, checkpoint: str, mode: str = "complete"):
    """Start a query into the in-memory sink and drain what is available (tests, notebooks)."""
    q = (sdf.writeStream.outputMode(mode).format("memory").queryName(name)
         .option("checkpointLocation", checkpoint).start())
    q.processAllAvailable()
    return q


def write_batches(sdf: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Durable sink for scored rows (S7 on a stream): every micro-batch is written
    to ``path/batch=<id>`` with overwrite, so a batch replayed after a failure
    replaces its own files instead of duplicating rows.  ``checkpoint`` must be
    a shared folder on a cluster."""

    def sink(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    w = sdf.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w
    return w.start()
