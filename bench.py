"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line: {"metric", "value", "unit", "queries", "sf", ...}.
Each query is forced to completion with a no-op write (nothing is collected
to the driver beyond what the operator itself needs); the time is the
median of ``BENCH_REPS`` runs after one warm-up query.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "standardize_orders",          # binding O: lineitem agg ⋈ orders, stats, standardise
    "orders_split",                # exact seeded split by distributed rank
    "kmeans_orders_lloyd",         # multi-model Lloyd passes on the scalable binding
    "silhouette_squared_orders",   # linear-time silhouette from cluster moments
    "cluster_label_error",         # flagship: nearest centre → C1
    "pairwise_silhouette",         # exact Euclidean silhouette, blocked GEMM
    "covariance_matrix",           # one Gram pass
    "projection_error",            # Gram identity over a projection grid
    "symmetric_uncertainty",       # exact ntile + entropies
    "em_spherical",                # EM passes
    "distance_histogram",          # binning + windows
    "pca_explained",               # covariance + eigen
    "kmeans_clusters",             # k sweep: Lloyd, one distance pass, one scoring pass
    "cfs_selection",               # counting cut points, pair counts, best-first search
    "ica_sources",                 # FastICA passes
    "scala_sweep",                 # MLlib PCA x k-means grid
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    from lodestar.session import get_spark
    spark = get_spark(f"local[{cpus}]", app="lodestar-bench", shuffle_partitions=max(8, 2 * cpus),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "8g"),
                             "spark.eventLog.enabled": "false"})
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="lodestar-bench-ckpt-"))
    from lodestar.plans.catalog import QUERIES

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("standardize_stats")  # warm-up: JVM, Python workers, file listing
    names = only or HEADLINE
    times = {}
    for name in names:
        taken = []
        for _ in range(reps):
            spark.catalog.clearCache()
            taken.append(run(name))
        times[name] = round(statistics.median(taken), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": float(m.group(1)) if m else None, "cpus": cpus,
           "reps": reps, "spark": spark.version}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
