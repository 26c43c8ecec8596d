"""Growth of operator time with input size (not a driver query).

Replicates the orders binding of ``sf_dir`` r times (ids stay unique, values
are perturbed deterministically so rows are not exact copies) and times the
core operators at each r.  Prints one JSON line per r.

    python tools/scale_probe.py /root/testdata/sf0.1 1 4 16
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    reps = [int(r) for r in sys.argv[2:]] or [1, 4, 16]
    from pyspark.sql import functions as F
    from lodestar.operators import kmeans as KM
    from lodestar.operators import prep, scoring
    from lodestar.operators import silhouette as SH
    from lodestar.session import get_spark
    from lodestar.sources import tables
    spark = get_spark("local[8]", app="lodestar-scale", shuffle_partitions=16,
                      extra={"spark.driver.memory": "8g"})
    base = tables.features_orders(spark, sf_dir)
    for r in reps:
        rep = F.explode(F.sequence(F.lit(0), F.lit(r - 1))).alias("rep")
        big = (base.select("id", "x", "label", rep)
               .select((F.col("id") * r + F.col("rep")).alias("id"),
                       F.transform("x", lambda v: v * (F.lit(1.0) + F.col("rep") * 1e-4)).alias("x"),
                       "label"))
        big = tables.remember_dims(big.repartition(8 * max(1, r // 2)).persist(), 5)
        n = big.count()
        t = {}
        t0 = time.perf_counter()
        s = prep.standardize(big)
        t["stats_pass"] = time.perf_counter() - t0
        t0 = time.perf_counter()
        prep.train_test_split(s, 0.8, 42).write.format("noop").mode("overwrite").save()
        t["exact_split"] = time.perf_counter() - t0
        c = KM.first_rows(s, 8)
        t0 = time.perf_counter()
        KM.lloyd(s, [c], max_iter=1)
        t["lloyd_2_passes"] = time.perf_counter() - t0
        a = KM.assign(s, c, passthrough=("id", "x", "label"))
        t0 = time.perf_counter()
        SH.silhouette_squared(a).write.format("noop").mode("overwrite").save()
        t["silhouette_squared"] = time.perf_counter() - t0
        t0 = time.perf_counter()
        scoring.cluster_predict_err(a, prep.levels(s)).collect()
        t["label_error"] = time.perf_counter() - t0
        print(json.dumps({"replication": r, "rows": n,
                          "sec": {k: round(v, 3) for k, v in t.items()}}), flush=True)
        big.unpersist()
    spark.stop()


if __name__ == "__main__":
    main()
