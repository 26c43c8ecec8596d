"""lodestar — unsupervised-learning analytics on Spark DataFrames.

Every operator takes and returns DataFrames keyed by a row id.  Per-row work
runs on Spark (built-in expressions where possible, Arrow-batched numpy in
``mapInArrow`` for GEMM-shaped steps); only small matrices (p x p, k x p,
G x p x p) ever reach the driver.
"""

from lodestar.session import get_spark, ensure_checkpoint_dir

__all__ = ["get_spark", "ensure_checkpoint_dir"]
