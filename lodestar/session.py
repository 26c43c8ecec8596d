"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "lodestar",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the operators assume.

    On a cluster ``master`` is left to spark-submit; locally it defaults to
    ``local[*]``.  AQE stays on so shuffle partition counts coalesce at run
    time and skewed joins are split.
    """
    b = SparkSession.builder.appName(app)
    if master or not os.environ.get("SPARK_MASTER"):
        b = b.master(master or "local[*]")
    conf = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, creating one only for local runs.

    On a cluster the folder must be the shared one named by
    ``spark.checkpoint.dir``; a machine-local temporary folder would not
    survive the loss of an executor, so it is refused there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running "
                           "operators that cut lineage")
    path = tempfile.mkdtemp(prefix="lodestar-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``lodestar`` importable in Python workers, once per application.

    Arrow kernels run as closures that reference this package; workers unpickle
    them, so the package travels with the job (``addPyFile``, the runtime form
    of ``--py-files``) instead of relying on the driver's working directory.
    """
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    import zipfile
    import lodestar
    root = os.path.dirname(os.path.dirname(os.path.abspath(lodestar.__file__)))
    fd, path = tempfile.mkstemp(prefix="lodestar-pkg-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, files in os.walk(os.path.join(root, "lodestar")):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(dirpath, f)
                    z.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    _SHIPPED.add(key)
