"""Session settings the operators rely on.

Every operator works on whatever ``SparkSession`` the caller hands in; this
module only offers a builder for tests/benchmarks and a few helpers that read
(never override) cluster settings.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings the results depend on (time zone for epoch <-> timestamp, ANSI casts)
# plus the adaptive-execution switches that handle skew and small partitions.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "itemscope", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own session instead."""
    master = master or os.environ.get("ITEMSCOPE_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("ITEMSCOPE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))
        # one BLAS thread per Python worker: Spark already runs one task per core
        .config("spark.executorEnv.OPENBLAS_NUM_THREADS", "1")
        .config("spark.executorEnv.OMP_NUM_THREADS", "1")
    )
    for key, value in {**REQUIRED_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def apply_required_conf(spark: SparkSession) -> SparkSession:
    """Set the result-relevant SQL settings on an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is only read; leaving
    it unset there is an error, because a folder of the driver's machine is
    not visible to the executors. A local session (tests) gets a fresh scratch
    folder instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        current = tempfile.mkdtemp(prefix="itemscope-ckpt-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def stored(df, name: str):
    """``df`` written as Parquet to a new place in the checkpoint folder and read back: cuts the lineage like a
    checkpoint, but later passes read only the columns they use, compressed. Order and partitioning are not kept."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in tasks are pickled by reference, so the workers must
    be able to import ``itemscope`` wherever the driver process was started."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="itemscope-pkg-"), "itemscope.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, dirs, names in os.walk(root):
            dirs[:] = sorted(d for d in dirs if d != "__pycache__")
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                z.write(path, os.path.join("itemscope", os.path.relpath(path, root)))
    sc.addPyFile(target)
    _SHIPPED.add(sc.applicationId)


def prepare(spark: SparkSession) -> SparkSession:
    """What every query needs before it runs: settings, checkpoint folder, package."""
    apply_required_conf(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark
