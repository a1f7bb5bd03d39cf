"""Spark session helpers.

Library code never creates a session on its own; it takes the caller's. These helpers only
apply the settings the operators rely on (UTC session time zone, AQE) and resolve the shared
checkpoint folder from the session configuration.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings the operators assume. AQE coalesces the many small post-aggregation partitions and
# splits skewed sort-merge-join partitions at runtime.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Generated code for wide rows (hundreds of feature columns) produces methods above HotSpot's
# huge-method limit, which are then never JIT-compiled; let the JIT compile them.
JIT_OPTIONS = "-XX:-DontCompileHugeMethods"


def local_session(cores: int = 8, shuffle_partitions: int = 8, app: str = "clickwise") -> SparkSession:
    """A local session for tests and the bench (the UI stays off: no server is started)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.driver.extraJavaOptions", JIT_OPTIONS)
        .config("spark.executor.extraJavaOptions", JIT_OPTIONS)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for k, v in SESSION_DEFAULTS.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def size_for_input(spark: SparkSession, input_bytes: int, partition_bytes: int = 256 << 20,
                   min_partitions: int = 200) -> int:
    """Size shuffles for an input of ``input_bytes`` (e.g. 100 TB): about ``partition_bytes`` per
    shuffle partition before AQE coalescing, the same advisory size for AQE, and scan splits of the
    same size. Returns the partition count set. Wide feature rows grow several-fold after the gap
    features, so the count is taken on the input and AQE coalesces where stages are small.
    """
    n = max(min_partitions, -(-input_bytes // partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(partition_bytes))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(partition_bytes))
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", str(4 * partition_bytes))
    return n


def apply_defaults(spark: SparkSession) -> SparkSession:
    for k, v in SESSION_DEFAULTS.items():
        spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is read, never overridden. Only when
    it is unset (local tests) is a fresh scratch folder created and registered.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local[") and sc.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="clickwise-ckpt-", dir=os.environ.get("CLICKWISE_SCRATCH", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` into the shared checkpoint folder (reliable, survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once for an application, so that their Python workers find it."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parent
        folder = tempfile.mkdtemp(prefix="clickwise-boosting-")  # on the driver; Spark sends the file from there
        sc.addPyFile(shutil.make_archive(f"{folder}/clickwise_package", "zip", root.parent, root.name))
        _shipped.add(sc.applicationId)
