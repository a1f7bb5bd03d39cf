"""Helpers shared by the training-data operators: scratch tables, hashed ranks, row filters."""

from __future__ import annotations

import math
import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickwise.session import ensure_checkpoint_dir

SEED = 20240229
#: Rows and bytes in one Arrow batch: bound the memory of a Python worker (texts may be long).
ARROW_ROWS = 512
ARROW_BYTES = "4m"
#: A key list of at most so many rows is broadcast (about 40 bytes a row); longer ones are shuffled.
BROADCAST_KEYS = 2_000_000

_scratch: dict[str, list[str]] = {}
_shipped: set[str] = set()


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Settings for the operators that run Python on the executors: bounded batches, the package shipped."""
    _ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once for an application, so that their Python finds it."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[1]
        folder = tempfile.mkdtemp(prefix="clickwise-package-")  # on the driver; Spark sends the file from there
        sc.addPyFile(shutil.make_archive(f"{folder}/clickwise", "zip", root.parent, root.name))
        _shipped.add(sc.applicationId)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared checkpoint folder, remembered for :func:`release`."""
    path = f"{ensure_checkpoint_dir(spark)}/llm-{label}-{uuid.uuid4().hex}"
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def scratch_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared checkpoint folder and read it back: cuts the lineage with
    files that every executor can reach, so a lost executor costs no recomputation of what is before."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean)
    spark.conf.set(clean, "true")  # once the table is written, its shuffle files are of no use
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(clean, before)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the scratch tables written in this application (call it once their results are stored)."""
    paths = _scratch.pop(spark.sparkContext.applicationId, [])
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def bucket_bits(spark: SparkSession) -> int:
    """Bits of a hash bucket: about four buckets a shuffle partition."""
    return max(4, math.ceil(math.log2(4 * int(spark.conf.get("spark.sql.shuffle.partitions")))))


def hashed_rank(df: DataFrame, key: list[str], by: list[str], out: str, seed: int = SEED) -> DataFrame:
    """Add ``out``: the row's rank from 0 within ``by``, in the order of a seeded hash of ``key`` (ties by
    the key itself). The order does not depend on the partitioning. Hash buckets are even whatever the
    group sizes, so a group with a third of all rows is ranked by many tasks: rank = rows in the group's
    earlier buckets + rank in the bucket. ``by`` columns must not be null. ``df`` is read twice."""
    bits = bucket_bits(df.sparkSession)
    h = df.withColumn("_h", F.xxhash64(F.lit(seed), *key)).withColumn("_b", F.shiftrightunsigned("_h", 64 - bits))
    sizes = h.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*by, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    inside = Window.partitionBy(*by, "_b").orderBy("_h", *[F.col(k).asc_nulls_first() for k in key])
    local = h.withColumn("_r", F.row_number().over(inside))
    return (local.join(offsets, [*by, "_b"])
            .withColumn(out, (F.col("_o") + F.col("_r") - 1).cast("long")).drop("_h", "_b", "_o", "_r"))


def free_name(columns: list[str], name: str) -> str:
    """``name``, or with underscores before it one that none of the columns has (in any case)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def text_key(text: Column) -> Column:
    """64-bit key of a text; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def maybe_broadcast(df: DataFrame) -> DataFrame:
    """Broadcast a stored key list when its counted rows are within the bound; else leave it to a shuffle."""
    return F.broadcast(df) if df.count() <= BROADCAST_KEYS else df


def without_rows(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows listed in ``gone`` (stored table: _id, _key = text_key). All columns stay."""
    return docs.join(maybe_broadcast(gone), docs["doc_id"].eqNullSafe(gone["_id"])
                     & (text_key(docs["text"]) == gone["_key"]), "left_anti")


def gcd_all(values: list[int]) -> int:
    return math.gcd(*values) or 1
