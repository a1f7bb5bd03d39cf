"""Exact, seeded sampling and fold assignment.

Randomness is a pure function of ``(seed, row id)``: the md5 of ``"<seed>|<id>"``. Results never
depend on partitioning, task order or retries, which also makes them reproducible in SQL.

* exact-size class samples (``sampleBy`` only gives expected sizes) – rank by hash within class;
* K folds with the library size law (first ``n % k`` folds one row larger) – rank by hash, then
  the ``ntile`` arithmetic; or, without any rank, ``hash % k`` (sizes only approximately equal);
* stratified K folds – the same within each class.

Ranks use :func:`clickwise.operators.rank.global_rank` (bucketed, never a single-task window).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwise.operators.rank import global_rank, hash_key, hex_prefix_number

SEED = 2022


def _with_hash(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    return df.withColumn("_h", hash_key(seed, id_col))


def sample_per_class(df: DataFrame, label_col: str, sizes: dict, id_col: str = "log_id", seed: int = SEED,
                     n_buckets: int | None = None) -> DataFrame:
    """Exactly ``sizes[c]`` rows of each class ``c`` (all of them if the class is smaller), without
    replacement, chosen by the seeded hash order. Classes not in ``sizes`` are dropped."""
    src = _with_hash(df.where(F.col(label_col).isin(list(sizes))), id_col, seed)
    ranked = global_rank(src, ["_h", id_col], hex_prefix_number(F.col("_h")), group_cols=[label_col],
                         out="_pos", n_buckets=n_buckets)
    limit = F.create_map(*[F.lit(x) for kv in sizes.items() for x in kv])[F.col(label_col)]
    return ranked.where(F.col("_pos") < limit).drop("_h", "_pos")


def ntile_index(pos: Column, n: Column, k: int) -> Column:
    """0-based ``ntile(k)`` bucket of 0-based position ``pos`` among ``n`` rows: the first ``n % k``
    buckets hold ``n // k + 1`` rows, the rest ``n // k`` (the K-fold size law)."""
    q = F.floor(n / k)
    r = n - q * k
    big = r * (q + 1)
    return F.when(pos < big, F.floor(pos / (q + 1))).otherwise(r + F.floor((pos - big) / q)).cast("int")


def kfold_exact(df: DataFrame, k: int = 5, id_col: str = "log_id", seed: int = SEED, out: str = "fold",
                stratify_col: str | None = None, n_buckets: int | None = None) -> DataFrame:
    """Assign ``out`` in ``0..k-1``: shuffled K-fold with exact fold sizes (optionally per class)."""
    groups = ["_class"] if stratify_col else []
    src = _with_hash(df, id_col, seed)
    if stratify_col:  # a null class is a class of its own
        c = F.col(stratify_col)
        src = src.withColumn("_class", F.when(c.isNull(), "null").otherwise(F.concat(F.lit("="), c.cast("string"))))
    ranked = global_rank(src, ["_h", id_col], hex_prefix_number(F.col("_h")), group_cols=groups, out="_pos",
                         n_buckets=n_buckets)
    if groups:
        sizes = src.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))  # one row per class
        ranked = ranked.join(F.broadcast(sizes), groups, "left")
        n = F.col("_n")
    else:
        n = F.lit(src.count())
    return ranked.withColumn(out, ntile_index(F.col("_pos"), n, k)).drop("_h", "_pos", "_n", "_class")


def kfold_hash(df: DataFrame, k: int = 5, id_col: str = "log_id", seed: int = SEED, out: str = "fold") -> DataFrame:
    """Rank-free fold: first 8 hex digits of the seeded md5, modulo ``k``. One narrow projection."""
    h = hash_key(seed, id_col)
    return df.withColumn(out, F.pmod(F.conv(F.substring(h, 1, 8), 16, 10).cast("long"), F.lit(k)).cast("int"))


def fold_split(df: DataFrame, i: int, fold_col: str = "fold") -> tuple[DataFrame, DataFrame]:
    """(train rows, validation rows) of fold ``i`` (D3)."""
    return df.where(F.col(fold_col) != i), df.where(F.col(fold_col) == i)


def fold_split_counts(df: DataFrame, k: int = 5, fold_col: str = "fold") -> DataFrame:
    """Rows per fold as (fold, n_valid, n_train) in one aggregation."""
    per = df.groupBy(fold_col).agg(F.count(F.lit(1)).alias("n_valid"))
    total = F.sum("n_valid").over(Window.partitionBy())  # k rows
    return per.select(F.col(fold_col), F.col("n_valid"), (total - F.col("n_valid")).alias("n_train"))
