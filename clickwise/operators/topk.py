"""Sorting and top-k on tables.

* full sort with its rank – exact bucketed rank, so the position is a column and not an accident of
  output order;
* k smallest / k largest overall – ``orderBy(...).limit(k)``: each task keeps its own k best, the
  final merge sees ``k × tasks`` rows;
* k largest per group – two phases: the top k inside ``(group, salt)`` sub-groups, then the top k
  among those ``k × salts`` candidates per group, so a group holding a third of all rows is still
  spread over ``salts`` tasks in the first phase;
* ordered merge of several inputs – union, then the same exact rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwise.operators.rank import global_rank


def sort_with_rank(df: DataFrame, order_cols: list[str], sort_key: Column, out: str = "pos",
                   n_buckets: int | None = None) -> DataFrame:
    return global_rank(df, order_cols, sort_key, out=out, n_buckets=n_buckets)


def k_smallest(df: DataFrame, k: int, order_cols: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(c).asc() for c in order_cols]).limit(k)


def k_largest(df: DataFrame, k: int, order_cols: list[str]) -> DataFrame:
    return df.orderBy(*[F.col(c).desc() for c in order_cols]).limit(k)


def top_k_per_group(df: DataFrame, group_cols: list[str], k: int, order: list[Column], salt_col: str,
                    salts: int = 16, out: str = "rank") -> DataFrame:
    """Rows with the ``k`` first places per group under ``order`` (a total order), with their
    1-based place in ``out``. ``salt_col`` is any well-spread column (e.g. the row id)."""
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(F.col(salt_col)), F.lit(salts)))
    w1 = Window.partitionBy(*group_cols, "_salt").orderBy(*order)
    cand = salted.withColumn("_r1", F.row_number().over(w1)).where(F.col("_r1") <= k)
    w2 = Window.partitionBy(*group_cols).orderBy(*order)  # at most k × salts rows per group
    return (cand.withColumn(out, F.row_number().over(w2)).where(F.col(out) <= k)
            .drop("_salt", "_r1"))


def ordered_merge(inputs: list[DataFrame], order_cols: list[str], sort_key: Column, out: str = "pos",
                  n_buckets: int | None = None) -> DataFrame:
    u = inputs[0]
    for other in inputs[1:]:
        u = u.unionByName(other)
    return global_rank(u, order_cols, sort_key, out=out, n_buckets=n_buckets)
