"""Projection, union, split, grouped counts and simple shifts.

Grouped results drop null keys, as the reference's group-bys do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickwise.operators.rank import bucketize, default_buckets
from clickwise.operators.skew import DEFAULT_HOT_THRESHOLD, keyed_left_join

DEFAULT_EXCLUDE = ["label", "istest", "log_id"]
SPLIT_OFFSET = 1 << 40  # ordinal offset of the test part: train rows come first


def tag(df: DataFrame, istest: int, col: str = "istest") -> DataFrame:
    return df.withColumn(col, F.lit(istest).cast("int"))


def union_train_test(train: DataFrame, test: DataFrame, ordinal_col: str | None = None,
                     out_ordinal: str = "ro") -> DataFrame:
    """Tag and stack train and test rows; columns missing on one side (the test label) become null.

    With ``ordinal_col`` (each part's own row ordinal), ``out_ordinal`` orders all train rows before
    all test rows, as a reset index after concatenation does.
    """
    u = tag(train, 0).unionByName(tag(test, 1), allowMissingColumns=True)
    if ordinal_col:
        u = u.withColumn(out_ordinal, F.col("istest").cast("long") * SPLIT_OFFSET + F.col(ordinal_col))
    return u


def project_exclude(df: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    return df.drop(*(exclude if exclude is not None else DEFAULT_EXCLUDE))


def split(df: DataFrame, col: str = "istest") -> tuple[DataFrame, DataFrame]:
    """(train, test) by the tag. Written partitioned by the tag, this is a partition-pruned read."""
    return df.where(F.col(col) == 0), df.where(F.col(col) == 1)


def group_count(df: DataFrame, key: str, col: str, out: str = "n") -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(col).alias(out))


def group_nunique(df: DataFrame, key: str, col: str, out: str = "nunique") -> DataFrame:
    """Distinct count per key. Spark plans a single-column distinct count as dedup on (key, col)
    followed by a count, so a hot key is pre-aggregated on the map side."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count_distinct(col).alias(out))


def column_cardinality(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: distinct values counting null as one (``unique``) and without it (``nunique``),
    from one aggregation; exact."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.count_distinct(c).alias(f"n{i}"), F.max(F.col(c).isNull().cast("int")).alias(f"z{i}")]
    one = df.agg(*aggs)
    args = ", ".join(f"'{c}', n{i} + coalesce(z{i}, 0), n{i}" for i, c in enumerate(cols))
    return one.selectExpr(f"stack({len(cols)}, {args}) AS (col_name, n_unique, n_nunique)")


def global_shift(df: DataFrame, value: str, order_cols: list[str], sort_key: Column, k: int = 1,
                 out: str | None = None, n_buckets: int | None = None) -> DataFrame:
    """Value of the row ``k`` places earlier in the global order (``lag`` without a partition).

    An unpartitioned window runs in one task; instead rows go into buckets of the sort key, the lag is taken inside the bucket, and only the
    first and last ``k`` rows of each bucket (a table whose size is set by the number of buckets) meet in a window of their own, which gives the first
    ``k`` rows of a bucket the values they take over from those before.
    """
    out = out or f"{value}_lag{k}"
    b = bucketize(df, sort_key, n_buckets or default_buckets(df.sparkSession), "_gs_b")
    inside = Window.partitionBy("_gs_b").orderBy(*order_cols)
    b = b.withColumns({"_gs_in": F.lag(value, k).over(inside), "_gs_rn": F.row_number().over(inside),
                       "_gs_n": F.count(F.lit(1)).over(Window.partitionBy("_gs_b"))})
    edge = b.where(f"_gs_rn <= {k} OR _gs_rn > _gs_n - {k}").select("_gs_b", "_gs_rn", F.col(value).alias("_gs_v"))
    taken = edge.withColumn("_gs_over", F.lag("_gs_v", k).over(Window.orderBy("_gs_b", "_gs_rn"))).where(f"_gs_rn <= {k}").drop("_gs_v")
    # at most k rows a bucket
    met = b.join(F.broadcast(taken), ["_gs_b", "_gs_rn"], "left")
    return met.withColumn(out, F.when(F.col("_gs_rn") <= k, F.col("_gs_over")).otherwise(F.col("_gs_in"))).select(*df.columns, out)


def group_diff(df: DataFrame, keys: list[str], order_col: str, value: str, out: str | None = None,
               hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """``value - lag(value)`` within the group (pandas ``shift(0) - shift(1)``).

    This is the first backward gap of the gap-feature operator with ``value`` in place of the time,
    so groups above ``hot_threshold`` rows take its split path; the other gap columns are never
    referenced and are pruned from the plan.
    """
    from clickwise.operators.gaps import gap_features
    n = "_".join(keys)
    g = gap_features(df, [keys], order_col, value, gaps=(1,), hot_threshold=hot_threshold)
    return g.select(*df.columns, F.col(f"ts_{n}_1_diff_last").alias(out or f"{value}_diff"))


def group_size_broadcast(df: DataFrame, keys: list[str], value: str, out: str = "n",
                         hot_threshold: int | None = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Non-null count of ``value`` per group, on every row of the group (``transform('count')``).

    Computed as an aggregate joined back rather than a whole-group window: the aggregate is combined
    map-side, and the join sends hot groups through a bounded broadcast (:func:`keyed_left_join`).
    """
    ok = F.lit(True)
    for k in keys:
        ok = ok & F.col(k).isNotNull()
    counts = df.where(ok).groupBy(*keys).agg(F.count(value).alias(out))
    return keyed_left_join(df, counts, keys, hot_threshold)
