"""Exact global running sums and ranks without a single-task window.

A window with an ORDER BY but no PARTITION BY runs in one task. Instead:

1. approximate quantiles of a numeric, order-preserving ``sort_key`` give ``n_buckets`` boundaries
   (a driver-side list bounded by ``n_buckets``);
2. every row gets the bucket of its key (``Bucketizer``, a JVM-side binary search); buckets hold
   contiguous key ranges of about ``N / n_buckets`` rows each;
3. per-bucket totals form a table of ``n_buckets`` rows per group; their running sum is the
   offset of each bucket;
4. a window partitioned by ``(group, bucket)`` gives the running sum inside the bucket; the offset
   is joined on ``(group, bucket)`` (the data's existing partitioning; AQE broadcasts the offset
   table when its measured size is small) and added.

``order_cols`` must be a total order (unique) within a group, and ``sort_key`` must be monotone
non-decreasing in it. Rows with equal ``sort_key`` always fall in the same bucket, so ties in the key
never split across buckets.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


MAX_BUCKETS = 65536  # bounds the driver-side boundary list (512 KB) and the offset table per group


def default_buckets(spark) -> int:
    return min(MAX_BUCKETS, max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) * 4))


def bucketize(df: DataFrame, sort_key: Column, n_buckets: int, out: str) -> DataFrame:
    """Add ``out``: the number of the row's range of the sort key (nulls first and NaN last, as Spark sorts them)."""
    key = sort_key.cast("double")
    keyed = df.withColumn("_rk_key", F.coalesce(F.nanvl(key, F.lit(float("inf"))), F.lit(float("-inf"))))
    probs = [i / n_buckets for i in range(1, n_buckets)]
    bounds = keyed.approxQuantile("_rk_key", probs, 1.0 / (4 * n_buckets)) if probs else []
    splits = [float("-inf")] + sorted({b for b in bounds if b is not None and abs(b) != float("inf")}) + [float("inf")]
    if len(splits) < 3:  # a single bucket
        return keyed.withColumn(out, F.lit(0.0)).drop("_rk_key")
    return Bucketizer(splits=splits, inputCol="_rk_key", outputCol=out,
                      handleInvalid="keep").transform(keyed).drop("_rk_key")


_AGG = {"sum": F.sum, "xor": F.bit_xor}


def _combine(kind: str, a: Column, b: Column) -> Column:
    return a + b if kind == "sum" else a.bitwiseXOR(b)


def running_scan(df: DataFrame, specs: list[tuple[Column | str, str, str]], order_cols: list[str], sort_key: Column,
                 group_cols: list[str] | tuple = (), n_buckets: int | None = None, few_groups: bool = False) -> DataFrame:
    """Inclusive prefix scans in ``order_cols`` order (within ``group_cols``).

    ``specs`` is a list of ``(value, kind, out)`` with ``kind`` in ``{"sum", "xor"}`` (associative, with
    identity 0). All scans share one bucketing, one shuffle and one window.

    The offset table (one row per group and bucket) is joined on ``(group, bucket)``, the key the
    data is already partitioned on, so only the offset table moves; AQE turns this into a broadcast
    join when the offset table's measured size is under the broadcast threshold. ``few_groups=True``
    forces the broadcast (only for a known small number of groups).
    """
    group_cols = list(group_cols)
    n_buckets = n_buckets or default_buckets(df.sparkSession)
    vals = {f"_rk_v{i}": (F.col(v) if isinstance(v, str) else v) for i, (v, _, _) in enumerate(specs)}
    b = bucketize(df.withColumns(vals), sort_key, n_buckets, "_rk_b")
    totals = b.groupBy(*group_cols, "_rk_b").agg(
        *[_AGG[kind](f"_rk_v{i}").alias(f"_rk_t{i}") for i, (_, kind, _) in enumerate(specs)])
    ow = Window.partitionBy(*group_cols).orderBy("_rk_b").rowsBetween(Window.unboundedPreceding, -1)
    # bounded: one row per (group, bucket)
    offsets = totals.select(*group_cols, "_rk_b", *[
        F.coalesce(_AGG[kind](f"_rk_t{i}").over(ow), F.lit(0).cast("long")).alias(f"_rk_o{i}")
        for i, (_, kind, _) in enumerate(specs)])
    iw = (Window.partitionBy(*group_cols, "_rk_b").orderBy(*order_cols)
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inner = b.withColumns({f"_rk_in{i}": _AGG[kind](f"_rk_v{i}").over(iw) for i, (_, kind, _) in enumerate(specs)})
    res = inner.join(F.broadcast(offsets) if few_groups else offsets, [*group_cols, "_rk_b"], "left")
    res = res.withColumns({out: _combine(kind, F.col(f"_rk_o{i}"), F.col(f"_rk_in{i}"))
                           for i, (_, kind, out) in enumerate(specs)})
    outs = {out for _, _, out in specs}
    tmp = [c for c in res.columns if c.startswith("_rk_") and c not in outs]
    return res.drop(*tmp)


def running_sum(df: DataFrame, value: Column | str, order_cols: list[str], sort_key: Column,
                group_cols: list[str] | tuple = (), out: str = "cum", n_buckets: int | None = None,
                few_groups: bool = False) -> DataFrame:
    """Add ``out`` = inclusive running sum of ``value`` (see :func:`running_scan`)."""
    return running_scan(df, [(value, "sum", out)], order_cols, sort_key, group_cols, n_buckets, few_groups)


def global_rank(df: DataFrame, order_cols: list[str], sort_key: Column, group_cols: list[str] | tuple = (),
                out: str = "pos", n_buckets: int | None = None, few_groups: bool = False) -> DataFrame:
    """Add ``out`` = 0-based position in ``order_cols`` order (within ``group_cols``): an exact
    ``row_number() - 1`` computed in parallel."""
    r = running_sum(df, F.lit(1).cast("long"), order_cols, sort_key, group_cols, "_rk_cum", n_buckets,
                    few_groups)
    return r.withColumn(out, F.col("_rk_cum") - 1).drop("_rk_cum")


def hash_key(seed: int, id_col: str) -> Column:
    """Seeded pseudo-random order key: md5 of ``"<seed>|<id>"`` (hex string; same in DuckDB)."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.col(id_col).cast("string")))


def hex_prefix_number(hex_col: Column, digits: int = 13) -> Column:
    """Leading ``digits`` hex digits as a number; monotone in the hex string, exact in a double for
    ``digits <= 13``."""
    return F.conv(F.substring(hex_col, 1, digits), 16, 10).cast("long")
