"""Hot-key detection.

A "hot" group is one with more than ``threshold`` rows. At most ``N / threshold`` groups can be hot,
so the table of hot keys has a proven size bound and may be broadcast or brought to the driver.
The count is a partial (map-side combined) aggregation, so even a key holding a third of all rows
costs one small record per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows one task may hold for a single group before the group is split.
DEFAULT_HOT_THRESHOLD = 2_000_000


def hot_keys(df: DataFrame, keys: list[str], threshold: int = DEFAULT_HOT_THRESHOLD,
             order_col: str | None = None) -> DataFrame:
    """Keys with more than ``threshold`` rows, with their row count (and ``order_col`` range)."""
    aggs = [F.count(F.lit(1)).alias("_n")]
    if order_col is not None:
        aggs += [F.min(order_col).alias("_omin"), F.max(order_col).alias("_omax")]
    return (df.where(_keys_not_null(keys)).groupBy(*keys).agg(*aggs)
            .where(F.col("_n") > threshold))


def collect_hot_keys(df: DataFrame, keys: list[str], threshold: int = DEFAULT_HOT_THRESHOLD,
                     order_col: str | None = None) -> list:
    """Hot keys as driver-side rows; bounded by ``N / threshold`` entries."""
    return hot_keys(df, keys, threshold, order_col).collect()


def _keys_not_null(keys: list[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def keyed_left_join(big: DataFrame, per_key: DataFrame, keys: list[str], threshold: int | None = DEFAULT_HOT_THRESHOLD,
                    hot_rows: list | None = None) -> DataFrame:
    """Left join of a table with at most one row per key onto a large table, safe for hot keys.

    Keys of ``big`` with more than ``threshold`` rows (at most ``N / threshold``; or the given
    ``hot_rows``) are joined separately with a broadcast of just their ``per_key`` rows, so no join
    task receives a hot key; all other keys use the planner's join (AQE may broadcast it when the
    measured size of ``per_key`` is small).
    """
    if threshold is None and hot_rows is None:
        return big.join(per_key, keys, "left")
    hot = hot_rows if hot_rows is not None else collect_hot_keys(big, keys, threshold)
    if not hot:
        return big.join(per_key, keys, "left")
    spark = big.sparkSession
    hot_ids = spark.createDataFrame([tuple(r[k] for k in keys) for r in hot], big.select(*keys).schema)
    cold = big.join(F.broadcast(hot_ids), keys, "left_anti").join(per_key, keys, "left")
    hot_side = per_key.join(F.broadcast(hot_ids), keys, "left_semi")  # bounded by the hot-key count
    hot_part = big.join(F.broadcast(hot_ids), keys, "left_semi").join(F.broadcast(hot_side), keys, "left")
    return cold.unionByName(hot_part)
