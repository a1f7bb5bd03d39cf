"""Longest even-parity run per entity.

For each user, with events in time order, the longest contiguous run of events in which every event
type occurs an even number of times. With ``mask_i`` = XOR of ``1 << type`` over the first ``i``
events (``mask_0 = 0``), a run ``(i, j]`` qualifies iff ``mask_i == mask_j``; the answer is the
largest ``j - i`` over equal masks.

Plan, all parallel: running XOR and position per user with the bucketed prefix scan (a hot user is
spread over buckets), then ``groupBy(user, mask)`` with ``max(pos) - min(pos)`` (map-side combined),
then ``max`` per user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickwise.operators.rank import running_scan


def longest_even_run(df: DataFrame, group_col: str, type_bit: Column, order_cols: list[str], sort_key: Column,
                     out: str = "longest", n_buckets: int | None = None) -> DataFrame:
    df = df.where(F.col(group_col).isNotNull())  # rows without a key are in no group
    src = df.select(group_col, *order_cols, type_bit.cast("long").alias("_bit"))
    scan = running_scan(src, [(F.lit(1).cast("long"), "sum", "_pos"), ("_bit", "xor", "_mask")], order_cols,
                        sort_key, [group_col], n_buckets, few_groups=False)
    starts = df.select(group_col).distinct().select(group_col, F.lit(0).cast("long").alias("_pos"),
                                                    F.lit(0).cast("long").alias("_mask"))
    points = scan.select(group_col, "_pos", "_mask").unionByName(starts)
    spans = points.groupBy(group_col, "_mask").agg((F.max("_pos") - F.min("_pos")).alias("_span"))
    return spans.groupBy(group_col).agg(F.max("_span").alias(out))
