"""Cross-domain user features: per-user distinct counts and means of the feed log, joined onto the
impression log (A1, A2, J1).

The reference runs one group-by and one merge per feature column (46 scans and 46 joins). Here all
columns of a kind are computed in one aggregation and everything meets the impressions in **one**
left join.

Distinct counts have two exact plans:

* ``"set"``   – ``size(collect_set(c))`` per user: one shuffle of pre-aggregated sets. Its state is
  bounded by the distinct values of *one* user, so it is only safe when no user is huge.
* ``"dedup"`` – drop duplicates of ``(user, column, value)`` and count per user. Users with more than ``SET_MAX_ROWS`` rows are unpivoted
  (shuffle keyed on the value, so a hot user is spread over all tasks; counted per user with map-side combine): no such group is held in one
  task. The rows of all other users are moved once as they are, by user, and their values counted in the task that gets them: an
  entry a column would move each user id as often as there are columns.

``"auto"`` (default) asks whether any user has more than ``SET_MAX_ROWS`` feed rows (one partial
aggregation, one row brought back) and takes ``"set"`` when none does, ``"dedup"`` otherwise. Where counts and means are asked for and no user has more,
the rows are moved once, packed by columns, and both are made in the task that gets them.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from clickwise.operators.gap_rows import addresses, distinct_counts, means, packing, unpacked
from clickwise.operators.skew import DEFAULT_HOT_THRESHOLD, keyed_left_join
from clickwise.session import ship_package

NUNI_SUFFIX = "_feeds_nuni"
SET_MAX_ROWS = 100_000  # largest per-user row count for which a per-user value set is kept in memory
LEAST_ROWS = 50_000  # feed rows a task gets, about, where the session has as many partitions (else more)
ROWS_PER_TASK = 500_000  # feed rows whose values one task counts, unless the shuffle partitions make them fewer
MEAN_SUFFIX = "_feeds_mean"

# Columns the reference leaves out of each feature kind (by name, in the real feed log).
NUNIQUE_EXCLUDE = ["label", "istest", "u_userId"]
MEAN_EXCLUDE = ["istest", "u_userId", "u_newsCatInterests", "u_newsCatDislike", "u_newsCatInterestsST",
                "u_click_ca2_news", "i_docId", "i_s_sourceId", "i_entities"]


def default_nunique_columns(feeds: DataFrame, key: str = "u_userId") -> list[str]:
    excl = set(NUNIQUE_EXCLUDE) | {key}
    return [c for c in feeds.columns if c not in excl]


def default_mean_columns(feeds: DataFrame, key: str = "u_userId") -> list[str]:
    """Columns the reference averages: everything not excluded that is numeric."""
    excl = set(MEAN_EXCLUDE) | {key}
    return [f.name for f in feeds.schema.fields
            if f.name not in excl and isinstance(f.dataType, T.NumericType)]


def _as_text(df: DataFrame, c: str):
    dt = df.schema[c].dataType
    col = F.col(c)
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        col = col + F.lit(0.0)  # -0.0 and 0.0 are one value, as in a hash set
    return col.cast("string")


def _set_value(df: DataFrame, c: str):
    """As text for floating columns, where a set would hold every NaN; both methods count NaN as one value."""
    return _as_text(df, c) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c)


def user_nunique(feeds: DataFrame, cols: list[str] | None = None, key: str = "u_userId",
                 method: str = "auto", hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """One row per user: ``<col>_feeds_nuni`` = number of distinct non-null values (A1)."""
    cols = cols if cols is not None else default_nunique_columns(feeds, key)
    src = feeds.where(F.col(key).isNotNull())
    if method in ("auto", "dedup"):
        # sets are held per user: take them only when no user has more than SET_MAX_ROWS rows
        limit, per_user, rows, big = _sizes(src, key, hot_threshold)
        method = "dedup" if big or method == "dedup" else "set"
    if method == "set":
        return src.groupBy(key).agg(
            *[F.size(F.collect_set(_set_value(src, c))).cast("long").alias(c + NUNI_SUFFIX) for c in cols])
    if method != "dedup":
        raise ValueError(f"unknown method {method!r}")
    if not big:
        return _counted_by_user(src, cols, key, rows or 0)
    # at most N / limit users
    hot = src.sparkSession.createDataFrame(per_user.where(F.col("_n") > limit).select(key).collect(), src.select(key).schema)
    cold = src.join(F.broadcast(hot), key, "left_anti")
    return _counted_by_user(cold, cols, key, rows).unionByName(_counted_by_value(src.join(F.broadcast(hot), key, "left_semi"), cols, key))


def _sizes(src: DataFrame, key: str, hot_threshold: int | None) -> tuple[int, DataFrame, int, bool]:
    """The largest number of rows of a user that a task holds, the rows of each user, of all users, and whether a user has more."""
    limit = SET_MAX_ROWS if hot_threshold is None else min(hot_threshold, SET_MAX_ROWS)
    per_user = src.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    rows, most = per_user.agg(F.sum("_n"), F.max("_n")).first()
    return limit, per_user, rows or 0, (most or 0) > limit


def _featured_by_user(src: DataFrame, nunique_cols: list[str], mean_cols: list[str], key: str, rows: int) -> DataFrame:
    """Distinct counts and means of every user, whose rows are moved once, packed."""
    cols = list(dict.fromkeys([*nunique_cols, *mean_cols]))
    session_tasks = int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(rows // ROWS_PER_TASK + 1, min(session_tasks, rows // LEAST_ROWS + 2))
    at = {c: f"c{i}" for i, c in enumerate(cols)}
    nested = (T.ArrayType, T.StructType, T.MapType)
    is_float = isinstance(src.schema[key].dataType, (T.FloatType, T.DoubleType))
    narrow = src.select(F.col(key).alias("key"), *[(_as_text(src, c) if isinstance(src.schema[c].dataType, nested) else F.col(c)).alias(n) for c, n in at.items()])
    schema = pa.schema([(f.name, f.type) for f in to_arrow_schema(narrow.schema)])
    counted, averaged = [at[c] for c in nunique_cols], [at[c] for c in mean_cols]
    nunique_names, mean_names = [c + NUNI_SUFFIX for c in nunique_cols], [c + MEAN_SUFFIX for c in mean_cols]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [unpacked(r, schema) for b in batches for r in b.column(1)]
        if held:
            table = pa.Table.from_batches(held)
            users, counts = distinct_counts(table.select(["key", *counted]))
            _, averages = means(table.select(["key", *averaged]))
            yield pa.RecordBatch.from_arrays([users, *map(pa.array, counts), *averages], names=[key, *nunique_names, *mean_names])
    ship_package(src.sparkSession)
    spread = F.pmod(F.xxhash64(F.col("key") + F.lit(0.0) if is_float else F.col("key")), F.lit(tasks)).cast("int")
    return (narrow.withColumn("_to", spread).mapInArrow(packing("_to", addresses(tasks), schema), "to int, rows binary").repartition(tasks, "to")
            .mapInArrow(features, T.StructType([src.schema[key], *[T.StructField(c, T.LongType(), False) for c in nunique_names],
                                                *[T.StructField(c, T.DoubleType()) for c in mean_names]])))


def _counted_by_user(src: DataFrame, cols: list[str], key: str, rows: int) -> DataFrame:
    """Rows moved once, by user; the distinct values of every user counted in its task."""
    nested = (T.ArrayType, T.StructType, T.MapType)
    values = [(_as_text(src, c) if isinstance(src.schema[c].dataType, nested) else F.col(c)).alias(f"c{i}") for i, c in enumerate(cols)]
    names = [c + NUNI_SUFFIX for c in cols]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            users, counts = distinct_counts(pa.Table.from_batches(held))
            yield pa.RecordBatch.from_arrays([users, *map(pa.array, counts)], names=[key, *names])
    ship_package(src.sparkSession)
    narrow = src.select(F.col(key), *values)
    tasks = rows // ROWS_PER_TASK + 1
    wide = tasks > int(src.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (narrow.repartition(tasks, key) if wide else narrow.repartition(key)).mapInArrow(
        count, T.StructType([src.schema[key], *[T.StructField(c, T.LongType(), False) for c in names]]))


def _counted_by_value(src: DataFrame, cols: list[str], key: str) -> DataFrame:
    """(user, column, value) entries spread by value."""
    # (cid=-1, '') marks every user once, so a user whose values are all null still gets zeros.
    entries = [F.struct(F.lit(-1).alias("cid"), F.lit("").alias("v"))]
    entries += [F.struct(F.lit(i).alias("cid"), _as_text(src, c).alias("v")) for i, c in enumerate(cols)]
    pairs = (src.select(F.col(key), F.explode(F.array(*entries)).alias("e"))
             .select(key, "e.cid", "e.v").where(F.col("v").isNotNull())
             .dropDuplicates([key, "cid", "v"]))
    return pairs.groupBy(key).agg(
        *[F.count(F.when(F.col("cid") == i, 1)).alias(c + NUNI_SUFFIX) for i, c in enumerate(cols)])


def user_mean(feeds: DataFrame, cols: list[str] | None = None, key: str = "u_userId") -> DataFrame:
    """One row per user: ``<col>_feeds_mean`` = mean of non-null values (A2)."""
    cols = cols if cols is not None else default_mean_columns(feeds, key)
    return (feeds.where(F.col(key).isNotNull()).groupBy(key)
            .agg(*[F.avg(c).alias(c + MEAN_SUFFIX) for c in cols]))


def user_features(feeds: DataFrame, nunique_cols: list[str] | None = None, mean_cols: list[str] | None = None,
                  key: str = "u_userId", out_key: str = "user_id", method: str = "auto",
                  hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Both feature kinds, one row per feed user, key renamed to ``out_key``.

    Users of up to ``SET_MAX_ROWS`` rows: the rows are moved once for both kinds. Else, or with a method given, the two aggregates come out
    hash-partitioned on the user key, so joining them adds no shuffle.
    """
    nunique_cols = nunique_cols if nunique_cols is not None else default_nunique_columns(feeds, key)
    mean_cols = mean_cols if mean_cols is not None else default_mean_columns(feeds, key)
    if method == "auto":
        src = feeds.where(F.col(key).isNotNull())
        rows, big = _sizes(src, key, hot_threshold)[2:]
        plain = (T.IntegralType, T.FloatType, T.DoubleType)
        if not big and all(isinstance(feeds.schema[c].dataType, plain) for c in mean_cols):
            return _featured_by_user(src, nunique_cols, mean_cols, key, rows).withColumnRenamed(key, out_key)
        method = "dedup" if big else "set"
    nuni = user_nunique(feeds, nunique_cols, key, method, hot_threshold)
    mean = user_mean(feeds, mean_cols, key)
    return nuni.join(mean, key, "inner").withColumnRenamed(key, out_key)


def join_user_features(ads: DataFrame, features: DataFrame, key: str = "user_id",
                       hot_threshold: int | None = None, hot_users: list | None = None) -> DataFrame:
    """Left join of the per-user features onto the impressions.

    The feature side has one row per user. For ordinary users the strategy is left to the planner:
    AQE turns the sort-merge join into a broadcast join only when the *measured* size of the
    aggregated side is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``.

    With ``hot_threshold``, users with more impressions than that (at most ``N / hot_threshold`` of
    them, collected as a bounded list) are joined separately: their feature rows, bounded by the
    number of hot users, are broadcast, so a user holding a third of all impressions never lands in
    one join task. ``hot_users`` (rows with the key) skips the lookup when already known.
    """
    return keyed_left_join(ads, features, [key], hot_threshold, hot_users)


def crossdomain_features(ads: DataFrame, feeds: DataFrame, nunique_cols: list[str] | None = None,
                         mean_cols: list[str] | None = None, feeds_key: str = "u_userId",
                         ads_key: str = "user_id", method: str = "auto",
                         hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    feats = user_features(feeds, nunique_cols, mean_cols, feeds_key, ads_key, method, hot_threshold)
    return join_user_features(ads, feats, ads_key, hot_threshold)
