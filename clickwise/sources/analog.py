"""Roles of the two click-prediction domains on the shared test tables.

The real inputs are an impression log ("ads", target domain, labelled) and a news-feed behaviour log
("feeds", source domain). The test tables carry neither, so every query maps them onto the test
tables in the same way, defined once here:

* ads   := ``events``               (one row per impression, key ``log_id``)
* feeds := ``orders ⋈ lineitem``    (one row per feed exposure, user key ``u_userId``)

``ADS_SQL`` / ``FEEDS_SQL`` are the same definitions for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickwise.functions.timeparts import pack_time

# Fixed values of the test mapping (our own choice, not taken from elsewhere).
# Row ordinal: the low 16 bits of event_id, permuted by an odd multiplier, go above the remaining bits. It is
# injective for ids from 0 to 2^61 - 1, and file order is not time order (as in the real logs); test rows come
# after train rows.
ORDINAL_MULTIPLIER = 40503
ORDINAL_LOW = 1 << 16
ORDINAL_HIGH = 1 << 45
ORDINAL_SPLIT_OFFSET = 1 << 61
TEST_EVERY = 5  # event_id % 5 == 4 -> test split

# The 11 key sets of the time-gap features, in the reference's order (which is also the
# output column order; execution groups them by leading key regardless).
GAP_KEY_SETS = [
    ["user_id"], ["task_id"], ["adv_id"],
    ["user_id", "adv_id"], ["user_id", "task_id"], ["user_id", "creat_type_cd"],
    ["user_id", "adv_prim_id"], ["user_id", "inter_type_cd"], ["user_id", "slot_id"],
    ["user_id", "site_id"], ["user_id", "spread_app_id"],
]

# Columns encoded by first appearance: the seven ^-joined list columns of the real log. Their values here come from the
# ids and the props of an event, never from its type, which is the label.
LIST_COLUMNS = ["ad_click_list_v001", "ad_click_list_v002", "ad_click_list_v003", "ad_close_list_v001", "ad_close_list_v002",
                "ad_close_list_v003", "u_newsCatInterestsST"]

# Raw profile columns used by the logistic baseline.
PROFILE_COLUMNS = ["adv_id", "task_id", "creat_type_cd", "adv_prim_id", "inter_type_cd", "slot_id",
                   "site_id", "spread_app_id", "app_score"]


def _k(props: Column) -> Column:
    return F.get_json_object(props, "$.k").cast("int")


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Impression log with train and test rows already tagged (``istest``) and ordered (``ro``)."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    k = _k(F.col("props"))
    istest = (F.col("event_id") % TEST_EVERY == TEST_EVERY - 1).cast("int")
    ro = F.expr(f"CASE WHEN event_id % {TEST_EVERY} = {TEST_EVERY - 1} THEN {ORDINAL_SPLIT_OFFSET}L ELSE 0L END"
                f" + event_id % {ORDINAL_LOW} * {ORDINAL_MULTIPLIER} % {ORDINAL_LOW} * {ORDINAL_HIGH}L + event_id div {ORDINAL_LOW}")

    def text(*cols: Column) -> list[Column]:
        return [c.cast("string") for c in cols]
    return ev.select(
        F.col("event_id").alias("log_id"),
        F.when(istest == 0, (F.col("event_type") == "click").cast("int")).alias("label"),
        F.col("user_id"),
        k.alias("adv_id"),
        F.floor(k / 5).cast("int").alias("task_id"),
        F.floor(k / 10).cast("int").alias("adv_prim_id"),
        (k % 4).alias("creat_type_cd"),
        (F.col("event_id") % 3).cast("int").alias("inter_type_cd"),
        (F.col("event_id") % 7).cast("int").alias("slot_id"),
        (F.col("event_id") % 2).cast("int").alias("site_id"),
        ((k * 7) % 13).alias("spread_app_id"),
        F.col("value").alias("app_score"),
        F.col("props").alias("ad_click_list_v001"),
        F.concat_ws("^", *text(k % 17, k % 5)).alias("ad_click_list_v002"),
        F.when(k % 6 != 0, *text(F.col("event_id") % 11)).alias("ad_click_list_v003"),
        F.concat_ws("^", *text(F.col("event_id") % 13, k % 3)).alias("ad_close_list_v001"),
        F.when(F.col("event_id") % 9 != 0, *text(k % 23)).alias("ad_close_list_v002"),
        F.concat_ws("^", *text(F.col("user_id") % 19, k % 2)).alias("ad_close_list_v003"),
        F.when(k % 8 != 0, F.concat_ws("^", *text(k % 12, F.col("user_id") % 4, F.col("event_id") % 2))).alias("u_newsCatInterestsST"),
        pack_time(F.col("ts")).alias("pt_d"),
        istest.alias("istest"),
        ro.alias("ro"),
    )


def feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feed behaviour log keyed by ``u_userId``."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(
        F.col("o_custkey").alias("u_userId"),
        F.col("l_partkey"),
        F.col("l_suppkey"),
        F.col("l_linenumber"),
        F.col("l_quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("l_extendedprice"),  # in cents
        F.col("l_discount"),
        F.col("l_tax"),
        F.col("l_returnflag"),
        F.col("l_linestatus"),
        pack_time(F.col("l_shipdate")).alias("l_shipdate"),
        F.col("o_orderstatus"),
        F.round(F.col("o_totalprice") * 100).cast("long").alias("o_totalprice"),
        F.col("o_orderpriority"),
        pack_time(F.col("o_orderdate")).alias("e_et"),
        (F.col("l_returnflag") == "R").cast("int").alias("label"),
        (F.col("l_orderkey") % TEST_EVERY == TEST_EVERY - 1).cast("int").alias("istest"),
    )


ADS_SQL = f"""
SELECT event_id AS log_id,
       CASE WHEN event_id % {TEST_EVERY} <> {TEST_EVERY - 1} THEN CAST(event_type = 'click' AS INTEGER) END AS label,
       user_id,
       k AS adv_id,
       CAST(floor(k / 5) AS INTEGER) AS task_id,
       CAST(floor(k / 10) AS INTEGER) AS adv_prim_id,
       k % 4 AS creat_type_cd,
       CAST(event_id % 3 AS INTEGER) AS inter_type_cd,
       CAST(event_id % 7 AS INTEGER) AS slot_id,
       CAST(event_id % 2 AS INTEGER) AS site_id,
       (k * 7) % 13 AS spread_app_id,
       value AS app_score,
       props AS ad_click_list_v001,
       concat_ws('^', k % 17, k % 5) AS ad_click_list_v002,
       CASE WHEN k % 6 <> 0 THEN CAST(event_id % 11 AS VARCHAR) END AS ad_click_list_v003,
       concat_ws('^', event_id % 13, k % 3) AS ad_close_list_v001,
       CASE WHEN event_id % 9 <> 0 THEN CAST(k % 23 AS VARCHAR) END AS ad_close_list_v002,
       concat_ws('^', user_id % 19, k % 2) AS ad_close_list_v003,
       CASE WHEN k % 8 <> 0 THEN concat_ws('^', k % 12, user_id % 4, event_id % 2) END AS u_newsCatInterestsST,
       CAST(strftime(ts, '%Y%m%d%H%M') AS BIGINT) AS pt_d,
       CAST(event_id % {TEST_EVERY} = {TEST_EVERY - 1} AS INTEGER) AS istest,
       CAST(event_id % {TEST_EVERY} = {TEST_EVERY - 1} AS BIGINT) * {ORDINAL_SPLIT_OFFSET}
         + event_id % {ORDINAL_LOW} * {ORDINAL_MULTIPLIER} % {ORDINAL_LOW} * {ORDINAL_HIGH} + event_id // {ORDINAL_LOW} AS ro
FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
"""

FEEDS_SQL = f"""
SELECT o.o_custkey AS u_userId, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity,
       CAST(round(l.l_extendedprice * 100) AS BIGINT) AS l_extendedprice, l.l_discount, l.l_tax,
       l.l_returnflag, l.l_linestatus, CAST(strftime(l.l_shipdate, '%Y%m%d%H%M') AS BIGINT) AS l_shipdate,
       o.o_orderstatus, CAST(round(o.o_totalprice * 100) AS BIGINT) AS o_totalprice, o.o_orderpriority,
       CAST(strftime(o.o_orderdate, '%Y%m%d%H%M') AS BIGINT) AS e_et,
       CAST(l.l_returnflag = 'R' AS INTEGER) AS label,
       CAST(l.l_orderkey % {TEST_EVERY} = {TEST_EVERY - 1} AS INTEGER) AS istest
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
"""


def with_views(sql: str) -> str:
    """Prefix an oracle query with the two role views as CTEs."""
    head = f"WITH ads AS ({ADS_SQL}), feeds AS ({FEEDS_SQL})"
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"{head},\n{body[5:]}"
    return f"{head}\n{body}"
