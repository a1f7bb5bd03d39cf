"""The query catalogue: one registered query per operator of the inventory.

Each query is a thin composition of library operators over the test-table roles; the SQL next to it
is an independent formulation for DuckDB.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from clickwise.operators import crossdomain as xd
from clickwise.queries import register, round_doubles
from clickwise.sources import analog

# All columns of the feed role that the reference's rules leave in (all but the key, the label and the split; for means the numeric ones).
NUNI_COLS = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
             "l_shipdate", "o_orderstatus", "o_totalprice", "o_orderpriority", "e_et"]
MEAN_COLS = ["l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate", "o_totalprice", "e_et",
             "label"]


def _nuni_sql(prefix: str = "") -> str:
    return ", ".join(f"count(DISTINCT {prefix}{c}) AS {c}_feeds_nuni" for c in NUNI_COLS)


# Means of integer columns are one exact division in both engines and are compared unrounded (DuckDB's
# round() is not exact at 1e11 magnitudes); means of double columns are rounded to 6 places on both sides.
MEAN_INT_COLS = ["l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate", "o_totalprice", "e_et", "label"]
EXACT_MEANS = [c + "_feeds_mean" for c in MEAN_INT_COLS]


def _mean_sql(prefix: str = "") -> str:
    def one(c):
        m = f"sum({prefix}{c})::DOUBLE / count({prefix}{c})"
        return f"{m if c in MEAN_INT_COLS else f'round({m}, 6)'} AS {c}_feeds_mean"
    return ", ".join(one(c) for c in MEAN_COLS)


# ---------------------------------------------------------------- sources


@register("scan_ads", "SELECT * FROM ads")
def q_scan_ads(spark, sf):
    return round_doubles(analog.ads(spark, sf))


# ---------------------------------------------------------------- cross-domain features


@register("crossdomain_nunique", f"""
SELECT u_userId, {_nuni_sql()} FROM feeds WHERE u_userId IS NOT NULL GROUP BY u_userId""")
def q_crossdomain_nunique(spark, sf):
    return xd.user_nunique(analog.feeds(spark, sf), NUNI_COLS, method="dedup")


@register("crossdomain_nunique_set", f"""
SELECT u_userId, {_nuni_sql()} FROM feeds WHERE u_userId IS NOT NULL GROUP BY u_userId""")
def q_crossdomain_nunique_set(spark, sf):
    return xd.user_nunique(analog.feeds(spark, sf), NUNI_COLS, method="set")


@register("crossdomain_mean", f"""
SELECT u_userId, {_mean_sql()} FROM feeds WHERE u_userId IS NOT NULL GROUP BY u_userId""")
def q_crossdomain_mean(spark, sf):
    return round_doubles(xd.user_mean(analog.feeds(spark, sf), MEAN_COLS), skip=EXACT_MEANS)


@register("crossdomain_features", f"""
SELECT a.log_id, a.user_id, f.* EXCLUDE (u_userId)
FROM ads a LEFT JOIN (
  SELECT u_userId, {_nuni_sql()}, {_mean_sql()} FROM feeds WHERE u_userId IS NOT NULL GROUP BY u_userId
) f ON a.user_id = f.u_userId""")
def q_crossdomain_features(spark, sf):
    ads = analog.ads(spark, sf).select("log_id", "user_id")
    return round_doubles(xd.crossdomain_features(ads, analog.feeds(spark, sf), NUNI_COLS, MEAN_COLS),
                         skip=EXACT_MEANS)


# ---------------------------------------------------------------- time-gap features

from clickwise.functions import timeparts as tp  # noqa: E402
from clickwise.operators import gaps as gp  # noqa: E402
from clickwise.plans.gap_sql import PARTS_SQL, gap_sql  # noqa: E402


def _gap_base(spark, sf):
    return tp.with_minute_ordinal(analog.ads(spark, sf))


def _gap_cols(keys, kinds):
    n = "_".join(keys)
    names = gp.feature_names(keys)
    pick = {
        "first": lambda c: c.startswith(f"ts_{n}_") and c.endswith(("_diff_next", "_diff_last")),
        "stats": lambda c: c.startswith(f"ts_{n}_") and c.endswith(("_count", "_mean", "_max", "_min")),
        "second": lambda c: c.startswith("ts_s_"),
    }
    return [c for c in names if any(pick[k](c) for k in kinds)]


def _gap_query(name, key_sets, kinds):
    cols = [c for ks in key_sets for c in _gap_cols(ks, kinds)]

    @register(name, gap_sql(key_sets, ", ".join(["log_id"] + cols)))
    def q(spark, sf):
        return gp.gap_features(_gap_base(spark, sf), key_sets, out=["log_id", *cols])
    return q


_gap_query("gap_next_last", [["user_id"]], ["first"])
_gap_query("gap_stats", [["task_id"]], ["stats"])
_gap_query("gap_second_order", [["user_id", "adv_id"]], ["second"])
_gap_query("gap_multi_key", analog.GAP_KEY_SETS, ["first", "stats", "second"])


# ---------------------------------------------------------------- encoding

from clickwise.operators import encode as enc  # noqa: E402


def _encode_sql(cols, compat=False):
    ctes, sel, joins = [], ["a.log_id"], []
    for i, c in enumerate(cols):
        code = "CAST(row_number() OVER (ORDER BY first) - 1 AS INTEGER)"
        if compat:
            code = (f"CASE WHEN (SELECT count(*) FROM ads WHERE {c} IS NULL) > 0 AND row_number() OVER (ORDER BY first)"
                    f" = count(*) OVER () THEN NULL ELSE {code} END")
        ctes.append(f"c{i} AS (SELECT v, {code} AS code FROM (SELECT {c} AS v, min(ro) AS first FROM ads GROUP BY 1))")
        sel.append(f"c{i}.code AS {c}")
        joins.append(f"LEFT JOIN c{i} ON a.{c} IS NOT DISTINCT FROM c{i}.v")
    return "WITH " + ", ".join(ctes) + f" SELECT {', '.join(sel)} FROM ads a " + " ".join(joins)


@register("label_encode", _encode_sql(analog.LIST_COLUMNS))
def q_label_encode(spark, sf):
    a = analog.ads(spark, sf)
    return enc.label_encode(a, analog.LIST_COLUMNS).select("log_id", *analog.LIST_COLUMNS)


@register("label_encode_compat", _encode_sql(analog.LIST_COLUMNS, compat=True))
def q_label_encode_compat(spark, sf):
    a = analog.ads(spark, sf)
    return enc.label_encode(a, analog.LIST_COLUMNS, compat=True).select("log_id", *analog.LIST_COLUMNS)


# ---------------------------------------------------------------- sampling and folds

from clickwise.operators import sampling as smp  # noqa: E402

SAMPLE_SIZES = {0: 3000, 1: 500}
H_SQL = "md5('2022|' || CAST(log_id AS VARCHAR))"


def _train(spark, sf):
    return analog.ads(spark, sf).where("istest = 0")


@register("sample_stratified", f"""
SELECT log_id, label FROM (
  SELECT log_id, label, row_number() OVER (PARTITION BY label ORDER BY {H_SQL}, log_id) AS rn
  FROM ads WHERE istest = 0 AND label IN (0, 1))
WHERE (label = 0 AND rn <= {SAMPLE_SIZES[0]}) OR (label = 1 AND rn <= {SAMPLE_SIZES[1]})""")
def q_sample_stratified(spark, sf):
    return smp.sample_per_class(_train(spark, sf), "label", SAMPLE_SIZES).select("log_id", "label")


@register("kfold_exact", f"""
SELECT log_id, CAST(ntile(5) OVER (ORDER BY {H_SQL}, log_id) - 1 AS INTEGER) AS fold FROM ads WHERE istest = 0""")
def q_kfold_exact(spark, sf):
    return smp.kfold_exact(_train(spark, sf), 5).select("log_id", "fold")


@register("kfold_hash", f"""
SELECT log_id, CAST(CAST('0x' || substr({H_SQL}, 1, 8) AS BIGINT) % 5 AS INTEGER) AS fold FROM ads WHERE istest = 0""")
def q_kfold_hash(spark, sf):
    return smp.kfold_hash(_train(spark, sf), 5).select("log_id", "fold")


@register("kfold_split_counts", f"""
SELECT CAST(fold AS INTEGER) AS fold, count(*) AS n_valid, CAST(sum(count(*)) OVER () - count(*) AS BIGINT) AS n_train FROM (
  SELECT ntile(5) OVER (ORDER BY {H_SQL}, log_id) - 1 AS fold FROM ads WHERE istest = 0) GROUP BY fold""")
def q_kfold_split_counts(spark, sf):
    return smp.fold_split_counts(smp.kfold_exact(_train(spark, sf), 5))


@register("kfold_stratified", f"""
SELECT log_id, label, CAST(ntile(5) OVER (PARTITION BY label ORDER BY {H_SQL}, log_id) - 1 AS INTEGER) AS fold
FROM ads WHERE istest = 0""")
def q_kfold_stratified(spark, sf):
    return smp.kfold_exact(_train(spark, sf), 5, stratify_col="label").select("log_id", "label", "fold")


# ---------------------------------------------------------------- scores

from clickwise.plans import evaluate as ev  # noqa: E402

# Deterministic stand-ins for three learners' scores, so the score arithmetic is SQL-checkable.
PSEUDO_SCORES = {"value": "app_score", "adv": "adv_id", "slot": "slot_id"}
FOLD_SQL = f"CAST(CAST('0x' || substr({H_SQL}, 1, 8) AS BIGINT) % 5 AS INTEGER)"


def _auc_sql(score: str, group: str) -> str:
    return f"""
SELECT {group}, sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc,
       CAST(sum(pos) AS BIGINT) AS n_pos, CAST(sum(neg) AS BIGINT) AS n_neg FROM (
  SELECT *, coalesce(sum(neg) OVER (PARTITION BY {group} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
            AS below
  FROM (SELECT {group}, {score} AS s, sum(label) AS pos, sum(1 - label) AS neg
        FROM (SELECT *, {FOLD_SQL} AS fold FROM ads WHERE istest = 0) GROUP BY {group}, {score}))
GROUP BY {group}"""


@register("auc_exact", f"SELECT fold, round(auc, 6) AS auc, n_pos, n_neg FROM ({_auc_sql('app_score', 'fold')})")
def q_auc_exact(spark, sf):
    t = smp.kfold_hash(_train(spark, sf), 5)
    return round_doubles(ev.auc(t, "app_score", "label", ["fold"]))


def _score_long(spark, sf):
    t = smp.kfold_hash(_train(spark, sf), 5)
    parts = [ev.auc(t.withColumn("_score", F.col(c).cast("double")), "_score", "label", ["fold"])
             .withColumn("learner", F.lit(name)) for name, c in PSEUDO_SCORES.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


_SCORES_SQL = " UNION ALL ".join(f"SELECT '{n}' AS learner, fold, auc FROM ({_auc_sql(c, 'fold')})"
                                 for n, c in PSEUDO_SCORES.items())


@register("cv_score_summary", f"""
SELECT coalesce(learner, 'all') AS learner, count(auc) AS n_folds, round(avg(auc), 6) AS score_mean,
       round(stddev_pop(auc), 6) AS score_std
FROM ({_SCORES_SQL}) GROUP BY ROLLUP (learner)""")
def q_cv_score_summary(spark, sf):
    return round_doubles(ev.score_summary(_score_long(spark, sf)))


# ---------------------------------------------------------------- sort, top-k, merge

from clickwise.operators import topk  # noqa: E402
from clickwise.operators import sequence as seq  # noqa: E402

TOP_K = 10


@register("sort_with_rank", """
SELECT log_id, app_score, row_number() OVER (ORDER BY app_score, log_id) - 1 AS pos FROM ads""")
def q_sort_with_rank(spark, sf):
    a = analog.ads(spark, sf).select("log_id", "app_score")
    return topk.sort_with_rank(a, ["app_score", "log_id"], F.col("app_score"))


@register("top_k_smallest", f"SELECT log_id, app_score FROM ads ORDER BY app_score, log_id LIMIT {TOP_K}")
def q_top_k_smallest(spark, sf):
    return topk.k_smallest(analog.ads(spark, sf).select("log_id", "app_score"), TOP_K, ["app_score", "log_id"])


@register("top_k_largest", f"SELECT log_id, app_score FROM ads ORDER BY app_score DESC, log_id DESC LIMIT {TOP_K}")
def q_top_k_largest(spark, sf):
    return topk.k_largest(analog.ads(spark, sf).select("log_id", "app_score"), TOP_K, ["app_score", "log_id"])


@register("top_k_per_user", """
SELECT user_id, log_id, app_score, CAST(rank AS INTEGER) AS rank FROM (
  SELECT user_id, log_id, app_score, row_number() OVER (PARTITION BY user_id ORDER BY app_score DESC, log_id) AS rank
  FROM ads) WHERE rank <= 3""")
def q_top_k_per_user(spark, sf):
    a = analog.ads(spark, sf).select("user_id", "log_id", "app_score")
    return topk.top_k_per_group(a, ["user_id"], 3, [F.col("app_score").desc(), F.col("log_id")], "log_id")


@register("ordered_merge", """
SELECT log_id, istest, row_number() OVER (ORDER BY pt_d, log_id) - 1 AS pos FROM (
  SELECT log_id, istest, pt_d FROM ads WHERE istest = 0 UNION ALL SELECT log_id, istest, pt_d FROM ads WHERE istest = 1)""")
def q_ordered_merge(spark, sf):
    a = analog.ads(spark, sf).select("log_id", "istest", "pt_d")
    parts = [a.where("istest = 0"), a.where("istest = 1")]
    return topk.ordered_merge(parts, ["pt_d", "log_id"], F.col("pt_d")).select("log_id", "istest", "pos")


# Bit of each event type in the parity mask (alphabetical order of the type names).
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _type_bit():
    expr = F.lit(0)
    for i, t in enumerate(EVENT_TYPES):
        expr = F.when(F.col("event_type") == t, F.lit(1 << i)).otherwise(expr)
    return expr


@register("parity_run", f"""
WITH e AS (SELECT user_id, ts, event_id,
                  CASE event_type {' '.join(f"WHEN '{t}' THEN {1 << i}" for i, t in enumerate(EVENT_TYPES))} ELSE 0 END AS bit
           FROM events),
p AS (SELECT user_id, row_number() OVER w AS pos,
             bit_xor(bit) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS mask
      FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
      UNION ALL SELECT DISTINCT user_id, 0, 0 FROM events),
s AS (SELECT user_id, mask, max(pos) - min(pos) AS span FROM p GROUP BY user_id, mask)
SELECT user_id, CAST(max(span) AS BIGINT) AS longest FROM s GROUP BY user_id""")
def q_parity_run(spark, sf):
    e = spark.read.parquet(f"{sf}/events.parquet")
    key = F.unix_micros(F.col("ts").cast("timestamp"))
    return seq.longest_even_run(e, "user_id", _type_bit(), ["ts", "event_id"], key)


# ---------------------------------------------------------------- bounds and type narrowing

from clickwise.operators import narrow as nr  # noqa: E402

ADS_NUMERIC = ["log_id", "label", "user_id", "adv_id", "task_id", "adv_prim_id", "creat_type_cd", "inter_type_cd",
               "slot_id", "site_id", "spread_app_id", "app_score", "pt_d", "istest", "ro"]
_SPARK_TYPE_SQL = ("CASE any_value(typeof({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
                   "WHEN 'SMALLINT' THEN 'smallint' WHEN 'DOUBLE' THEN 'double' WHEN 'FLOAT' THEN 'float' END")


def _bounds_sql() -> str:
    parts = []
    for c in ADS_NUMERIC:
        parts.append(
            f"SELECT '{c}' AS col_name, {_SPARK_TYPE_SQL.format(c=c)} AS dtype, CAST(min({c}) AS DOUBLE) AS min, "
            f"CAST(max({c}) AS DOUBLE) AS max, CASE WHEN any_value(typeof({c})) IN ('DOUBLE', 'FLOAT') THEN "
            f"max(CAST(CAST(CAST({c} AS FLOAT) AS DOUBLE) <> CAST({c} AS DOUBLE) AS INTEGER)) END AS lossy_f32, "
            f"count(*) AS n_rows FROM ads")
    return " UNION ALL ".join(parts)


_PLAN_SQL = f"""
SELECT col_name, dtype, min, max, n_rows,
  CASE WHEN dtype IN ('smallint', 'int', 'bigint') THEN
         CASE WHEN min IS NULL THEN 'float64'
              WHEN min > -128 AND max < 127 THEN 'tinyint'
              WHEN min > -32768 AND max < 32767 THEN 'smallint'
              WHEN min > -2147483648 AND max < 2147483647 THEN 'int' ELSE 'bigint' END
       ELSE CASE WHEN min IS NULL THEN 'float64'
                 WHEN min > -65504 AND max < 65504 THEN 'float16'
                 WHEN min > -3.4028234663852886e38 AND max < 3.4028234663852886e38 THEN 'float32'
                 ELSE 'float64' END END AS ref_type,
  lossy_f32
FROM ({_bounds_sql()})"""

_PLAN_TARGET_SQL = f"""
SELECT *, CASE WHEN dtype IN ('smallint', 'int', 'bigint') THEN (CASE WHEN min IS NULL THEN dtype ELSE ref_type END)
               WHEN lossy_f32 = 0 AND ref_type <> 'float64' THEN 'float' ELSE dtype END AS spark_type
FROM ({_PLAN_SQL})"""


@register("numeric_bounds", f"SELECT col_name, dtype, min, max FROM ({_bounds_sql()})")
def q_numeric_bounds(spark, sf):
    return nr.bounds_frame(analog.ads(spark, sf)).select("col_name", "dtype", "min", "max")


@register("narrow_types_plan", f"SELECT col_name, dtype, min, max, ref_type, spark_type FROM ({_PLAN_TARGET_SQL})")
def q_narrow_types_plan(spark, sf):
    return nr.plan_frame(analog.ads(spark, sf)).drop("n_rows")


_SQL_TYPE = {"tinyint": "TINYINT", "smallint": "SMALLINT", "int": "INTEGER", "bigint": "BIGINT", "float": "FLOAT",
             "double": "DOUBLE"}


def _apply_sql() -> str:
    parts = []
    for c in ADS_NUMERIC:
        eq = " ".join(f"WHEN '{t}' THEN CAST(TRY_CAST(a.{c} AS {st}) = a.{c} AS INTEGER)" for t, st in _SQL_TYPE.items())
        parts.append(f"SELECT '{c}' AS col_name, any_value(p.spark_type) AS spark_type, count(*) AS n_rows, "
                     f"CAST(sum(CASE p.spark_type {eq} END) AS BIGINT) AS n_equal "
                     f"FROM ads a, (SELECT spark_type FROM plan WHERE col_name = '{c}') p")
    return f"WITH plan AS ({_PLAN_TARGET_SQL}) " + " UNION ALL ".join(parts)


@register("narrow_types_apply", _apply_sql())
def q_narrow_types_apply(spark, sf):
    a = analog.ads(spark, sf).select(*ADS_NUMERIC)
    plan = nr.narrowing_plan(a)
    both = nr.apply_plan(a.select(*ADS_NUMERIC, *[F.col(c).alias(f"{c}__orig") for c in ADS_NUMERIC]), plan)
    types = {f.name: f.dataType.simpleString() for f in both.schema.fields}
    agg = both.agg(F.count(F.lit(1)).alias("n"),
                   *[F.sum((F.col(c) == F.col(f"{c}__orig")).cast("long")).alias(f"eq_{c}") for c in ADS_NUMERIC])
    args = ", ".join(f"'{c}', '{types[c]}', eq_{c}" for c in ADS_NUMERIC)
    return agg.selectExpr(f"stack({len(ADS_NUMERIC)}, {args}) AS (col_name, spark_type, n_equal)", "n AS n_rows")


@register("narrow_types_report", f"""
WITH p AS ({_PLAN_TARGET_SQL}),
w AS (SELECT col_name,
             n_rows * CASE dtype WHEN 'tinyint' THEN 1 WHEN 'smallint' THEN 2 WHEN 'int' THEN 4 WHEN 'float' THEN 4 ELSE 8 END
               AS bytes_before,
             n_rows * CASE spark_type WHEN 'tinyint' THEN 1 WHEN 'smallint' THEN 2 WHEN 'int' THEN 4 WHEN 'float' THEN 4
               ELSE 8 END AS bytes_after FROM p),
t AS (SELECT col_name, bytes_before, bytes_after FROM w
      UNION ALL SELECT '__total__', CAST(sum(bytes_before) AS BIGINT), CAST(sum(bytes_after) AS BIGINT) FROM w)
SELECT col_name, CAST(bytes_before AS BIGINT) AS bytes_before, CAST(bytes_after AS BIGINT) AS bytes_after,
       round(100.0 * (bytes_before - bytes_after) / bytes_before, 1) AS reduction_pct FROM t""")
def q_narrow_types_report(spark, sf):
    return nr.size_report(analog.ads(spark, sf).select(*ADS_NUMERIC))


# ---------------------------------------------------------------- sources, projection, simple groups

from clickwise.operators import basic  # noqa: E402
from clickwise.sources import io as sio  # noqa: E402

LR_COLUMNS = ["log_id", "label", "user_id", "adv_id", "task_id", "creat_type_cd", "slot_id", "app_score"]


@register("scan_subset", f"SELECT {', '.join(LR_COLUMNS)} FROM ads")
def q_scan_subset(spark, sf):
    return round_doubles(analog.ads(spark, sf).select(*LR_COLUMNS))


@register("csv_scan_ordinal", """
SELECT log_id, user_id, pt_d, ad_click_list_v001, row_number() OVER (ORDER BY ro) - 1 AS ro FROM ads""")
def q_csv_scan_ordinal(spark, sf):
    """Write the impressions as CSV in row order, scan them back with a declared schema, and recover
    the file-order ordinal."""
    a = analog.ads(spark, sf).select("log_id", "user_id", "pt_d", "ad_click_list_v001", "ro")
    path = sio.scratch_path(spark, "ads-csv")
    a.orderBy("ro").drop("ro").write.option("header", True).csv(path)
    schema = "log_id bigint, user_id bigint, pt_d bigint, ad_click_list_v001 string"
    back = spark.read.option("header", True).schema(schema).csv(path)
    return sio.with_file_ordinal(back, "ro")


@register("head_n", "SELECT * FROM ads ORDER BY ro LIMIT 10")
def q_head_n(spark, sf):
    return round_doubles(sio.head_n(analog.ads(spark, sf), 10, "ro"))


@register("submission_roundtrip", """
SELECT log_id, round(app_score / 1000.0, 6) AS pctr FROM ads WHERE istest = 1""")
def q_submission_roundtrip(spark, sf):
    test = analog.ads(spark, sf).where("istest = 1")
    preds = test.select("log_id", F.round(F.col("app_score") / 1000.0, 6).alias("pctr"))
    path = sio.write_submission(preds, sio.scratch_path(spark, "submission"))
    return sio.read_submission(spark, path)


@register("profile_table", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, CASE any_value(typeof({c})) WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
    f"WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' END AS dtype, count({c}) AS non_null FROM ads"
    for c in ["log_id", "label", "user_id", "adv_id", "task_id", "adv_prim_id", "creat_type_cd", "inter_type_cd",
              "slot_id", "site_id", "spread_app_id", "app_score", *analog.LIST_COLUMNS, "pt_d", "istest", "ro"]))
def q_profile_table(spark, sf):
    return sio.profile(analog.ads(spark, sf))


@register("union_train_test", """
SELECT log_id, label, istest, CAST(istest AS BIGINT) * 1099511627776 + pos AS ro FROM (
  SELECT log_id, label, 0 AS istest, row_number() OVER (ORDER BY ro) - 1 AS pos FROM ads WHERE istest = 0
  UNION ALL
  SELECT log_id, NULL AS label, 1 AS istest, row_number() OVER (ORDER BY ro) - 1 AS pos FROM ads WHERE istest = 1)""")
def q_union_train_test(spark, sf):
    a = analog.ads(spark, sf)
    train = a.where("istest = 0").select("log_id", "label", "ro")
    test = a.where("istest = 1").select("log_id", "ro")  # the test log has no label column
    from clickwise.operators.rank import global_rank
    train = global_rank(train, ["ro"], F.col("ro"), out="pos").drop("ro")
    test = global_rank(test, ["ro"], F.col("ro"), out="pos").drop("ro")
    return basic.union_train_test(train, test, "pos").select("log_id", "label", "istest", "ro")


@register("project_exclude", "SELECT * EXCLUDE (label, istest, log_id) FROM ads")
def q_project_exclude(spark, sf):
    return round_doubles(basic.project_exclude(analog.ads(spark, sf)))


@register("split_train_test", """
SELECT istest, count(*) AS n_rows, count(label) AS n_labelled, CAST(sum(label) AS BIGINT) AS n_pos
FROM ads GROUP BY istest""")
def q_split_train_test(spark, sf):
    train, test = basic.split(analog.ads(spark, sf))
    def summ(d):
        return d.groupBy("istest").agg(F.count(F.lit(1)).alias("n_rows"), F.count("label").alias("n_labelled"),
                                       F.sum("label").cast("long").alias("n_pos"))
    return summ(train).unionByName(summ(test))


@register("group_count", "SELECT adv_id, count(app_score) AS n FROM ads WHERE adv_id IS NOT NULL GROUP BY adv_id")
def q_group_count(spark, sf):
    return basic.group_count(analog.ads(spark, sf), "adv_id", "app_score")


@register("group_nunique", """
SELECT user_id, count(DISTINCT adv_id) AS nunique FROM ads WHERE user_id IS NOT NULL GROUP BY user_id""")
def q_group_nunique(spark, sf):
    return basic.group_nunique(analog.ads(spark, sf), "user_id", "adv_id")


@register("column_cardinality", " UNION ALL ".join(
    f"SELECT '{c}' AS col_name, count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS n_unique, "
    f"count(DISTINCT {c}) AS n_nunique FROM ads" for c in analog.LIST_COLUMNS))
def q_column_cardinality(spark, sf):
    return basic.column_cardinality(analog.ads(spark, sf), analog.LIST_COLUMNS)


@register("global_lag", """
SELECT log_id, app_score, lag(app_score, 1) OVER (ORDER BY ro) AS app_score_lag1 FROM ads""")
def q_global_lag(spark, sf):
    a = analog.ads(spark, sf).select("log_id", "app_score", "ro")
    return basic.global_shift(a, "app_score", ["ro"], F.col("ro")).drop("ro")


@register("group_diff", """
SELECT log_id, round(app_score - lag(app_score, 1) OVER (PARTITION BY user_id ORDER BY ro), 6) AS app_score_diff
FROM ads""")
def q_group_diff(spark, sf):
    a = analog.ads(spark, sf)
    return round_doubles(basic.group_diff(a, ["user_id"], "ro", "app_score").select("log_id", "app_score_diff"))


@register("group_size_broadcast", "SELECT log_id, count(app_score) OVER (PARTITION BY adv_id) AS n FROM ads")
def q_group_size_broadcast(spark, sf):
    return basic.group_size_broadcast(analog.ads(spark, sf), ["adv_id"], "app_score").select("log_id", "n")


# ---------------------------------------------------------------- scalar functions on packed times

_SLICE_SQL = ", ".join(f"CAST(substr(CAST(pt_d AS VARCHAR), {s + 1}, 2) AS INTEGER) AS {n}"
                       for n, s in [("month", 4), ("day", 6), ("hour", 8), ("minu", 10)])


@register("time_parts_slice", f"SELECT log_id, {_SLICE_SQL} FROM ads")
def q_time_parts_slice(spark, sf):
    return tp.time_parts_slice(analog.ads(spark, sf)).select("log_id", "month", "day", "hour", "minu")


@register("minute_ordinal", f"SELECT log_id, day * 1440 + hour * 60 + minu AS date FROM (SELECT log_id, {_SLICE_SQL} FROM ads)")
def q_minute_ordinal(spark, sf):
    return tp.with_minute_ordinal(analog.ads(spark, sf)).select("log_id", "date")


@register("time_parts_arith", """
SELECT log_id, CAST(pt_d // 100000000 AS INTEGER) AS year, CAST(pt_d % 100000000 // 1000000 AS INTEGER) AS month,
       CAST(pt_d % 1000000 // 10000 AS INTEGER) AS day, CAST(pt_d % 10000 // 100 AS INTEGER) AS hour,
       CAST(pt_d % 100 AS INTEGER) AS minute FROM ads""")
def q_time_parts_arith(spark, sf):
    return analog.ads(spark, sf).select("log_id", *[c.alias(n) for n, c in tp.time_parts_arith("pt_d").items()])


@register("parse_packed_time", "SELECT log_id, strptime(CAST(pt_d AS VARCHAR), '%Y%m%d%H%M') AS ts FROM ads")
def q_parse_packed_time(spark, sf):
    return analog.ads(spark, sf).select("log_id", tp.parse_packed_time("pt_d").alias("ts"))


@register("calendar_parts", """
SELECT log_id, CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day,
       CAST(isodow(ts) - 1 AS INTEGER) AS weekday, CAST(hour(ts) AS INTEGER) AS hour
FROM (SELECT log_id, strptime(CAST(pt_d AS VARCHAR), '%Y%m%d%H%M') AS ts FROM ads)""")
def q_calendar_parts(spark, sf):
    a = analog.ads(spark, sf).select("log_id", tp.parse_packed_time("pt_d").alias("ts"))
    return a.select("log_id", *[c.alias(n) for n, c in tp.calendar_parts("ts").items()])


@register("safe_narrow_cast", """
SELECT log_id, TRY_CAST(user_id AS TINYINT) AS user_id_i8, TRY_CAST(pt_d AS INTEGER) AS pt_d_i32,
       CAST(pt_d AS VARCHAR) AS pt_d_str, CAST(CAST(pt_d AS VARCHAR) AS BIGINT) AS pt_d_back,
       TRY_CAST(CAST(pt_d // 100000000 AS INTEGER) AS TINYINT) AS year_i8 FROM ads""")
def q_safe_narrow_cast(spark, sf):
    a = analog.ads(spark, sf)
    return a.select("log_id", tp.safe_cast("user_id", "tinyint").alias("user_id_i8"),
                    tp.safe_cast("pt_d", "int").alias("pt_d_i32"), F.col("pt_d").cast("string").alias("pt_d_str"),
                    F.col("pt_d").cast("string").cast("long").alias("pt_d_back"),
                    tp.safe_cast(tp.time_parts_arith("pt_d")["year"], "tinyint").alias("year_i8"))


# ---------------------------------------------------------------- the full feature table (flagship)

from clickwise.plans import features as ft  # noqa: E402

DOUBLE_MEANS = [c + "_feeds_mean" for c in MEAN_COLS if c not in MEAN_INT_COLS]
_ADS_OUT = ["log_id", "label", "user_id", "adv_id", "task_id", "adv_prim_id", "creat_type_cd", "inter_type_cd",
            "slot_id", "site_id", "spread_app_id", "app_score", *analog.LIST_COLUMNS, "pt_d", "istest", "ro"]
_GAP_OUT = [c for ks in analog.GAP_KEY_SETS for c in gp.feature_names(ks)]
_CROSS_OUT = [c + "_feeds_nuni" for c in NUNI_COLS] + [c + "_feeds_mean" for c in MEAN_COLS]


def _features_sql() -> str:
    enc_sql = _encode_sql(analog.LIST_COLUMNS)
    cross_sql = f"""
SELECT a.log_id, f.* EXCLUDE (u_userId) FROM ads a LEFT JOIN (
  SELECT u_userId, {_nuni_sql()}, {_mean_sql()} FROM feeds WHERE u_userId IS NOT NULL GROUP BY u_userId
) f ON a.user_id = f.u_userId"""
    gap = gap_sql(analog.GAP_KEY_SETS, ", ".join(["log_id", "month", "day", "hour", "minu", "date"] + _GAP_OUT))
    gap_ctes, gap_select = gap[len("WITH "):].rsplit("\nSELECT ", 1)
    plain = [c for c in _ADS_OUT if c not in analog.LIST_COLUMNS]
    return (f"WITH {gap_ctes}, gsel AS (SELECT {gap_select}), enc AS ({enc_sql}), cross_f AS ({cross_sql})\n"
            f"SELECT {', '.join('a.' + c for c in plain)}, {', '.join('enc.' + c for c in analog.LIST_COLUMNS)}, "
            f"{', '.join('cross_f.' + c for c in _CROSS_OUT)}, "
            f"{', '.join('gsel.' + c for c in ['month', 'day', 'hour', 'minu', 'date'] + _GAP_OUT)}\n"
            f"FROM ads a JOIN enc USING (log_id) JOIN cross_f USING (log_id) JOIN gsel USING (log_id)")


def ctr_feature_frame(spark, sf, **kw):
    a = analog.ads(spark, sf)
    return ft.feature_table(a, analog.feeds(spark, sf), analog.LIST_COLUMNS, analog.GAP_KEY_SETS, NUNI_COLS,
                            MEAN_COLS, **kw)


@register("ctr_features", _features_sql())
def q_ctr_features(spark, sf):
    return round_doubles(ctr_feature_frame(spark, sf), only=DOUBLE_MEANS)


# ---------------------------------------------------------------- learners, cross-validation, fusion

from clickwise.plans import fusion as fu  # noqa: E402
from clickwise.plans import logistic as lg  # noqa: E402
from clickwise.plans import models as md  # noqa: E402
from clickwise.plans import submission as sub  # noqa: E402
from clickwise.session import cut_lineage  # noqa: E402

#: Every column of the feature table but the row's id, its ordinal, the label and the split.
MODEL_COLS = ([c for c in _ADS_OUT if c not in ("log_id", "label", "istest", "ro")] + _CROSS_OUT
              + ["month", "day", "hour", "minu", "date"] + _GAP_OUT)

def _stored_features(spark, sf):
    """The feature table, stored once: bins, folds and codes read it."""
    return cut_lineage(ctr_feature_frame(spark, sf).select("log_id", "label", "istest", *MODEL_COLS))


def _quantised(spark, sf):
    base = _stored_features(spark, sf)
    return md.quantise(base.where("istest = 0"), base.where("istest = 1"), MODEL_COLS)


def _lr_frames(spark, sf):
    """(train sample, test) of the logistic baseline, nulls filled with the sample's means."""
    a = analog.ads(spark, sf)
    train = cut_lineage(smp.sample_per_class(a.where("istest = 0"), "label", SAMPLE_SIZES).select("log_id", "label", *analog.PROFILE_COLUMNS))
    test = md.fill_mean(a.where("istest = 1").select("log_id", *analog.PROFILE_COLUMNS), analog.PROFILE_COLUMNS, train)
    return md.fill_mean(train, analog.PROFILE_COLUMNS), test


def _lr_model(train):
    return lg.fit_logistic(train, analog.PROFILE_COLUMNS)


@register("lr_baseline")
def q_lr_baseline(spark, sf):
    train, test = _lr_frames(spark, sf)
    return md.predict_proba(_lr_model(train), test, "pctr").select("log_id", "pctr")


def _cv(spark, sf, learner):
    return md.cv_quantised(learner, _quantised(spark, sf))


@register("gbt_cat")
def q_gbt_cat(spark, sf):
    return _cv(spark, sf, md.gbt_cat()).test.withColumnRenamed("p", "pctr")


@register("gbt_lgb")
def q_gbt_lgb(spark, sf):
    return _cv(spark, sf, md.gbt_lgb()).test.withColumnRenamed("p", "pctr")


@register("gbt_xgb")
def q_gbt_xgb(spark, sf):
    return _cv(spark, sf, md.gbt_xgb()).test.withColumnRenamed("p", "pctr")


@register("predict_proba")
def q_predict_proba(spark, sf):
    q = _quantised(spark, sf)
    return md.predict_proba(md.boost(q.train, q.bins, md.gbt_lgb(), [None]), q, "pctr")


@register("cv_oof")
def q_cv_oof(spark, sf):
    return _cv(spark, sf, md.gbt_lgb()).oof


@register("cv_test_mean")
def q_cv_test_mean(spark, sf):
    """Each fold model's prediction of a test row beside their mean."""
    r = _cv(spark, sf, md.gbt_xgb())
    folds = r.test_by_fold.groupBy("log_id").pivot("fold", list(range(5))).agg(F.first("p"))
    return r.test.join(folds, "log_id").select("log_id", F.col("p").alias("pctr"), *[F.col(str(i)).alias(f"fold_{i}") for i in range(5)])


@register("cv_fold_scores")
def q_cv_fold_scores(spark, sf):
    r = _cv(spark, sf, md.gbt_lgb())
    return ev.score_summary(r.scores)


def _learners(spark, sf):
    """All three learners cross-validated on the same folds and codes, and the labels of the train rows."""
    base = _stored_features(spark, sf)
    train = base.where("istest = 0")
    res = fu.run_learners([md.gbt_lgb(), md.gbt_xgb(), md.gbt_cat()], train, base.where("istest = 1"), MODEL_COLS)
    return res, train.select("log_id", "label")


@register("fusion_stacking")
def q_fusion_stacking(spark, sf):
    res, labels = _learners(spark, sf)
    return fu.stacked(res, labels).test.withColumnRenamed("p", "pctr")


@register("fusion_fitted")
def q_fusion_fitted(spark, sf):
    """Mean of the 15 fitted models (3 learners, 5 folds) of each test row, with every learner's own mean."""
    res, _ = _learners(spark, sf)
    long = fu.long_predictions(res)
    means = fu.oof_matrix(fu.long_predictions(res, "test"), list(res))
    return fu.average_probability(long).join(means, "log_id")


@register("fusion_fold_scores")
def q_fusion_fold_scores(spark, sf):
    """AUC of every learner and of the meta-model on every fold."""
    res, labels = _learners(spark, sf)
    return fu.fold_scores(res | {"stack": fu.stacked(res, labels)})


def submission_inputs(spark, sf):
    return ctr_feature_frame(spark, sf).select("log_id", "label", "istest", *MODEL_COLS), MODEL_COLS


@register("pipeline_submission")
def q_pipeline_submission(spark, sf):
    """The whole run: the rows of the submission file, read back."""
    return sub.run(*submission_inputs(spark, sf)).submission


# Deterministic stand-in predictions: learner L, fold i -> (column mod 97 + i) / 100, so fusion
# arithmetic is checkable in SQL.
def _pseudo_long(spark, sf, split):
    a = smp.kfold_hash(analog.ads(spark, sf), 5)
    src = a.where(f"istest = {split}")
    folds = F.array(F.col("fold")) if split == 0 else F.sequence(F.lit(0), F.lit(4))
    scores = F.array(*[F.struct(F.lit(n), F.pmod(F.floor(F.col(c)).cast("long"), F.lit(97)))
                       .cast("struct<learner:string,base:bigint>") for n, c in PSEUDO_SCORES.items()])
    return (src.select("log_id", F.explode(folds).alias("fold"), scores.alias("s")).select("log_id", "fold", F.inline("s"))
            .select("log_id", "learner", "fold", ((F.col("base") + F.col("fold")) / 100.0).alias("p")))


def _pseudo_sql(split: int) -> str:
    parts = []
    for name, c in PSEUDO_SCORES.items():
        for i in range(5):
            cond = f"istest = 1" if split == 1 else f"istest = 0 AND {FOLD_SQL} = {i}"
            parts.append(f"SELECT log_id, '{name}' AS learner, {i} AS fold, "
                         f"(CAST(floor({c}) AS BIGINT) % 97 + {i}) / 100.0 AS p FROM ads WHERE {cond}")
    return " UNION ALL ".join(parts)


@register("fusion_avgprob", f"SELECT log_id, round(avg(p), 6) AS pctr FROM ({_pseudo_sql(1)}) GROUP BY log_id")
def q_fusion_avgprob(spark, sf):
    return round_doubles(fu.average_probability(_pseudo_long(spark, sf, 1)))


@register("oof_matrix", "SELECT log_id, " + ", ".join(
    f"round(max(CASE WHEN learner = '{n}' THEN p END), 6) AS {n}" for n in PSEUDO_SCORES)
    + f" FROM ({_pseudo_sql(0)}) GROUP BY log_id")
def q_oof_matrix(spark, sf):
    return round_doubles(fu.oof_matrix(_pseudo_long(spark, sf, 0), list(PSEUDO_SCORES)))


@register("stack_columns", "SELECT log_id, " + ", ".join(
    f"round(max(CASE WHEN learner = '{n}' THEN p END), 6) AS {n}" for n in PSEUDO_SCORES)
    + f" FROM ({_pseudo_sql(0)}) GROUP BY log_id")
def q_stack_columns(spark, sf):
    long = _pseudo_long(spark, sf, 0)
    vecs = {n: long.where(F.col("learner") == n).select("log_id", "p") for n in PSEUDO_SCORES}
    return round_doubles(fu.stack_columns(vecs))


# ---------------------------------------------------------------- backward-only (non-leaky) gaps

_NOLEAK_COLS = gp.feature_names(["user_id"], leaky=False)


def _noleak_sql() -> str:
    w = "(PARTITION BY user_id ORDER BY pt_d, log_id)"
    r = "(PARTITION BY user_id ORDER BY pt_d, log_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    first = ", ".join(f"date - lag(date, {g}) OVER {w} AS ts_user_id_{g}_diff_last" for g in (1, 2, 3))
    stats = ", ".join(f"{fn}(ts_user_id_{g}_diff_last) OVER {r} AS ts_user_id_{g}_diff_last_{nm}"
                      for g in (1, 2, 3) for fn, nm in (("count", "count"), ("avg", "mean"), ("max", "max"),
                                                       ("min", "min")))
    second = ", ".join(f"ts_user_id_1_diff_last - lag(ts_user_id_1_diff_last, {g}) OVER {w} "
                       f"AS ts_s_last_user_id_{g}_last_1" for g in (1, 2, 3))
    return (f"WITH g0 AS ({PARTS_SQL}) SELECT log_id, {', '.join(_NOLEAK_COLS)} FROM "
            f"(SELECT *, {stats}, {second} FROM (SELECT *, {first} FROM g0))")


@register("gap_no_leak", _noleak_sql())
def q_gap_no_leak(spark, sf):
    base = _gap_base(spark, sf)
    return gp.gap_features(base, [["user_id"]], order_col=["pt_d", "log_id"], leaky=False).select(
        "log_id", *_NOLEAK_COLS)
