"""Hand-written frames with literal expected values."""

from pyspark.sql import functions as F

from clickwise.operators import crossdomain as xd
from clickwise.operators import encode as enc
from clickwise.operators import gaps as gp
from clickwise.operators import narrow as nr


def test_gaps_small_groups_null_key_negative_gap(spark):
    # group a: 3 rows in ordinal order with times 10, 5 (negative gap), 5 (duplicate); group b: 1 row;
    # a null key gets null everywhere, counts included
    rows = [(1, "a", 0, 10), (2, "a", 1, 5), (3, "a", 2, 5), (4, "b", 3, 7), (5, None, 4, 9)]
    df = spark.createDataFrame(rows, "id int, k string, ro int, date int")
    out = {r["id"]: r for r in gp.gap_features(df, [["k"]]).collect()}
    assert out[1]["ts_k_1_diff_next"] == -5 and out[1]["ts_k_1_diff_last"] is None
    assert out[2]["ts_k_1_diff_next"] == 0 and out[2]["ts_k_1_diff_last"] == -5
    assert out[3]["ts_k_2_diff_last"] == -5 and out[3]["ts_k_1_diff_next"] is None
    assert out[1]["ts_k_1_diff_next_count"] == 2 and out[1]["ts_k_2_diff_next_count"] == 1
    assert out[1]["ts_k_3_diff_next_count"] == 0 and out[1]["ts_k_3_diff_next_mean"] is None
    assert out[2]["ts_k_1_diff_next_mean"] == -2.5
    assert out[1]["ts_k_1_diff_next_max"] == 0 and out[1]["ts_k_1_diff_next_min"] == -5
    # second order: shift(-1) of diff_next_1 minus itself, at row 1: (0) - (-5) = 5
    assert out[1]["ts_s_next_k_1_next_1"] == 5 and out[2]["ts_s_next_k_1_next_1"] is None
    assert out[4]["ts_k_1_diff_next"] is None and out[4]["ts_k_1_diff_next_count"] == 0
    assert all(out[5][c] is None for c in gp.feature_names(["k"]))


def test_gaps_follow_ordinal_not_time(spark):
    # the ordinal decides the neighbour, even when time goes backwards
    df = spark.createDataFrame([(1, "a", 1, 100), (2, "a", 0, 50)], "id int, k string, ro int, date int")
    out = {r["id"]: r for r in gp.gap_features(df, [["k"]]).collect()}
    assert out[2]["ts_k_1_diff_next"] == 50 and out[1]["ts_k_1_diff_last"] == 50


def test_label_encode_null_is_a_category(spark):
    df = spark.createDataFrame([(0, "b"), (1, None), (2, "a"), (3, "c"), (4, "b")], "ro int, v string")
    got = [r["v"] for r in enc.label_encode(df, ["v"]).orderBy("ro").collect()]
    assert got == [0, 1, 2, 3, 0]
    compat = [r["v"] for r in enc.label_encode(df, ["v"], compat=True).orderBy("ro").collect()]
    assert compat == [0, 1, 2, None, 0]
    big = [r["v"] for r in enc.label_encode(df, ["v"], broadcast_max_codes=0).orderBy("ro").collect()]
    assert big == [0, 1, 2, 3, 0]


def test_label_encode_without_null_compat_is_identical(spark):
    df = spark.createDataFrame([(0, "x"), (1, "y"), (2, "x")], "ro int, v string")
    assert [r["v"] for r in enc.label_encode(df, ["v"], compat=True).orderBy("ro").collect()] == [0, 1, 0]


def test_narrowing_bounds_are_strict(spark):
    df = spark.createDataFrame([(127, 1.5, 100000, None), (0, 2.0, -5, None)], "a int, b double, c bigint, d int")
    plan = {p["col_name"]: p for p in nr.narrowing_plan(df)}
    assert plan["a"]["spark_type"] == "smallint"  # 127 is not strictly inside tinyint
    assert plan["b"]["ref_type"] == "float16" and plan["b"]["spark_type"] == "float"  # 1.5 and 2.0 are exact
    assert plan["c"]["spark_type"] == "int"
    assert plan["d"]["ref_type"] == "float64" and plan["d"]["spark_type"] == "int"  # all null: left alone
    lossy = spark.createDataFrame([(0.1,)], "x double")
    assert nr.narrowing_plan(lossy)[0]["spark_type"] == "double"
    assert nr.narrowing_plan(lossy, lossy=True)[0]["spark_type"] == "float"
    narrowed, _ = nr.reduce_mem_usage(df)
    assert dict(narrowed.dtypes) == {"a": "smallint", "b": "float", "c": "int", "d": "int"}


def test_crossdomain_user_without_feed_rows_and_all_null_values(spark):
    feeds = spark.createDataFrame([(1, "x", 2.0), (1, "x", 4.0), (1, "y", None), (2, None, None)],
                                  "u_userId long, s string, v double")
    ads = spark.createDataFrame([(10, 1), (11, 2), (12, 3)], "log_id long, user_id long")
    for method in ("set", "dedup"):
        out = {r["log_id"]: r for r in xd.crossdomain_features(ads, feeds, ["s", "v"], ["v"], method=method).collect()}
        assert out[10]["s_feeds_nuni"] == 2 and out[10]["v_feeds_nuni"] == 2 and out[10]["v_feeds_mean"] == 3.0
        assert out[11]["s_feeds_nuni"] == 0 and out[11]["v_feeds_mean"] is None
        assert out[12]["s_feeds_nuni"] is None  # no feed rows at all


def test_nunique_treats_negative_zero_as_zero(spark):
    feeds = spark.createDataFrame([(1, 0.0), (1, -0.0)], "u_userId long, v double")
    for method in ("set", "dedup"):
        assert xd.user_nunique(feeds, ["v"], method=method).first()["v_feeds_nuni"] == 1


def test_non_leaky_features_ignore_the_future(spark):
    from clickwise.plans.catalog import ctr_feature_frame
    from clickwise.plans.catalog import analog as an
    from conftest import SF_SMALL
    full = ctr_feature_frame(spark, SF_SMALL, leaky=False)
    gap_cols = [c for c in full.columns if c.startswith("ts_")]
    assert gap_cols and not any("diff_next" in c or c.startswith("ts_s_next") for c in gap_cols)
    cut = full.agg(F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY pt_d)")).first()[0]
    # the same computation on the past only: features of past rows must not change
    a = an.ads(spark, SF_SMALL).where(F.col("pt_d") <= cut)
    from clickwise.plans import features as ft
    from clickwise.plans.catalog import MEAN_COLS, NUNI_COLS
    past = ft.feature_table(a, an.feeds(spark, SF_SMALL), an.LIST_COLUMNS, an.GAP_KEY_SETS, NUNI_COLS, MEAN_COLS,
                            leaky=False)
    x = full.where(F.col("pt_d") <= cut).select("log_id", *gap_cols)
    y = past.select("log_id", *gap_cols)
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_csv_scan_forces_list_columns_to_text_and_keeps_file_order(spark, tmp_path):
    from clickwise.sources import io as sio
    header = ",".join(n for n, _ in sio.ADS_FIELDS)
    rows = []
    for i in range(5):
        vals = {n: "1" for n, _ in sio.ADS_FIELDS}
        vals.update(log_id=str(100 - i), ad_click_list_v001="24107" if i % 2 else "30157^30648",
                    app_score="10.0", pt_d="202206030326")
        rows.append(",".join(vals[n] for n, _ in sio.ADS_FIELDS))
    path = tmp_path / "ads.csv"
    path.write_text(header + "\n" + "\n".join(rows) + "\n")
    df = sio.read_csv(spark, str(path), sio.ADS_SCHEMA)
    assert dict(df.dtypes)["ad_click_list_v001"] == "string" and dict(df.dtypes)["pt_d"] == "bigint"
    ordered = sio.with_file_ordinal(df, "ro").orderBy("ro").select("log_id", "ro").collect()
    assert [(r["log_id"], r["ro"]) for r in ordered] == [(100 - i, i) for i in range(5)]
    sub = sio.read_csv(spark, str(path), sio.ADS_SCHEMA, ["log_id", "label"])
    assert sub.columns == ["log_id", "label"]


def test_size_for_input_sets_partitions_and_restores(spark):
    from clickwise.session import size_for_input
    keys = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes"]
    old = {k: spark.conf.get(k, None) for k in keys}
    try:
        assert size_for_input(spark, 100 * 10**12) == 372530
        assert size_for_input(spark, 10**6) == 200
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
