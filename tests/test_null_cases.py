"""Nulls, single classes, empty tables and free gap lists in the reference operators."""

import pytest
from pyspark.sql import functions as F

from clickwise.operators.crossdomain import user_nunique
from clickwise.operators.gaps import gap_features
from clickwise.operators.narrow import size_report
from clickwise.operators.rank import global_rank
from clickwise.operators.sampling import kfold_exact
from clickwise.operators.sequence import longest_even_run
from clickwise.plans.evaluate import auc


def test_auc_of_one_class_is_null(spark):
    df = spark.createDataFrame([(0, 0.2, 0), (0, 0.4, 0), (1, 0.3, 0), (1, 0.9, 1)], "fold int, p double, label int")
    assert {r["fold"]: r["auc"] for r in auc(df, "p", "label", ["fold"]).collect()} == {0: None, 1: 1.0}


def test_null_class_gets_folds(spark):
    df = spark.createDataFrame([(i, None if i < 10 else i % 2) for i in range(50)], "log_id long, label int")
    got = kfold_exact(df, 5, stratify_col="label").toPandas()
    assert len(got) == 50 and got["fold"].notna().all()
    assert got[got["label"].isna()].groupby("fold").size().tolist() == [2] * 5


def test_null_sort_keys_rank_first(spark):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else float(i)) for i in range(50)], "id long, v double")
    got = global_rank(df, ["v", "id"], F.col("v"), out="r", n_buckets=4).toPandas()
    assert got["r"].notna().all() and got["r"].nunique() == 50
    assert got[got["v"].isna()]["r"].max() < got[got["v"].notna()]["r"].min()


def test_rows_without_a_user_are_in_no_run(spark):
    df = spark.createDataFrame([(None, i, 0) for i in range(10)] + [(1, i, 0) for i in range(10)], "u int, o long, b int")
    got = longest_even_run(df, "u", F.col("b"), ["o"], F.col("o")).collect()
    assert [(r["u"], r["longest"]) for r in got] == [(1, 10)]


def test_size_report_of_an_empty_table(spark):
    got = size_report(spark.createDataFrame([], "a long, b double"))
    assert got.where("reduction_pct IS NOT NULL").isEmpty()


@pytest.mark.parametrize("threshold", [10 ** 9, 5])
def test_gap_lists_are_free(spark, threshold):
    df = spark.createDataFrame([(1, i, i * i) for i in range(12)], "user_id int, ro long, date long")
    got = gap_features(df, [["user_id"]], "ro", "date", gaps=(1, 5), hot_threshold=threshold).orderBy("ro").collect()
    assert [r["ts_user_id_5_diff_next"] for r in got] == [(i + 5) ** 2 - i * i for i in range(7)] + [None] * 5


@pytest.mark.parametrize("method", ["set", "dedup"])
def test_nan_is_one_value_by_either_method(spark, method):
    df = spark.createDataFrame([(1, float("nan")), (1, float("nan")), (1, 1.0), (1, -0.0), (1, 0.0)], "u_userId int, v double")
    assert user_nunique(df, ["v"], method=method).first()["v_feeds_nuni"] == 3
