"""Hot and keyless groups are spread evenly, whatever their ordinals; headers and fills follow the train side."""

import pytest
from pyspark.sql import functions as F

from clickwise.operators import gaps as gp
from clickwise.plans import models as md
from clickwise.sources import analog
from clickwise.sources import io as sio


def test_hot_ranges_are_even_across_the_gap_between_train_and_test(spark):
    train = spark.range(20_000).select(F.lit(1).alias("user_id"), F.col("id").alias("ro"))
    test = spark.range(2_000).select(F.lit(1).alias("user_id"), (F.col("id") + (1 << 40)).alias("ro"))
    sizes = gp.hot_ranges(train.unionByName(test), "user_id", "ro", 1_000).groupBy("_sb").count().collect()
    assert sorted(r["_sb"] for r in sizes) == list(range(22)) and {r["count"] for r in sizes} == {1_000}


def test_rows_without_a_key_are_spread(spark):
    df = spark.range(8_000).select(F.when(F.col("id") % 2 == 0, F.col("id") % 400).alias("user_id"),
                                   F.col("id").alias("ro"), F.col("id").alias("date"))
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        rows = (gp.gap_features(df, [["user_id"]], hot_threshold=None)
                .groupBy(F.spark_partition_id().alias("p"), F.col("user_id").isNull().alias("keyless"))
                .agg(F.count(F.lit(1)).alias("n"), F.max("ts_user_id_1_diff_next_count").alias("gaps")).collect())
    finally:
        spark.conf.set(coalesce, "true")
    keyless = [r for r in rows if r["keyless"]]
    assert sum(r["n"] for r in keyless) == 4_000 and max(r["n"] for r in keyless) < 1_000
    assert {r["gaps"] for r in keyless} == {None}
    assert {r["gaps"] for r in rows if not r["keyless"]} == {19}


def test_ordinals_of_distant_events_differ(spark, tmp_path):
    ids = [5, 5 + 2**31 - 1, 4 * 10**9, 2**60]
    ev = spark.createDataFrame([(i, "click", 1, 1.0, '{"k": 3}') for i in ids],
                               "event_id long, event_type string, user_id long, value double, props string")
    ev.withColumn("ts", F.timestamp_ntz_seconds(F.lit(0)) if hasattr(F, "timestamp_ntz_seconds")
                  else F.timestamp_seconds(F.lit(0))).write.parquet(str(tmp_path / "events.parquet"))
    assert analog.ads(spark, str(tmp_path)).select("ro").distinct().count() == len(ids)


def test_header_in_another_order_is_refused(spark, tmp_path):
    names = sio.ADS_SCHEMA.names
    swapped = [names[1], names[0], *names[2:]]
    path = tmp_path / "ads.csv"
    path.write_text(",".join(swapped) + "\n" + ",".join("1" for _ in swapped) + "\n")
    with pytest.raises(Exception, match="header|schema"):
        sio.read_csv(spark, str(path), sio.ADS_SCHEMA).collect()


def test_test_rows_are_filled_from_train_statistics(spark):
    train = spark.createDataFrame([(1.0,), (3.0,), (None,)], "x double")
    test = spark.createDataFrame([(10.0,), (None,)], "x double")
    out = md.fill_mean(test, ["x"], fit_on=train)
    assert sorted(r["x"] for r in out.collect()) == [2.0, 10.0]


@pytest.mark.parametrize("threshold", [1, 7, 40])
def test_running_statistics_of_hot_keys_are_carried_over_the_ranges(spark, threshold):
    """leaky=False on split groups equals the plain windows, with ties in the time, null keys and null times."""
    rows = [(i, 1 if i % 3 else i % 11, None if i % 13 == 0 else i % 4, None if i % 17 == 0 else (i * 37) % 200, 1000 + (i * 7) % 90) for i in range(400)]
    df = spark.createDataFrame(rows, "log_id long, user_id long, adv_id long, date long, pt_d long")
    key_sets, order = [["user_id"], ["user_id", "adv_id"]], ["pt_d", "log_id"]
    plain = gp.gap_features(df, key_sets, order, leaky=False, hot_threshold=None)
    split = gp.gap_features(df, key_sets, order, leaky=False, hot_threshold=threshold)
    assert plain.columns == split.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, split.collect()))


@pytest.mark.parametrize("k", [1, 2, 5])
def test_global_shift_carries_over_the_bucket_edges(spark, k):
    from clickwise.operators import basic
    rows = [(i, None if i % 7 == 0 else float(i), (i * 37) % 101) for i in range(101)]
    df = spark.createDataFrame(rows, "log_id long, v double, ro long").repartition(5)
    want = {r[0]: None for r in rows}
    ordered = sorted(rows, key=lambda r: r[2])
    want |= {b[0]: a[1] for a, b in zip(ordered, ordered[k:])}
    for n in (1, 4, 60):
        got = basic.global_shift(df, "v", ["ro"], F.col("ro"), k, n_buckets=n)
        assert got.columns == ["log_id", "v", "ro", f"v_lag{k}"]
        assert {r["log_id"]: r[f"v_lag{k}"] for r in got.collect()} == want
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1
