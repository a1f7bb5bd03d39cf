"""The hot-group paths give exactly the plain results."""

from pyspark.sql import functions as F

from clickwise.operators import crossdomain as xd
from clickwise.operators import gaps as gp
from clickwise.sources import analog
from conftest import SF_SMALL


def _same(a, b):
    cols = sorted(a.columns)
    assert sorted(b.columns) == cols
    x, y = a.select(*cols), b.select(*cols)
    assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_gap_features_hot_split_equals_plain(spark):
    from clickwise.functions import timeparts as tp
    base = tp.with_minute_ordinal(analog.ads(spark, SF_SMALL))
    key_sets = [["user_id"], ["user_id", "adv_id"], ["user_id", "site_id"], ["task_id"]]
    plain = gp.gap_features(base, key_sets, hot_threshold=None)
    # 1000 rows, 15 users, 20 tasks: a threshold of 40 makes every user and most tasks hot and
    # splits each into several ordinal ranges
    for threshold in (40, 12):
        split = gp.gap_features(base, key_sets, hot_threshold=threshold)
        _same(plain, split)


def test_nunique_methods_agree(spark):
    feeds = analog.feeds(spark, SF_SMALL)
    cols = ["l_partkey", "l_quantity", "l_returnflag", "e_et"]
    _same(xd.user_nunique(feeds, cols, method="set"), xd.user_nunique(feeds, cols, method="dedup"))
    assert xd.user_nunique(feeds, cols, method="auto", hot_threshold=5).count() == feeds.select("u_userId").distinct().count()


def test_join_with_hot_users_equals_plain(spark):
    ads = analog.ads(spark, SF_SMALL).select("log_id", "user_id")
    feeds = analog.feeds(spark, SF_SMALL)
    plain = xd.crossdomain_features(ads, feeds, ["l_partkey"], ["l_quantity"], hot_threshold=None)
    split = xd.crossdomain_features(ads, feeds, ["l_partkey"], ["l_quantity"], hot_threshold=60)
    _same(plain, split)


def test_feature_table_with_hot_keys_equals_plain(spark):
    from clickwise.plans.catalog import ctr_feature_frame
    plain = ctr_feature_frame(spark, SF_SMALL, hot_threshold=10**9)
    split = ctr_feature_frame(spark, SF_SMALL, hot_threshold=50)
    _same(plain, split)


def test_group_diff_hot_split_equals_plain(spark):
    from clickwise.operators import basic
    a = analog.ads(spark, SF_SMALL).select("log_id", "user_id", "ro", "app_score")
    _same(basic.group_diff(a, ["user_id"], "ro", "app_score", hot_threshold=None),
          basic.group_diff(a, ["user_id"], "ro", "app_score", hot_threshold=20))


def test_group_size_broadcast_hot_split_equals_plain(spark):
    from clickwise.operators import basic
    a = analog.ads(spark, SF_SMALL).select("log_id", "adv_id", "app_score")
    _same(basic.group_size_broadcast(a, ["adv_id"], "app_score", hot_threshold=None),
          basic.group_size_broadcast(a, ["adv_id"], "app_score", hot_threshold=8))
