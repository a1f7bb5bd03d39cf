"""Gap features made in tasks by numpy: the rows of the window expressions, and wide rows that are neither sorted nor windowed."""

import random

import pytest

from clickwise.operators import gaps as gp

KEY_SETS = [["u"], ["u", "a"], ["u", "s", "x"], ["a"]]


def _rows(spark, n, date="int"):
    r = random.Random(5)
    pick = lambda *v: r.choice(v)
    rows = [(i, pick(1, 2, 3, 400, None), pick(0, 1, None), pick("p", "q", None), pick(0.0, -0.0, float("nan"), None), i * 7919 % 1009, pick(None, *range(-50, 50))) for i in range(n)]
    return spark.createDataFrame(rows, f"id long, u long, a int, s string, x double, ro long, date {date}")


@pytest.mark.parametrize("date", ["int", "long", "smallint"])
@pytest.mark.parametrize("gaps", [(1, 2, 3), (2, 5)])
def test_tasks_equal_windows(spark, date, gaps):
    df = _rows(spark, 700, date)
    got = gp.gap_features(df, KEY_SETS, gaps=gaps)
    want = df
    for family in (KEY_SETS[:3], KEY_SETS[3:]):
        want = gp._family_plain(want, family, "ro", "date", gaps, True)
    want = want.select(*got.columns)
    assert got.dtypes == want.dtypes and got.count() == 700
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_two_order_columns_nulls_first(spark):
    rows = [(1, 7, None, "b", 10), (2, 7, None, "a", 4), (3, 7, 0.5, "a", 1), (4, 7, float("nan"), None, 0)]
    df = spark.createDataFrame(rows, "id int, u int, o1 double, o2 string, date int")
    got = {r["id"]: r["ts_u_1_diff_next"] for r in gp.gap_features(df, [["u"]], ["o1", "o2"]).collect()}
    assert got == {2: 6, 1: -9, 3: -1, 4: None}


def test_wide_rows_are_moved_once_a_family_and_never_sorted(spark):
    got = gp.gap_features(_rows(spark, 50), KEY_SETS, out=["id", *gp.feature_names(["u"]), "ts_a_1_diff_next"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort" not in plan and plan.count("Exchange hashpartitioning") == 2
    assert got.columns == ["id", *gp.feature_names(["u"]), "ts_a_1_diff_next"] and got.count() == 50
    assert not gp.gap_features(_rows(spark, 50).where("id < 0"), KEY_SETS).collect()


def test_large_tables_get_more_tasks(spark, monkeypatch):
    monkeypatch.setattr(gp, "ROWS_PER_TASK", 10)
    got = gp.gap_features(_rows(spark, 300), [["u"]])
    assert got.rdd.getNumPartitions() == 31 and got.count() == 300


def test_distinct_counts_move_each_row_once(spark):
    """Users below the bound: one row a feed row is moved, not one a value. A larger user is spread by value; the counts are the same."""
    from clickwise.operators import crossdomain as xd
    r = random.Random(3)
    rows = [(r.choice([1, 2, 3, 4, None]) if i % 2 else 9, r.choice("abc"), r.choice([0.0, -0.0, float("nan"), 1.5, None]), [i % 3], None) for i in range(400)]
    feeds = spark.createDataFrame(rows, "u_userId long, s string, v double, a array<int>, n int")
    cols = ["s", "v", "a", "n"]
    got = xd.user_nunique(feeds, cols, method="dedup")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and plan.count("Exchange") == 1
    spread = xd.user_nunique(feeds, cols, method="dedup", hot_threshold=100)
    assert "Generate" in spread._jdf.queryExecution().executedPlan().toString()
    want = {}
    for u, *vs in rows:
        if u is not None:
            seen = want.setdefault(u, [set() for _ in cols])
            for s, v in zip(seen, vs):
                if v is not None:
                    s.add(str(v + 0.0 if isinstance(v, float) else v))
    want = sorted((u, *map(len, s)) for u, s in want.items())
    assert sorted(map(tuple, got.collect())) == want == sorted(map(tuple, spread.collect()))
    assert got.dtypes == spread.dtypes and not xd.user_nunique(feeds.where("s = 'z'"), cols, method="dedup").collect()


def test_exchanges_move_rows_packed(spark):
    """Between the families, and from the feed log to its users, rows are moved by columns and compressed, not as they are."""
    from clickwise.operators import crossdomain as xd
    got = gp.gap_features(_rows(spark, 3000), KEY_SETS)
    plan = got._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(exchanges) == 2 and all("hashpartitioning(to#" in line for line in exchanges)
    r = random.Random(4)
    feeds = spark.createDataFrame([(r.choice([1, 2, 3, None]), r.choice([None, 0.5, -0.0, 0.0]), r.choice([None, 3, 4]), r.choice("ab")) for _ in range(500)] + [(9, None, None, None)],
                                  "u_userId long, v double, n int, s string")
    got = xd.user_features(feeds, ["v", "n", "s"], ["v", "n"])
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    for method, threshold in (("set", 2_000_000), ("auto", 20)):  # the two aggregates, of which counts may be spread by value
        want = xd.user_features(feeds, ["v", "n", "s"], ["v", "n"], method=method, hot_threshold=threshold)
        assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert not xd.user_features(feeds.where("n = 77"), ["v"], ["n"]).collect()


def test_packed_rows_are_dealt_to_every_partition(spark):
    from clickwise.operators.gap_rows import addresses
    places = addresses(37).tolist()
    where = spark.createDataFrame([(v,) for v in places], "v int").selectExpr("pmod(hash(v), 37) AS p").collect()
    assert [r["p"] for r in where] == list(range(37))
