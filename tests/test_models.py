"""Invariants of the learners and the cross-validation (model fits are not SQL-checkable)."""

from pyspark.sql import functions as F

from clickwise.plans import evaluate as ev
from clickwise.plans import fusion as fu
from clickwise.plans import models as md


def _planted(spark, n=600, signal=True):
    rows = []
    for i in range(n):
        x = (i * 7919) % 1000 / 1000.0
        y = int(x > 0.5) if signal else (i * 31) % 2
        rows.append((i, y, x, float((i * 13) % 7)))
    return spark.createDataFrame(rows, "log_id long, label int, x double, z double")


def test_cv_oof_covers_each_row_once_and_test_is_fold_mean(spark):
    df = _planted(spark)
    train, test = df.where("log_id < 500"), df.where("log_id >= 500").drop("label")
    r = md.cv_model(md.gbt_lgb(5), train, test, ["x", "z"])
    oof = r.oof.collect()
    assert sorted(x["log_id"] for x in oof) == list(range(500))
    assert all(0.0 <= x["p"] <= 1.0 for x in oof)
    means = r.test_by_fold.groupBy("log_id").agg(F.avg("p").alias("m"))
    diff = r.test.join(means, "log_id").select(F.max(F.abs(F.col("p") - F.col("m")))).first()[0]
    assert diff < 1e-12 and r.test.count() == 100
    scores = r.scores.collect()
    assert len(scores) == 5 and min(s["auc"] for s in scores) > 0.9


def test_fold_sizes_differ_by_at_most_one(spark):
    from clickwise.operators.sampling import kfold_exact
    sizes = [r["count"] for r in kfold_exact(_planted(spark, 503), 5).groupBy("fold").count().collect()]
    assert sorted(sizes) == [100, 100, 101, 101, 101]


def test_auc_on_noise_is_near_half_and_ties_get_half_credit(spark):
    noise = ev.auc(_planted(spark, 2000, signal=False), "x", "label").first()["auc"]
    assert 0.4 < noise < 0.6
    ties = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9), (0, 0.1)], "label int, s double")
    # pairs: (0.5 vs 0.5) = 1/2, (0.5 vs 0.1) = 1, (0.9 vs 0.5) = 1, (0.9 vs 0.1) = 1 -> 3.5 / 4
    assert ev.auc(ties, "s", "label").first()["auc"] == 0.875


def test_logistic_and_stacking_run(spark):
    df = _planted(spark, 400)
    train, test = df.where("log_id < 300"), df.where("log_id >= 300").drop("label")
    res = fu.run_learners([md.gbt_lgb(3), md.gbt_xgb(3)], train, test, ["x", "z"])
    names = list(res)
    oof = fu.oof_matrix(fu.long_predictions(res, "oof"), names)
    tst = fu.oof_matrix(fu.long_predictions(res, "test"), names)
    stacked = fu.stack_model(oof, tst, names, train.select("log_id", "label"))
    preds = stacked.test.collect()
    assert len(preds) == 100 and all(0.0 <= p["p"] <= 1.0 for p in preds)
    avg = fu.average_probability(fu.long_predictions(res, "test_by_fold")).count()
    assert avg == 100


def test_model_queries_use_every_feature_and_the_learners_rounds(spark, monkeypatch):
    from clickwise.plans import catalog as ct
    from conftest import SF_SMALL
    want = set(ct.ctr_feature_frame(spark, SF_SMALL).columns) - {"log_id", "label", "istest", "ro"}
    assert set(ct.MODEL_COLS) == want and len(want) > 490
    learners = []
    monkeypatch.setattr(ct, "_cv", lambda spark, sf, learner: learners.append(learner) or md.CVResult(*[spark.range(1).withColumn("p", F.lit(0.0))] * 4, []))
    for q in (ct.q_gbt_cat, ct.q_gbt_lgb, ct.q_gbt_xgb):
        q(spark, SF_SMALL)
    assert {x.name: x.rounds for x in learners} == {"cat": 20_000, "lgb": 100, "xgb": 100}
    assert {x.name: x.patience for x in learners} == {"cat": 50, "lgb": None, "xgb": None}


def test_no_single_input_separates_the_label(spark):
    """Each raw input's best AUC (either direction, values ordered by their click rate on other rows) stays near chance."""
    from clickwise.sources import analog
    from conftest import SF_SMALL
    a = analog.ads(spark, SF_SMALL.replace("0.001", "0.01")).where("istest = 0").toPandas()
    inputs = [c for c in a.columns if c not in ("log_id", "label", "istest", "ro", "pt_d", "app_score")]
    half = a.log_id % 2 == 0
    for c in inputs:
        rate = a[half].groupby(a[c].astype(str)).label.mean()
        score = a[~half][c].astype(str).map(rate).fillna(a.label.mean())
        y = a[~half].label
        rank = score.rank()
        auc = (rank[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())
        assert 0.44 < auc < 0.56, c


def test_logistic_gradient_is_zero_in_sql(spark):
    """DuckDB recomputes the penalised gradient at the returned terms from the same rows."""
    import duckdb
    from clickwise.plans import catalog as ct
    from clickwise.plans import logistic as lg
    from clickwise.sources import analog
    from conftest import SF_SMALL
    train, test = ct._lr_frames(spark, SF_SMALL)
    model = ct._lr_model(train)
    con = duckdb.connect()
    con.register("t", train.toPandas())
    z = " + ".join([repr(model.intercept)] + [f"({c!r}) * {f}" for f, c in zip(model.features, model.coefficients)])
    for f, c in zip(["1.0", *model.features], [0.0, *model.coefficients]):
        g = con.sql(f"SELECT sum((1 / (1 + exp(-({z}))) - label) * {f}) / count(*), count(*) FROM t").fetchall()[0]
        assert abs(g[0] + c / g[1]) < 1e-9
    assert model.gradient < 1e-9 and 0 < model.steps < lg.MAX_STEPS
    p = [r["pctr"] for r in md.predict_proba(model, test, "pctr").collect()]
    assert len(p) == 200 and all(0 < x < 1 for x in p)


def test_logistic_on_odd_frames(spark):
    from clickwise.plans import logistic as lg
    schema = "log_id long, label int, x double"
    assert lg.fit_logistic(spark.createDataFrame([], schema), ["x"]).terms() == {"(intercept)": 0.0, "x": 0.0}
    even = spark.createDataFrame([(i, i // 2 % 2, float(i % 2)) for i in range(40)] + [(99, None, 5.0)], schema)
    assert abs(lg.fit_logistic(even, ["x"]).coefficients[0]) < 1e-9
    apart = spark.createDataFrame([(i, i % 2, float(i % 2)) for i in range(40)], schema)
    a, b = (lg.fit_logistic(apart.repartition(k), ["x"]) for k in (1, 7))
    assert a.gradient < 1e-9 and abs(a.coefficients[0] - b.coefficients[0]) < 1e-9


def test_submission_run_end_to_end(spark, monkeypatch):
    """All steps from the two logs to the file, with few rounds; the stored table is narrow, partitioned, and pruned when read."""
    from clickwise.plans import catalog as ct
    from clickwise.plans import submission as sub
    from conftest import SF_SMALL
    got = sub.run(*ct.submission_inputs(spark, SF_SMALL), learner=md.gbt_lgb(2))
    rows = got.submission.collect()
    assert got.submission.columns == ["log_id", "pctr"] and len(rows) == len({r["log_id"] for r in rows}) == 200
    assert all(0 < r["pctr"] < 1 for r in rows) and got.scores.count() == 5
    assert dict(got.table.dtypes)["site_id"] == "tinyint"
    assert "PartitionFilters: [isnotnull(istest" in got.table.where("istest = 1")._jdf.queryExecution().toString()
    assert {(r["istest"], r["fold"]) for r in got.table.select("istest", "fold").distinct().collect()} == {(0, i) for i in range(5)} | {(1, -1)}
