"""Every registered query with an oracle agrees with DuckDB on the small test tables."""

import math
from collections import Counter

import duckdb
import pytest

from clickwise.queries import oracle_sql, queries
from conftest import SF_SMALL

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]
ORACLE = oracle_sql()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    sdf = queries()[name](spark, SF_SMALL)
    cols = sorted(sdf.columns)
    got = Counter(tuple(_norm(r[c]) for c in cols) for r in sdf.collect())
    rel = con.sql(ORACLE[name])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    want = Counter(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert got == want


def test_every_query_has_oracle_or_is_a_model():
    missing = set(queries()) - set(ORACLE)
    models = {"lr_baseline", "gbt_cat", "gbt_lgb", "gbt_xgb", "predict_proba", "cv_oof", "cv_test_mean",
              "cv_fold_scores", "fusion_stacking", "fusion_fitted", "fusion_fold_scores", "pipeline_submission"}
    assert missing <= models
