"""Results do not depend on the number of shuffle partitions (ordinals, samples, folds, codes, gaps)."""

import pytest

from clickwise.queries import queries
from conftest import SF_SMALL

NAMES = ["label_encode", "kfold_exact", "kfold_stratified", "sample_stratified", "gap_next_last", "sort_with_rank",
         "parity_run", "global_lag"]


@pytest.mark.parametrize("name", NAMES)
def test_same_result_for_1_and_37_partitions(spark, name):
    q = queries()[name]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        results = []
        for n in ("1", "37"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = q(spark, SF_SMALL)
            results.append(sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect()))
        assert results[0] == results[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
