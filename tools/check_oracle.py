"""Local correctness check: run each registered query in Spark and its oracle SQL in DuckDB on the
same parquet tables, compare row count, column names and the multiset of rows.

    python tools/check_oracle.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

from clickwise.queries import oracle_sql, queries  # noqa: E402
from clickwise.session import local_session  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


TYPE_MAP = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
            "SMALLINT": "smallint", "TINYINT": "tinyint", "FLOAT": "float", "DATE": "date",
            "TIMESTAMP": "timestamp_ntz"}


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = local_session(8, 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    qs, os_ = queries(), oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf)
            cols = sorted(sdf.columns)
            srows = [tuple(norm(r[c]) for c in cols) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:2000]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in os_:
            print(f"ROWS {name}: {len(srows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            rel = con.sql(os_[name])
            dcols = rel.columns
            drows_raw = rel.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:2000]}")
            bad += 1
            continue
        if sorted(dcols) != cols:
            print(f"FAIL {name}: columns differ spark={cols} duck={sorted(dcols)}")
            bad += 1
            continue
        dtypes = dict(zip(dcols, [str(t) for t in rel.types]))
        stypes = {f.name: f.dataType.simpleString() for f in sdf.schema.fields}
        tdiff = [(c, stypes[c], dtypes[c]) for c in cols if TYPE_MAP.get(dtypes[c], dtypes[c]) != stypes[c]]
        if tdiff:
            print(f"TYPE {name}: types differ {tdiff[:6]}")
        idx = [dcols.index(c) for c in cols]
        drows = [tuple(norm(r[i]) for i in idx) for r in drows_raw]
        cs, cd = Counter(srows), Counter(drows)
        if cs != cd:
            print(f"FAIL {name}: rows spark={len(srows)} duck={len(drows)}; "
                  f"spark-only {list((cs - cd).elements())[:3]} duck-only {list((cd - cs).elements())[:3]}")
            bad += 1
        else:
            print(f"OK   {name}: {len(srows)} rows {ts:.1f}s")
    print(f"{bad} failing")
    spark.stop()


if __name__ == "__main__":
    main()
