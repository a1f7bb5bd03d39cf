"""Registered queries: a Spark callable and (where SQL can express it) the DuckDB oracle text.

Every query reads the test tables of ``sf_dir`` through the domain roles in
:mod:`clickwise.sources.analog`; computed columns carry the same alias on both sides, and doubles
are rounded to 6 places on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickwise.sources import analog

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = analog.with_views(sql)
        return fn
    return deco


def round_doubles(df: DataFrame, digits: int = 6, skip=(), only=None) -> DataFrame:
    return df.select(*[F.round(F.col(f.name), digits).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and f.name not in skip
                       and (only is None or f.name in only)
                       else F.col(f.name)
                       for f in df.schema.fields])


def _load_all():
    # Importing the query modules fills QUERIES / ORACLE.
    from clickwise.plans import catalog  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(ORACLE)
