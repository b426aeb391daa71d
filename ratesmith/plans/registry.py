"""Registered queries: one per operator of the inventory, each with its
DuckDB oracle where the semantics are expressible in SQL.

Every query reads the given tables (through the fixture views) in full.
Doubles are rounded to 6 places on both sides, since floating sums depend on
the order rows are combined in.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratesmith.plans.oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
_ORACLE_SRC: dict[str, tuple[str, tuple[str, ...]]] = {}

ROUND_PLACES = 6


def round_doubles(df: DataFrame, places: int = ROUND_PLACES) -> DataFrame:
    """Round every double column (float sums are order dependent)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), places).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def rounded_sql(sql: str, doubles: Sequence[str]) -> str:
    """Wrap an oracle SELECT so the listed double columns are rounded."""
    if not doubles:
        return with_views(sql)
    repl = ", ".join(f"round({c}, {ROUND_PLACES}) AS {c}" for c in doubles)
    return with_views(f"SELECT * REPLACE ({repl}) FROM (\n{sql}\n) q")


def register(name: str, sql: str | None = None, doubles: Sequence[str] = ()):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            _ORACLE_SRC[name] = (sql, tuple(doubles))
        return fn
    return deco


def oracle_strings() -> dict[str, str]:
    """Self-contained oracle SQL per query (views expanded once all are defined)."""
    return {name: rounded_sql(sql, doubles) for name, (sql, doubles) in _ORACLE_SRC.items()}
