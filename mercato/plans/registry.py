"""Registry of named queries and their DuckDB oracle SQL.

Every query takes ``(spark, sf_dir)`` and returns a lazy DataFrame over
the driver tables under ``sf_dir`` (whole tables, no sampling). Results
that are doubles are rounded to 6 decimals *only in the registered form*
(``finish``) so that an order-dependent floating-point sum in Spark and in
DuckDB hashes the same; the library functions return full precision.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from mercato.session import bounded_tasks

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")

        @wraps(fn)
        def query(spark: SparkSession, sf_dir: str) -> DataFrame:
            bounded_tasks(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = query
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def finish(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round double columns for stable hashing.

    Rounding goes through ``decimal(38,9)`` so that exact binary ties (an
    average over 32 rows is one) round the same way in Spark and DuckDB;
    it also folds -0.0 into 0.0."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            dec = F.col(f.name).cast("double").try_cast("decimal(38,9)")
            cols.append(F.round(dec, digits).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def R(expr: str, name: str | None = None, digits: int = DIGITS) -> str:
    """SQL twin of ``finish`` for one column."""
    alias = name or expr
    return f"CAST(ROUND(TRY_CAST(CAST({expr} AS DOUBLE) AS DECIMAL(38,9)), {digits}) AS DOUBLE) AS {alias}"
