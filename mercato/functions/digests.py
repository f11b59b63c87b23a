"""Digests of rows and tables that another SQL engine can compute as well.

A row is written as text in one canonical form and hashed with md5; the digest of a
table is the sum of two words of these hashes, so it does not depend on the order
or the partitioning of the rows, and repeated rows count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, TimestampNTZType, TimestampType

# Places to which doubles are rounded: sums of another order differ beyond them.
PLACES = 6
# Hex digits of a word: 60 bits, so that the sum of 10^18 words fits a decimal.
WORD = 15


def canonical_text(column: Column, kind: DataType) -> Column:
    """A value as text: doubles as decimals of ``PLACES`` places (NULL if they
    are none), times in microseconds, everything else as Spark casts it."""
    if isinstance(kind, (DoubleType, FloatType)):
        return F.round(column.cast("double").try_cast("decimal(38,9)"), PLACES).cast(f"decimal(38,{PLACES})").cast("string")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return column.cast("string")


def row_text(df: DataFrame) -> Column:
    """The values of a row in order of the column names, each as its length in
    bytes, ``:`` and its text, or ``-`` if NULL."""
    cells = []
    for f in sorted(df.schema.fields, key=lambda f: f.name):
        text = canonical_text(F.col(f.name), f.dataType)
        cells.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*cells)


def multiset_digest(df: DataFrame) -> Column:
    """Aggregate: the sums of the first two words of the rows' md5, as text."""
    h = F.md5(row_text(df))
    words = [F.conv(F.substring(h, 1 + WORD * i, WORD), 16, 10).cast("decimal(38,0)") for i in range(2)]
    return F.concat_ws(":", *[F.coalesce(F.sum(w), F.lit(0).cast("decimal(38,0)")).cast("string") for w in words])


def row_text_sql(columns: dict[str, str]) -> str:
    """``row_text`` in DuckDB for columns given as name -> kind (double, time, other)."""
    cells = []
    for c, kind in sorted(columns.items()):
        text = {
            "double": f"CAST(CAST(ROUND(TRY_CAST(CAST({c} AS DOUBLE) AS DECIMAL(38,9)), {PLACES}) AS DECIMAL(38,{PLACES})) AS VARCHAR)",
            "time": f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f')",
        }.get(kind, f"CAST({c} AS VARCHAR)")
        cells.append(f"coalesce(strlen({text}) || ':' || {text}, '-')")
    return " || ".join(cells)


def multiset_digest_sql(columns: dict[str, str]) -> str:
    """``multiset_digest`` in DuckDB."""
    h = f"md5({row_text_sql(columns)})"
    words = [f"coalesce(CAST(sum(CAST('0x' || substr({h}, {1 + WORD * i}, {WORD}) AS HUGEINT)) AS VARCHAR), '0')" for i in range(2)]
    return " || ':' || ".join(words)
