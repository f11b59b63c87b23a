"""Column-level helpers. All return Spark ``Column`` expressions, so they
stay inside whole-stage codegen (no Python UDF anywhere)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num: str | Column, den: str | Column, default: float = 0.0) -> Column:
    """``num / den`` when ``den > 0``, else ``default`` (ANSI division by
    zero raises, so the guard is part of the expression)."""
    n, d = col_(num), col_(den)
    return F.when(d > 0, n.cast("double") / d).otherwise(F.lit(default))


def count_when(cond: Column) -> Column:
    """Conditional count; NULL conditions count as false."""
    return F.sum(F.when(cond, 1).otherwise(0))


def missing(c: str, data_type) -> Column:
    """Missing = NULL, or the empty string for string columns."""
    if isinstance(data_type, StringType):
        return F.col(c).isNull() | (F.col(c) == "")
    return F.col(c).isNull()


def weight_of(event_col: str | Column, weights: Mapping[str, float]) -> Column:
    """Map an event type to its weight; unknown types weigh 0."""
    expr = F.lit(0)
    for k, w in weights.items():
        expr = F.when(col_(event_col) == k, F.lit(w)).otherwise(expr)
    return expr


def clip(c: str | Column, lo: float | None, hi: float | None) -> Column:
    """Clamp into ``[lo, hi]``; NULL stays NULL."""
    x = col_(c)
    out = x
    if lo is not None:
        out = F.when(out < lo, F.lit(lo)).otherwise(out)
    if hi is not None:
        out = F.when(out > hi, F.lit(hi)).otherwise(out)
    return F.when(x.isNull(), F.lit(None)).otherwise(out)


def short_id(*parts: str | Column, length: int = 12) -> Column:
    """First ``length`` hex digits of md5 over the parts joined by ``_``."""
    return F.substring(F.md5(F.concat_ws("_", *[col_(p) for p in parts])), 1, length)


def entity_key(namespace: str | Column, entity: str | Column) -> Column:
    """Serving key ``namespace:entity_id``."""
    ns = F.lit(namespace) if isinstance(namespace, str) else namespace
    return F.concat_ws(":", ns, col_(entity).cast("string"))


def equal_width_bin(x: str | Column, lo: Column, hi: Column, n_bins: int) -> Column:
    """1-based equal-width bin over ``[lo, hi]`` with the last bin closed.

    ``width_bucket`` returns ``n + 1`` at the maximum and NULL when
    ``lo == hi``; both are folded into the valid range."""
    v = col_(x)
    raw = F.floor((v - lo) / (hi - lo) * n_bins) + 1
    return (
        F.when(v.isNull(), F.lit(None))
        .when(hi == lo, F.lit(1))
        .otherwise(F.least(F.greatest(raw, F.lit(1)), F.lit(n_bins)))
        .cast("int")
    )


def right_closed_bin(x: str | Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval ``(e[i], e[i+1]]`` containing x;
    the first interval also includes its left edge. Values outside all
    intervals give NULL."""
    v = col_(x)
    expr = F.lit(None).cast("string")
    for i in range(len(edges) - 2, -1, -1):
        lo, hi = edges[i], edges[i + 1]
        cond = (v > lo) & (v <= hi) if i > 0 else (v >= lo) & (v <= hi)
        expr = F.when(cond, F.lit(labels[i])).otherwise(expr)
    return expr


def nan_to_null(c: str) -> Column:
    return F.when(F.isnan(F.col(c)), F.lit(None)).otherwise(F.col(c)).alias(c)
