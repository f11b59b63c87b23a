"""Exact discrete quantiles (``percentile_disc``) at any scale.

``percentile_disc`` keeps a value -> count map of the whole column in one
final task. That is fine while the number of distinct values is bounded,
so the bound is checked first. Beyond it the quantile is found from a
distributed sort of (value, count): the sorted distinct values are pinned
by a reliable checkpoint, each range partition's total gives an offset
(one row per partition, broadcast), and the running count inside each
partition locates the first value whose cumulative share reaches ``q``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.session import ensure_checkpoint_dir

# Largest distinct-value count whose exact quantile is taken by one
# ``percentile_disc`` (a value -> count map in the final task, ~100 MB).
DEFAULT_DISTINCT_LIMIT = 4_000_000


def percentile_disc_expr(c: str, q: float) -> Column:
    """``percentile_disc(q)`` of column ``c`` cast to double."""
    return F.expr(f"percentile_disc({q!r}) WITHIN GROUP (ORDER BY CAST(`{c}` AS DOUBLE))")


def _cumulative(values: DataFrame, c: str) -> tuple[DataFrame, Column]:
    """Distinct non-NULL values of ``c`` with ``_pos`` = number of rows with
    a value <= it, and the scalar row count ``n``."""
    vc = values.where(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("_cnt"))
    ensure_checkpoint_dir(values.sparkSession)
    pinned = vc.orderBy(c).withColumn("_mid", F.monotonically_increasing_id()).checkpoint(eager=True)
    pid = F.shiftright(F.col("_mid"), 33)
    totals = pinned.groupBy(pid.alias("_pid")).agg(F.sum("_cnt").alias("_tot"))
    # One row per sort partition: bounded by the partition count.
    offsets = totals.withColumn(
        "_off",
        F.coalesce(
            F.sum("_tot").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0),
        ),
    ).select("_pid", "_off")
    n = pinned.select(F.sum("_cnt")).scalar()
    running = pinned.withColumn("_pid", pid).withColumn(
        "_cum", F.sum("_cnt").over(Window.partitionBy("_pid").orderBy("_mid"))
    )
    located = running.join(F.broadcast(offsets), "_pid").withColumn("_pos", F.col("_off") + F.col("_cum"))
    return located, n


def _value_at(located: DataFrame, c: str, rank: Column) -> Column:
    """Value of 1-based rank ``rank`` in sorted order (scalar subquery)."""
    return located.where(F.col("_pos") >= rank).select(F.min(c)).scalar()


def _distributed_quantile(values: DataFrame, c: str, q: float) -> Column:
    located, n = _cumulative(values, c)
    return _value_at(located, c, F.lit(q) * n)


def exact_median(df: DataFrame, c: str, distinct_limit: int = DEFAULT_DISTINCT_LIMIT) -> Column:
    """Interpolated median (mean of the two middle values for an even
    count), as pandas ``median`` and SQL ``median``. Returns a scalar
    subquery column."""
    values = df.select(F.col(c).cast("double").alias(c))
    if small_distinct(values, [c], distinct_limit)[c]:
        return values.select(F.median(c)).scalar()
    located, n = _cumulative(values, c)
    lo = F.floor((n - 1) / 2) + 1
    hi = F.ceil((n - 1) / 2) + 1
    return (_value_at(located, c, lo) + _value_at(located, c, hi)) / 2


def small_distinct(df: DataFrame, cols: list[str], limit: int = DEFAULT_DISTINCT_LIMIT) -> dict[str, bool]:
    """Which columns have at most ``limit`` distinct values, from one
    HyperLogLog pass (5 % relative standard error; the estimate is
    compared with half the limit, a margin of many standard errors, so an
    underestimate cannot pass a column that is really over the limit)."""
    if not cols:
        return {}
    row = df.agg(*[F.approx_count_distinct(F.col(c)).alias(c) for c in cols]).first()
    return {c: (row[c] or 0) <= limit // 2 for c in cols}


def exact_quantile(
    df: DataFrame, c: str, q: float, distinct_limit: int = DEFAULT_DISTINCT_LIMIT, small: bool | None = None
) -> tuple[Column, bool]:
    """Return (expression, is_aggregate). When the distinct-value count is
    within ``distinct_limit`` the expression is a ``percentile_disc``
    aggregate to put into a single-pass ``agg``; otherwise it is a scalar
    subquery computed by the distributed path."""
    values = df.select(F.col(c).cast("double").alias(c))
    if small is None:
        small = small_distinct(values, [c], distinct_limit)[c]
    if small:
        return percentile_disc_expr(c, q), True
    return _distributed_quantile(values, c, q), False


def exact_quantile_exprs(
    df: DataFrame,
    cols: list[str],
    q: float,
    accuracy: int = 10_000,
    candidate_limit: int = DEFAULT_DISTINCT_LIMIT,
    collect_all_limit: int = 1_000_000,
) -> dict[str, tuple[Column, bool]]:
    """Exact ``percentile_disc(q)`` for several columns without a
    value->count map of the whole column.

    0. One pass: the non-NULL count n of each column. A column with at most
       ``collect_all_limit`` values is answered inside the caller's
       aggregate from its sorted values (bounded by that check).
    1. Larger columns, one pass: ``percentile_approx`` at q -/+ 3/accuracy;
       its rank error is at most n/accuracy, so the exact answer lies
       between the two returned values.
    2. One pass: exact counts below and inside that bracket, which verify it.
    3. The caller's aggregate collects only the bracketed values (about
       6n/accuracy of them, checked against ``candidate_limit``) and takes the
       value at rank ceil(q n) - below from the sorted candidates.

    Returns, per column, (expression, is_aggregate). A column whose bracket
    fails the check or is too large uses the distributed sort instead.
    Each step brings back a few numbers per column.
    """
    import math

    if not cols:
        return {}
    x = {c: F.col(c).cast("double") for c in cols}
    counts = df.agg(*[F.count(x[c]).alias(f"n_{i}") for i, c in enumerate(cols)]).first()
    out: dict[str, tuple[Column, bool]] = {}
    large = []
    for i, c in enumerate(cols):
        n = counts[f"n_{i}"] or 0
        if n == 0:
            out[c] = (F.lit(None).cast("double"), False)
        elif n <= min(collect_all_limit, candidate_limit):
            k = max(1, math.ceil(q * n))
            out[c] = (F.element_at(F.sort_array(F.collect_list(x[c])), k), True)
        else:
            large.append((i, c, n))
    if not large:
        return out
    eps = 3.0 / accuracy
    lo_q, hi_q = max(0.0, q - eps), min(1.0, q + eps)
    first = df.agg(
        *[F.percentile_approx(x[c], [lo_q, hi_q], accuracy).alias(f"b_{i}") for i, c, n in large]
    ).first()
    checks = [(i, c, n, *first[f"b_{i}"]) for i, c, n in large]
    second = df.agg(
        *[F.count(F.when(x[c] < lo, 1)).alias(f"below_{i}") for i, c, n, lo, hi in checks],
        *[F.count(F.when((x[c] >= lo) & (x[c] <= hi), 1)).alias(f"mid_{i}") for i, c, n, lo, hi in checks],
    ).first()
    for i, c, n, lo, hi in checks:
        k = max(1, math.ceil(q * n))
        below, mid = second[f"below_{i}"], second[f"mid_{i}"]
        if below < k <= below + mid and mid <= candidate_limit:
            cand = F.sort_array(F.collect_list(F.when((x[c] >= lo) & (x[c] <= hi), x[c])))
            out[c] = (F.element_at(cand, k - below), True)
        else:
            out[c] = (_distributed_quantile(df.select(x[c].alias(c)), c, q), False)
    return out
