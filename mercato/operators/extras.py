"""Capabilities the reference only declares (lineage text, docstrings):
repair instead of drop, temporal patterns, correlations, cohorts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import clip


def repair(
    df: DataFrame,
    fills: Mapping[str, object] | None = None,
    clips: Mapping[str, tuple[float | None, float | None]] | None = None,
    recompute: Mapping[str, object] | None = None,
) -> DataFrame:
    """Repair policy: fill defaults, clamp ranges (NULL stays NULL) and
    recompute derived columns (``recompute`` maps column -> Column)."""
    out = df.fillna(dict(fills)) if fills else df
    if clips:
        out = out.withColumns({c: clip(c, lo, hi) for c, (lo, hi) in clips.items()})
    if recompute:
        out = out.withColumns(dict(recompute))
    return out


def with_time_parts(df: DataFrame, ts: str) -> DataFrame:
    """Event time cast to timestamp (text is parsed leniently) plus hour
    and day of week (1 = Sunday ... 7 = Saturday)."""
    t = F.try_to_timestamp(F.col(ts).cast("string")) if dict(df.dtypes)[ts] == "string" else F.col(ts)
    return df.withColumn(ts, t).withColumns({"hour": F.hour(ts), "day_of_week": F.dayofweek(ts)})


def temporal_patterns(df: DataFrame, ts: str, by: Sequence[str] = ()) -> DataFrame:
    """Event counts per (hour, day of week[, by...])."""
    return with_time_parts(df, ts).groupBy("day_of_week", "hour", *by).agg(F.count(F.lit(1)).alias("events"))


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, one aggregate pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1 :]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    rows = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"{a}__{b}").alias("correlation"))
        for a, b in pairs
    ]
    return wide.select(F.inline(F.array(*rows)))


def cohorts(df: DataFrame, user: str, ts: str) -> DataFrame:
    """First-month cohorts: active users per (cohort month, month offset),
    cohort size and retention share."""
    month = F.trunc(F.col(ts).cast("date"), "month")
    acts = df.select(user, month.alias("activity_month")).distinct()
    first = acts.groupBy(user).agg(F.min("activity_month").alias("cohort_month"))
    j = acts.join(first, user)
    offset = F.months_between("activity_month", "cohort_month").cast("int")
    grid = j.groupBy("cohort_month", offset.alias("month_offset")).agg(F.count(F.lit(1)).alias("active_users"))
    size = first.groupBy("cohort_month").agg(F.count(F.lit(1)).alias("cohort_size"))
    return grid.join(size, "cohort_month").withColumn("retention", F.col("active_users") / F.col("cohort_size"))
