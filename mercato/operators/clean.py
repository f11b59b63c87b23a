"""Cleaning: tagged waterfall, deduplication and the cleaned table.

The reference filters step by step and counts before and after each rule
(two jobs per rule). Here each row is tagged once with the first failing
step, in the order missing (column order) -> domain -> range, and the
waterfall is a conditional count over the tags. Duplicates are counted
among the survivors only, and the active filter runs last, on the
deduplicated rows, as in the sequential version.

Deduplication keeps one row per key with an explicit order (the whole row
breaks remaining ties), so the survivor is deterministic. It is a
``row_number() = 1`` filter, which Spark plans with a partial
``WindowGroupLimit`` before the shuffle: every executor keeps only its
best row per key, so a hot key arrives at its reducer as one row per map
partition, never as the whole group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.columns import count_when, missing
from mercato.operators.rules import TableSpec

STEPS = ["missing", "domain", "range", "duplicates", "inactive"]


def tag_reason(df: DataFrame, spec: TableSpec) -> Column:
    """First failing step of a row, NULL when it passes all row rules.
    Columns whose names start with ``_`` are never a reason to drop."""
    types = {f.name: f.dataType for f in df.schema.fields}
    key_cols = [c for c in df.columns if not c.startswith("_")]
    expr = F.lit(None).cast("string")
    # Build from the last step backwards so the first failing one wins.
    for r in reversed(list(spec.range_rules)):
        expr = F.when(r.drop(), F.lit("range")).otherwise(expr)
    for r in reversed(list(spec.domain_rules)):
        expr = F.when(r.drop(), F.lit("domain")).otherwise(expr)
    if key_cols:
        any_missing = F.lit(False)
        for c in key_cols:
            any_missing = any_missing | missing(c, types[c])
        expr = F.when(any_missing, F.lit("missing")).otherwise(expr)
    return expr


def dedupe(
    df: DataFrame,
    keys: Sequence[str] | None,
    order_by: Sequence[str] = (),
    keep: str = "first",
) -> DataFrame:
    """One row per key. ``keep="first"`` keeps the row with the smallest
    ``order_by`` values, ``"last"`` the largest; remaining ties are broken
    by the whole row. Without keys, exact duplicate rows are dropped."""
    if not keys:
        return df.dropDuplicates()
    cols = df.columns
    ordering = [F.col(c) for c in list(order_by) + cols]
    ordering = [c.asc_nulls_first() for c in ordering] if keep == "first" else [c.desc_nulls_last() for c in ordering]
    w = Window.partitionBy(*keys).orderBy(*ordering)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def clean(df: DataFrame, spec: TableSpec) -> DataFrame:
    """The cleaned table (silver): row rules, dedupe, then the active filter."""
    survivors = df.where(tag_reason(df, spec).isNull())
    out = dedupe(survivors, list(spec.pk) or None, spec.order_by, spec.keep)
    if spec.active_col:
        out = out.where(F.col(spec.active_col) == F.lit(True))
    return out


def cleaning_waterfall(df: DataFrame, spec: TableSpec) -> DataFrame:
    """One row: original rows, rows removed per step, final rows, retention.

    Two aggregates (tag counts; survivors after dedupe) combined through
    scalar subqueries, so the input is scanned by the jobs that need it
    and no partial result goes through the driver."""
    spark = df.sparkSession
    tagged = df.withColumn("_reason", tag_reason(df, spec))
    counts = tagged.agg(
        F.count(F.lit(1)).alias("original_rows"),
        count_when(F.col("_reason") == "missing").alias("removed_missing"),
        count_when(F.col("_reason") == "domain").alias("removed_domain"),
        count_when(F.col("_reason") == "range").alias("removed_range"),
        count_when(F.col("_reason").isNull()).alias("_survivors"),
    )
    survivors = tagged.where(F.col("_reason").isNull()).drop("_reason")
    if spec.active_col or not spec.pk:
        # The active filter looks at the surviving row of each key, so the
        # deduplicated rows are needed.
        deduped = dedupe(survivors, list(spec.pk) or None, spec.order_by, spec.keep)
        if spec.active_col:
            inactive = count_when(~F.coalesce(F.col(spec.active_col) == F.lit(True), F.lit(False)))
        else:
            inactive = F.lit(0)
        after = deduped.agg(F.count(F.lit(1)).alias("_deduped"), inactive.alias("removed_inactive"))
    else:
        # Only the number of distinct keys among survivors matters: one
        # distinct count, no sort of whole rows.
        key = F.struct(*[F.col(c) for c in spec.pk])
        after = tagged.agg(
            F.countDistinct(F.when(F.col("_reason").isNull(), key)).alias("_deduped"),
            F.lit(0).alias("removed_inactive"),
        )
    q = {name: counts.select(name).scalar() for name in counts.columns}
    a = {name: after.select(name).scalar() for name in after.columns}
    one = spark.range(1).select(
        F.lit(spec.source).alias("source"),
        q["original_rows"].cast("bigint").alias("original_rows"),
        q["removed_missing"].cast("bigint").alias("removed_missing"),
        q["removed_domain"].cast("bigint").alias("removed_domain"),
        q["removed_range"].cast("bigint").alias("removed_range"),
        (q["_survivors"] - a["_deduped"]).cast("bigint").alias("removed_duplicates"),
        a["removed_inactive"].cast("bigint").alias("removed_inactive"),
    )
    removed = sum(F.col(f"removed_{s}") for s in STEPS)
    return one.withColumns(
        {
            "final_rows": F.col("original_rows") - removed,
            "total_removed": removed,
        }
    ).withColumn(
        "retention_pct",
        F.when(
            F.col("original_rows") > 0,
            F.bround((F.lit(100.0) * F.col("final_rows") / F.col("original_rows")).try_cast("decimal(38,9)"), 2).cast(
                "double"
            ),
        ).otherwise(F.lit(0.0)),
    )


def waterfall_with_total(parts: Sequence[DataFrame]) -> DataFrame:
    """Per-source waterfalls plus a TOTAL row, from one ``rollup`` over the
    union (sums per source and overall; retention recomputed)."""
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    counts = [c for c in u.columns if c not in ("source", "retention_pct")]
    rolled = u.rollup("source").agg(*[F.sum(c).cast("bigint").alias(c) for c in counts])
    rolled = rolled.withColumn("source", F.coalesce(F.col("source"), F.lit("TOTAL")))
    return rolled.withColumn(
        "retention_pct",
        F.when(
            F.col("original_rows") > 0,
            F.bround((F.lit(100.0) * F.col("final_rows") / F.col("original_rows")).try_cast("decimal(38,9)"), 2).cast(
                "double"
            ),
        ).otherwise(F.lit(0.0)),
    ).select(*u.columns)
