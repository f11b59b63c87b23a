"""Exploratory aggregates as distributed DataFrame work.

The reference draws these with pandas after collecting whole tables; here
each one is a grouped aggregate whose result is a small table. Global
figures (totals, min/max for bin edges) are scalar subqueries.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.functions.columns import equal_width_bin, right_closed_bin, weight_of
from mercato.operators.quantiles import exact_median


def _half_even(x: Column, d: int) -> Column:
    return F.bround(x.cast("double").try_cast("decimal(38,9)"), d).cast("double")


def share_of_total(df: DataFrame, key: str, count_name: str = "count", pct: bool = False) -> DataFrame:
    """Counts per key with the share of the total (fraction, or percent
    rounded half-even to 2 places)."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias(count_name))
    total = df.select(F.count(F.lit(1))).scalar()
    share = F.col(count_name) / total
    if pct:
        return counts.withColumn("share_pct", _half_even(share * 100.0, 2))
    return counts.withColumn("share", share)


def payment_mix(purchases: DataFrame, method: str = "payment_method", amount: str = "total_price") -> DataFrame:
    total = purchases.select(F.count(F.lit(1))).scalar()
    return purchases.groupBy(method).agg(
        F.count(F.lit(1)).alias("transactions"),
        F.sum(amount).alias("revenue"),
        F.avg(amount).alias("avg_transaction"),
    ).withColumn("share_pct", _half_even(F.col("transactions") / total * 100.0, 2))


def entity_weights(
    clicks: DataFrame, key: str, weights: Mapping[str, float], event_col: str = "event_type"
) -> DataFrame:
    """Sum of event weights per entity (unknown event types weigh 0)."""
    return clicks.groupBy(key).agg(F.sum(weight_of(event_col, weights)).alias("total"))


def histogram(values: DataFrame, c: str, n_bins: int) -> DataFrame:
    """Equal-width histogram over [min, max] with the last bin closed; all
    ``n_bins`` bins are returned, empty ones with count 0."""
    v = values.select(F.col(c).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    lo = v.select(F.min("_v")).scalar()
    hi = v.select(F.max("_v")).scalar()
    counts = v.groupBy(equal_width_bin("_v", lo, hi, n_bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count")
    )
    spark = values.sparkSession
    bins = spark.range(1, n_bins + 1).select(F.col("id").cast("int").alias("bin"))
    width = (hi - lo) / n_bins
    return (
        bins.join(counts, "bin", "left")
        .select(
            "bin",
            (lo + (F.col("bin") - 1) * width).alias("bin_lo"),
            (lo + F.col("bin") * width).alias("bin_hi"),
            F.coalesce("count", F.lit(0)).cast("bigint").alias("count"),
        )
        .where(lo.isNotNull())
    )


def totals_summary(values: DataFrame, c: str, name: str) -> DataFrame:
    """Mean and (interpolated) median of a per-entity total."""
    return values.agg(
        F.lit(name).alias("metric"),
        F.count(F.lit(1)).alias("entities"),
        F.avg(F.col(c).cast("double")).alias("mean"),
    ).withColumn("median", exact_median(values, c))


# Rating bin edges and labels (right-closed, lowest included).
RATING_EDGES = [1, 1.5, 2, 2.5, 3, 3.5, 4, 4.5, 5, 5.01]
RATING_LABELS = ["1.0", "1.5", "2.0", "2.5", "3.0", "3.5", "4.0", "4.5", "5.0"]


def rating_bins(catalog: DataFrame, c: str = "rating") -> DataFrame:
    """Items per rating bin; every label is listed, empty bins with 0."""
    spark = catalog.sparkSession
    binned = catalog.select(right_closed_bin(c, RATING_EDGES, RATING_LABELS).alias("rating_bin"))
    counts = binned.where(F.col("rating_bin").isNotNull()).groupBy("rating_bin").agg(
        F.count(F.lit(1)).alias("items")
    )
    labels = spark.createDataFrame([(lab,) for lab in RATING_LABELS], "rating_bin string")
    return labels.join(counts, "rating_bin", "left").select(
        "rating_bin", F.coalesce("items", F.lit(0)).cast("bigint").alias("items")
    )


def first_attribute_per_user(
    purchases: DataFrame, attr: str, order_by: Sequence[str] = ("purchase_date", "order_id", "line_number")
) -> DataFrame:
    """One value of ``attr`` per user: the one of the earliest purchase."""
    order = F.struct(*[F.col(c) for c in order_by], F.col(attr))
    return purchases.groupBy("user_id").agg(F.min_by(F.col(attr), order).alias(attr))


def crosstab_long(
    clicks: DataFrame, user_attr: DataFrame, attr: str, event_col: str = "event_type", default: str = "Unknown"
) -> DataFrame:
    """Events per (attribute, event type) with the row-normalised share. Clicks are
    counted by (user, event type) before the join, so a hot user is a few rows."""
    per_user = clicks.groupBy("user_id", event_col).agg(F.count(F.lit(1)).alias("n"))
    joined = per_user.join(user_attr, "user_id", "left").fillna({attr: default})
    counts = joined.groupBy(attr, event_col).agg(F.sum("n").alias("events"))
    return counts.withColumn("share", F.col("events") / F.sum("events").over(Window.partitionBy(attr)))


def crosstab_wide(long: DataFrame, attr: str, event_col: str, event_values: Sequence[str]) -> DataFrame:
    """Pivot of the long crosstab over a fixed list of event types; missing
    cells are 0."""
    wide = long.groupBy(attr).pivot(event_col, list(event_values)).agg(F.first("share"))
    return wide.fillna({v: 0.0 for v in event_values})


def top_k(df: DataFrame, key: str, score: str, k: int) -> DataFrame:
    """Top ``k`` rows by score, ties broken by key ascending."""
    return df.orderBy(F.desc(score), F.asc(key)).limit(k)


def interaction_matrix(
    clicks: DataFrame,
    weights: Mapping[str, float],
    n_users: int = 50,
    n_items: int = 100,
    event_col: str = "event_type",
) -> DataFrame:
    """Long (user, item, score) cells of the top-user x top-item matrix."""
    ui = clicks.groupBy("user_id", "item_id").agg(F.sum(weight_of(event_col, weights)).alias("interaction_score"))
    users = top_k(ui.groupBy("user_id").agg(F.sum("interaction_score").alias("s")), "user_id", "s", n_users)
    items = top_k(ui.groupBy("item_id").agg(F.sum("interaction_score").alias("s")), "item_id", "s", n_items)
    # Top-N key lists are bounded by n_users / n_items rows: safe to broadcast.
    return ui.join(F.broadcast(users.select("user_id")), "user_id", "left_semi").join(
        F.broadcast(items.select("item_id")), "item_id", "left_semi"
    )


def matrix_sparsity(cells: DataFrame, score: str = "interaction_score") -> DataFrame:
    """Shape of the pivoted matrix, non-zero cells and sparsity."""
    return cells.agg(
        F.countDistinct("user_id").alias("n_users"),
        F.countDistinct("item_id").alias("n_items"),
        F.count(F.when(F.col(score) > 0, 1)).alias("nonzero"),
    ).withColumn(
        "sparsity",
        F.when(
            F.col("n_users") * F.col("n_items") > 0,
            1.0 - F.col("nonzero") / (F.col("n_users") * F.col("n_items")),
        ),
    )


def pivot_matrix(cells: DataFrame, item_values: Sequence, score: str = "interaction_score") -> DataFrame:
    """Wide user x item matrix over a bounded item list; missing cells 0."""
    wide = cells.groupBy("user_id").pivot("item_id", list(item_values)).agg(F.sum(score))
    return wide.fillna(0)


# Social-mention tiers (lower bounds inclusive).
MENTION_TIERS = [("viral", 1000, None), ("popular", 100, 1000), ("low", None, 100)]


def mention_tiers(df: DataFrame, mentions: str, trend: str) -> DataFrame:
    """Items per mention tier with share, plus overall mean trend and total
    mentions on every row."""
    expr = F.lit(None).cast("string")
    for name, lo, hi in reversed(MENTION_TIERS):
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (F.col(mentions) >= lo)
        if hi is not None:
            cond = cond & (F.col(mentions) < hi)
        expr = F.when(cond, F.lit(name)).otherwise(expr)
    total = df.select(F.count(F.lit(1))).scalar()
    avg_trend = df.select(F.avg(trend)).scalar()
    total_mentions = df.select(F.sum(mentions)).scalar()
    spark = df.sparkSession
    tiers = spark.createDataFrame([(t[0],) for t in MENTION_TIERS], "tier string")
    counts = df.groupBy(expr.alias("tier")).agg(F.count(F.lit(1)).alias("items"))
    return tiers.join(counts, "tier", "left").select(
        "tier",
        F.coalesce("items", F.lit(0)).cast("bigint").alias("items"),
        F.when(total > 0, _half_even(F.coalesce("items", F.lit(0)) / total * 100.0, 1))
        .otherwise(F.lit(0.0))
        .alias("share_pct"),
        avg_trend.cast("double").alias("avg_trend_score"),
        total_mentions.cast("bigint").alias("total_mentions"),
    )
