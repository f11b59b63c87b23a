"""Registered declared-only extras."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import extras as X
from mercato.plans.oracle_views import with_views
from mercato.plans.registry import R, finish, register
from mercato.sources import tables as T

# Repair defaults and clamps declared by the reference.
PURCHASE_FILLS = {"payment_method": "UNSPECIFIED"}
SIGNAL_CLIPS = {"popularity_score": (0.0, 1.0), "avg_sentiment": (-1.0, 1.0), "return_rate": (0.0, 1.0)}
RATING_CLIP = {"rating": (1.0, 5.0)}


def _clip_sql(c: str, lo: float, hi: float) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN {c} < {lo} THEN {lo} WHEN {c} > {hi} THEN {hi} ELSE {c} END"


@register(
    "repair_purchases",
    with_views(
        ["purch"],
        "SELECT order_id, line_number, user_id, item_id, quantity, "
        f"{R('unit_price')}, {R('unit_price * quantity', 'total_price')}, purchase_date, "
        "coalesce(payment_method, 'UNSPECIFIED') AS payment_method FROM purch",
    ),
)
def q_repair_purchases(spark, sf_dir):
    p = T.purchases(spark, sf_dir)
    out = X.repair(p, fills=PURCHASE_FILLS, recompute={"total_price": F.col("unit_price") * F.col("quantity")})
    return finish(out)


@register(
    "repair_catalog_signals",
    with_views(
        ["cat", "sig"],
        "SELECT c.item_id, "
        + R(_clip_sql("c.rating", 1.0, 5.0), "rating")
        + ", "
        + ", ".join(R(_clip_sql(f"s.{k}", lo, hi), k) for k, (lo, hi) in SIGNAL_CLIPS.items())
        + " FROM cat c LEFT JOIN sig s ON c.item_id = s.item_id",
    ),
)
def q_repair_catalog_signals(spark, sf_dir):
    cat = T.catalog(spark, sf_dir).select("item_id", "rating")
    sig = T.signals(spark, sf_dir).select("item_id", *SIGNAL_CLIPS)
    out = X.repair(cat.join(sig, "item_id", "left"), clips={**RATING_CLIP, **SIGNAL_CLIPS})
    return finish(out)


@register(
    "temporal_patterns",
    with_views(
        ["clicks"],
        "SELECT CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week, CAST(hour(ts) AS INTEGER) AS hour, count(*) AS events "
        "FROM clicks GROUP BY 1, 2",
    ),
)
def q_temporal_patterns(spark, sf_dir):
    return X.temporal_patterns(T.clickstream(spark, sf_dir), "ts")


_CORR_COLS = ["quantity", "unit_price", "total_price"]


@register(
    "correlations",
    with_views(
        ["purch"],
        " UNION ALL ".join(
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, {R(f'corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))', 'correlation')} FROM purch"
            for i, a in enumerate(_CORR_COLS)
            for b in _CORR_COLS[i + 1 :]
        ),
    ),
)
def q_correlations(spark, sf_dir):
    return finish(X.correlations(T.purchases(spark, sf_dir), _CORR_COLS))


@register(
    "cohorts",
    with_views(
        ["purch"],
        """
acts AS (SELECT DISTINCT user_id, date_trunc('month', CAST(purchase_date AS DATE)) AS activity_month FROM purch),
firsts AS (SELECT user_id, min(activity_month) AS cohort_month FROM acts GROUP BY user_id),
grid AS (SELECT f.cohort_month, CAST(date_diff('month', f.cohort_month, a.activity_month) AS INTEGER) AS month_offset,
                count(*) AS active_users
         FROM acts a JOIN firsts f ON a.user_id = f.user_id GROUP BY 1, 2),
sizes AS (SELECT cohort_month, count(*) AS cohort_size FROM firsts GROUP BY cohort_month)
SELECT CAST(g.cohort_month AS DATE) AS cohort_month, g.month_offset, g.active_users, s.cohort_size, """
        + R("g.active_users / s.cohort_size", "retention")
        + " FROM grid g JOIN sizes s ON g.cohort_month = s.cohort_month",
    ),
)
def q_cohorts(spark, sf_dir):
    return finish(X.cohorts(T.purchases(spark, sf_dir), "user_id", "purchase_date"))
