"""Registered feature-table queries."""

from __future__ import annotations

import re

from mercato.plans import features as feat
from mercato.plans.oracle_views import with_views
from mercato.plans.registry import R, finish, register
from mercato.sources import tables as T

# Fixed values for the test data: the event stream is January 2024, so
# recency is measured from 2024-02-01; ``signup`` plays the cart role.
REFERENCE_DATE = "2024-02-01"
ROLES = T.EVENT_ROLES


def _inputs(spark, sf_dir):
    return (
        T.clickstream(spark, sf_dir),
        T.purchases(spark, sf_dir),
        T.catalog(spark, sf_dir),
    )


def user_features_df(spark, sf_dir):
    clicks, purch, cat = _inputs(spark, sf_dir)
    return feat.user_features(
        clicks,
        purch,
        cat,
        REFERENCE_DATE,
        device_col="event_type",
        time_col="ts",
        roles=ROLES,
    )


def item_features_df(spark, sf_dir):
    clicks, purch, cat = _inputs(spark, sf_dir)
    return feat.item_features(clicks, purch, cat, T.signals(spark, sf_dir), roles=ROLES, time_col="ts")


def user_item_features_df(spark, sf_dir):
    return feat.user_item_features(T.clickstream(spark, sf_dir), T.purchases(spark, sf_dir), roles=ROLES, time_col="ts")


_USER_BODY = f"""
ca AS (
  SELECT user_id, count(*) AS user_total_events,
         count(DISTINCT item_id) AS user_distinct_items,
         max(ts) AS last_ev, min(ts) AS first_ev,
         CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS user_view_count,
         CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS user_click_count,
         CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS user_cart_count
  FROM clicks GROUP BY user_id),
dm AS (
  SELECT user_id, event_type AS user_preferred_device FROM (
    SELECT user_id, event_type,
           row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, event_type) AS rn
    FROM clicks WHERE event_type IS NOT NULL GROUP BY user_id, event_type) t
  WHERE rn = 1),
ta AS (
  SELECT user_id, count(*) AS user_purchase_count,
         CAST(sum(CAST(total_price AS DECIMAL(38,9))) AS DOUBLE) AS user_total_spend,
         CAST(sum(CAST(total_price AS DECIMAL(38,9))) AS DOUBLE) / count(*) AS user_avg_spend,
         max(total_price) AS user_max_spend,
         CAST(sum(quantity) AS BIGINT) AS user_total_quantity,
         count(DISTINCT item_id) AS user_distinct_purchased_items,
         max(purchase_date) AS last_p
  FROM purch GROUP BY user_id),
cm AS (
  SELECT user_id, category AS user_preferred_category FROM (
    SELECT p.user_id, c.category,
           row_number() OVER (PARTITION BY p.user_id ORDER BY count(*) DESC, c.category) AS rn
    FROM purch p JOIN cat c ON p.item_id = c.item_id
    WHERE c.category IS NOT NULL GROUP BY p.user_id, c.category) t
  WHERE rn = 1),
j AS (
  SELECT ca.user_id, ca.user_total_events, ca.user_distinct_items, ca.last_ev, ca.first_ev,
         ca.user_view_count, ca.user_click_count, ca.user_cart_count,
         dm.user_preferred_device, cm.user_preferred_category,
         coalesce(ta.user_purchase_count, 0) AS user_purchase_count,
         coalesce(ta.user_total_spend, 0.0) AS user_total_spend,
         coalesce(ta.user_avg_spend, 0.0) AS user_avg_spend,
         coalesce(ta.user_max_spend, 0.0) AS user_max_spend,
         coalesce(ta.user_total_quantity, 0) AS user_total_quantity,
         coalesce(ta.user_distinct_purchased_items, 0) AS user_distinct_purchased_items,
         ta.last_p
  FROM ca LEFT JOIN dm ON ca.user_id = dm.user_id
          LEFT JOIN ta ON ca.user_id = ta.user_id
          LEFT JOIN cm ON ca.user_id = cm.user_id),
k AS (
  SELECT j.*, user_total_events + 5 * user_purchase_count AS user_activity_score FROM j)
SELECT user_id, user_total_events, user_distinct_items, user_purchase_count,
       {R("CASE WHEN user_total_events > 0 THEN user_purchase_count / user_total_events ELSE 0.0 END", "user_purchase_rate")},
       {R("user_total_spend")},
       {R("ln(1 + user_total_spend)", "user_total_spend_log")},
       {R("user_avg_spend")}, {R("user_max_spend")},
       user_total_quantity, user_distinct_purchased_items,
       CAST(date_diff('day', CAST(coalesce(last_p, last_ev) AS DATE), DATE '{REFERENCE_DATE}') AS INTEGER) AS user_recency_days,
       CAST(date_diff('day', CAST(first_ev AS DATE), CAST(last_ev AS DATE)) + 1 AS INTEGER) AS user_tenure_days,
       user_activity_score,
       {R("CASE WHEN max(user_activity_score) OVER () IS NOT DISTINCT FROM min(user_activity_score) OVER () THEN 0.0 ELSE (user_activity_score - min(user_activity_score) OVER ()) / (max(user_activity_score) OVER () - min(user_activity_score) OVER ()) END", "user_activity_score_norm")},
       user_preferred_device,
       CAST(dense_rank() OVER (ORDER BY user_preferred_device NULLS FIRST) - 1 AS INTEGER) AS user_preferred_device_enc,
       user_preferred_category,
       CAST(dense_rank() OVER (ORDER BY user_preferred_category NULLS FIRST) - 1 AS INTEGER) AS user_preferred_category_enc,
       user_view_count, user_click_count, user_cart_count
FROM k"""
_USER_SQL = with_views(["clicks", "purch", "cat"], _USER_BODY)


def _minmax_sql(c: str, out: str, frame: str = "") -> str:
    mx, mn = f"max({c}) OVER ()", f"min({c}) OVER ()"
    return R(
        f"CASE WHEN {mx} IS NOT DISTINCT FROM {mn} THEN 0.0 ELSE ({c} - {mn}) / ({mx} - {mn}) END",
        out,
    )


_ITEM_BODY = f"""
ica AS (
  SELECT item_id, count(*) AS item_total_interactions, count(DISTINCT user_id) AS item_unique_users,
         CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS item_view_count,
         CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS item_click_count,
         CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS item_cart_count
  FROM clicks GROUP BY item_id),
ita AS (
  SELECT item_id, count(*) AS item_purchase_count,
         CAST(sum(quantity) AS BIGINT) AS item_total_quantity_sold,
         CAST(sum(CAST(total_price AS DECIMAL(38,9))) AS DOUBLE) AS item_total_revenue,
         CAST(sum(CAST(total_price AS DECIMAL(38,9))) AS DOUBLE) / count(*) AS item_avg_order_value,
         count(DISTINCT user_id) AS item_unique_buyers
  FROM purch GROUP BY item_id),
j AS (
  SELECT c.item_id, c.category, c.brand, c.price, c.stock, c.rating, c.review_count, c.is_active,
         coalesce(ica.item_total_interactions, 0) AS item_total_interactions,
         coalesce(ica.item_unique_users, 0) AS item_unique_users,
         coalesce(ica.item_view_count, 0) AS item_view_count,
         coalesce(ica.item_click_count, 0) AS item_click_count,
         coalesce(ica.item_cart_count, 0) AS item_cart_count,
         coalesce(ita.item_purchase_count, 0) AS item_purchase_count,
         coalesce(ita.item_total_quantity_sold, 0) AS item_total_quantity_sold,
         coalesce(ita.item_total_revenue, 0.0) AS item_total_revenue,
         coalesce(ita.item_avg_order_value, 0.0) AS item_avg_order_value,
         coalesce(ita.item_unique_buyers, 0) AS item_unique_buyers,
         s.popularity_score, s.avg_sentiment, s.trend_score, s.return_rate
  FROM cat c LEFT JOIN ica ON c.item_id = ica.item_id
             LEFT JOIN ita ON c.item_id = ita.item_id
             LEFT JOIN sig s ON c.item_id = s.item_id)
SELECT item_id, item_total_interactions, item_unique_users, item_purchase_count,
       {R("CASE WHEN item_total_interactions > 0 THEN item_purchase_count / item_total_interactions ELSE 0.0 END", "item_conversion_rate")},
       item_total_quantity_sold, {R("item_total_revenue")}, {R("item_avg_order_value")},
       item_unique_buyers, {R("coalesce(rating, 0.0)", "item_avg_rating")},
       item_view_count, item_click_count, item_cart_count,
       category, CAST(dense_rank() OVER (ORDER BY category NULLS FIRST) - 1 AS INTEGER) AS item_category_enc,
       brand, CAST(dense_rank() OVER (ORDER BY brand NULLS FIRST) - 1 AS INTEGER) AS item_brand_enc,
       {R("price")}, {R("ln(1 + price)", "item_price_log")},
       stock, {_minmax_sql("stock", "item_stock_norm")},
       review_count, {R("ln(1 + review_count)", "item_review_count_log")},
       {R("popularity_score")}, {_minmax_sql("popularity_score", "item_popularity_score_norm")},
       {R("coalesce(avg_sentiment, 0.0)", "item_avg_sentiment")},
       {R("trend_score")}, {_minmax_sql("trend_score", "item_trend_score_norm")},
       {R("coalesce(return_rate, 0.0)", "item_return_rate")},
       is_active
FROM j"""
_ITEM_SQL = with_views(["clicks", "purch", "cat", "sig"], _ITEM_BODY)

_USER_ITEM_BODY = f"""
ui AS (
  SELECT user_id, item_id, count(*) AS ui_total_interactions,
         CAST(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS BIGINT) AS ui_views,
         CAST(sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS BIGINT) AS ui_clicks,
         CAST(sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS BIGINT) AS ui_carts,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS BIGINT) AS ui_purchases_events
  FROM clicks GROUP BY user_id, item_id),
b AS (SELECT DISTINCT user_id, item_id FROM purch),
s AS (
  SELECT ui.*, ui_views * 1 + ui_clicks * 2 + ui_carts * 3 + ui_purchases_events * 5 AS ui_interaction_score,
         CASE WHEN b.user_id IS NULL THEN 0 ELSE 1 END AS ui_has_purchased
  FROM ui LEFT JOIN b ON ui.user_id = b.user_id AND ui.item_id = b.item_id)
SELECT user_id, item_id, ui_total_interactions, ui_views, ui_clicks, ui_carts, ui_purchases_events,
       ui_interaction_score, {_minmax_sql("ui_interaction_score", "ui_interaction_score_norm")},
       ui_has_purchased
FROM s"""
_USER_ITEM_SQL = with_views(["clicks", "purch"], _USER_ITEM_BODY)


@register("user_features", _USER_SQL)
def q_user_features(spark, sf_dir):
    return finish(user_features_df(spark, sf_dir))


@register("item_features", _ITEM_SQL)
def q_item_features(spark, sf_dir):
    return finish(item_features_df(spark, sf_dir))


@register("user_item_features", _USER_ITEM_SQL)
def q_user_item_features(spark, sf_dir):
    return finish(user_item_features_df(spark, sf_dir))


# ---- silver variants: cleaning feeds the feature builders --------------------------------

_SILVER_NAMES = {"clicks": "clickstream", "purch": "purchases", "cat": "catalog", "sig": "signals"}


def _silver_sql(body: str, views: list[str]) -> str:
    from mercato.plans import quality_sql as S
    from mercato.plans.rulesets import SPECS, SQL_VIEW

    ctes = [S.clean_ctes(SPECS[_SILVER_NAMES[v]], SQL_VIEW[_SILVER_NAMES[v]], f"{v}_c") for v in views]
    for v in views:
        body = re.sub(rf"\b{v}\b", f"{v}_c", body)
    return with_views(["clicks", "purch", "purch_age", "cat", "sig"], ",\n".join(ctes) + ",\n" + body)


def _silver_inputs(spark, sf_dir):
    from mercato.operators.clean import clean
    from mercato.plans.rulesets import SPECS

    return (
        clean(T.clickstream(spark, sf_dir), SPECS["clickstream"]),
        clean(T.purchases(spark, sf_dir, with_age_group=True), SPECS["purchases"]),
        clean(T.catalog(spark, sf_dir), SPECS["catalog"]),
        clean(T.signals(spark, sf_dir), SPECS["signals"]),
    )


@register("user_features_silver", _silver_sql(_USER_BODY, ["clicks", "purch", "cat"]))
def q_user_features_silver(spark, sf_dir):
    clicks, purch, cat, _ = _silver_inputs(spark, sf_dir)
    return finish(
        feat.user_features(clicks, purch, cat, REFERENCE_DATE, device_col="event_type", time_col="ts", roles=ROLES)
    )


@register("item_features_silver", _silver_sql(_ITEM_BODY, ["clicks", "purch", "cat", "sig"]))
def q_item_features_silver(spark, sf_dir):
    clicks, purch, cat, sig = _silver_inputs(spark, sf_dir)
    return finish(feat.item_features(clicks, purch, cat, sig, roles=ROLES, time_col="ts"))


@register("user_item_features_silver", _silver_sql(_USER_ITEM_BODY, ["clicks", "purch"]))
def q_user_item_features_silver(spark, sf_dir):
    clicks, purch, _, _ = _silver_inputs(spark, sf_dir)
    return finish(feat.user_item_features(clicks, purch, roles=ROLES, time_col="ts"))
