"""Feature tables: user, item and user x item.

Shape of every builder: aggregate each source per entity first (partial
aggregation runs map-side, so a hot user or item is combined before the
shuffle), then join the per-entity aggregates on the entity key. The
per-entity frames are hash-partitioned on the same key, so the joins need
no further exchange. The assembled frame is checkpointed once before
encoding/scaling, because those steps read it several times (distinct
values, min and max) and must not re-run the source aggregation.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from mercato.functions.columns import count_when, safe_div
from mercato.operators.transforms import label_encode, log1p_columns, min_max_normalize
from mercato.session import ensure_checkpoint_dir

# Event roles of the retail features and their default event names.
DEFAULT_ROLES = {"view": "view", "click": "click", "cart": "add_to_cart", "purchase": "purchase"}
# Interaction weights per role (fixed values of the interaction score).
ROLE_WEIGHTS = {"view": 1, "click": 2, "cart": 3, "purchase": 5}

USER_FEATURE_COLUMNS = [
    "user_id",
    "user_total_events",
    "user_distinct_items",
    "user_purchase_count",
    "user_purchase_rate",
    "user_total_spend",
    "user_total_spend_log",
    "user_avg_spend",
    "user_max_spend",
    "user_total_quantity",
    "user_distinct_purchased_items",
    "user_recency_days",
    "user_tenure_days",
    "user_activity_score",
    "user_activity_score_norm",
    "user_preferred_device",
    "user_preferred_device_enc",
    "user_preferred_category",
    "user_preferred_category_enc",
    "user_view_count",
    "user_click_count",
    "user_cart_count",
]

ITEM_FEATURE_COLUMNS = [
    "item_id",
    "item_total_interactions",
    "item_unique_users",
    "item_purchase_count",
    "item_conversion_rate",
    "item_total_quantity_sold",
    "item_total_revenue",
    "item_avg_order_value",
    "item_unique_buyers",
    "item_avg_rating",
    "item_view_count",
    "item_click_count",
    "item_cart_count",
    "category",
    "item_category_enc",
    "brand",
    "item_brand_enc",
    "price",
    "item_price_log",
    "stock",
    "item_stock_norm",
    "review_count",
    "item_review_count_log",
    "popularity_score",
    "item_popularity_score_norm",
    "item_avg_sentiment",
    "trend_score",
    "item_trend_score_norm",
    "item_return_rate",
    "is_active",
]

USER_ITEM_FEATURE_COLUMNS = [
    "user_id",
    "item_id",
    "ui_total_interactions",
    "ui_views",
    "ui_clicks",
    "ui_carts",
    "ui_purchases_events",
    "ui_interaction_score",
    "ui_interaction_score_norm",
    "ui_has_purchased",
]


def _ts(df: DataFrame, c: str):
    """Event time as timestamp; text times are parsed leniently."""
    if isinstance(df.schema[c].dataType, StringType):
        return F.try_to_timestamp(F.col(c))
    return F.col(c)


def _role_counts(event_col: str, roles: Mapping[str, str], names: Mapping[str, str]):
    return [count_when(F.col(event_col) == roles[r]).alias(names[r]) for r in names]


def weighted_mode(df: DataFrame, key: str, value: str, weight: str | None, out: str) -> DataFrame:
    """Most frequent non-NULL ``value`` per ``key``; ties go to the lowest
    value (the rule of ``mode(c, deterministic=True)``). ``weight`` lets
    pre-aggregated counts stand for rows."""
    w = F.col(weight) if weight else F.lit(1)
    per_value = (
        df.where(F.col(value).isNotNull())
        .groupBy(key, value)
        .agg(F.sum(w).alias("_w"))
    )
    return per_value.groupBy(key).agg(
        F.min_by(F.col(value), F.struct(-F.col("_w"), F.col(value))).alias(out)
    )


def _checkpoint(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


# Money is summed exactly (decimal) and turned back into double at the end,
# so totals do not depend on how rows are spread over partitions.
MONEY = "decimal(38,9)"


def click_pairs(
    clicks: DataFrame, roles: Mapping[str, str] = DEFAULT_ROLES, time_col: str = "timestamp"
) -> DataFrame:
    """Clicks combined per (user, item): events, events per role, first and
    last event time. The one shuffle of the click stream that the user,
    item and user x item features all derive from."""
    t = _ts(clicks, time_col)
    return clicks.groupBy("user_id", "item_id").agg(
        F.count(F.lit(1)).alias("n"),
        *[count_when(F.col("event_type") == roles[r]).alias(f"n_{r}") for r in ("view", "click", "cart", "purchase")],
        F.min(t).alias("first_ts"),
        F.max(t).alias("last_ts"),
    )


def purchase_pairs(purchases: DataFrame, purchase_time_col: str = "purchase_date") -> DataFrame:
    """Purchases combined per (user, item): lines, exact spend, largest
    line, quantity and last purchase time (the one shuffle of purchases)."""
    return purchases.groupBy("user_id", "item_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("total_price").cast(MONEY)).alias("spend"),
        F.max("total_price").alias("max_spend"),
        F.sum("quantity").alias("qty"),
        F.max(_ts(purchases, purchase_time_col)).alias("last_ts"),
    )


def user_features(
    clicks: DataFrame,
    purchases: DataFrame,
    catalog: DataFrame,
    reference_date: _dt.date | str,
    *,
    device_col: str = "device",
    time_col: str = "timestamp",
    purchase_time_col: str = "purchase_date",
    roles: Mapping[str, str] = DEFAULT_ROLES,
    checkpoint: bool = True,
    clicks_ui: DataFrame | None = None,
    purchases_ui: DataFrame | None = None,
) -> DataFrame:
    """One row per user seen in ``clicks`` (22 columns). ``clicks_ui`` /
    ``purchases_ui`` let a caller share the (user, item) pre-aggregates."""
    ref = F.lit(str(reference_date)).cast("date")
    cu = clicks_ui if clicks_ui is not None else click_pairs(clicks, roles, time_col)
    pu = purchases_ui if purchases_ui is not None else purchase_pairs(purchases, purchase_time_col)
    click_agg = cu.groupBy("user_id").agg(
        F.sum("n").alias("user_total_events"),
        F.count("item_id").alias("user_distinct_items"),
        F.max("last_ts").alias("user_last_event"),
        F.min("first_ts").alias("user_first_event"),
        F.sum("n_view").alias("user_view_count"),
        F.sum("n_click").alias("user_click_count"),
        F.sum("n_cart").alias("user_cart_count"),
    )
    device_mode = weighted_mode(clicks, "user_id", device_col, None, "user_preferred_device")
    spend = F.sum("spend")
    txn_agg = pu.groupBy("user_id").agg(
        F.sum("n").alias("user_purchase_count"),
        spend.cast("double").alias("user_total_spend"),
        (spend.cast("double") / F.sum("n")).alias("user_avg_spend"),
        F.max("max_spend").alias("user_max_spend"),
        F.sum("qty").alias("user_total_quantity"),
        F.count("item_id").alias("user_distinct_purchased_items"),
        F.max("last_ts").alias("user_last_purchase"),
    )
    # Preferred category: the catalogue join sees (user, item) pairs, not lines.
    with_cat = pu.select("user_id", "item_id", "n").join(catalog.select("item_id", "category"), "item_id", "left")
    cat_mode = weighted_mode(with_cat, "user_id", "category", "n", "user_preferred_category")

    uf = (
        click_agg.join(device_mode, "user_id", "left")
        .join(txn_agg, "user_id", "left")
        .join(cat_mode, "user_id", "left")
        .fillna(
            {
                "user_purchase_count": 0,
                "user_total_spend": 0.0,
                "user_avg_spend": 0.0,
                "user_max_spend": 0.0,
                "user_total_quantity": 0,
                "user_distinct_purchased_items": 0,
            }
        )
        .withColumns(
            {
                "user_purchase_rate": safe_div("user_purchase_count", "user_total_events"),
                "user_recency_days": F.datediff(
                    ref, F.coalesce("user_last_purchase", "user_last_event")
                ),
                "user_tenure_days": F.datediff("user_last_event", "user_first_event") + 1,
                "user_activity_score": F.col("user_total_events")
                + F.col("user_purchase_count") * 5,
            }
        )
    )
    if checkpoint:
        uf = _checkpoint(uf)
    uf = label_encode(
        uf,
        {
            "user_preferred_device": "user_preferred_device_enc",
            "user_preferred_category": "user_preferred_category_enc",
        },
    )
    uf = min_max_normalize(uf, {"user_activity_score": "user_activity_score_norm"})
    uf = log1p_columns(uf, {"user_total_spend": "user_total_spend_log"})
    return uf.select(*USER_FEATURE_COLUMNS)


def item_features(
    clicks: DataFrame,
    purchases: DataFrame,
    catalog: DataFrame,
    signals: DataFrame,
    *,
    roles: Mapping[str, str] = DEFAULT_ROLES,
    checkpoint: bool = True,
    time_col: str = "timestamp",
    clicks_ui: DataFrame | None = None,
    purchases_ui: DataFrame | None = None,
) -> DataFrame:
    """One row per catalogue item (30 columns)."""
    cu = clicks_ui if clicks_ui is not None else click_pairs(clicks, roles, time_col)
    pu = purchases_ui if purchases_ui is not None else purchase_pairs(purchases)
    click_agg = cu.groupBy("item_id").agg(
        F.sum("n").alias("item_total_interactions"),
        F.count("user_id").alias("item_unique_users"),
        F.sum("n_view").alias("item_view_count"),
        F.sum("n_click").alias("item_click_count"),
        F.sum("n_cart").alias("item_cart_count"),
    )
    spend = F.sum("spend")
    txn_agg = pu.groupBy("item_id").agg(
        F.sum("n").alias("item_purchase_count"),
        F.sum("qty").alias("item_total_quantity_sold"),
        spend.cast("double").alias("item_total_revenue"),
        (spend.cast("double") / F.sum("n")).alias("item_avg_order_value"),
        F.count("user_id").alias("item_unique_buyers"),
    )
    base = catalog.select(
        "item_id", "category", "brand", "price", "stock", "rating", "review_count", "is_active"
    )
    ext = signals.select("item_id", "popularity_score", "avg_sentiment", "trend_score", "return_rate")
    itf = (
        base.join(click_agg, "item_id", "left")
        .join(txn_agg, "item_id", "left")
        .join(ext, "item_id", "left")
        .fillna(
            {
                "item_total_interactions": 0,
                "item_unique_users": 0,
                "item_view_count": 0,
                "item_click_count": 0,
                "item_cart_count": 0,
                "item_purchase_count": 0,
                "item_total_quantity_sold": 0,
                "item_total_revenue": 0.0,
                "item_avg_order_value": 0.0,
                "item_unique_buyers": 0,
            }
        )
        .withColumns(
            {
                "item_conversion_rate": safe_div("item_purchase_count", "item_total_interactions"),
                "item_avg_rating": F.coalesce(F.col("rating").cast("double"), F.lit(0.0)),
                "item_avg_sentiment": F.coalesce(F.col("avg_sentiment"), F.lit(0.0)),
                "item_return_rate": F.coalesce(F.col("return_rate"), F.lit(0.0)),
            }
        )
    )
    if checkpoint:
        itf = _checkpoint(itf)
    itf = label_encode(itf, {"category": "item_category_enc", "brand": "item_brand_enc"})
    itf = min_max_normalize(
        itf,
        {
            "popularity_score": "item_popularity_score_norm",
            "trend_score": "item_trend_score_norm",
            "stock": "item_stock_norm",
        },
    )
    itf = log1p_columns(itf, {"price": "item_price_log", "review_count": "item_review_count_log"})
    return itf.select(*ITEM_FEATURE_COLUMNS)


def interaction_score(roles: Mapping[str, str] = DEFAULT_ROLES):
    """Weighted score over the per-role count columns of user x item."""
    return (
        F.col("ui_views") * ROLE_WEIGHTS["view"]
        + F.col("ui_clicks") * ROLE_WEIGHTS["click"]
        + F.col("ui_carts") * ROLE_WEIGHTS["cart"]
        + F.col("ui_purchases_events") * ROLE_WEIGHTS["purchase"]
    )


def user_item_features(
    clicks: DataFrame,
    purchases: DataFrame,
    *,
    roles: Mapping[str, str] = DEFAULT_ROLES,
    time_col: str = "timestamp",
    clicks_ui: DataFrame | None = None,
    purchases_ui: DataFrame | None = None,
) -> DataFrame:
    """One row per clicked (user, item) pair; label ``ui_has_purchased``."""
    cu = clicks_ui if clicks_ui is not None else click_pairs(clicks, roles, time_col)
    pu = purchases_ui if purchases_ui is not None else purchases.select("user_id", "item_id").distinct()
    ui = cu.select(
        "user_id",
        "item_id",
        F.col("n").alias("ui_total_interactions"),
        F.col("n_view").alias("ui_views"),
        F.col("n_click").alias("ui_clicks"),
        F.col("n_cart").alias("ui_carts"),
        F.col("n_purchase").alias("ui_purchases_events"),
    )
    bought = pu.select("user_id", "item_id").withColumn("ui_has_purchased", F.lit(1))
    uif = (
        ui.join(bought, ["user_id", "item_id"], "left")
        .fillna({"ui_has_purchased": 0})
        .withColumn("ui_interaction_score", interaction_score(roles))
    )
    uif = min_max_normalize(uif, {"ui_interaction_score": "ui_interaction_score_norm"})
    return uif.select(*USER_ITEM_FEATURE_COLUMNS)


# Provenance of each feature column (catalogue ``source``); anything not
# listed is derived from other features.
FEATURE_SOURCES = {
    **dict.fromkeys(
        [
            "user_total_events", "user_distinct_items", "user_preferred_device", "user_view_count",
            "user_click_count", "user_cart_count", "item_total_interactions", "item_unique_users",
            "item_view_count", "item_click_count", "item_cart_count", "ui_total_interactions",
            "ui_views", "ui_clicks", "ui_carts", "ui_purchases_events",
        ],
        "clickstream",
    ),
    **dict.fromkeys(
        [
            "user_purchase_count", "user_total_spend", "user_avg_spend", "user_max_spend",
            "user_total_quantity", "user_distinct_purchased_items", "user_preferred_category",
            "item_purchase_count", "item_total_quantity_sold", "item_total_revenue",
            "item_avg_order_value", "item_unique_buyers", "ui_has_purchased",
        ],
        "transactions",
    ),
    **dict.fromkeys(["category", "brand", "price", "stock", "review_count", "item_avg_rating"], "catalog"),
    **dict.fromkeys(["popularity_score", "trend_score", "item_avg_sentiment", "item_return_rate"], "external"),
}
