import datetime as dt
import math

from mercato.operators.pairs import co_purchase_pairs
from mercato.plans import features as FT

CLICKS = [
    # event_id, user_id, item_id, event_type, device, timestamp
    ("e1", "u1", "i1", "view", "mobile", "2026-04-01 10:00:00"),
    ("e2", "u1", "i1", "click", "mobile", "2026-04-02 10:00:00"),
    ("e3", "u1", "i2", "add_to_cart", "desktop", "2026-04-03 10:00:00"),
    ("e4", "u1", "i2", "purchase", "desktop", "2026-04-10 10:00:00"),
    ("e5", "u2", "i1", "view", "tablet", "2026-04-20 09:00:00"),
]
CLICK_SCHEMA = "event_id string, user_id string, item_id string, event_type string, device string, timestamp string"
PURCHASES = [
    # order_id, user_id, item_id, quantity, total_price, payment_method, purchase_date
    ("o1", "u1", "i2", 2, 30.0, "UPI", "2026-04-10 10:05:00"),
    ("o2", "u1", "i1", 1, 10.0, "COD", "2026-04-12 08:00:00"),
    ("o3", "u3", "i1", 1, 10.0, "COD", "2026-04-12 09:00:00"),
]
PURCHASE_SCHEMA = "order_id string, user_id string, item_id string, quantity int, total_price double, payment_method string, purchase_date string"
CATALOG = [("i1", "Books", "B1", 10.0, 5, 4.0, 10, True), ("i2", "Toys", "B2", 15.0, 0, None, 0, True), ("i3", "Books", "B1", 20.0, 9, 3.0, 2, False)]
CATALOG_SCHEMA = "item_id string, category string, brand string, price double, stock long, rating double, review_count long, is_active boolean"
SIGNALS = [("i1", 0.2, 0.5, 40.0, 0.1), ("i3", 0.6, -0.5, 80.0, 0.3)]
SIGNAL_SCHEMA = "item_id string, popularity_score double, avg_sentiment double, trend_score double, return_rate double"


def frames(spark):
    return (
        spark.createDataFrame(CLICKS, CLICK_SCHEMA),
        spark.createDataFrame(PURCHASES, PURCHASE_SCHEMA),
        spark.createDataFrame(CATALOG, CATALOG_SCHEMA),
        spark.createDataFrame(SIGNALS, SIGNAL_SCHEMA),
    )


def test_user_features(spark):
    clicks, purch, cat, _ = frames(spark)
    uf = {r.user_id: r for r in FT.user_features(clicks, purch, cat, dt.date(2026, 4, 26), checkpoint=False).collect()}
    assert set(uf) == {"u1", "u2"}  # users seen in clicks only
    u1, u2 = uf["u1"], uf["u2"]
    assert list(uf["u1"].asDict()) == FT.USER_FEATURE_COLUMNS
    assert (u1.user_total_events, u1.user_distinct_items, u1.user_purchase_count) == (4, 2, 2)
    assert u1.user_purchase_rate == 0.5
    assert (u1.user_total_spend, u1.user_avg_spend, u1.user_max_spend) == (40.0, 20.0, 30.0)
    assert u1.user_total_spend_log == math.log1p(40.0)
    assert (u1.user_view_count, u1.user_click_count, u1.user_cart_count) == (1, 1, 1)
    assert u1.user_recency_days == 14  # last purchase 2026-04-12
    assert u1.user_tenure_days == 10  # 2026-04-01 .. 2026-04-10
    assert u1.user_activity_score == 4 + 5 * 2
    # device tie (mobile 2, desktop 2) -> lowest value
    assert u1.user_preferred_device == "desktop"
    # category tie (Books 1, Toys 1) -> lowest value
    assert u1.user_preferred_category == "Books"
    assert (u2.user_purchase_count, u2.user_total_spend, u2.user_purchase_rate) == (0, 0.0, 0.0)
    assert u2.user_recency_days == 6 and u2.user_preferred_category is None
    # NULL category encodes first, then values ascending
    assert (u2.user_preferred_category_enc, u1.user_preferred_category_enc) == (0, 1)
    assert (u1.user_preferred_device_enc, u2.user_preferred_device_enc) == (0, 1)
    assert (u1.user_activity_score_norm, u2.user_activity_score_norm) == (1.0, 0.0)


def test_item_features(spark):
    clicks, purch, cat, sig = frames(spark)
    itf = {r.item_id: r for r in FT.item_features(clicks, purch, cat, sig, checkpoint=False).collect()}
    assert set(itf) == {"i1", "i2", "i3"}  # catalogue items
    i1, i2, i3 = itf["i1"], itf["i2"], itf["i3"]
    assert (i1.item_total_interactions, i1.item_unique_users, i1.item_purchase_count) == (3, 2, 2)
    assert i1.item_conversion_rate == 2 / 3 and i3.item_conversion_rate == 0.0
    assert (i2.item_avg_rating, i2.item_avg_sentiment, i2.item_return_rate) == (0.0, 0.0, 0.0)
    assert (i1.item_category_enc, i2.item_category_enc, i3.item_category_enc) == (0, 1, 0)
    assert (i1.item_popularity_score_norm, i2.item_popularity_score_norm, i3.item_popularity_score_norm) == (0.0, None, 1.0)
    assert (i1.item_stock_norm, i2.item_stock_norm, i3.item_stock_norm) == (5 / 9, 0.0, 1.0)
    assert i3.is_active is False


def test_user_item_features(spark):
    clicks, purch, _, _ = frames(spark)
    ui = {(r.user_id, r.item_id): r for r in FT.user_item_features(clicks, purch).collect()}
    assert set(ui) == {("u1", "i1"), ("u1", "i2"), ("u2", "i1")}
    assert ui[("u1", "i2")].ui_interaction_score == 3 + 5
    assert ui[("u1", "i1")].ui_interaction_score == 1 + 2
    assert ui[("u1", "i2")].ui_has_purchased == 1 and ui[("u2", "i1")].ui_has_purchased == 0
    assert ui[("u1", "i2")].ui_interaction_score_norm == 1.0 and ui[("u2", "i1")].ui_interaction_score_norm == 0.0


def test_basket_pairs_hand_computed(spark):
    # 3 orders x 3 items with a repeated line in o1
    lines = [("o1", "a"), ("o1", "b"), ("o1", "b"), ("o2", "a"), ("o2", "b"), ("o2", "c"), ("o3", "a"), ("o3", "c"), ("o3", "d")]
    df = spark.createDataFrame(lines, "order_id string, item_id string")
    got = {(r.item_a, r.item_b): r for r in co_purchase_pairs(df, min_count=2, min_lift=0.0).collect()}
    ab = got[("a", "b")]
    # a-b: o1 gives 1*2 line pairs, o2 gives 1 -> 3; a in 3 orders, b in 2
    assert ab.co_purchase_count == 3 and ab.support == 1.0
    assert ab.confidence_a_to_b == 1.0 and ab.confidence_b_to_a == 1.5 and ab.lift == 1.5
    assert set(got) == {("a", "b"), ("a", "c")}
    assert got[("a", "c")].lift == 2 * 3 / (3 * 2)
