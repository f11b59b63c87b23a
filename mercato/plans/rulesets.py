"""Rule sets of the four retail sources, bound to the test-data views.

The structure follows the reference's four profiling calls: domain
membership and format rules, inclusive ranges, a primary key, and the
active filter on the catalogue. Reference ranges are kept as they are;
the domain lists are the vocabularies of the test data.
"""

from __future__ import annotations

from mercato.operators.rules import TableSpec, in_range, member, pattern
from mercato.sources.tables import VALID_EVENT_TYPES

# Vocabularies of the test data.
VALID_PAYMENTS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
VALID_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
VALID_CATEGORIES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
# Brand names follow the rule ``Brand#<n>`` for n = 1..25.
VALID_BRANDS = [f"Brand#{n}" for n in range(1, 26)]

CLICKSTREAM = TableSpec(
    source="clickstream",
    numeric_cols=["value"],
    cardinality_cols=["user_id", "item_id", "event_type"],
    rules=[
        member("event_type values", "event_type", VALID_EVENT_TYPES),
        pattern("user_id format", "user_id", r"^\d{1,9}$"),
        pattern("item_id format", "item_id", r"^\d{1,9}$"),
        pattern("event_id format", "event_id", r"^\d+$"),
        pattern("timestamp format", "ts", r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}"),
        in_range("value", 0.0, 250.0),
    ],
    pk=["event_id"],
    order_by=["ts"],
    keep="first",
    column_types={
        "event_id": "bigint",
        "user_id": "bigint",
        "item_id": "bigint",
        "event_type": "string",
        "ts": "timestamp_ntz",
        "value": "double",
    },
)

PURCHASES = TableSpec(
    source="purchases",
    numeric_cols=["quantity", "unit_price", "total_price"],
    cardinality_cols=["user_id", "item_id", "payment_method", "age_group"],
    rules=[
        member("payment_method values", "payment_method", VALID_PAYMENTS, null_ok=True),
        member("age_group values", "age_group", VALID_SEGMENTS),
        in_range("quantity", 1, 100),
        in_range("unit_price", 0.01, 100000),
        in_range("total_price", 0.01, 500000),
    ],
    pk=["order_id", "line_number"],
    order_by=["purchase_date"],
    keep="last",
    column_types={
        "order_id": "bigint",
        "line_number": "int",
        "user_id": "bigint",
        "item_id": "bigint",
        "quantity": "int",
        "unit_price": "double",
        "total_price": "double",
        "purchase_date": "timestamp_ntz",
        "payment_method": "string",
        "age_group": "string",
    },
)

CATALOG = TableSpec(
    source="catalog",
    numeric_cols=["price", "stock", "rating", "review_count"],
    cardinality_cols=["category", "brand"],
    rules=[
        member("category values", "category", VALID_CATEGORIES),
        member("brand values", "brand", VALID_BRANDS),
        in_range("price", 0.01, 100000),
        in_range("stock", 0, 100000),
        in_range("rating", 1.0, 5.0),
        in_range("review_count", 0, 1000000),
    ],
    pk=["item_id"],
    order_by=[],
    keep="first",
    active_col="is_active",
    column_types={
        "item_id": "bigint",
        "name": "string",
        "category": "string",
        "brand": "string",
        "price": "double",
        "stock": "bigint",
        "rating": "double",
        "review_count": "bigint",
        "is_active": "boolean",
    },
)

SIGNALS = TableSpec(
    source="signals",
    numeric_cols=["popularity_score", "avg_sentiment", "trend_score", "search_volume_7d", "return_rate"],
    cardinality_cols=["item_id"],
    rules=[
        in_range("popularity_score", 0.0, 1.0),
        in_range("avg_sentiment", -1.0, 1.0),
        in_range("trend_score", 0.0, 100.0),
        in_range("return_rate", 0.0, 1.0),
    ],
    pk=["item_id"],
    column_types={
        "item_id": "bigint",
        "popularity_score": "double",
        "avg_sentiment": "double",
        "trend_score": "double",
        "return_rate": "double",
        "search_volume_7d": "bigint",
    },
)

SPECS = {s.source: s for s in (CLICKSTREAM, PURCHASES, CATALOG, SIGNALS)}
# SQL view (CTE) name of each source in the oracle text.
SQL_VIEW = {"clickstream": "clicks", "purchases": "purch_age", "catalog": "cat", "signals": "sig"}
