"""Driver tables and the retail views built on them.

The retail pipeline speaks of clickstream, purchases, catalogue and external
signals. The test data is a star schema; these functions declare the views
lazily (no action runs here) so Catalyst can prune columns and push filters
into the parquet scans of the underlying tables.

View definitions (the oracle SQL in ``mercato.plans.oracle`` mirrors them):

* clickstream(event_id, user_id, item_id, event_type, ts, value)
  from events; ``item_id`` is the ``k`` key of the JSON ``props`` column.
* purchases(order_id, line_number, user_id, item_id, quantity, unit_price,
  total_price, purchase_date, payment_method[, age_group])
  from lineitem joined to orders (and customer for ``age_group``).
* catalog(item_id, name, category, brand, price, stock, rating,
  review_count, is_active) from part.
* signals(item_id, popularity_score, avg_sentiment, trend_score,
  return_rate, search_volume_7d) aggregated from lineitem per part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Event vocabulary of the test data, mapped onto the roles the retail
# features use. The test stream has no cart event; ``signup`` takes its
# place (weight 3), and ``error`` is outside the valid domain.
EVENT_ROLES = {"view": "view", "click": "click", "cart": "signup", "purchase": "purchase"}
VALID_EVENT_TYPES = ["view", "click", "signup", "purchase"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Register every driver table as a temp view of the same name."""
    for name in TABLES:
        table(spark, sf_dir, name).createOrReplaceTempView(name)


def clickstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        "event_type",
        "ts",
        "value",
    )


def purchases(spark: SparkSession, sf_dir: str, with_age_group: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice"
    )
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"
    )
    df = li.join(od, li.l_orderkey == od.o_orderkey, "inner")
    cols = [
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("item_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_extendedprice").alias("total_price"),
        F.col("o_orderdate").alias("purchase_date"),
        F.col("o_orderpriority").alias("payment_method"),
    ]
    if with_age_group:
        cu = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
        df = df.join(cu, df.o_custkey == cu.c_custkey, "left")
        cols.append(F.col("c_mktsegment").alias("age_group"))
    return df.select(*cols)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("item_id"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").alias("price"),
        F.col("p_size").cast("bigint").alias("stock"),
        (F.lit(1.0) + (F.col("p_size") % 9) * F.lit(0.5)).alias("rating"),
        ((F.col("p_partkey") * 37) % 1000).cast("bigint").alias("review_count"),
        (F.col("p_size") > 1).alias("is_active"),
    )


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy(F.col("l_partkey").alias("item_id")).agg(
        (F.avg("l_discount") * 10).alias("popularity_score"),
        (F.avg("l_tax") * 25 - 1).alias("avg_sentiment"),
        (F.avg("l_quantity") * 2).alias("trend_score"),
        F.avg(F.when(F.col("l_returnflag") == "R", 1.0).otherwise(0.0)).alias("return_rate"),
        F.count(F.lit(1)).alias("search_volume_7d"),
    )
