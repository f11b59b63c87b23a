"""Registered queries on stored tables: keyed merges, catalogued tables, snapshots,
exports, previews and the small projections around them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from mercato.operators import clean as C
from mercato.operators import eda as E
from mercato.operators.extras import with_time_parts
from mercato.plans import store as ST
from mercato.plans.oracle_views import with_views
from mercato.plans.q_eda import WEIGHT_SQL, WEIGHTS
from mercato.plans.q_quality import _clean_sql
from mercato.plans.registry import R, finish, register
from mercato.plans.rulesets import SPECS
from mercato.session import ensure_checkpoint_dir, scratch_dir
from mercato.sources import sinks as K
from mercato.sources import tables as T
from mercato.sources.keyed import KeyedTable

# ---- keyed merges ---------------------------------------------------------------------

# Keys of customers that a change adds.
NEW_KEYS = 10_000_000
_CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"
_MERGE_SQL = f"""
c1 AS (SELECT {_CUSTOMER}, CAST(NULL AS VARCHAR) AS tier FROM customer),
ch AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal + 100 AS c_acctbal, c_mktsegment, 'gold' AS tier FROM customer WHERE c_custkey % 5 = 0
       UNION ALL SELECT c_custkey + {NEW_KEYS}, c_name, c_nationkey, c_acctbal, c_mktsegment, 'new' FROM customer WHERE c_custkey % 50 = 0),
c2 AS (SELECT * FROM c1 WHERE c_custkey NOT IN (SELECT c_custkey FROM ch) UNION ALL SELECT * FROM ch),
c3 AS (SELECT * FROM c2 WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 7 = 0))"""


def merged_customers(spark, sf_dir) -> KeyedTable:
    """A keyed table of customers in three versions: loaded, upserted (with a new
    column), and with keys deleted."""
    cust = T.table(spark, sf_dir, "customer").select(*_CUSTOMER.split(", "))
    table = KeyedTable(spark, scratch_dir(spark, "customers"), ["c_custkey"], buckets=16)
    table.overwrite(cust)
    changed = cust.where("c_custkey % 5 = 0").withColumns({"c_acctbal": F.col("c_acctbal") + 100, "tier": F.lit("gold")})
    added = cust.where("c_custkey % 50 = 0").withColumns({"c_custkey": F.col("c_custkey") + NEW_KEYS, "tier": F.lit("new")})
    table.upsert(changed.unionByName(added))
    table.delete(cust.where("c_custkey % 7 = 0"))
    return table


@register("keyed_merge", f"WITH {_MERGE_SQL}\nSELECT c_custkey, c_name, c_nationkey, {R('c_acctbal')}, c_mktsegment, tier FROM c3")
def q_keyed_merge(spark, sf_dir):
    return finish(merged_customers(spark, sf_dir).read())


@register(
    "keyed_versions",
    f"WITH {_MERGE_SQL}\n"
    + "\nUNION ALL\n".join(f"SELECT CAST({i} AS BIGINT) AS version, count(*) AS rows, count(tier) AS tiers, {R('sum(c_acctbal)', 'balance')} FROM c{i}" for i in (1, 2, 3)),
)
def q_keyed_versions(spark, sf_dir):
    """Every version stays readable."""
    table = merged_customers(spark, sf_dir)
    out = None
    for v in (1, 2, 3):
        df = table.read(v)
        tiers = F.count("tier") if "tier" in df.columns else F.lit(0).cast("bigint")
        part = df.agg(F.lit(v).cast("bigint").alias("version"), F.count(F.lit(1)).alias("rows"), tiers.alias("tiers"), F.sum("c_acctbal").alias("balance"))
        out = part if out is None else out.unionByName(part)
    return finish(out)


# ---- catalogued tables ------------------------------------------------------------------


@register(
    "catalogued_append",
    with_views(
        ["clicks"],
        f"SELECT event_id, user_id, event_type, CASE WHEN event_id % 2 = 1 THEN {R('value').rsplit(' AS ', 1)[0]} END AS value, "
        "CAST(2 AS BIGINT) AS listed FROM clicks",
    ),
)
def q_catalogued_append(spark, sf_dir):
    """Two appends to a catalogued table, the second one with a new column; the
    database and both its tables are made if they are missing, then dropped."""
    clicks = T.clickstream(spark, sf_dir)
    db = f"mercato_{uuid.uuid4().hex[:10]}"
    K.ensure_database(spark, db)
    try:
        first = clicks.where("event_id % 2 = 0").select("event_id", "user_id", "event_type")
        for _ in range(2):  # the second call finds the tables
            K.ensure_table(spark, f"{db}.clicks", first.schema)
            K.ensure_table(spark, f"{db}.run_log", first.limit(0).select("event_id").schema)
        K.append_table(first, f"{db}.clicks")
        K.append_table(clicks.where("event_id % 2 = 1").select("event_id", "user_id", "event_type", "value"), f"{db}.clicks")
        listed = K.list_tables(spark, db).count()
        ensure_checkpoint_dir(spark)
        out = spark.table(f"{db}.clicks").withColumn("listed", F.lit(listed).cast("bigint")).checkpoint(eager=True)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {db} CASCADE")
    return finish(out)


@register(
    "snapshot_overwrite",
    with_views(["cat"], f"SELECT item_id, category, {R('price * 2', 'price')} FROM cat WHERE stock > 10 AND price > 950"),
)
def q_snapshot_overwrite(spark, sf_dir):
    """A table overwritten by a snapshot, then replaced by a result that reads it."""
    cat = T.catalog(spark, sf_dir).select("item_id", "category", "price", "stock")
    name = f"snapshot_{uuid.uuid4().hex[:10]}"
    K.overwrite_snapshot(cat, name)
    try:
        K.overwrite_snapshot(cat.where("stock > 10"), name)
        K.replace_table(spark.table(name).where("price > 950").withColumn("price", F.col("price") * 2), name)
        ensure_checkpoint_dir(spark)
        out = spark.table(name).select("item_id", "category", "price").checkpoint(eager=True)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return finish(out)


# ---- exports, previews, lookups --------------------------------------------------------


@register(
    "export_reload",
    with_views(["purch"], "SELECT count(*) AS rows, CAST(sum(order_id * 8 + line_number) AS BIGINT) AS keys, CAST(0 AS BIGINT) AS inversions FROM purch"),
)
def q_export_reload(spark, sf_dir):
    """A CSV export in time order and its load; ``inversions`` counts rows that stand
    before an earlier one in their file."""
    path = f"{scratch_dir(spark, 'export')}/purchases"
    p = T.purchases(spark, sf_dir).select("order_id", "line_number", "item_id", "purchase_date")
    K.export_csv(p, path, sort_within=["purchase_date"])
    back = K.load_csv(spark, path, p.schema)
    placed = back.withColumns({"_file": F.col("_metadata.file_path"), "_at": F.monotonically_increasing_id()})
    from pyspark.sql import Window

    before = F.lag("purchase_date").over(Window.partitionBy("_file", F.shiftright("_at", 33)).orderBy("_at"))
    return placed.withColumn("_before", before).agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.col("order_id") * 8 + F.col("line_number")).alias("keys"),
        F.count_if(F.col("_before") > F.col("purchase_date")).alias("inversions"),
    )


_PREVIEW = ["order_id", "line_number", "item_id", "quantity", "total_price"]


@register(
    "preview_purchases",
    with_views(["purch"], f"SELECT order_id, line_number, item_id, quantity, {R('total_price')} FROM purch ORDER BY order_id, line_number, item_id, quantity, total_price LIMIT 20"),
)
def q_preview_purchases(spark, sf_dir):
    return finish(K.preview(T.purchases(spark, sf_dir), _PREVIEW, 20, _PREVIEW))


@register(
    "feature_rows_by_key",
    with_views(
        ["purch"],
        "SELECT user_id, count(*) AS lines, CAST(sum(quantity) AS BIGINT) AS units FROM purch "
        "WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 10 = 0) GROUP BY user_id",
    ),
)
def q_feature_rows_by_key(spark, sf_dir):
    """Feature rows of a set of keys, some of the columns; unknown names are passed over."""
    totals = T.purchases(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("lines"), F.sum("quantity").alias("units"), F.sum("total_price").alias("spend"))
    keys = T.table(spark, sf_dir, "customer").where("c_custkey % 10 = 0").select("c_custkey")
    return K.feature_subset(K.read_features(totals, "user_id", keys, ["lines", "units"]), ["user_id", "lines", "units", "not_there"])


@register("clean_with_metadata", _clean_sql("catalog"))
def q_clean_with_metadata(spark, sf_dir):
    """Metadata columns (``_``) are never a reason to drop a row."""
    cat = T.catalog(spark, sf_dir)
    noted = cat.withColumns({"_batch_id": F.when(F.col("item_id") % 2 == 0, F.lit("b1")), "_source_path": F.lit("")})
    return finish(C.clean(noted, SPECS["catalog"]).select(*cat.columns))


@register("distinct_actions", with_views(["clicks"], "SELECT DISTINCT user_id, item_id, event_type FROM clicks"))
def q_distinct_actions(spark, sf_dir):
    return C.dedupe(T.clickstream(spark, sf_dir).select("user_id", "item_id", "event_type"), None)


@register(
    "versioned_totals",
    with_views(["clicks"], "SELECT user_id, count(*) AS events, 'v1.0' AS _version, TIMESTAMP '2024-02-01 00:00:00' AS _written_at FROM clicks GROUP BY user_id"),
)
def q_versioned_totals(spark, sf_dir):
    totals = T.clickstream(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    out = ST.with_version_columns(totals, ST.DEFAULT_VERSION, "2024-02-01 00:00:00")
    return out.withColumn("_written_at", F.col("_written_at").cast("timestamp_ntz"))


# ---- text, arrays, pivots ------------------------------------------------------------------

_TEXT_TS = "CASE WHEN event_id % 13 = 0 THEN 'not a time' WHEN event_id % 17 = 0 THEN '' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END"


@register(
    "text_timestamps",
    with_views(
        ["clicks"],
        f"""
tx AS (SELECT event_id, try_strptime({_TEXT_TS}, '%Y-%m-%d %H:%M:%S') AS seen FROM clicks)
SELECT event_id, seen, strftime(seen, '%Y%m%d%H%M%S') AS stamp, CAST(hour(seen) AS INTEGER) AS hour, CAST(dayofweek(seen) + 1 AS INTEGER) AS day_of_week FROM tx""",
    ),
)
def q_text_timestamps(spark, sf_dir):
    """Event times that came as text, some of which are none."""
    clicks = T.clickstream(spark, sf_dir)
    text = F.when(F.col("event_id") % 13 == 0, "not a time").when(F.col("event_id") % 17 == 0, "").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    parts = with_time_parts(clicks.select("event_id", text.alias("seen")), "seen")
    return parts.select("event_id", F.col("seen").cast("timestamp_ntz").alias("seen"), F.date_format("seen", "yyyyMMddHHmmss").alias("stamp"), "hour", "day_of_week")


@register(
    "array_text",
    with_views(["cat"], "SELECT category, '[' || string_agg(DISTINCT brand, ', ' ORDER BY brand) || ']' AS brands FROM cat GROUP BY category"),
)
def q_array_text(spark, sf_dir):
    """An array column as text."""
    per = T.catalog(spark, sf_dir).groupBy("category").agg(F.array_sort(F.collect_set("brand")).alias("brands"))
    return per.withColumn("brands", F.col("brands").cast("string"))


_ITEMS = list(range(10))


@register(
    "interaction_matrix_wide",
    with_views(
        ["clicks"],
        "SELECT user_id, "
        + ", ".join(f'CAST(coalesce(sum(CASE WHEN item_id = {i} THEN {WEIGHT_SQL} END), 0) AS BIGINT) AS "{i}"' for i in _ITEMS)
        + " FROM clicks GROUP BY user_id",
    ),
)
def q_interaction_matrix_wide(spark, sf_dir):
    """The users' scores over a bounded list of items as columns, 0 where there is none."""
    from mercato.functions.columns import weight_of

    cells = T.clickstream(spark, sf_dir).groupBy("user_id", "item_id").agg(F.sum(weight_of("event_type", WEIGHTS)).alias("interaction_score"))
    return E.pivot_matrix(cells, _ITEMS)
