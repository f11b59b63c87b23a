"""Registered landing-zone queries.

Each query writes its landing files from the test tables into a fresh
folder on shared storage (next to the checkpoint directory), then runs the
ingestion operators on them. Batch times are fixed so the oracle can
reproduce the metadata columns.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from mercato.operators.profile import contract_check
from mercato.plans.oracle_views import with_views
from mercato.plans.registry import R, finish, register
from mercato.session import scratch_dir
from mercato.sources import files as L
from mercato.sources import tables as T

V1 = _dt.datetime(2024, 1, 31, 0, 0, 0)
V2 = _dt.datetime(2024, 2, 1, 0, 0, 0)
BATCH = _dt.datetime(2024, 2, 1, 0, 0, 0)
REQUIRED_PURCHASE_COLUMNS = [
    "order_id", "user_id", "item_id", "quantity", "unit_price", "total_price", "purchase_date", "payment_method",
]


def _drifted(purchases):
    """Purchases under the simulator's drifted header."""
    return purchases.select(
        F.col("order_id").alias("transaction_id"),
        "user_id",
        "item_id",
        "quantity",
        F.col("total_price").alias("amount"),
        "payment_method",
        F.col("purchase_date").alias("timestamp"),
    )


def _landing(spark, sf_dir, with_json: bool = False):
    base = scratch_dir(spark, "landing")
    p = T.purchases(spark, sf_dir)
    L.write_landing_csv(p, base, "purchase_history", V1)
    L.write_landing_csv(p, base, "purchase_history", V2)
    if with_json:
        L.write_landing_json_envelope(T.catalog(spark, sf_dir), base, "product_catalog", V2, key="item_id")
    return base, p


_PCOLS = "order_id, line_number, user_id, item_id, quantity, unit_price, total_price, purchase_date, payment_method"


@register(
    "csv_ingest",
    with_views(
        ["purch"],
        f"SELECT order_id, line_number, user_id, item_id, quantity, {R('unit_price')}, {R('total_price')}, purchase_date, "
        "payment_method, CAST(NULL AS VARCHAR) AS _corrupt_record, "
        f"'{BATCH.isoformat()}' AS _ingested_at, 'csv' AS _source_type, '{BATCH.strftime('%Y%m%d%H%M%S')}' AS _batch_id, "
        f"'{L.version_name('purchase_history', V2, 'csv')}' AS _source_version FROM purch",
    ),
)
def q_csv_ingest(spark, sf_dir):
    base, p = _landing(spark, sf_dir)
    path = L.latest_path(L.list_landing(spark, base, "*.csv"), "purchase_history", "csv")
    df = L.read_csv_bronze(spark, path, p.schema)
    df = L.with_ingest_metadata(df, "csv", BATCH)
    df = df.withColumn("_source_version", F.regexp_extract("_source_path", r"/([^/]+)/[^/]+$", 1)).drop("_source_path")
    return finish(df)


@register(
    "json_envelope_explode",
    with_views(
        ["cat"],
        f"SELECT item_id, name, category, brand, {R('price')}, stock, {R('rating')}, review_count, is_active, "
        f"'json_api' AS _source_type, '{BATCH.strftime('%Y%m%d%H%M%S')}' AS _batch_id FROM cat",
    ),
)
def q_json_envelope_explode(spark, sf_dir):
    base = scratch_dir(spark, "landing")
    cat = T.catalog(spark, sf_dir)
    path = L.write_landing_json_envelope(cat, base, "product_catalog", V2, key="item_id")
    rows = L.read_json_envelope(spark, path, cat.schema)
    out = L.with_ingest_metadata(rows, "json_api", BATCH, path_col="_file")
    return finish(out.drop("_source_path", "_ingested_at"))


def _contract_sql() -> str:
    present = {"user_id", "item_id", "quantity", "payment_method"}
    parts = []
    for c in REQUIRED_PURCHASE_COLUMNS:
        if c in present:
            parts.append(
                f"SELECT '{c}' AS column_name, TRUE AS present, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
                f"CASE WHEN count(*) FILTER (WHERE {c} IS NULL) > 0 THEN 'WARN' ELSE 'OK' END AS status FROM purch"
            )
        else:
            parts.append(
                f"SELECT '{c}' AS column_name, FALSE AS present, CAST(NULL AS BIGINT) AS null_count, 'MISSING' AS status"
            )
    return with_views(["purch"], "\nUNION ALL\n".join(parts))


@register("csv_contract_check", _contract_sql())
def q_csv_contract_check(spark, sf_dir):
    base = scratch_dir(spark, "landing")
    path = L.write_landing_csv(_drifted(T.purchases(spark, sf_dir)), base, "purchase_history", V2)
    raw = spark.read.option("header", True).csv(path)
    return contract_check(raw, REQUIRED_PURCHASE_COLUMNS)


@register(
    "csv_corrupt_capture",
    with_views(["purch"], "SELECT count(*) AS rows, count(*) AS corrupt_rows, CAST(0 AS BIGINT) AS good_rows FROM purch"),
)
def q_csv_corrupt_capture(spark, sf_dir):
    """The drifted file read with the declared bronze schema: columns bind
    by position, so cells fail to parse and land in ``_corrupt_record``."""
    base = scratch_dir(spark, "landing")
    p = T.purchases(spark, sf_dir)
    path = L.write_landing_csv(_drifted(p), base, "purchase_history", V2)
    scanned = L.read_csv_bronze(spark, path, p.schema).checkpoint(eager=True)
    good, bad = L.split_corrupt(scanned)
    return scanned.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count("_corrupt_record").alias("corrupt_rows"),
    ).withColumn("good_rows", F.col("rows") - F.col("corrupt_rows"))


@register(
    "latest_file",
    "SELECT 'purchase_history' AS prefix, 'csv' AS extension, "
    f"'{L.version_name('purchase_history', V2, 'csv')}' AS latest_version, CAST(2 AS BIGINT) AS versions "
    f"UNION ALL SELECT 'product_catalog', 'json', '{L.version_name('product_catalog', V2, 'json')}', CAST(1 AS BIGINT) "
    "FROM (SELECT count(*) FROM part)",
)
def q_latest_file(spark, sf_dir):
    base, _ = _landing(spark, sf_dir, with_json=True)
    return L.latest_versions(L.list_landing(spark, base)).select("prefix", "extension", "latest_version", "versions")


V0 = _dt.datetime(2024, 1, 30, 0, 0, 0)


def _key_versions(spark, sf_dir):
    """Three versions of the purchase keys without a header: every third order, every
    second one, all."""
    base = scratch_dir(spark, "landing")
    keys = T.purchases(spark, sf_dir).select("order_id", "line_number", "item_id")
    for at, n in ((V0, 3), (V1, 2), (V2, 1)):
        L.write_landing_csv(keys.where(F.col("order_id") % n == 0), base, "purchase_keys", at, header=False)
    return L.list_landing(spark, base)


def _versions_sql(columns: str) -> str:
    size = "sum(length(CAST(order_id AS VARCHAR)) + length(CAST(line_number AS VARCHAR)) + length(CAST(item_id AS VARCHAR)) + 3)"
    parts = [
        f"SELECT '{L.version_name('purchase_keys', at, 'csv')}' AS version, CAST({rank} AS INTEGER) AS rank, coalesce({size}, 0) AS bytes FROM purch WHERE order_id % {n} = 0"
        for at, n, rank in ((V0, 3, 3), (V1, 2, 2), (V2, 1, 1))
    ]
    return with_views(["purch"], "v AS (" + "\nUNION ALL\n".join(parts) + f")\nSELECT {columns} FROM v")


@register("version_retention", _versions_sql("'purchase_keys' AS prefix, 'csv' AS extension, version, rank, rank > 2 AS expired, CAST(bytes AS BIGINT) AS bytes"))
def q_version_retention(spark, sf_dir):
    return L.version_retention(_key_versions(spark, sf_dir), keep=2).select("prefix", "extension", "version", "rank", "expired", "bytes")


@register("landing_inventory", _versions_sql("'csv' AS extension, rank, version, round(bytes / 1024.0, 1) AS size_kb, rank = 1 AS is_latest"))
def q_landing_inventory(spark, sf_dir):
    return L.landing_inventory(_key_versions(spark, sf_dir))
