"""Registered queries of the batch bronze run and of the quarantine."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from mercato.plans.bronze import CORRUPT, BronzeSource, bronze_run
from mercato.plans.oracle_views import with_views
from mercato.plans.q_streaming import CLICK_SCHEMA
from mercato.plans.registry import register
from mercato.session import scratch_dir
from mercato.sources import files as L
from mercato.sources import tables as T
from mercato.streaming import ingest as S

V1, V2 = _dt.datetime(2024, 1, 31), _dt.datetime(2024, 2, 1)
BATCH_TIMES = _dt.datetime(2024, 2, 1, 2), _dt.datetime(2024, 2, 1, 4)
# Rows of a landed file whose cells do not parse, by a rule on the key.
BAD_ORDERS, BAD_EVENTS = 9, 11


def _run(spark, sf_dir):
    """Land two versions of the purchases (the newest with bad cells) and the catalogue
    as documents of many lines, and run the batch three times: a first batch, a
    second one, and the second one again."""
    base = scratch_dir(spark, "bronze")
    landing = f"{base}/landing"
    p, cat = T.purchases(spark, sf_dir), T.catalog(spark, sf_dir)
    mixed = p.withColumn("quantity", F.when(F.col("order_id") % BAD_ORDERS == 0, "n/a").otherwise(F.col("quantity").cast("string")))
    L.write_landing_csv(p.where("false"), landing, "purchase_history", V1)
    L.write_landing_csv(mixed, landing, "purchase_history", V2)
    L.write_landing_json_envelope(cat, landing, "product_catalog", V2, key="item_id", rows_per_envelope=500, multiline=True)
    sources = [
        BronzeSource("purchase_history", "purchase_history", "csv", p.schema, ["order_id", "user_id", "quantity"]),
        BronzeSource("product_catalog", "product_catalog", "json", cat.schema, ["item_id", "price", "tags"], multiline=True),
        BronzeSource("external_signals", "external_signals", "json", cat.schema, ["item_id"]),
    ]
    out = None
    for n, at in enumerate((BATCH_TIMES[0], BATCH_TIMES[1], BATCH_TIMES[1]), 1):
        out = bronze_run(spark, sources, landing, base, at, f"run-{n:04d}")
    return out


@register(
    "bronze_batch_run",
    with_views(
        ["purch", "cat"],
        f"""
n AS (SELECT 'purchase_history' AS source, count(*) FILTER (WHERE order_id % {BAD_ORDERS} <> 0) AS good, count(*) FILTER (WHERE order_id % {BAD_ORDERS} = 0) AS bad,
             sum(order_id) FILTER (WHERE order_id % {BAD_ORDERS} <> 0) AS keys, 0 AS warnings FROM purch
      UNION ALL SELECT 'product_catalog', count(*), 0, sum(item_id), 1 FROM cat)
SELECT source, CAST(2 AS BIGINT) AS batches, CAST(2 * good AS BIGINT) AS good_rows, CAST(2 * bad AS BIGINT) AS bad_rows, CAST(2 * keys AS BIGINT) AS key_sum,
       CAST(warnings AS BIGINT) AS warnings, 'SUCCESS' AS status, CAST(good AS BIGINT) AS records_processed, CAST(NULL AS VARCHAR) AS error_type FROM n
UNION ALL SELECT 'external_signals', NULL, NULL, NULL, NULL, NULL, 'FAILED', NULL, 'FileNotFoundError'""",
    ),
)
def q_bronze_batch_run(spark, sf_dir):
    """Two batches, one of them run twice: every batch counts once. The last run's
    log, with a source that has no file."""
    tables, report, log = _run(spark, sf_dir)
    keys = {"purchase_history": "order_id", "product_catalog": "item_id"}
    counts = None
    for name, (good, bad) in tables.items():
        g = good.agg(F.countDistinct("batch").alias("batches"), F.count(F.lit(1)).alias("good_rows"), F.sum(keys[name]).alias("key_sum"))
        part = g.select(F.lit(name).alias("source"), "batches", "good_rows", bad.select(F.count(F.lit(1))).scalar().alias("bad_rows"), "key_sum")
        counts = part if counts is None else counts.unionByName(part)
    warnings = report.groupBy("source").agg(F.count_if(F.col("status") != "OK").alias("warnings"))
    last = S.latest_status(log).where(F.col("run_id").startswith("run-0003")).select(F.col("tables_updated"), F.regexp_extract("run_id", "run-0003-(.*)", 1).alias("source"), "status", "records_processed", "error_type")
    return last.join(counts, "source", "left").join(warnings, "source", "left").select(
        "source", "batches", "good_rows", "bad_rows", "key_sum", "warnings", "status", "records_processed", "error_type"
    )


@register(
    "bronze_quarantine",
    with_views(
        ["purch"],
        f"SELECT order_id, line_number, 'n/a' AS quantity, 2 * count(*) AS rows FROM purch WHERE order_id % {BAD_ORDERS} = 0 GROUP BY order_id, line_number",
    ),
)
def q_bronze_quarantine(spark, sf_dir):
    """The quarantined rows keep their text: key and bad cell are read from it."""
    tables, _, _ = _run(spark, sf_dir)
    cells = F.split(CORRUPT, ",")
    bad = tables["purchase_history"][1].select(cells[0].cast("bigint").alias("order_id"), cells[1].cast("int").alias("line_number"), cells[4].alias("quantity"))
    return bad.groupBy("order_id", "line_number", "quantity").agg(F.count(F.lit(1)).alias("rows"))


@register(
    "stream_quarantine",
    with_views(
        ["clicks"],
        f"""
k AS (SELECT *, CASE WHEN event_id % {BAD_EVENTS} = 0 THEN 'bad' ELSE 'good' END AS kind FROM clicks)
SELECT kind, count(*) AS rows, count(*) AS rows_after_replay, CAST(sum(event_id) AS BIGINT) AS key_sum FROM k GROUP BY kind""",
    ),
)
def q_stream_quarantine(spark, sf_dir):
    """A stream of mixed files; then its micro-batches are delivered once more under
    the same batch ids."""
    base = scratch_dir(spark, "quarantine")
    clicks = T.clickstream(spark, sf_dir)
    mixed = clicks.withColumn("user_id", F.when(F.col("event_id") % BAD_EVENTS == 0, "unknown").otherwise(F.col("user_id").cast("string")))
    S.drop_parts(mixed.withColumn("part", F.pmod("event_id", F.lit(3)).cast("int")), f"{base}/landing", "part", one_file_each=True)

    def deliver(checkpoint: str):
        stream = S.raw_file_stream(spark, f"{base}/landing", CLICK_SCHEMA, CORRUPT, 1)
        S.ingest_split(stream, f"{base}/table", f"{base}/{checkpoint}", CORRUPT)
        good, bad = S.read_split(spark, f"{base}/table", CLICK_SCHEMA, CORRUPT)
        keyed = good.select(F.lit("good").alias("kind"), "event_id").unionByName(bad.select(F.lit("bad").alias("kind"), F.split(CORRUPT, ",")[0].cast("bigint").alias("event_id")))
        return keyed.groupBy("kind").agg(F.count(F.lit(1)).alias("rows"), F.sum("event_id").alias("key_sum")).checkpoint(eager=True)

    first, again = deliver("ck1"), deliver("ck2")
    return first.select("kind", "rows").join(again.select("kind", F.col("rows").alias("rows_after_replay"), "key_sum"), "kind")
