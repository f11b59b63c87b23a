"""Registered streaming queries.

The click stream is produced from the events table as CSV files in a
fresh landing folder, then ingested by an ``availableNow`` file stream into
a parquet bronze table. Run-log rows record each run.
"""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

from mercato.plans.oracle_views import with_views
from mercato.plans.registry import R, finish, register
from mercato.session import scratch_dir
from mercato.sources import tables as T
from mercato.streaming import ingest as S
from mercato.streaming import progress as P

CLICK_SCHEMA = StructType(
    [
        StructField("event_id", LongType()),
        StructField("user_id", LongType()),
        StructField("item_id", LongType()),
        StructField("event_type", StringType()),
        StructField("ts", TimestampNTZType()),
        StructField("value", DoubleType()),
    ]
)
# Landed files are of this size at most (a click is some 80 bytes of text); a run
# takes them in a bounded number of micro-batches.
FILE_BYTES, CLICK_BYTES = 128 << 20, 80
LEAST_FILES, MOST_BATCHES = 8, 8
# Micro-batches of the progress checks: more than a query's progress keeps.
MANY_BATCHES = 104
# Files of a micro-batch of the redelivered days, and how late a click may come.
FILES_OF_DAYS = 8
LATE = "8 days"

# Shared by the queries of a session: read-only folders by (application, tables).
_LANDED: dict[tuple[str, str], tuple[str, int]] = {}
_MANY: dict[tuple[str, str], tuple[str, str]] = {}


def files_of(rows: int) -> int:
    return max(LEAST_FILES, -(-rows * CLICK_BYTES // FILE_BYTES))


def landed(spark, sf_dir) -> tuple[str, int]:
    """(folder, files of a micro-batch) of the click stream as CSV files, landed
    once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _LANDED:
        clicks = T.clickstream(spark, sf_dir)
        files = files_of(clicks.count())
        _LANDED[key] = S.drop_files(clicks, f"{scratch_dir(spark, 'landing')}/clicks", files, "event_id"), -(-files // MOST_BATCHES)
    return _LANDED[key]


def run_stream(spark, sf_dir, runs: int = 1, fail_last: bool = False):
    """Ingest the landed click stream ``runs`` times with one checkpoint (later
    runs find nothing new), logging every run. With
    ``fail_last`` one more run points at a missing folder and is logged as
    FAILED. Returns (table path, run-log path, per-run row counts)."""
    base = scratch_dir(spark, "stream")
    src, per_trigger = landed(spark, sf_dir)
    table, ckpt, log_path = f"{base}/bronze", f"{base}/_checkpoint", f"{base}/run_log"
    counts, total = [], 0

    def note(run: int, status: str, began=None, records: int = 0, tables=(), error: Exception | None = None):
        now = datetime.datetime.now()
        text, kind = (str(error), type(error).__name__) if error else (None, None)
        S.append_events(spark, log_path, [(f"run-{run:04d}", "stream_ingest", "STREAMING", status, now, began, records, list(tables), text, kind)])
        return now

    for i in range(1, runs + 1):
        began = note(i, "RUNNING")
        S.ingest_available(S.enrich(S.file_stream(spark, src, CLICK_SCHEMA, per_trigger)), table, ckpt)
        before, total = total, S.table_rows(spark, table, CLICK_SCHEMA)
        counts.append(total - before)
        note(i, "SUCCESS", began, total - before, ["user_interaction_logs"])
    if fail_last:
        began = note(runs + 1, "RUNNING")
        try:
            S.ingest_available(
                S.enrich(S.file_stream(spark, f"{base}/missing", CLICK_SCHEMA)), table, f"{base}/_ckpt_missing"
            )
        except Exception as e:  # noqa: BLE001 - the failure is what is logged
            note(runs + 1, "FAILED", began, error=e)
    return table, log_path, counts


@register(
    "stream_ingest",
    with_views(
        ["clicks"],
        f"SELECT event_id, user_id, item_id, event_type, ts, {R('value')}, 'streaming_csv' AS _source_type FROM clicks",
    ),
)
def q_stream_ingest(spark, sf_dir):
    table, _, _ = run_stream(spark, sf_dir)
    bronze = spark.read.parquet(table)
    return finish(bronze.select(*CLICK_SCHEMA.fieldNames(), "_source_type"))


@register(
    "stream_exactly_once",
    with_views(
        ["clicks"],
        "SELECT count(*) AS first_run_rows, CAST(0 AS BIGINT) AS second_run_rows, count(*) AS table_rows FROM clicks",
    ),
)
def q_stream_exactly_once(spark, sf_dir):
    table, _, counts = run_stream(spark, sf_dir, runs=2)
    return spark.read.parquet(table).agg(F.count(F.lit(1)).alias("table_rows")).select(
        F.lit(counts[0]).cast("bigint").alias("first_run_rows"),
        F.lit(counts[1]).cast("bigint").alias("second_run_rows"),
        "table_rows",
    )


@register(
    "stream_table_stats",
    with_views(
        ["clicks"],
        "SELECT count(*) AS total_rows, count(DISTINCT user_id) AS unique_users, count(DISTINCT item_id) AS unique_items FROM clicks",
    ),
)
def q_stream_table_stats(spark, sf_dir):
    table, _, _ = run_stream(spark, sf_dir)
    return S.table_stats(spark.read.parquet(table))


@register(
    "stream_event_counts",
    with_views(["clicks"], "SELECT event_type, count(*) AS count FROM clicks GROUP BY event_type"),
)
def q_stream_event_counts(spark, sf_dir):
    table, _, _ = run_stream(spark, sf_dir)
    return S.event_counts(spark.read.parquet(table))


@register(
    "stream_progress",
    with_views(
        ["clicks"],
        f"SELECT CAST({MANY_BATCHES} AS BIGINT) AS batches, CAST(count(*) AS BIGINT) AS rows_over_batches, count(*) AS table_rows FROM clicks",
    ),
)
def q_stream_progress(spark, sf_dir):
    """Exact record counts of a run of many micro-batches (one file each)."""
    path, _ = many_batches(spark, sf_dir)
    table = spark.read.parquet(path)
    counts = S.batch_counts(table).agg(F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows_over_batches"))
    return counts.withColumn("table_rows", table.select(F.count(F.lit(1))).scalar())


def many_batches(spark, sf_dir) -> tuple[str, str]:
    """(table, progress log) of a run with one micro-batch per remainder of the
    event id, in order; run once a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MANY:
        _MANY[key] = _run_many(spark, sf_dir)
    return _MANY[key]


def _run_many(spark, sf_dir) -> tuple[str, str]:
    base = scratch_dir(spark, "stream")
    clicks = T.clickstream(spark, sf_dir).withColumn("part", (F.col("event_id") % MANY_BATCHES).cast("int"))
    src = S.drop_parts(clicks, f"{base}/landing", "part", one_file_each=True)
    table, log = f"{base}/bronze", f"{base}/progress"
    with P.ProgressLog(spark, log, flush_rows=60) as listener:
        run = S.ingest_available(S.enrich(S.file_stream(spark, src, CLICK_SCHEMA, 1)), table, f"{base}/_checkpoint", "clicks")
        listener.wait(str(run.runId))
    return table, log


@register(
    "stream_batch_progress",
    with_views(
        ["clicks"],
        f"SELECT row_number() OVER (ORDER BY event_id % {MANY_BATCHES}) - 1 AS batch_id, count(*) AS rows, count(*) AS table_rows, "
        f"TRUE AS rates_agree, TRUE AS has_input_rate FROM clicks GROUP BY event_id % {MANY_BATCHES}",
    ),
)
def q_stream_batch_progress(spark, sf_dir):
    """R4: what the listener logged for each micro-batch, against the rows that the
    table holds of it."""
    table, log = many_batches(spark, sf_dir)
    progress = P.read_progress(spark, log)
    held = S.batch_counts(spark.read.parquet(table)).select((F.col("batch") - 1).alias("held_batch"), F.col("rows").alias("table_rows"))
    joined = progress.join(held, F.col("batch_id") == F.col("held_batch"), "full")
    # the first batch of a run has no trigger before it to measure the input rate from
    has_rate = (F.col("batch_id") == 0) | (F.col("input_rows_per_second") > 0)
    return joined.select("batch_id", "rows", "table_rows", P.rates_agree().alias("rates_agree"), has_rate.alias("has_input_rate"))


@register(
    "run_log_latest",
    with_views(
        ["clicks"],
        "SELECT 'run-0001' AS run_id, 'STREAMING' AS job_type, 'SUCCESS' AS status, count(*) AS records_processed, "
        "'user_interaction_logs' AS tables_updated, CAST(NULL AS VARCHAR) AS error_type FROM clicks "
        "UNION ALL SELECT 'run-0002', 'STREAMING', 'SUCCESS', NULL, 'user_interaction_logs', NULL "
        "UNION ALL SELECT 'run-0003', 'STREAMING', 'FAILED', NULL, NULL, 'AnalysisException'",
    ),
)
def q_run_log_latest(spark, sf_dir):
    _, log_path, _ = run_stream(spark, sf_dir, runs=2, fail_last=True)
    return S.recent_runs(spark.read.parquet(log_path)).select(
        "run_id", "job_type", "status", "records_processed", "tables_updated", "error_type"
    )


@register(
    "stream_dedupe",
    with_views(
        ["clicks"],
        f"SELECT event_id, user_id, item_id, event_type, ts, {R('value')} FROM clicks",
    ),
)
def q_stream_dedupe(spark, sf_dir):
    """Every event is delivered twice, the second time behind the other events of
    its day; the watermarked dedupe on ``event_id`` lets one copy through."""
    base = scratch_dir(spark, "stream")
    clicks = T.clickstream(spark, sf_dir)
    day = F.datediff(F.col("ts"), F.lit("1970-01-01").cast("date"))
    twice = clicks.withColumn("part", 2 * day).unionByName(clicks.withColumn("part", 2 * day + 1))
    first = twice.select(F.min("part")).first()[0] or 0
    src = S.drop_parts(twice.withColumn("part", F.col("part") - first), f"{base}/landing", "part")
    stream = S.dedupe_within_watermark(S.file_stream(spark, src, CLICK_SCHEMA, FILES_OF_DAYS), ["event_id"], "ts", LATE)
    S.ingest_available(stream, f"{base}/bronze", f"{base}/_checkpoint")
    return finish(spark.read.parquet(f"{base}/bronze").select(*CLICK_SCHEMA.fieldNames()))
