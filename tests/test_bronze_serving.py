import datetime as dt
import tempfile

from pyspark.sql import functions as F

from mercato.plans import serving as SV
from mercato.plans.bronze import BronzeSource, bronze_run
from mercato.sources import files as L
from mercato.sources import sinks as K
from mercato.streaming import ingest as S
from mercato.streaming import progress as P


def test_a_batch_that_is_written_again_replaces_itself(spark):
    path = tempfile.mkdtemp(prefix="mercato-split-") + "/t"
    schema = spark.createDataFrame([], "a int, b string").schema
    first = spark.createDataFrame([(1, "x", None), (None, None, "bad,row"), (2, "y", None)], "a int, b string, _corrupt_record string")
    for batch in (0, 0, 1):
        S.write_split(first, path, batch)
    good, bad = S.read_split(spark, path, schema)
    assert good.count() == 4 and bad.count() == 2 and good.columns == ["a", "b", "batch"]
    S.write_split(first.where("a = 1"), path, 1)
    good, bad = S.read_split(spark, path, schema)
    assert good.count() == 3 and bad.count() == 1


def test_bronze_run_goes_on_after_a_failing_source(spark):
    base = tempfile.mkdtemp(prefix="mercato-bronze-")
    df = spark.createDataFrame([(i, f"n{i}") for i in range(30)], "item_id long, name string")
    L.write_landing_json_envelope(df, f"{base}/in", "items", dt.datetime(2024, 1, 1), "item_id", rows_per_envelope=7, multiline=True)
    sources = [BronzeSource("none", "none", "csv", df.schema, ["a"]), BronzeSource("items", "items", "json", df.schema, ["item_id", "price"], multiline=True)]
    tables, report, log = bronze_run(spark, sources, f"{base}/in", base, dt.datetime(2024, 1, 2), "r1")
    assert set(tables) == {"items"} and tables["items"][0].count() == 30 and tables["items"][1].count() == 0
    assert {(r.column_name, r.status) for r in report.collect()} == {("item_id", "OK"), ("price", "MISSING")}
    assert {(r.run_id, r.status, r.error_type) for r in S.latest_status(log).collect()} == {("r1-none", "FAILED", "FileNotFoundError"), ("r1-items", "SUCCESS", None)}


def test_progress_log_has_a_row_per_batch(spark):
    base = tempfile.mkdtemp(prefix="mercato-progress-")
    df = spark.createDataFrame([(i, i % 5) for i in range(57)], "event_id long, part int")
    S.drop_parts(df, f"{base}/in", "part", one_file_each=True)
    with P.ProgressLog(spark, f"{base}/log", flush_rows=2) as log:
        run = S.ingest_available(S.enrich(S.file_stream(spark, f"{base}/in", df.drop("part").schema, 1)), f"{base}/out", f"{base}/ck", "clicks")
        log.wait(str(run.runId))
    rows = P.read_progress(spark, f"{base}/log").orderBy("batch_id").collect()
    assert [(r.batch_id, r.rows, r.query_name) for r in rows] == [(k, 12 if k < 2 else 11, "clicks") for k in range(5)]
    assert P.read_progress(spark, f"{base}/log").where(~P.rates_agree()).count() == 0
    total = P.run_summary(P.read_progress(spark, f"{base}/log")).first()
    assert (total.batches, total.rows) == (5, 57) and total.max_latency_ms >= total.median_latency_ms > 0


def test_lookup_returns_values_and_reads_only_the_buckets_of_its_keys(spark):
    users = spark.createDataFrame([(i, i / 2, float("nan") if i == 1 else 1.0, 5) for i in range(40)], "user_id long, a double, b double, _c int")
    rows = SV.serving_rows(users, "user", "user_id", ["a", "b", "_c"])
    path = tempfile.mkdtemp(prefix="mercato-serving-") + "/t"
    at = F.lit("2024-02-01 00:00:00")
    SV.write_serving(SV.with_expiry(rows.where("entity_id < 20"), at, 60), path, 8)
    asked = spark.createDataFrame([("user", 1), ("user", 1), ("user", 30), ("user", 99), ("item", 1)], "namespace string, entity_id long")
    stored = SV.stored_rows(spark, path, asked, 8)
    assert len(stored.inputFiles()) <= 8 and "PartitionFilters: [bucket" in stored._jdf.queryExecution().toString()
    got = {(r.namespace, r.entity_id): (r.source, r.features) for r in SV.lookup_values(asked, stored, rows, "2024-02-01 00:00:30").collect()}
    assert got == {("user", 1): ("online", {"a": 0.5, "b": None}), ("user", 30): ("offline", {"a": 15.0, "b": 1.0}), ("user", 99): ("none", None), ("item", 1): ("none", None)}
    late = SV.lookup_values(asked, stored, rows.where("entity_id > 1"), "2024-02-01 00:01:00")
    assert {r.entity_id: r.source for r in late.where("namespace = 'user'").collect()} == {1: "none", 30: "offline", 99: "none"}
    assert SV.feature_values(late).count() == 5


def test_replace_table_keeps_the_old_rows_when_the_write_fails(spark):
    name = "replaced_" + dt.datetime.now().strftime("%H%M%S%f")
    spark.createDataFrame([(1,), (2,)], "id int").write.format("parquet").saveAsTable(name)
    broken = spark.table(name).select(F.raise_error(F.lit("no")).cast("int").alias("id"))
    try:
        K.replace_table(broken, name)
    except Exception:  # noqa: BLE001
        pass
    assert sorted(r.id for r in spark.table(name).collect()) == [1, 2]
    K.replace_table(spark.table(name).withColumn("v", F.lit("x")), name)
    assert sorted(map(tuple, spark.table(name).collect())) == [(1, "x"), (2, "x")]
    spark.sql(f"DROP TABLE {name}")


def test_split_batch_is_written_without_a_sort(spark, tmp_path):
    """Good and bad rows are written side by side: the rows keep their order."""
    from mercato.streaming import ingest as S

    rows = [(i, "bad" if i % 3 == 0 else None) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, _corrupt_record string").coalesce(1)
    spark.conf.unset("spark.sql.maxConcurrentOutputFileWriters")
    S.write_split(df, str(tmp_path / "t"), "1")
    assert int(spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")) >= 2
    found = spark.read.parquet(str(tmp_path / "t"))
    kinds = {k: sorted(r.id for r in found.where(F.col("kind") == k).collect()) for k in ("good", "bad")}
    assert kinds == {"good": [i for i in range(3000) if i % 3], "bad": [i for i in range(3000) if i % 3 == 0]}
