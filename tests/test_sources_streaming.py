import datetime as dt
import hashlib
import math
import random
import tempfile

from pyspark.sql import functions as F

from mercato.operators.quantiles import exact_quantile_exprs
from mercato.sources import files as L
from mercato.streaming import ingest as S


def _dir():
    return tempfile.mkdtemp(prefix="mercato-test-")


def test_landing_latest_retention_and_envelope(spark):
    base = _dir()
    df = spark.createDataFrame([(i, f"n{i}") for i in range(50)], "item_id long, name string")
    L.write_landing_csv(df, base, "items", dt.datetime(2024, 1, 1))
    L.write_landing_csv(df, base, "items", dt.datetime(2024, 1, 2))
    L.write_landing_json_envelope(df, base, "catalog", dt.datetime(2024, 1, 3), key="item_id", rows_per_envelope=7)
    listing = L.list_landing(spark, base)
    latest = {(r.prefix, r.extension): (r.latest_version, r.versions) for r in L.latest_versions(listing).collect()}
    assert latest[("items", "csv")] == ("items_20240102_000000.csv", 2)
    assert latest[("catalog", "json")][1] == 1
    ret = {r.version: r.expired for r in L.version_retention(listing, keep=1).collect()}
    assert ret["items_20240101_000000.csv"] is True and ret["items_20240102_000000.csv"] is False
    path = L.latest_path(listing, "catalog", "json")
    rows = L.read_json_envelope(spark, path, df.schema)
    assert sorted(r.item_id for r in rows.collect()) == list(range(50))
    envelopes = spark.read.json(path)
    assert envelopes.count() == math.ceil(50 / 7) and envelopes.agg(F.max("count")).first()[0] <= 50


def test_latest_path_missing_raises(spark):
    base = _dir()
    L.write_landing_csv(spark.createDataFrame([(1,)], "a int"), base, "x", dt.datetime(2024, 1, 1))
    try:
        L.latest_path(L.list_landing(spark, base), "nope", "csv")
    except FileNotFoundError:
        return
    raise AssertionError("expected FileNotFoundError")


def test_corrupt_rows_are_captured(spark):
    base = _dir()
    path = f"{base}/f.csv"
    with open(path, "w") as fh:
        fh.write("a,b\n1,2.5\nx,3.0\n4,oops\n")
    df = L.read_csv_bronze(spark, path, spark.createDataFrame([], "a int, b double").schema).checkpoint()
    good, bad = L.split_corrupt(df)
    assert good.count() == 1 and bad.count() == 2


def test_fingerprints(spark):
    base = _dir()
    with open(f"{base}/a.txt", "w") as fh:
        fh.write("hello")
    assets = spark.createDataFrame([(f"{base}/a.txt",), (f"{base}/missing.txt",)], "path string")
    got = {r.path: (r.checksum, r.size_kb) for r in L.asset_fingerprints(spark, assets, base).collect()}
    assert got[f"{base}/a.txt"][0] == "5d41402abc4b2a76b9719d911017c592"
    assert got[f"{base}/missing.txt"] == ("FILE_NOT_FOUND", 0.0)


def test_asset_fingerprints_of_files_too_large_for_a_row(spark, tmp_path, monkeypatch):
    texts = {"large one.bin": bytes(range(256)) * 700, "folder/part-0": b"x" * 90_000, "folder/part-1": b"y"}
    for name, data in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    md5 = {name: hashlib.md5(data).hexdigest() for name, data in texts.items()}
    folder = hashlib.md5(",".join(sorted([md5["folder/part-0"], md5["folder/part-1"]])).encode()).hexdigest()
    want = {"large one.bin": (md5["large one.bin"], 175.0), "folder": (folder, 87.9), "none": ("FILE_NOT_FOUND", 0.0)}
    assets = spark.createDataFrame([(f"{tmp_path}/{name}",) for name in want], "path string")

    def found():
        return {r.path.removeprefix(f"{tmp_path}/"): (r.checksum, r.size_kb) for r in L.asset_fingerprints(spark, assets, str(tmp_path)).collect()}

    assert found() == want
    key = "spark.sql.sources.binaryFile.maxLength"
    spark.conf.set(key, "1000")  # stands for the 2 GiB that Spark hands over as a row
    try:
        assert found() == want
    finally:
        spark.conf.unset(key)
    monkeypatch.setattr(L, "MOST_ROW_BYTES", 0)
    assert found() == want


def test_stream_is_exactly_once(spark):
    base = _dir()
    df = spark.createDataFrame(
        [(i, i % 3, i % 5, "view", dt.datetime(2024, 1, 1, 0, 0, i % 60, 123456), float(i)) for i in range(40)],
        "event_id long, user_id long, item_id long, event_type string, ts timestamp_ntz, value double",
    )
    S.drop_files(df, f"{base}/in", 4, "event_id")
    runs = []
    for _ in range(2):
        q = S.ingest_available(S.enrich(S.file_stream(spark, f"{base}/in", df.schema, 2)), f"{base}/out", f"{base}/ck")
        runs.append(sum(p["numInputRows"] for p in q.recentProgress))
    out = spark.read.parquet(f"{base}/out")
    assert runs == [40, 0] and out.count() == 40
    assert out.select("ts").exceptAll(df.select("ts")).count() == 0  # microseconds survive the CSV hop


def test_bracketed_median_matches_bruteforce(spark):
    rnd = random.Random(5)
    xs = [rnd.random() * 100 for _ in range(3001)] + [None] * 3
    df = spark.createDataFrame([(x, float(i % 7)) for i, x in enumerate(xs)], "x double, y double")
    vals = sorted(x for x in xs if x is not None)
    ys = sorted(float(i % 7) for i in range(len(xs)))
    # whole column sorted; bracketed candidates; distributed fallback
    for all_limit, limit in ((1_000_000, 4_000_000), (0, 4_000_000), (0, 0)):
        exprs = exact_quantile_exprs(df, ["x", "y"], 0.5, candidate_limit=limit, collect_all_limit=all_limit)
        aggs = [e.alias(c) for c, (e, is_agg) in exprs.items() if is_agg]
        row = df.agg(*aggs).first() if aggs else None
        got = {c: (row[c] if is_agg else spark.range(1).select(e.alias("v")).first().v) for c, (e, is_agg) in exprs.items()}
        assert got["x"] == vals[math.ceil(0.5 * len(vals)) - 1]
        assert got["y"] == ys[math.ceil(0.5 * len(ys)) - 1]
