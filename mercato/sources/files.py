"""Landing-zone files: versioned CSV / JSON-envelope drops, listing,
latest version, retention, inventory, bronze reads with ingest metadata,
corrupt-record capture and asset fingerprints.

A version is a folder ``{prefix}_{yyyyMMdd_HHmmss}.{ext}`` holding part
files (what a Spark writer produces). Listings come from the
``binaryFile`` source with the ``content`` column pruned, so only file
metadata is read; everything after the listing is DataFrame work.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

VERSION_FORMAT = "%Y%m%d_%H%M%S"


def version_name(prefix: str, ts: _dt.datetime, ext: str) -> str:
    return f"{prefix}_{ts.strftime(VERSION_FORMAT)}.{ext}"


def write_landing_csv(df: DataFrame, base: str, prefix: str, ts: _dt.datetime, header: bool = True) -> str:
    path = f"{base.rstrip('/')}/{version_name(prefix, ts, 'csv')}"
    df.write.mode("errorifexists").option("header", header).csv(path)
    return path


def write_landing_json_envelope(
    df: DataFrame,
    base: str,
    prefix: str,
    ts: _dt.datetime,
    key: str,
    rows_per_envelope: int = 50_000,
    data_field: str = "data",
    multiline: bool = False,
) -> str:
    """Write ``df`` as API-style envelopes ``{status, timestamp, count,
    data: [...]}``, one JSON document per line, or with ``multiline`` one document
    of many lines per file. Rows are spread over
    ``ceil(rows / rows_per_envelope)`` envelopes by their position (not by
    ``key``, which may be skewed or repeated), so every envelope holds about
    ``rows_per_envelope`` rows and no task has to hold a large group."""
    n = df.count()
    buckets = max(1, -(-n // rows_per_envelope))
    path = f"{base.rstrip('/')}/{version_name(prefix, ts, 'json')}"
    rec = F.struct(*[F.col(c) for c in df.columns])
    env = (
        df.withColumn("_bucket", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(buckets)))
        .groupBy("_bucket")
        .agg(F.collect_list(rec).alias(data_field))
        .select(
            F.lit("success").alias("status"),
            F.lit(ts.isoformat()).alias("timestamp"),
            F.size(data_field).alias("count"),
            F.col(data_field),
        )
    )
    if multiline:
        pretty = env.select(F.to_json(F.struct(*env.columns), {"pretty": "true"}).alias("value"))
        pretty.write.mode("errorifexists").option("maxRecordsPerFile", 1).text(path)
    else:
        env.write.mode("errorifexists").json(path)
    return path


def list_landing(spark: SparkSession, base: str, glob: str = "*") -> DataFrame:
    """One row per version folder: prefix, extension, version name and path,
    newest part-file modification time, total bytes and part count."""
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", glob)
        .load(base)
        .select("path", "modificationTime", "length")
    )
    folder = F.regexp_extract("path", r"^(.*)/[^/]+$", 1)
    name = F.regexp_extract("path", r"/([^/]+)/[^/]+$", 1)
    versions = (
        files.withColumn("version_path", folder)
        .withColumn("version", name)
        .where(F.col("version").rlike(r"^.+_\d{8}_\d{6}\.[A-Za-z0-9]+$"))
        .groupBy("version_path", "version")
        .agg(
            F.max("modificationTime").alias("modified_at"),
            F.sum("length").alias("bytes"),
            F.count(F.lit(1)).alias("parts"),
        )
    )
    return versions.withColumns(
        {
            "prefix": F.regexp_extract("version", r"^(.+)_\d{8}_\d{6}\.[A-Za-z0-9]+$", 1),
            "extension": F.regexp_extract("version", r"\.([A-Za-z0-9]+)$", 1),
        }
    )


def _newest_first(listing: DataFrame, by: list[str]) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(F.desc("modified_at"), F.desc("version"))
    return listing.withColumn("rank", F.row_number().over(w))


def latest_versions(listing: DataFrame) -> DataFrame:
    """Newest version per (prefix, extension) (ties by name)."""
    order = F.struct("modified_at", "version")
    return listing.groupBy("prefix", "extension").agg(
        F.max_by("version", order).alias("latest_version"),
        F.max_by("version_path", order).alias("latest_path"),
        F.count(F.lit(1)).alias("versions"),
    )


def latest_path(listing: DataFrame, prefix: str, ext: str) -> str:
    """Path of the newest version of ``prefix`` / ``ext``; raises when none
    exists (one small row comes back to pick the path to read)."""
    row = (
        latest_versions(listing.where((F.col("prefix") == prefix) & (F.col("extension") == ext)))
        .select("latest_path")
        .first()
    )
    if row is None:
        raise FileNotFoundError(f"no files match {prefix}*.{ext}")
    return row.latest_path


def version_retention(listing: DataFrame, keep: int = 10) -> DataFrame:
    """Versions ranked newest first per prefix; those beyond ``keep`` are
    marked expired (deletion is the caller's)."""
    ranked = _newest_first(listing, ["prefix", "extension"])
    return ranked.withColumn("expired", F.col("rank") > keep)


def landing_inventory(listing: DataFrame, per_type: int = 5) -> DataFrame:
    """Newest ``per_type`` versions per extension with size in KB and a
    latest marker."""
    ranked = _newest_first(listing, ["extension"])
    return ranked.where(F.col("rank") <= per_type).select(
        "extension",
        "rank",
        "version",
        F.round(F.col("bytes") / 1024.0, 1).alias("size_kb"),
        (F.col("rank") == 1).alias("is_latest"),
    )


def with_corrupt_column(schema: StructType, name: str = "_corrupt_record") -> StructType:
    if name in schema.fieldNames():
        return schema
    return StructType(list(schema.fields) + [StructField(name, StringType(), True)])


def read_csv_bronze(
    spark: SparkSession,
    path: str,
    schema: StructType,
    corrupt_col: str = "_corrupt_record",
    enforce_header: bool = False,
) -> DataFrame:
    """CSV with header and an explicit schema, PERMISSIVE: a row whose cells
    do not parse keeps its raw text in ``corrupt_col``. With
    ``enforce_header`` a header that does not name the schema's columns
    fails the read instead of binding columns by position."""
    reader = (
        spark.read.schema(with_corrupt_column(schema, corrupt_col))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", corrupt_col)
    )
    if enforce_header:
        reader = reader.option("enforceSchema", False)
    return reader.csv(path)


def split_corrupt(df: DataFrame, corrupt_col: str = "_corrupt_record") -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt column, quarantined raw rows). Spark
    refuses a query that reads only the corrupt column of a raw CSV scan,
    so callers persist or write the scan once before splitting."""
    good = df.where(F.col(corrupt_col).isNull()).drop(corrupt_col)
    bad = df.where(F.col(corrupt_col).isNotNull()).select(corrupt_col)
    return good, bad


def read_json_envelope(
    spark: SparkSession,
    path: str,
    record_schema: StructType | None = None,
    data_field: str = "data",
    multiline: bool = False,
) -> DataFrame:
    """Explode the ``data_field`` array of envelope documents into rows."""
    reader = spark.read.option("mode", "PERMISSIVE").option("multiLine", multiline)
    if record_schema is not None:
        env_schema = StructType.fromJson(
            {
                "type": "struct",
                "fields": [
                    {"name": "status", "type": "string", "nullable": True, "metadata": {}},
                    {"name": "timestamp", "type": "string", "nullable": True, "metadata": {}},
                    {"name": "count", "type": "long", "nullable": True, "metadata": {}},
                    {
                        "name": data_field,
                        "type": {"type": "array", "elementType": record_schema.jsonValue(), "containsNull": True},
                        "nullable": True,
                        "metadata": {},
                    },
                ],
            }
        )
        reader = reader.schema(env_schema)
    raw = reader.json(path)
    return raw.select(F.explode(F.col(data_field)).alias("record"), F.col("_metadata.file_path").alias("_file")).select(
        "record.*", "_file"
    )


def with_ingest_metadata(
    df: DataFrame, source_type: str, batch_time: _dt.datetime, path_col: str | None = None
) -> DataFrame:
    """Bronze metadata: ingest time (ISO text), source file path, source
    type and a ``yyyyMMddHHmmss`` batch id."""
    src = F.col(path_col) if path_col else F.col("_metadata.file_path")
    out = df.withColumns(
        {
            "_ingested_at": F.lit(batch_time.isoformat()),
            "_source_path": src,
            "_source_type": F.lit(source_type),
            "_batch_id": F.lit(batch_time.strftime("%Y%m%d%H%M%S")),
        }
    )
    return out.drop(path_col) if path_col else out


#: A file of more bytes is not handed over as one row, but read as a stream.
MOST_ROW_BYTES = 64 << 20


def _streamed_md5(spark: SparkSession, path: str) -> str:
    """The md5 of a file of any size, read piece by piece by the driver's JVM: md5 is
    a chain over all bytes, so that tasks cannot share a file, and a task gets a
    file only as one row in memory (2 GiB at most)."""
    jvm = spark._jvm
    file = jvm.org.apache.hadoop.fs.Path(path)
    stream = file.getFileSystem(spark._jsc.hadoopConfiguration()).open(file)
    try:
        return jvm.org.apache.commons.codec.digest.DigestUtils.md5Hex(stream)
    finally:
        stream.close()


def asset_fingerprints(spark: SparkSession, assets: DataFrame, base: str, path_col: str = "path") -> DataFrame:
    """MD5 and size (KB, 1 place) of each asset path under ``base``; a
    missing asset gives ``FILE_NOT_FOUND`` and 0. A folder asset (a Spark
    output) is fingerprinted from its part files: md5 of the sorted part
    digests. The listing under ``base`` reads no content; files are matched to
    assets by two equi-joins (the file path itself, or its parent folder), never
    by a prefix scan, and only files of assets are opened. ``assets`` is a
    list of names: its matched files are collected to be opened, those of up to
    ``MOST_ROW_BYTES`` by tasks, larger ones as streams, whatever their size."""
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(base)
        .select("path", F.regexp_replace("path", "^file:", "").alias("file"), "length")
        .withColumn("parent", F.regexp_extract("file", r"^(.*)/[^/]+$", 1))
    )
    a = assets.select(F.regexp_replace(F.col(path_col), "^file:", "").alias("asset")).distinct()
    matched = a.join(listed, a.asset == listed.file).select("asset", "path", "length")
    matched = matched.unionByName(a.join(listed, a.asset == listed.parent).select("asset", "path", "length"))
    files = matched.select("path", "length").distinct().collect()
    most = min(MOST_ROW_BYTES, int(spark.conf.get("spark.sql.sources.binaryFile.maxLength")))
    small = [r.path for r in files if r.length <= most]
    content = spark.createDataFrame([(r.path, _streamed_md5(spark, r.path)) for r in files if r.length > most], "path string, md5 string")
    if small:
        content = content.unionByName(spark.read.format("binaryFile").load(small).select("path", F.md5("content").alias("md5")))
    agg = matched.join(content, "path").groupBy("asset").agg(
        F.array_sort(F.collect_list("md5")).alias("_parts"),
        F.sum("length").alias("_bytes"),
    )
    return a.join(agg, "asset", "left").select(
        F.col("asset").alias("path"),
        F.when(F.col("_parts").isNull(), F.lit("FILE_NOT_FOUND"))
        .when(F.size("_parts") == 1, F.element_at("_parts", 1))
        .otherwise(F.md5(F.array_join("_parts", ",")))
        .alias("checksum"),
        F.coalesce(F.round(F.col("_bytes") / 1024.0, 1), F.lit(0.0)).alias("size_kb"),
    )
