"""Sinks and catalog helpers: append with schema evolution, whole-table
snapshots, database/log-table creation, CSV export/load, one-row JSON
documents, literal frames and typed previews.

Tables are parquet (the reference writes Delta, which is not installed
here). Additive schema evolution uses parquet's per-file schemas merged
at read time; a table that is replaced while it is being read gets a new
folder and is then pointed to it.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def append_path(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), sort_within: Sequence[str] = ()
) -> None:
    """Append files to a parquet table folder; new columns are allowed and
    show up through ``read_evolving``. ``sort_within`` sorts each output
    file (better min/max pruning on that column) without a global sort."""
    w = (df.sortWithinPartitions(*sort_within) if sort_within else df).write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a parquet table whose files carry different (additive) schemas."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def append_table(df: DataFrame, table: str) -> None:
    """Append to a catalogued table; columns missing on either side are
    filled with NULL by name (additive evolution)."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.mode("append").format("parquet").saveAsTable(table)
        return
    existing = spark.table(table)
    missing_in_new = [c for c in existing.columns if c not in df.columns]
    new = [f for f in df.schema.fields if f.name not in existing.columns]
    if new:
        # Only the catalogue changes; files written before read as NULL.
        added = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({added})")
        spark.catalog.refreshTable(table)
        existing = spark.table(table)
    aligned = df.select(*[F.col(c) for c in df.columns], *[F.lit(None).cast(existing.schema[c].dataType).alias(c) for c in missing_in_new])
    aligned.select(*existing.columns).write.mode("append").insertInto(table)


def replace_table(df: DataFrame, table: str) -> None:
    """Overwrite a table with ``df`` even when ``df`` reads that table. The new rows
    are written as a table of their own first. With the same columns the old
    table is then pointed to them, which is one step; else the old table is
    renamed, the new one takes its name, and only then the old one is dropped.
    A failure on the way leaves the old rows readable."""
    spark = df.sparkSession
    tag = uuid.uuid4().hex[:8]
    staging, former = f"{table}__staging_{tag}", f"{table}__former_{tag}"
    exists = spark.catalog.tableExists(table)
    same = exists and [(f.name, f.dataType) for f in spark.table(table).schema] == [(f.name, f.dataType) for f in df.schema]
    if same:
        folder = f"{table_location(spark, table)}__v_{tag}"
        df.write.parquet(folder)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
        return
    df.write.mode("overwrite").format("parquet").saveAsTable(staging)
    if exists:
        spark.sql(f"ALTER TABLE {table} RENAME TO {former}")
    spark.sql(f"ALTER TABLE {staging} RENAME TO {table}")
    if exists:
        spark.sql(f"DROP TABLE {former}")


def table_location(spark: SparkSession, table: str) -> str:
    """The folder of a catalogued table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where(F.col("col_name") == "Location")
    return rows.first()["data_type"].rstrip("/")


def overwrite_snapshot(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").format("parquet").saveAsTable(table)


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def ensure_table(spark: SparkSession, name: str, schema: StructType) -> None:
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")


def export_csv(df: DataFrame, path: str, sort_within: Sequence[str] = ()) -> None:
    """Distributed CSV export with a header (one file per partition);
    ``sort_within`` orders rows inside each file (e.g. by time) without a
    global sort."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    out.write.mode("overwrite").option("header", True).csv(path)


def load_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def json_document(df: DataFrame, name: str, generated_at: str | None = None) -> DataFrame:
    """All rows of a small result (a profile, a scorecard) as one JSON
    document row. Only for results whose size is bounded by metadata (one
    row per column or check), never for data tables."""
    ts = F.lit(generated_at) if generated_at else F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss")
    return df.agg(F.to_json(F.collect_list(F.struct(*[F.col(c) for c in df.columns]))).alias(name)).withColumn(
        "generated_at", ts
    )


def literal_frame(spark: SparkSession, rows: list[tuple], schema: StructType | str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def preview(df: DataFrame, columns: Sequence[str], n: int = 20, order_by: Sequence[str] = ()) -> DataFrame:
    """Typed preview: fixed columns, first ``n`` rows (in key order when
    given, so the preview is repeatable)."""
    out = df.select(*columns)
    if order_by:
        out = out.orderBy(*order_by)
    return out.limit(n)


def read_features(
    table: DataFrame,
    pk: str,
    keys: DataFrame | None = None,
    columns: Sequence[str] | None = None,
    broadcast_limit: int = 1_000_000,
) -> DataFrame:
    """Rows of a feature table for a set of keys (all rows without keys),
    optionally only some columns. The key list is broadcast only when a
    size check passes; otherwise the semi join shuffles."""
    out = table
    if keys is not None:
        k = keys.select(F.col(keys.columns[0]).alias(pk)).distinct()
        n = k.limit(broadcast_limit + 1).count()
        side = F.broadcast(k) if n <= broadcast_limit else k
        out = out.join(side, pk, "left_semi")
    if columns:
        out = out.select(*([pk] if pk not in columns else []), *columns)
    return out


def feature_subset(df: DataFrame, names: Sequence[str], strict: bool = False) -> DataFrame:
    """Columns of ``names`` that exist; ``strict`` raises on missing ones."""
    missing = [c for c in names if c not in df.columns]
    if strict and missing:
        raise KeyError(f"unknown features: {missing}")
    return df.select(*[c for c in names if c in df.columns])
