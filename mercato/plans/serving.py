"""The stored serving table: feature values by entity, with expiry.

Rows (namespace, entity_id, features, written_at, expires_at) lie in buckets by the
hash of their key, sorted by it, with a Bloom filter on the entity in every file.
A batch of lookups reads the buckets of its keys only; a small batch also hands its
keys to the scan, which then skips files and row groups by these filters.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
# Keys that a batch hands to the scan as a list.
FEW_KEYS = 1000


def serving_bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("namespace", "entity_id"), F.lit(buckets)).cast("int")


def serving_rows(df: DataFrame, namespace: str, id_col: str, features: Sequence[str]) -> DataFrame:
    """(namespace, entity_id, features): numeric features as a map, NaN as NULL,
    columns that begin with ``_`` never."""
    cells = []
    for c in features:
        if not c.startswith("_"):
            x = F.col(c).cast("double")
            cells += [F.lit(c), F.when(~F.isnan(x), x)]
    return df.select(F.lit(namespace).alias("namespace"), F.col(id_col).cast("bigint").alias("entity_id"), F.create_map(*cells).alias("features"))


def with_expiry(rows: DataFrame, written_at: Column, ttl_seconds: int) -> DataFrame:
    at = written_at.cast("timestamp")
    return rows.withColumns({"written_at": at, "expires_at": at + F.make_interval(secs=F.lit(ttl_seconds))})


def write_serving(rows: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write the serving table; rows of a key lie in one bucket."""
    (
        rows.withColumn("bucket", serving_bucket(buckets))
        .repartition("bucket")
        .sortWithinPartitions("bucket", "namespace", "entity_id")
        .write.partitionBy("bucket")
        .option("parquet.bloom.filter.enabled#entity_id", "true")
        .parquet(path)
    )


def stored_rows(spark: SparkSession, path: str, requests: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows of the serving table that the requests may need: of their buckets
    only, of their keys only if these are few."""
    wanted = [r[0] for r in requests.select(serving_bucket(buckets).alias("b")).distinct().collect()]
    rows = spark.read.parquet(path).where(F.col("bucket").isin(wanted))
    keys = requests.select("entity_id").distinct().limit(FEW_KEYS + 1).collect()
    return rows.where(F.col("entity_id").isin([r[0] for r in keys])) if len(keys) <= FEW_KEYS else rows


def lookup_values(requests: DataFrame, serving: DataFrame, offline: DataFrame, at: str | _dt.datetime) -> DataFrame:
    """(namespace, entity_id, source, features) of each requested key: the features
    of an unexpired serving row (``online``), else those of the offline table
    (``offline``), else none (``none``). Repeated requests are answered once."""
    t = F.lit(str(at)).cast("timestamp")
    key = ["namespace", "entity_id"]
    fresh = serving.where(t < F.col("expires_at"))
    newest = fresh.groupBy(*key).agg(F.max_by("features", "written_at").alias("online"))
    kept = offline.groupBy(*key).agg(F.any_value("features").alias("offline"))
    found = requests.select(*key).distinct().join(newest, key, "left").join(kept, key, "left")
    source = F.when(F.col("online").isNotNull(), "online").when(F.col("offline").isNotNull(), "offline").otherwise("none")
    return found.select(*key, source.alias("source"), F.coalesce("online", "offline").alias("features"))


def feature_values(resolved: DataFrame) -> DataFrame:
    """Resolved requests with a row per feature; one with NULLs if nothing was found."""
    return resolved.select("namespace", "entity_id", "source", F.explode_outer("features").alias("feature_name", "feature_value"))


def hit_statistics(resolved: DataFrame, by: Sequence[str] = ("namespace",)) -> DataFrame:
    """Requests, hits and misses by namespace, and the hit rate (3 places)."""
    online = F.count_if(F.col("source") == "online")
    total = F.count(F.lit(1))
    rate = F.bround((online / total).try_cast("decimal(38,9)"), 3).cast("double")
    return resolved.groupBy(*by).agg(
        total.alias("requests"),
        online.alias("cache_hits"),
        (total - online).alias("cache_misses"),
        F.count_if(F.col("source") == "offline").alias("offline_fallbacks"),
        F.count_if(F.col("source") == "none").alias("not_found"),
        rate.alias("hit_rate"),
    )


def materialise(frames: Mapping[str, tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """``serving_rows`` of several (frame, id column, features) by namespace."""
    out: DataFrame | None = None
    for namespace, (df, id_col, features) in frames.items():
        part = serving_rows(df, namespace, id_col, features)
        out = part if out is None else out.unionByName(part)
    if out is None:
        raise ValueError("nothing to serve")
    return out
