"""Feature store as table work: catalogue, feature sets, versions,
training sets, serving table and vectors, point-in-time join, upserts.

The reference keeps these in SQLite and a Python dict; here every piece is
a DataFrame, so building a training set or a batch of serving vectors is
one distributed join, and the online cache is a keyed table with an expiry
column that a key-value loader can bulk-export.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, NumericType, StringType

from mercato.functions.columns import entity_key, short_id
from mercato.functions.digests import multiset_digest

# Default serving/training feature lists and feature sets.
DEFAULT_USER_FEATURES = [
    "user_total_events",
    "user_purchase_count",
    "user_purchase_rate",
    "user_avg_spend",
    "user_total_spend",
    "user_distinct_items",
    "user_recency_days",
    "user_tenure_days",
    "user_activity_score_norm",
    "user_preferred_device_enc",
    "user_preferred_category_enc",
]
DEFAULT_ITEM_FEATURES = [
    "item_total_interactions",
    "item_purchase_count",
    "item_conversion_rate",
    "item_avg_rating",
    "item_popularity_score_norm",
    "item_avg_sentiment",
    "item_price_log",
    "item_stock_norm",
    "item_category_enc",
    "item_brand_enc",
    "item_trend_score_norm",
    "item_return_rate",
]
FEATURE_SETS = {
    "user_basic": [
        "user_total_events",
        "user_purchase_count",
        "user_purchase_rate",
        "user_recency_days",
        "user_activity_score_norm",
    ],
    "item_popularity": [
        "item_total_interactions",
        "item_conversion_rate",
        "item_avg_rating",
        "item_popularity_score",
        "item_avg_sentiment",
    ],
    "training_default": DEFAULT_USER_FEATURES + DEFAULT_ITEM_FEATURES,
}
LABEL_COLUMN = "ui_has_purchased"
DEFAULT_VERSION = "v1.0"
DEFAULT_TTL_SECONDS = 3600


# ---- catalogue ---------------------------------------------------------------------


def _feature_type(name: str, dtype, label: str | None) -> str:
    if name == label:
        return "binary"
    if isinstance(dtype, StringType) or name.endswith("_enc"):
        return "categorical"
    return "continuous"


def _describe(name: str, group: str) -> str:
    words = name.split("_")
    if words and words[0] in ("user", "item", "ui"):
        words = words[1:]
    return f"{group} feature: " + " ".join(words)


def catalogue_rows(
    tables: Mapping[str, tuple[DataFrame, str, str]],
    sources: Mapping[str, str],
    *,
    exclude: Sequence[str] = ("is_active",),
    label: str | None = LABEL_COLUMN,
    version: str = DEFAULT_VERSION,
) -> list[tuple]:
    """Catalogue entries from the schemas of the feature tables.

    ``tables`` maps table name -> (frame, group, primary key). Every column
    that is not a key column and not excluded is a feature. The result is
    metadata (bounded by the number of columns), not data."""
    rows = []
    for table, (df, group, pk) in tables.items():
        keys = {pk, "user_id", "item_id"}
        for f in df.schema.fields:
            if f.name in keys or f.name in exclude:
                continue
            rows.append(
                (
                    f.name,
                    group,
                    table,
                    pk,
                    f.dataType.typeName(),
                    _feature_type(f.name, f.dataType, label),
                    _describe(f.name, group),
                    sources.get(f.name, "derived"),
                    version,
                )
            )
    return rows


CATALOGUE_SCHEMA = (
    "feature_name string, feature_group string, table_name string, primary_key string, dtype string, "
    "feature_type string, description string, source string, version string"
)


def feature_catalogue(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    df = spark.createDataFrame(rows, CATALOGUE_SCHEMA)
    return df.withColumn("feature_id", short_id("feature_name", "version")).withColumn(
        "is_active", F.lit(True)
    )


def feature_fill(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Long table (table_name, feature_name, rows, non_null_rows): one
    aggregate pass per feature table."""
    parts = []
    for table, df in tables.items():
        cols = df.columns
        wide = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(F.col(c)).alias(f"__nn_{c}") for c in cols])
        rows = [
            F.struct(
                F.lit(c).alias("feature_name"),
                F.col("__rows").alias("rows"),
                F.col(f"__nn_{c}").alias("non_null_rows"),
            )
            for c in cols
        ]
        parts.append(wide.select(F.lit(table).alias("table_name"), F.inline(F.array(*rows))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def feature_coverage(catalogue: DataFrame, fill: DataFrame) -> DataFrame:
    """Catalogue vs real columns: every catalogued feature with its fill
    rate, and every table column missing from the catalogue."""
    cat = catalogue.select("feature_name", "table_name", "dtype")
    j = cat.join(fill, ["table_name", "feature_name"], "full_outer")
    return j.select(
        "table_name",
        "feature_name",
        F.col("dtype").isNotNull().alias("in_catalogue"),
        F.col("rows").isNotNull().alias("in_table"),
        "rows",
        "non_null_rows",
        F.when(F.col("rows") > 0, F.col("non_null_rows") / F.col("rows")).alias("fill_rate"),
    )


def feature_sets_frame(spark: SparkSession, sets: Mapping[str, Sequence[str]] = FEATURE_SETS) -> DataFrame:
    rows = [(name, list(names)) for name, names in sets.items()]
    return spark.createDataFrame(rows, "set_name string, feature_names array<string>")


def feature_set_integrity(sets: DataFrame, catalogue: DataFrame, fill: DataFrame) -> DataFrame:
    """Each member of each feature set, whether it is catalogued, and its
    fill from the real table (NULL for a dangling name)."""
    members = sets.select("set_name", F.posexplode("feature_names").alias("position", "feature_name"))
    cat = catalogue.select("feature_name", "table_name")
    return (
        members.join(cat, "feature_name", "left")
        .join(fill, ["table_name", "feature_name"], "left")
        .select(
            "set_name",
            "position",
            "feature_name",
            F.col("table_name").isNotNull().alias("in_catalogue"),
            "table_name",
            "non_null_rows",
        )
    )


# ---- versions ----------------------------------------------------------------------


def snapshot_version(df: DataFrame, table: str, version: str = DEFAULT_VERSION, notes: str = "") -> DataFrame:
    """Row count and the order-free checksum of a feature table (``multiset_digest``)."""
    return df.agg(F.count(F.lit(1)).alias("row_count"), multiset_digest(df).alias("checksum")).select(
        F.lit(table).alias("table_name"),
        F.lit(version).alias("version"),
        "row_count",
        "checksum",
        F.lit(notes).alias("notes"),
        short_id(F.lit(table), F.lit(version)).alias("version_id"),
    )


def with_version_columns(df: DataFrame, version: str, written_at: str | None = None) -> DataFrame:
    ts = F.lit(written_at).cast("timestamp") if written_at else F.current_timestamp()
    return df.withColumns({"_version": F.lit(version), "_written_at": ts})


# ---- training ----------------------------------------------------------------------


def training_dataset(
    user_item: DataFrame,
    users: DataFrame,
    items: DataFrame,
    user_features: Sequence[str] = DEFAULT_USER_FEATURES,
    item_features: Sequence[str] = DEFAULT_ITEM_FEATURES,
    label_col: str = LABEL_COLUMN,
    limit: int | None = None,
) -> DataFrame:
    """Labels left-joined to user and item features (28 columns by
    default). ``limit`` keeps the first rows in key order."""
    base = user_item.select(
        "user_id", "item_id", "ui_interaction_score", "ui_interaction_score_norm", label_col
    )
    u = users.select("user_id", *user_features)
    i = items.select("item_id", *item_features)
    out = base.join(u, "user_id", "left").join(i, "item_id", "left").select(
        "user_id",
        "item_id",
        "ui_interaction_score",
        "ui_interaction_score_norm",
        label_col,
        *user_features,
        *item_features,
    )
    if limit is not None:
        out = out.orderBy("user_id", "item_id").limit(limit)
    return out


def label_distribution(df: DataFrame, label_col: str = LABEL_COLUMN) -> DataFrame:
    return df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))


# ---- serving -----------------------------------------------------------------------


def serving_table(
    frames: Mapping[str, tuple[DataFrame, str, Sequence[str]]],
    as_of: str | _dt.datetime,
    ttl_seconds: int = DEFAULT_TTL_SECONDS,
) -> DataFrame:
    """Long serving table: (namespace, entity_id, entity_key, feature_name,
    feature_value, written_at, expires_at). ``frames`` maps namespace ->
    (frame, id column, feature columns). Numeric features only; NaN is
    stored as NULL; ``_``-prefixed columns are never served."""
    at = F.lit(str(as_of)).cast("timestamp")
    parts = []
    for ns, (df, id_col, cols) in frames.items():
        feats = [c for c in cols if not c.startswith("_")]
        cells = [
            F.struct(
                F.lit(c).alias("feature_name"),
                F.when(F.isnan(F.col(c).cast("double")), F.lit(None))
                .otherwise(F.col(c).cast("double"))
                .alias("feature_value"),
            )
            for c in feats
        ]
        parts.append(
            df.select(
                F.lit(ns).alias("namespace"),
                F.col(id_col).cast("bigint").alias("entity_id"),
                entity_key(ns, id_col).alias("entity_key"),
                F.inline(F.array(*cells)),
            )
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumns(
        {"written_at": at, "expires_at": at + F.make_interval(secs=F.lit(ttl_seconds))}
    )


def numeric_columns(df: DataFrame, keys: Sequence[str]) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if f.name not in keys
        and isinstance(f.dataType, (NumericType, BooleanType))
        and not isinstance(f.dataType, BooleanType)
    ]


def serving_vectors(
    candidates: DataFrame,
    users: DataFrame,
    items: DataFrame,
    user_features: Sequence[str] = DEFAULT_USER_FEATURES,
    item_features: Sequence[str] = DEFAULT_ITEM_FEATURES,
) -> DataFrame:
    """One flat vector per candidate (user, item): ``u_`` + user features,
    ``i_`` + item features. A pair whose user or item has no features
    yields no vector (inner joins)."""
    u = users.select("user_id", *[F.col(c).alias(f"u_{c}") for c in user_features])
    i = items.select("item_id", *[F.col(c).alias(f"i_{c}") for c in item_features])
    return candidates.select("user_id", "item_id").join(u, "user_id").join(i, "item_id")


def lookup(
    requests: DataFrame,
    serving: DataFrame,
    offline_keys: DataFrame,
    at: str | _dt.datetime,
) -> DataFrame:
    """Resolve (namespace, entity_id) requests: ``online`` when an
    unexpired serving row exists, else ``offline`` when the offline table
    has the key, else ``none``."""
    t = F.lit(str(at)).cast("timestamp")
    online = (
        serving.where(t < F.col("expires_at"))
        .select("namespace", "entity_id")
        .distinct()
        .withColumn("_online", F.lit(True))
    )
    offline = offline_keys.select("namespace", "entity_id").distinct().withColumn("_offline", F.lit(True))
    return (
        requests.select("namespace", "entity_id")
        .join(online, ["namespace", "entity_id"], "left")
        .join(offline, ["namespace", "entity_id"], "left")
        .withColumn(
            "source",
            F.when(F.col("_online"), "online").when(F.col("_offline"), "offline").otherwise("none"),
        )
        .drop("_online", "_offline")
    )


def lookup_stats(resolved: DataFrame) -> DataFrame:
    """Hits, misses and hit rate (3 places) of a batch of lookups."""
    hits = F.count(F.when(F.col("source") == "online", 1))
    total = F.count(F.lit(1))
    return resolved.agg(
        total.alias("requests"),
        hits.alias("cache_hits"),
        (total - hits).alias("cache_misses"),
        F.count(F.when(F.col("source") == "offline", 1)).alias("offline_fallbacks"),
        F.count(F.when(F.col("source") == "none", 1)).alias("not_found"),
    ).withColumn(
        "hit_rate",
        F.when(
            F.col("requests") > 0,
            F.bround((F.col("cache_hits") / F.col("requests")).try_cast("decimal(38,9)"), 3).cast("double"),
        ).otherwise(F.lit(0.0)),
    )


# ---- upserts -------------------------------------------------------------------------


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """INSERT OR REPLACE by key: rows of ``new`` win. Write the result to a
    new table/path and swap; a table cannot be overwritten while read."""
    return old.join(new.select(*keys), list(keys), "left_anti").unionByName(new, allowMissingColumns=True)


def delete_keys(old: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return old.join(keys_df.select(*keys), list(keys), "left_anti")


# ---- point in time -----------------------------------------------------------------


def spread_by_time(labels: DataFrame, snapshots: DataFrame, key: str, label_ts: str, snapshot_ts: str, value_cols: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Labels and snapshots as one table (_k, _t, _kind, _snap, _row) in range
    partitions of (key, time), numbered in order by _p and pinned. Rows of one key
    are cut by time, rows of one time by their hash, so partitions are alike
    whatever the keys."""
    from mercato.session import stored

    snap = F.struct(F.col("_t").alias("snapshot_ts"), *[F.col(c) for c in value_cols])
    s = snapshots.where(F.col(key).isNotNull() & F.col(snapshot_ts).isNotNull())
    s = s.select(F.col(key).alias("_k"), F.col(snapshot_ts).alias("_t"), *[F.col(c) for c in value_cols]).select("_k", "_t", snap.alias("_snap"))
    own = labels.select(F.col(key).alias("_k"), F.col(label_ts).alias("_t"), F.struct(*[F.col(c) for c in labels.columns]).alias("_row"))
    s = s.select("_k", "_t", F.lit(0).alias("_kind"), "_snap", F.lit(None).cast(own.schema["_row"].dataType).alias("_row"))
    own = own.select("_k", "_t", F.lit(1).alias("_kind"), F.lit(None).cast(s.schema["_snap"].dataType).alias("_snap"), "_row")
    events = s.unionByName(own)
    order = ["_k", "_t", "_kind", F.xxhash64("_snap", "_row")]
    ranged = events.repartitionByRange(partitions, *order) if partitions else events.repartitionByRange(*order)
    return stored(ranged.withColumn("_p", F.spark_partition_id()), "as_of")


def as_of_join(
    labels: DataFrame,
    snapshots: DataFrame,
    key: str,
    label_ts: str,
    snapshot_ts: str,
    value_cols: Sequence[str],
    partitions: int | None = None,
) -> DataFrame:
    """Attach to each label row the latest snapshot with
    ``snapshot_ts <= label_ts`` for the same key (NULLs when none); of several
    at that time the one with the largest values.

    Skew-safe: labels and snapshots are range-partitioned by (key, time), a hot
    key like any other. Within a partition a running ``last`` finds the latest
    snapshot; what a partition ends with is carried on to the next ones of the
    key, by the same running ``last`` over one summary row per (key, partition).
    """
    from pyspark.sql import Window

    events = spread_by_time(labels, snapshots, key, label_ts, snapshot_ts, value_cols, partitions)
    w = Window.partitionBy("_p", "_k").orderBy("_t", "_kind", "_snap").rowsBetween(Window.unboundedPreceding, 0)
    inside = events.withColumn("_in", F.last("_snap", ignorenulls=True).over(w)).where(F.col("_kind") == 1).select("_p", "_k", "_row", "_in")
    ends = events.groupBy("_k", "_p").agg(F.max("_snap").alias("_end"))
    wp = Window.partitionBy("_k").orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.withColumn("_prev", F.last("_end", ignorenulls=True).over(wp)).select(F.col("_p").alias("_q"), F.col("_k").alias("_of"), "_prev")
    m = F.coalesce("_in", "_prev")
    return inside.join(carried, (F.col("_p") == F.col("_q")) & F.col("_k").eqNullSafe(F.col("_of")), "left").select(
        *[F.col(f"_row.{c}").alias(c) for c in labels.columns],
        m.getField("snapshot_ts").alias("snapshot_ts"),
        *[m.getField(c).alias(c) for c in value_cols],
    )


# ---- registry tables (upserts) -------------------------------------------------------

# Source names shown for catalogue sources.
SOURCE_NAMES = {
    "clickstream": "user_interaction_logs",
    "transactions": "purchase_history",
    "catalog": "product_catalog",
    "external": "external_signals",
    "derived": "derived",
}


def feature_definitions(catalogue: DataFrame, at: str) -> DataFrame:
    """Registry rows from catalogue rows: id from md5(name_version), source
    mapped by a join to the (bounded) source-name table, active flag and
    times."""
    spark = catalogue.sparkSession
    names = spark.createDataFrame(list(SOURCE_NAMES.items()), "source string, source_table string")
    t = F.lit(at).cast("timestamp")
    return (
        catalogue.join(F.broadcast(names), "source", "left")
        .select(
            short_id("feature_name", "version").alias("feature_id"),
            "feature_name",
            "feature_group",
            "table_name",
            "primary_key",
            "dtype",
            "feature_type",
            "description",
            F.coalesce("source_table", F.lit("derived")).alias("source_table"),
            "version",
            F.lit(True).alias("is_active"),
            t.alias("created_at"),
            t.alias("updated_at"),
            F.to_json(F.array().cast("array<string>")).alias("tags"),
        )
    )


def list_features(registry: DataFrame, group: str | None = None) -> DataFrame:
    """Active registered features, optionally of one group."""
    out = registry.where(F.col("is_active"))
    return out.where(F.col("feature_group") == group) if group else out


def register_features(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """INSERT OR REPLACE by feature_id."""
    return new if existing is None else upsert(existing, new, ["feature_id"])


def register_feature_sets(existing: DataFrame | None, sets: DataFrame, descriptions: Mapping[str, str], at: str) -> DataFrame:
    spark = sets.sparkSession
    desc = spark.createDataFrame(list(descriptions.items()), "set_name string, description string")
    rows = sets.join(desc, "set_name", "left").select(
        "set_name", "description", F.to_json("feature_names").alias("feature_names"), F.lit(at).cast("timestamp").alias("created_at")
    )
    return rows if existing is None else upsert(existing, rows, ["set_name"])


def record_versions(existing: DataFrame | None, versions: DataFrame) -> DataFrame:
    """Append version snapshots (keyed by version_id, latest wins)."""
    return versions if existing is None else upsert(existing, versions, ["version_id"])
