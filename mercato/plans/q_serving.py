"""Registered queries of the stored serving table and of the stored registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.plans import serving as SV
from mercato.plans import store as ST
from mercato.plans.features import FEATURE_SOURCES
from mercato.plans.oracle_views import with_views
from mercato.plans.q_features import _ITEM_SQL, _USER_SQL, item_features_df, user_features_df
from mercato.plans.q_store import _CAT_CTES, _SRC_VALUES, AS_OF, LOOKUP_AT, _tables
from mercato.plans.registry import R, finish, register
from mercato.session import ensure_checkpoint_dir, scratch_dir
from mercato.sources import tables as T
from mercato.sources.keyed import KeyedTable

# Features that the lookups serve, and the rules by which an entity is online (written
# just now, or two hours ago and expired), offline or asked for though unknown.
SERVED = {"user": ["user_total_events", "user_purchase_count", "user_total_spend"], "item": ["item_total_interactions", "price", "popularity_score"]}
MISSING = 1_000_000_000


def _resolved(spark, sf_dir):
    ensure_checkpoint_dir(spark)
    frames = {
        "user": user_features_df(spark, sf_dir).select("user_id", *SERVED["user"]).checkpoint(eager=True),
        "item": item_features_df(spark, sf_dir).select("item_id", *SERVED["item"]).checkpoint(eager=True),
    }
    rows = SV.materialise({n: (df, f"{n}_id", SERVED[n]) for n, df in frames.items()})
    written = F.when(F.col("entity_id") % 3 == 0, F.lit(AS_OF).cast("timestamp")).otherwise(F.lit(AS_OF).cast("timestamp") - F.expr("INTERVAL 2 HOURS"))
    path = f"{scratch_dir(spark, 'serving')}/table"
    SV.write_serving(SV.with_expiry(rows.where("entity_id % 3 <> 2"), written, ST.DEFAULT_TTL_SECONDS), path)
    clicks = T.clickstream(spark, sf_dir)
    asked = None
    for n in SERVED:
        ids = clicks.select(F.lit(n).alias("namespace"), F.col(f"{n}_id").alias("entity_id"))
        both = ids.unionByName(ids.where("entity_id % 10 = 0").withColumn("entity_id", F.col("entity_id") + MISSING))
        asked = both if asked is None else asked.unionByName(both)
    asked = asked.distinct()
    offline = rows.where("entity_id % 5 <> 0")
    return SV.lookup_values(asked, SV.stored_rows(spark, path, asked), offline, LOOKUP_AT)


def _resolved_sql() -> str:
    values = "\nUNION ALL\n".join(
        f"SELECT '{n}' AS namespace, CAST({n}_id AS BIGINT) AS entity_id, '{c}' AS feature_name, CAST({c} AS DOUBLE) AS feature_value FROM ({sql})"
        for n, sql in (("user", _USER_SQL), ("item", _ITEM_SQL))
        for c in SERVED[n]
    )
    return with_views(
        ["clicks"],
        f"""
vals AS MATERIALIZED ({values}),
ids AS (SELECT 'user' AS namespace, user_id AS entity_id FROM clicks UNION SELECT 'item', item_id FROM clicks),
req AS (SELECT * FROM ids UNION SELECT namespace, entity_id + {MISSING} FROM ids WHERE entity_id % 10 = 0),
known AS (SELECT DISTINCT namespace, entity_id FROM vals),
res AS (SELECT r.namespace, r.entity_id,
               CASE WHEN k.entity_id IS NULL THEN 'none'
                    WHEN r.entity_id % 3 = 0 AND TIMESTAMP '{LOOKUP_AT}' < TIMESTAMP '{AS_OF}' + INTERVAL {ST.DEFAULT_TTL_SECONDS} SECOND THEN 'online'
                    WHEN r.entity_id % 3 = 1 AND TIMESTAMP '{LOOKUP_AT}' < TIMESTAMP '{AS_OF}' - INTERVAL 2 HOUR + INTERVAL {ST.DEFAULT_TTL_SECONDS} SECOND THEN 'online'
                    WHEN r.entity_id % 5 <> 0 THEN 'offline' ELSE 'none' END AS source
        FROM req r LEFT JOIN known k ON r.namespace = k.namespace AND r.entity_id = k.entity_id)""",
    )


@register(
    "serving_lookup_values",
    _resolved_sql()
    + f"""
SELECT res.namespace, res.entity_id, res.source, v.feature_name, {R('v.feature_value', 'feature_value')}
FROM res LEFT JOIN vals v ON res.source <> 'none' AND res.namespace = v.namespace AND res.entity_id = v.entity_id""",
)
def q_serving_lookup_values(spark, sf_dir):
    """A batch of lookups with the values that it returns: online, from the offline
    table (no row, or an expired one), or none."""
    return finish(SV.feature_values(_resolved(spark, sf_dir)))


@register(
    "serving_hit_statistics",
    _resolved_sql()
    + """
SELECT namespace, count(*) AS requests, count(*) FILTER (WHERE source = 'online') AS cache_hits, count(*) FILTER (WHERE source <> 'online') AS cache_misses,
       count(*) FILTER (WHERE source = 'offline') AS offline_fallbacks, count(*) FILTER (WHERE source = 'none') AS not_found,
       CAST(round_even(CAST(count(*) FILTER (WHERE source = 'online') / count(*) AS DECIMAL(38,9)), 3) AS DOUBLE) AS hit_rate
FROM res GROUP BY namespace""",
)
def q_serving_hit_statistics(spark, sf_dir):
    return SV.hit_statistics(_resolved(spark, sf_dir))


# ---- the stored registry ------------------------------------------------------------------

FIRST, SECOND = "2024-02-01 00:00:00", "2024-02-02 00:00:00"


def _registry(spark, sf_dir):
    """Definitions registered, then those of the item features once more a day later;
    a feature is active if its column holds a value."""
    tables = _tables(spark, sf_dir)
    catalogue = ST.feature_catalogue(spark, ST.catalogue_rows(tables, FEATURE_SOURCES))
    ensure_checkpoint_dir(spark)
    fill = ST.feature_fill({t: df for t, (df, _, _) in tables.items()}).checkpoint(eager=True)

    def definitions(at: str):
        defs = ST.feature_definitions(catalogue, at)
        return defs.join(fill, ["table_name", "feature_name"], "left").withColumn("is_active", F.coalesce(F.col("non_null_rows") > 0, F.lit(False))).drop("rows")

    table = KeyedTable(spark, scratch_dir(spark, "registry"), ["feature_id"], buckets=8)
    table.upsert(definitions(FIRST))
    table.upsert(definitions(SECOND).where("feature_group = 'item'"))
    return table, fill


_REGISTRY_SQL = (
    "WITH "
    + _CAT_CTES
    + f""",
srcv(source, source_table) AS (VALUES {_SRC_VALUES}),
reg AS (SELECT substring(md5(c.feature_name || '_' || c.version), 1, 12) AS feature_id, c.feature_name, c.feature_group, coalesce(s.source_table, 'derived') AS source_table,
               coalesce(f.non_null_rows > 0, FALSE) AS is_active, f.non_null_rows,
               CASE WHEN c.feature_group = 'item' THEN TIMESTAMP '{SECOND}' ELSE TIMESTAMP '{FIRST}' END AS updated_at
        FROM catv c LEFT JOIN srcv s ON c.source = s.source LEFT JOIN fill f ON c.table_name = f.table_name AND c.feature_name = f.feature_name)"""
)


@register("feature_registry_merge", _REGISTRY_SQL + "\nSELECT * FROM reg")
def q_feature_registry_merge(spark, sf_dir):
    table, _ = _registry(spark, sf_dir)
    return table.read().select(
        "feature_id", "feature_name", "feature_group", "source_table", "is_active", "non_null_rows", F.col("updated_at").cast("timestamp_ntz").alias("updated_at")
    )


@register("active_item_features", _REGISTRY_SQL + "\nSELECT feature_name, non_null_rows FROM reg WHERE is_active AND feature_group = 'item'")
def q_active_item_features(spark, sf_dir):
    table, _ = _registry(spark, sf_dir)
    return ST.list_features(table.read(), "item").select("feature_name", "non_null_rows")


# The set that is registered a second time, and how many of its features it keeps.
SHORTENED, KEPT = "user_basic", 3
_SETS = ", ".join(
    f"('{s}', {i}, '{n}')" for s, names in ST.FEATURE_SETS.items() for i, n in enumerate(names[:KEPT] if s == SHORTENED else names)
)


@register(
    "feature_sets_merge",
    "WITH "
    + _CAT_CTES
    + f""",
setv(set_name, position, feature_name) AS (VALUES {_SETS})
SELECT s.set_name, CAST(s.position AS INTEGER) AS position, s.feature_name, f.table_name, f.non_null_rows
FROM setv s LEFT JOIN fill f ON f.feature_name = s.feature_name""",
)
def q_feature_sets_merge(spark, sf_dir):
    """Feature sets stored as JSON text, one of them registered again, read back with
    the fill of their features."""
    _, fill = _registry(spark, sf_dir)
    table = KeyedTable(spark, scratch_dir(spark, "sets"), ["set_name"], buckets=4)
    names = {s: f"features of {s}" for s in ST.FEATURE_SETS}
    table.upsert(ST.register_feature_sets(None, ST.feature_sets_frame(spark), names, FIRST))
    again = ST.feature_sets_frame(spark, {SHORTENED: ST.FEATURE_SETS[SHORTENED][:KEPT]})
    table.upsert(ST.register_feature_sets(None, again, names, SECOND))
    members = table.read().select("set_name", F.posexplode(F.from_json("feature_names", "array<string>")).alias("position", "feature_name"))
    return members.join(fill.select("feature_name", "table_name", "non_null_rows"), "feature_name", "left").select("set_name", "position", "feature_name", "table_name", "non_null_rows")


# ---- stored documents and limits ------------------------------------------------------------


def _profile_document(spark, sf_dir):
    from mercato.plans.q_quality import source_frames
    from mercato.plans.quality import profile_all
    from mercato.plans.rulesets import SPECS
    from mercato.sources.sinks import json_document

    profile = profile_all(source_frames(spark, sf_dir), SPECS)
    return json_document(profile, "validation_json", FIRST), profile.schema


def _profile_oracle() -> str:
    from mercato.plans.q_quality import _profile_sql

    return _profile_sql()


@register("profile_document_rows", _profile_oracle())
def q_profile_document_rows(spark, sf_dir):
    """The profile document written as a row of JSON text, read back and parsed."""
    document, schema = _profile_document(spark, sf_dir)
    path = f"{scratch_dir(spark, 'profile')}/document"
    document.write.parquet(path)
    kind = f"array<{schema.simpleString()}>"
    return finish(spark.read.parquet(path).select(F.inline(F.from_json("validation_json", kind))))


def _sample_sql() -> str:
    from mercato.plans.registry import ORACLE

    return f"SELECT * FROM ({ORACLE['training_dataset']}) ORDER BY user_id, item_id LIMIT 500"


@register("training_sample", _sample_sql())
def q_training_sample(spark, sf_dir):
    """The training set limited to its first rows by key (the limit is the feature)."""
    t = _tables(spark, sf_dir)
    return finish(ST.training_dataset(t["user_item_features"][0], t["user_features"][0], t["item_features"][0], limit=500))
