"""Registered feature-store queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.functions.digests import multiset_digest_sql
from mercato.plans import store as ST
from mercato.plans.features import FEATURE_SOURCES
from mercato.plans.oracle_views import with_views
from mercato.plans.q_features import (
    _ITEM_SQL,
    _USER_ITEM_SQL,
    _USER_SQL,
    item_features_df,
    user_features_df,
    user_item_features_df,
)
from mercato.plans.registry import R, finish, register
from mercato.sources import tables as T

# Fixed clock of the registered serving queries (the oracle cannot read
# the wall clock of the Spark run).
AS_OF = "2024-02-01 00:00:00"
LOOKUP_AT = "2024-02-01 00:30:00"


def _tables(spark, sf_dir):
    """The three feature tables from one shared, stored pair of (user, item)
    pre-aggregates: each source is shuffled once, and each reader takes the
    columns it needs."""
    from mercato.plans import features as FT
    from mercato.plans.q_features import REFERENCE_DATE, ROLES
    from mercato.session import stored

    clicks, purch, cat = T.clickstream(spark, sf_dir), T.purchases(spark, sf_dir), T.catalog(spark, sf_dir)
    shared = {
        "clicks_ui": stored(FT.click_pairs(clicks, ROLES, "ts"), "click-pairs"),
        "purchases_ui": stored(FT.purchase_pairs(purch), "purchase-pairs"),
    }
    uf = FT.user_features(clicks, purch, cat, REFERENCE_DATE, device_col="event_type", time_col="ts", roles=ROLES, **shared)
    itf = FT.item_features(clicks, purch, cat, T.signals(spark, sf_dir), roles=ROLES, **shared)
    uif = FT.user_item_features(clicks, purch, roles=ROLES, **shared)
    return {
        "user_features": (uf, "user", "user_id"),
        "item_features": (itf, "item", "item_id"),
        "user_item_features": (uif, "user_item", "user_id"),
    }


def _sql_str(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def _catalogue_values_sql(rows) -> str:
    vals = ",\n".join("(" + ", ".join(_sql_str(x) for x in r) + ")" for r in rows)
    return (
        "catv(feature_name, feature_group, table_name, primary_key, dtype, feature_type, description, source, version) "
        f"AS (VALUES {vals})"
    )


def _fill_sql(spark_schemas: dict[str, list[str]]) -> str:
    sqls = {"user_features": _USER_SQL, "item_features": _ITEM_SQL, "user_item_features": _USER_ITEM_SQL}
    parts = []
    for t, cols in spark_schemas.items():
        for c in cols:
            parts.append(
                f"SELECT '{t}' AS table_name, '{c}' AS feature_name, count(*) AS rows, count({c}) AS non_null_rows FROM ({sqls[t]})"
            )
    return "fill AS (" + "\nUNION ALL\n".join(parts) + ")"


# Column lists of the feature tables (known without running anything).
from mercato.plans.features import ITEM_FEATURE_COLUMNS, USER_FEATURE_COLUMNS, USER_ITEM_FEATURE_COLUMNS  # noqa: E402

_SCHEMAS = {
    "user_features": USER_FEATURE_COLUMNS,
    "item_features": ITEM_FEATURE_COLUMNS,
    "user_item_features": USER_ITEM_FEATURE_COLUMNS,
}

# Catalogue rows depend on Spark data types only; they are recomputed from
# the live schemas in the Spark query and must agree with this static copy.
_TYPE_NAMES = {
    "user_features": {
        "user_preferred_device": "string", "user_preferred_category": "string",
        "user_preferred_device_enc": "integer", "user_preferred_category_enc": "integer",
        "user_recency_days": "integer", "user_tenure_days": "integer",
        "user_purchase_rate": "double", "user_total_spend": "double", "user_total_spend_log": "double",
        "user_avg_spend": "double", "user_max_spend": "double", "user_activity_score_norm": "double",
    },
    "item_features": {
        "category": "string", "brand": "string", "item_category_enc": "integer", "item_brand_enc": "integer",
        "item_conversion_rate": "double", "item_total_revenue": "double", "item_avg_order_value": "double",
        "item_avg_rating": "double", "price": "double", "item_price_log": "double",
        "item_stock_norm": "double", "item_review_count_log": "double", "popularity_score": "double",
        "item_popularity_score_norm": "double", "item_avg_sentiment": "double", "trend_score": "double",
        "item_trend_score_norm": "double", "item_return_rate": "double", "is_active": "boolean",
    },
    "user_item_features": {"ui_interaction_score_norm": "double", "ui_has_purchased": "integer"},
}
_GROUPS = {"user_features": ("user", "user_id"), "item_features": ("item", "item_id"), "user_item_features": ("user_item", "user_id")}


def _static_catalogue_rows():
    rows = []
    for t, cols in _SCHEMAS.items():
        group, pk = _GROUPS[t]
        for c in cols:
            if c in (pk, "user_id", "item_id", "is_active"):
                continue
            dtype = _TYPE_NAMES[t].get(c, "long")
            if c == ST.LABEL_COLUMN:
                ftype = "binary"
            elif dtype == "string" or c.endswith("_enc"):
                ftype = "categorical"
            else:
                ftype = "continuous"
            rows.append((c, group, t, pk, dtype, ftype, ST._describe(c, group), FEATURE_SOURCES.get(c, "derived"), ST.DEFAULT_VERSION))
    return rows


_CAT_ROWS = _static_catalogue_rows()


def _catalogue(spark, sf_dir):
    tables = _tables(spark, sf_dir)
    rows = ST.catalogue_rows(tables, FEATURE_SOURCES)
    cat = ST.feature_catalogue(spark, rows)
    fill = ST.feature_fill({t: df for t, (df, _, _) in tables.items()})
    return cat, fill


_CAT_CTES = _catalogue_values_sql(_CAT_ROWS) + ",\n" + _fill_sql(_SCHEMAS)


@register(
    "feature_catalogue",
    "WITH "
    + _CAT_CTES
    + """
SELECT substring(md5(c.feature_name || '_' || c.version), 1, 12) AS feature_id, c.feature_name, c.feature_group,
       c.table_name, c.primary_key, c.dtype, c.feature_type, c.description, c.source, c.version, TRUE AS is_active,
       f.rows, f.non_null_rows
FROM catv c LEFT JOIN fill f ON c.table_name = f.table_name AND c.feature_name = f.feature_name""",
)
def q_feature_catalogue(spark, sf_dir):
    cat, fill = _catalogue(spark, sf_dir)
    return cat.join(fill, ["table_name", "feature_name"], "left").select(
        "feature_id", "feature_name", "feature_group", "table_name", "primary_key", "dtype", "feature_type",
        "description", "source", "version", "is_active", "rows", "non_null_rows",
    )


@register(
    "feature_group_counts",
    "WITH " + _catalogue_values_sql(_CAT_ROWS) + "\nSELECT feature_group, count(*) AS features FROM catv GROUP BY feature_group",
)
def q_feature_group_counts(spark, sf_dir):
    cat, fill = _catalogue(spark, sf_dir)
    # Count per group over catalogued features present in the real tables.
    present = cat.join(fill.select("table_name", "feature_name"), ["table_name", "feature_name"], "left_semi")
    return present.groupBy("feature_group").agg(F.count(F.lit(1)).alias("features")).orderBy("feature_group")


def _sets_values_sql() -> str:
    vals = ",\n".join(
        f"('{s}', {i}, '{n}')" for s, names in ST.FEATURE_SETS.items() for i, n in enumerate(names)
    )
    return f"setv(set_name, position, feature_name) AS (VALUES {vals})"


@register(
    "feature_set_integrity",
    "WITH "
    + _CAT_CTES
    + ",\n"
    + _sets_values_sql()
    + """
SELECT s.set_name, CAST(s.position AS INTEGER) AS position, s.feature_name, c.table_name IS NOT NULL AS in_catalogue,
       c.table_name, f.non_null_rows
FROM setv s LEFT JOIN catv c ON s.feature_name = c.feature_name
LEFT JOIN fill f ON c.table_name = f.table_name AND s.feature_name = f.feature_name""",
)
def q_feature_set_integrity(spark, sf_dir):
    cat, fill = _catalogue(spark, sf_dir)
    return ST.feature_set_integrity(ST.feature_sets_frame(spark), cat, fill)


@register(
    "feature_coverage",
    "WITH "
    + _CAT_CTES
    + """
SELECT coalesce(c.table_name, f.table_name) AS table_name, coalesce(c.feature_name, f.feature_name) AS feature_name,
       c.dtype IS NOT NULL AS in_catalogue, f.rows IS NOT NULL AS in_table, f.rows, f.non_null_rows,
       """
    + R("CASE WHEN f.rows > 0 THEN f.non_null_rows / f.rows END", "fill_rate")
    + """
FROM catv c FULL OUTER JOIN fill f ON c.table_name = f.table_name AND c.feature_name = f.feature_name""",
)
def q_feature_coverage(spark, sf_dir):
    cat, fill = _catalogue(spark, sf_dir)
    return finish(ST.feature_coverage(cat, fill))


def _versions_sql() -> str:
    from mercato.operators.pairs import PAIR_COLUMNS
    from mercato.plans.q_pairs import ORDER_PAIRS_SQL

    sqls = {"user_features": _USER_SQL, "item_features": _ITEM_SQL, "user_item_features": _USER_ITEM_SQL}
    kinds = {t: {c: "double" if _TYPE_NAMES[t].get(c) == "double" else "other" for c in cols} for t, cols in _SCHEMAS.items()}
    sqls["co_purchase_pairs"] = ORDER_PAIRS_SQL
    kinds["co_purchase_pairs"] = {c: "other" if c.startswith("item_") or c == "co_purchase_count" else "double" for c in PAIR_COLUMNS}
    notes = {"co_purchase_pairs": "written, not versioned upstream"}
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{ST.DEFAULT_VERSION}' AS version, count(*) AS row_count, {multiset_digest_sql(kinds[t])} AS checksum, "
        f"'{notes.get(t, '')}' AS notes, substring(md5('{t}_{ST.DEFAULT_VERSION}'), 1, 12) AS version_id FROM ({sql})"
        for t, sql in sqls.items()
    )


@register("feature_versions", _versions_sql())
def q_feature_versions(spark, sf_dir):
    parts = [ST.snapshot_version(df, t) for t, (df, _, _) in _tables(spark, sf_dir).items()]
    parts.append(ST.snapshot_version(_pairs(spark, sf_dir), "co_purchase_pairs", notes="written, not versioned upstream"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _pairs(spark, sf_dir):
    from mercato.operators.pairs import co_purchase_pairs

    return co_purchase_pairs(T.purchases(spark, sf_dir), order=False)


# ---- training and serving -------------------------------------------------------------

_U = ", ".join(f"u.{c}" for c in ST.DEFAULT_USER_FEATURES)
_I = ", ".join(f"i.{c}" for c in ST.DEFAULT_ITEM_FEATURES)


@register(
    "training_dataset",
    f"""SELECT ui.user_id, ui.item_id, ui.ui_interaction_score, ui.ui_interaction_score_norm, ui.ui_has_purchased, {_U}, {_I}
FROM ({_USER_ITEM_SQL}) ui LEFT JOIN ({_USER_SQL}) u ON ui.user_id = u.user_id
LEFT JOIN ({_ITEM_SQL}) i ON ui.item_id = i.item_id""",
)
def q_training_dataset(spark, sf_dir):
    t = _tables(spark, sf_dir)
    return finish(ST.training_dataset(t["user_item_features"][0], t["user_features"][0], t["item_features"][0]))


@register(
    "label_distribution",
    f"SELECT ui_has_purchased, count(*) AS count FROM ({_USER_ITEM_SQL}) GROUP BY ui_has_purchased",
)
def q_label_distribution(spark, sf_dir):
    return ST.label_distribution(user_item_features_df(spark, sf_dir))


def _serving(spark, sf_dir):
    uf, itf = user_features_df(spark, sf_dir), item_features_df(spark, sf_dir)
    return ST.serving_table(
        {
            "user": (uf, "user_id", ST.DEFAULT_USER_FEATURES),
            "item": (itf, "item_id", ST.DEFAULT_ITEM_FEATURES),
        },
        AS_OF,
    ), uf, itf


def _serving_sql_body() -> str:
    def cells(ns: str, src: str, idc: str, cols: list[str]) -> str:
        return "\nUNION ALL\n".join(
            f"SELECT '{ns}' AS namespace, CAST({idc} AS BIGINT) AS entity_id, '{ns}:' || CAST({idc} AS VARCHAR) AS entity_key, "
            f"'{c}' AS feature_name, CASE WHEN isnan(CAST({c} AS DOUBLE)) THEN NULL ELSE CAST({c} AS DOUBLE) END AS feature_value FROM ({src})"
            for c in cols
        )

    return (
        cells("user", _USER_SQL, "user_id", ST.DEFAULT_USER_FEATURES)
        + "\nUNION ALL\n"
        + cells("item", _ITEM_SQL, "item_id", ST.DEFAULT_ITEM_FEATURES)
    )


@register(
    "serving_table",
    f"""SELECT namespace, entity_id, entity_key, feature_name, {R('feature_value')},
       TIMESTAMP '{AS_OF}' AS written_at, TIMESTAMP '{AS_OF}' + INTERVAL {ST.DEFAULT_TTL_SECONDS} SECOND AS expires_at
FROM ({_serving_sql_body()})""",
)
def q_serving_table(spark, sf_dir):
    s, _, _ = _serving(spark, sf_dir)
    return finish(s.withColumns({"written_at": F.col("written_at").cast("timestamp_ntz"), "expires_at": F.col("expires_at").cast("timestamp_ntz")}))


_UV = ", ".join(f"u.{c} AS u_{c}" for c in ST.DEFAULT_USER_FEATURES)
_IV = ", ".join(f"i.{c} AS i_{c}" for c in ST.DEFAULT_ITEM_FEATURES)


@register(
    "serving_vectors",
    f"""SELECT ui.user_id, ui.item_id, {_UV}, {_IV}
FROM ({_USER_ITEM_SQL}) ui JOIN ({_USER_SQL}) u ON ui.user_id = u.user_id
JOIN ({_ITEM_SQL}) i ON ui.item_id = i.item_id""",
)
def q_serving_vectors(spark, sf_dir):
    t = _tables(spark, sf_dir)
    cand = t["user_item_features"][0].select("user_id", "item_id")
    # rounded once a user and an item, not once a pair
    return ST.serving_vectors(cand, finish(t["user_features"][0]), finish(t["item_features"][0]))


@register(
    "serving_lookup_stats",
    with_views(
        ["clicks"],
        f"""
req AS (SELECT DISTINCT 'user' AS namespace, user_id AS entity_id FROM clicks
        UNION SELECT DISTINCT 'item', item_id FROM clicks),
srv AS (SELECT DISTINCT namespace, entity_id FROM ({_serving_sql_body()})
        WHERE TIMESTAMP '{LOOKUP_AT}' < TIMESTAMP '{AS_OF}' + INTERVAL {ST.DEFAULT_TTL_SECONDS} SECOND),
off AS (SELECT DISTINCT 'user' AS namespace, user_id AS entity_id FROM ({_USER_SQL})
        UNION SELECT DISTINCT 'item', item_id FROM ({_ITEM_SQL})),
res AS (SELECT r.namespace, r.entity_id,
          CASE WHEN s.entity_id IS NOT NULL THEN 'online' WHEN o.entity_id IS NOT NULL THEN 'offline' ELSE 'none' END AS source
        FROM req r LEFT JOIN srv s ON r.namespace = s.namespace AND r.entity_id = s.entity_id
        LEFT JOIN off o ON r.namespace = o.namespace AND r.entity_id = o.entity_id)
SELECT count(*) AS requests, count(*) FILTER (WHERE source = 'online') AS cache_hits,
       count(*) FILTER (WHERE source <> 'online') AS cache_misses,
       count(*) FILTER (WHERE source = 'offline') AS offline_fallbacks,
       count(*) FILTER (WHERE source = 'none') AS not_found,
       CASE WHEN count(*) > 0 THEN CAST(round_even(CAST(count(*) FILTER (WHERE source = 'online') / count(*) AS DECIMAL(38,9)), 3) AS DOUBLE) ELSE 0.0 END AS hit_rate
FROM res""",
    ),
)
def q_serving_lookup_stats(spark, sf_dir):
    serving, uf, itf = _serving(spark, sf_dir)
    clicks = T.clickstream(spark, sf_dir)
    req = clicks.select(F.lit("user").alias("namespace"), F.col("user_id").alias("entity_id")).unionByName(
        clicks.select(F.lit("item").alias("namespace"), F.col("item_id").alias("entity_id"))
    ).distinct()
    offline = uf.select(F.lit("user").alias("namespace"), F.col("user_id").alias("entity_id")).unionByName(
        itf.select(F.lit("item").alias("namespace"), F.col("item_id").alias("entity_id"))
    )
    return ST.lookup_stats(ST.lookup(req, serving, offline, LOOKUP_AT))


# ---- point in time ------------------------------------------------------------------


def _daily_snapshots(clicks):
    day = F.date_trunc("day", F.col("ts"))
    return clicks.groupBy("user_id", day.alias("day")).agg(F.count(F.lit(1)).alias("day_events")).select(
        "user_id",
        (F.col("day") + F.expr("INTERVAL 1 DAY")).cast("timestamp_ntz").alias("snapshot_ts"),
        "day_events",
    )


@register(
    "point_in_time_training",
    with_views(
        ["clicks"],
        """
snaps AS (SELECT user_id, date_trunc('day', ts) + INTERVAL 1 DAY AS snapshot_ts, count(*) AS day_events
          FROM clicks GROUP BY user_id, date_trunc('day', ts)),
lab AS (SELECT event_id, user_id, ts FROM clicks WHERE event_type = 'purchase')
SELECT l.event_id, l.user_id, l.ts, CAST(s.snapshot_ts AS TIMESTAMP) AS snapshot_ts, s.day_events
FROM lab l ASOF LEFT JOIN snaps s ON l.user_id = s.user_id AND l.ts >= s.snapshot_ts""",
    ),
)
def q_point_in_time_training(spark, sf_dir):
    clicks = T.clickstream(spark, sf_dir)
    labels = clicks.where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    return ST.as_of_join(labels, _daily_snapshots(clicks), "user_id", "ts", "snapshot_ts", ["day_events"])


REGISTERED_AT = "2024-02-01 00:00:00"
_SRC_VALUES = ", ".join(f"('{k}', '{v}')" for k, v in ST.SOURCE_NAMES.items())


@register(
    "feature_registry",
    "WITH "
    + _catalogue_values_sql(_CAT_ROWS)
    + f""",
srcv(source, source_table) AS (VALUES {_SRC_VALUES})
SELECT substring(md5(c.feature_name || '_' || c.version), 1, 12) AS feature_id, c.feature_name, c.feature_group,
       c.table_name, c.primary_key, c.dtype, c.feature_type, c.description,
       coalesce(s.source_table, 'derived') AS source_table, c.version, TRUE AS is_active,
       TIMESTAMP '{REGISTERED_AT}' AS created_at, TIMESTAMP '{REGISTERED_AT}' AS updated_at, '[]' AS tags
FROM catv c LEFT JOIN srcv s ON c.source = s.source""",
)
def q_feature_registry(spark, sf_dir):
    """Feature definitions (L1): ids, mapped source tables, active flag."""
    cat, fill = _catalogue(spark, sf_dir)
    present = cat.join(fill.select("table_name", "feature_name"), ["table_name", "feature_name"], "left_semi")
    defs = ST.feature_definitions(present, REGISTERED_AT)
    return defs.withColumns(
        {"created_at": F.col("created_at").cast("timestamp_ntz"), "updated_at": F.col("updated_at").cast("timestamp_ntz")}
    )


@register("profile_document")
def q_profile_document(spark, sf_dir):
    """The column profile of all sources as one JSON document row (S17)."""
    from mercato.plans.q_quality import source_frames
    from mercato.plans.quality import profile_all
    from mercato.plans.rulesets import SPECS
    from mercato.sources.sinks import json_document

    return json_document(profile_all(source_frames(spark, sf_dir), SPECS), "validation_json", REGISTERED_AT)
