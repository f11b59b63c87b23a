"""Registered quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import clean as C
from mercato.plans import quality as Q
from mercato.plans import quality_sql as S
from mercato.plans.oracle_views import with_views
from mercato.plans.registry import R, finish, register
from mercato.plans.rulesets import SPECS, SQL_VIEW
from mercato.sources import tables as T

ALL_VIEWS = ["clicks", "purch", "purch_age", "cat", "sig"]


def source_frames(spark, sf_dir):
    return {
        "clickstream": T.clickstream(spark, sf_dir),
        "purchases": T.purchases(spark, sf_dir, with_age_group=True),
        "catalog": T.catalog(spark, sf_dir),
        "signals": T.signals(spark, sf_dir),
    }


def cleaned_frames(spark, sf_dir):
    return {n: C.clean(df, SPECS[n]) for n, df in source_frames(spark, sf_dir).items()}


# ---- oracle text --------------------------------------------------------------


def _profile_sql() -> str:
    ctes, sels = [], []
    for name, spec in SPECS.items():
        c, s = S.profile_sql(spec, SQL_VIEW[name])
        ctes.append(c)
        sels.append(s)
    return with_views(ALL_VIEWS, ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(sels))


def _rules_sql() -> str:
    ctes, sels = [], []
    for name, spec in SPECS.items():
        r = S.rules_sql(spec, SQL_VIEW[name])
        if r:
            ctes.append(r[0])
            sels.append(r[1])
    return with_views(ALL_VIEWS, ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(sels))


def _dup_sql() -> str:
    return with_views(
        ALL_VIEWS, "\nUNION ALL\n".join(S.duplicates_sql(spec, SQL_VIEW[n]) for n, spec in SPECS.items())
    )


def _waterfall_sql() -> str:
    ctes, rows = [], []
    for name, spec in SPECS.items():
        c, r = S.waterfall_sql(spec, SQL_VIEW[name])
        ctes.append(c)
        rows.append(r)
    body = ",\n".join(ctes) + ",\nwf AS (\n" + "\nUNION ALL\n".join(rows) + "),\n"
    body += (
        "wf2 AS (SELECT *, removed_missing + removed_domain + removed_range + removed_duplicates "
        "+ removed_inactive AS total_removed FROM wf),\n"
        "wf3 AS (SELECT *, original_rows - total_removed AS final_rows FROM wf2),\n"
        "wft AS (SELECT * FROM wf3 UNION ALL SELECT 'TOTAL', sum(original_rows), sum(removed_missing), "
        "sum(removed_domain), sum(removed_range), sum(removed_duplicates), sum(removed_inactive), "
        "sum(total_removed), sum(final_rows) FROM wf3)\n"
    )
    body += (
        "SELECT source, CAST(original_rows AS BIGINT) AS original_rows, CAST(removed_missing AS BIGINT) AS removed_missing, "
        "CAST(removed_domain AS BIGINT) AS removed_domain, CAST(removed_range AS BIGINT) AS removed_range, "
        "CAST(removed_duplicates AS BIGINT) AS removed_duplicates, CAST(removed_inactive AS BIGINT) AS removed_inactive, "
        "CAST(final_rows AS BIGINT) AS final_rows, CAST(total_removed AS BIGINT) AS total_removed, "
        f"{R(S.pct_sql('final_rows', 'original_rows'), 'retention_pct')} FROM wft"
    )
    return with_views(ALL_VIEWS, body)


def _clean_sql(source: str) -> str:
    spec = SPECS[source]
    ctes = S.clean_ctes(spec, SQL_VIEW[source], "cln")
    doubles = [c for c, t in spec.column_types.items() if t == "double"]
    cols = ", ".join(R(c) if c in doubles else c for c in spec.column_types)
    return with_views(ALL_VIEWS, ctes + f"\nSELECT {cols} FROM cln")


def _integrity_sql() -> str:
    ctes = [S.clean_ctes(SPECS[n], SQL_VIEW[n], f"c_{n}") for n in SPECS]
    body = ",\n".join(ctes) + ",\nchk AS (\n"
    ci, pi, ki, si = "c_clickstream", "c_purchases", "c_catalog", "c_signals"
    body += (
        f"SELECT 'clickstream_items_not_in_catalog' AS check_name, (SELECT count(*) FROM (SELECT DISTINCT item_id FROM {ci} "
        f"WHERE item_id NOT IN (SELECT item_id FROM {ki} WHERE item_id IS NOT NULL) OR item_id IS NULL)) AS count\n"
        f"UNION ALL SELECT 'transaction_items_not_in_catalog', (SELECT count(*) FROM (SELECT DISTINCT item_id FROM {pi} "
        f"WHERE item_id NOT IN (SELECT item_id FROM {ki} WHERE item_id IS NOT NULL) OR item_id IS NULL))\n"
        f"UNION ALL SELECT 'catalog_items_missing_ext_signals', (SELECT count(*) FROM (SELECT DISTINCT item_id FROM {ki} "
        f"WHERE item_id NOT IN (SELECT item_id FROM {si} WHERE item_id IS NOT NULL) OR item_id IS NULL))\n"
        f"UNION ALL SELECT 'user_overlap_click_txn', (SELECT count(*) FROM (SELECT DISTINCT user_id FROM {ci}) a "
        f"JOIN (SELECT DISTINCT user_id FROM {pi}) b ON a.user_id = b.user_id))\n"
    )
    body += (
        "SELECT check_name, CAST(count AS BIGINT) AS count, CASE WHEN check_name = 'user_overlap_click_txn' "
        "THEN 'INFO' WHEN count = 0 THEN 'PASS' ELSE 'WARN' END AS status FROM chk"
    )
    return with_views(ALL_VIEWS, body)


def _scorecard_sql() -> str:
    parts = []
    for name, spec in SPECS.items():
        view = SQL_VIEW[name]
        rules = list(spec.domain_rules) + list(spec.range_rules)
        passed = " + ".join(
            f"(CASE WHEN (SELECT count(*) FROM {view} WHERE {r.report_sql()}) = 0 THEN 1 ELSE 0 END)" for r in rules
        ) or "0"
        failed = " + ".join(
            f"(CASE WHEN (SELECT count(*) FROM {view} WHERE {r.report_sql()}) > 0 THEN 1 ELSE 0 END)" for r in rules
        ) or "0"
        if spec.pk:
            pk = ", ".join(spec.pk)
            nn = " AND ".join(f"{c} IS NOT NULL" for c in spec.pk)
            dup = f"((SELECT count(*) FROM {view}) - (SELECT count(*) FROM (SELECT DISTINCT {pk} FROM {view} WHERE {nn})))"
        else:
            dup = "0"
        miss = " + ".join(f"(SELECT count(*) FROM {view} WHERE {S.missing_sql(spec, c)})" for c in spec.column_types)
        parts.append(
            f"SELECT '{name}' AS source, CAST({passed} + CASE WHEN {dup} = 0 THEN 1 ELSE 0 END AS BIGINT) AS checks_passed, "
            f"CAST({failed} AS BIGINT) AS checks_failed, CAST(CASE WHEN {dup} > 0 THEN 1 ELSE 0 END AS BIGINT) AS checks_warned, "
            f"CAST({miss} AS BIGINT) AS total_missing_values, CASE WHEN ({failed}) = 0 THEN 'PASS' ELSE 'FAIL' END AS overall"
        )
    return with_views(ALL_VIEWS, "\nUNION ALL\n".join(parts))


# ---- registered queries -----------------------------------------------------------


@register("column_profile", _profile_sql())
def q_column_profile(spark, sf_dir):
    return finish(Q.profile_all(source_frames(spark, sf_dir), SPECS))


@register("rule_violations", _rules_sql())
def q_rule_violations(spark, sf_dir):
    return Q.rules_all(source_frames(spark, sf_dir), SPECS)


@register("duplicate_report", _dup_sql())
def q_duplicate_report(spark, sf_dir):
    return Q.duplicates_all(source_frames(spark, sf_dir), SPECS)


@register("cleaning_waterfall", _waterfall_sql())
def q_cleaning_waterfall(spark, sf_dir):
    return finish(Q.waterfall_all(source_frames(spark, sf_dir), SPECS))


@register("clean_clickstream", _clean_sql("clickstream"))
def q_clean_clickstream(spark, sf_dir):
    return finish(C.clean(T.clickstream(spark, sf_dir), SPECS["clickstream"]))


@register("clean_purchases", _clean_sql("purchases"))
def q_clean_purchases(spark, sf_dir):
    return finish(C.clean(T.purchases(spark, sf_dir, with_age_group=True), SPECS["purchases"]))


@register("clean_catalog", _clean_sql("catalog"))
def q_clean_catalog(spark, sf_dir):
    return finish(C.clean(T.catalog(spark, sf_dir), SPECS["catalog"]))


@register("referential_integrity", _integrity_sql())
def q_referential_integrity(spark, sf_dir):
    c = cleaned_frames(spark, sf_dir)
    return Q.referential_integrity(c["clickstream"], c["purchases"], c["catalog"], c["signals"])


@register("scorecard", _scorecard_sql())
def q_scorecard(spark, sf_dir):
    return Q.scorecard(source_frames(spark, sf_dir), SPECS)


def _row_counts_sql() -> str:
    ctes = [S.clean_ctes(SPECS[n], SQL_VIEW[n], f"rc_{n}") for n in SPECS]
    sel = " UNION ALL ".join(
        f"SELECT '{n}' AS source, (SELECT count(*) FROM {SQL_VIEW[n]}) AS bronze_rows, (SELECT count(*) FROM rc_{n}) AS silver_rows"
        for n in SPECS
    )
    return with_views(ALL_VIEWS, ",\n".join(ctes) + "\n" + sel)


@register("source_row_counts", _row_counts_sql())
def q_source_row_counts(spark, sf_dir):
    """Rows per source after load (bronze) and after cleaning (silver)."""
    frames = source_frames(spark, sf_dir)
    rows = []
    for n, df in frames.items():
        bronze = df.select(F.count(F.lit(1))).scalar()
        silver = C.clean(df, SPECS[n]).select(F.count(F.lit(1))).scalar()
        rows.append(F.struct(F.lit(n).alias("source"), bronze.alias("bronze_rows"), silver.alias("silver_rows")))
    return spark.range(1).select(F.inline(F.array(*rows)))
