"""DuckDB text for the quality queries, generated from the same rule specs
(the rules supply only *what* to check; the SQL computes independently)."""

from __future__ import annotations

from mercato.operators.rules import TableSpec
from mercato.plans.registry import R


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def missing_sql(spec: TableSpec, c: str) -> str:
    if spec.column_types[c] == "string":
        return f"({c} IS NULL OR {c} = '')"
    return f"({c} IS NULL)"


def _half_even(expr: str, d: int) -> str:
    return f"CAST(round_even(TRY_CAST(CAST({expr} AS DOUBLE) AS DECIMAL(38,9)), {d}) AS DOUBLE)"


def pct_sql(n: str, total: str) -> str:
    return f"CASE WHEN {total} > 0 THEN {_half_even(f'CAST(100.0 AS DOUBLE) * {n} / {total}', 2)} ELSE 0.0 END"


def profile_sql(spec: TableSpec, view: str) -> tuple[str, str]:
    """(CTE text, SELECT rows text) for one source."""
    cols = list(spec.column_types)
    cte = f"a_{spec.source}"
    aggs = ["count(*) AS total"]
    for i, c in enumerate(cols):
        aggs.append(f"count(*) FILTER (WHERE {missing_sql(spec, c)}) AS m{i}")
    for i, c in enumerate(spec.numeric_cols):
        x = f"CAST({c} AS DOUBLE)"
        aggs += [
            f"min({x}) AS mn{i}",
            f"max({x}) AS mx{i}",
            f"avg({x}) AS av{i}",
            f"stddev_samp({x}) AS sd{i}",
            f"quantile_disc({x}, 0.5) AS md{i}",
        ]
    for i, c in enumerate(spec.cardinality_cols):
        aggs.append(f"count(DISTINCT {c}) AS cd{i}")
    cte_text = f"{cte} AS (SELECT {', '.join(aggs)} FROM {view})"
    selects = []
    nulld = "CAST(NULL AS DOUBLE)"
    for i, c in enumerate(cols):
        if c in spec.numeric_cols:
            j = list(spec.numeric_cols).index(c)
            mn, mx, md = f"mn{j}", f"mx{j}", f"md{j}"
            av = _half_even(f"av{j}", 4)
            sd = _half_even(f"coalesce(sd{j}, 0.0)", 4)
        else:
            mn = mx = md = av = sd = nulld
        card = (
            f"CAST(cd{list(spec.cardinality_cols).index(c)} AS BIGINT)"
            if c in spec.cardinality_cols
            else "CAST(NULL AS BIGINT)"
        )
        selects.append(
            f"SELECT {_q(spec.source)} AS source, {_q(c)} AS column_name, "
            f"{_q(spec.column_types[c])} AS dtype, CAST(m{i} AS BIGINT) AS missing_count, "
            f"{R(pct_sql(f'm{i}', 'total'), 'missing_pct')}, {R(mn, 'min_value')}, {R(mx, 'max_value')}, "
            f"{R(av, 'mean_value')}, {R(md, 'median_value')}, {R(sd, 'std_value')}, {card} AS cardinality "
            f"FROM {cte}"
        )
    return cte_text, "\nUNION ALL\n".join(selects)


def rules_sql(spec: TableSpec, view: str) -> tuple[str, str] | None:
    rules = list(spec.domain_rules) + list(spec.range_rules)
    if not rules:
        return None
    cte = f"r_{spec.source}"
    aggs = [f"CAST(sum(CASE WHEN {r.report_sql()} THEN 1 ELSE 0 END) AS BIGINT) AS v{i}" for i, r in enumerate(rules)]
    cte_text = f"{cte} AS (SELECT {', '.join(aggs)} FROM {view})"
    sels = []
    for i, r in enumerate(rules):
        exp = _q(r.expected) if r.expected is not None else "CAST(NULL AS VARCHAR)"
        sels.append(
            f"SELECT {_q(spec.source)} AS source, {_q(r.name)} AS check_name, {_q(r.family)} AS kind, "
            f"{_q(r.column)} AS column_name, {exp} AS expected, v{i} AS violations, "
            f"CASE WHEN v{i} = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM {cte}"
        )
    return cte_text, "\nUNION ALL\n".join(sels)


def duplicates_sql(spec: TableSpec, view: str) -> str:
    cols = ", ".join(spec.column_types)
    notnull = " AND ".join(f"{c} IS NOT NULL" for c in spec.column_types)
    pk = ", ".join(spec.pk)
    pk_nn = " AND ".join(f"{c} IS NOT NULL" for c in spec.pk)
    total = f"(SELECT count(*) FROM {view})"
    full = f"(SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {view}))"
    compat = f"(SELECT count(*) FROM (SELECT DISTINCT {cols} FROM {view} WHERE {notnull}))"
    pkd = f"(SELECT count(*) FROM (SELECT DISTINCT {pk} FROM {view} WHERE {pk_nn}))" if spec.pk else total
    return (
        f"SELECT {_q(spec.source)} AS source, {total} AS total_rows, {total} - {full} AS full_row_duplicates, "
        f"greatest(0, {total} - {compat}) AS duplicate_rows_compat, "
        f"CAST(greatest(0, {total} - {pkd}) AS BIGINT) AS pk_duplicates, "
        f"CASE WHEN greatest(0, {total} - {compat}) = 0 THEN 'PASS' ELSE 'WARN' END AS duplicates_status, "
        f"CASE WHEN greatest(0, {total} - {pkd}) = 0 THEN 'PASS' ELSE 'WARN' END AS pk_status"
    )


def reason_sql(spec: TableSpec) -> str:
    key_cols = [c for c in spec.column_types if not c.startswith("_")]
    whens = []
    if key_cols:
        whens.append(f"WHEN {' OR '.join(missing_sql(spec, c) for c in key_cols)} THEN 'missing'")
    for r in spec.domain_rules:
        whens.append(f"WHEN {r.drop_sql()} THEN 'domain'")
    for r in spec.range_rules:
        whens.append(f"WHEN {r.drop_sql()} THEN 'range'")
    if not whens:
        return "CAST(NULL AS VARCHAR)"
    return "CASE " + " ".join(whens) + " END"


def dedupe_sql(spec: TableSpec, src: str) -> str:
    """Rows of ``src`` (already filtered) with one survivor per key."""
    cols = list(spec.column_types)
    if not spec.pk:
        return f"SELECT DISTINCT {', '.join(cols)} FROM {src}"
    direction = "ASC NULLS FIRST" if spec.keep == "first" else "DESC NULLS LAST"
    order = ", ".join(f"{c} {direction}" for c in list(spec.order_by) + cols)
    return (
        f"SELECT {', '.join(cols)} FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {', '.join(spec.pk)} ORDER BY {order}) AS rn__ FROM {src}) WHERE rn__ = 1"
    )


def clean_ctes(spec: TableSpec, view: str, name: str) -> str:
    """CTEs ``{name}_t`` (tagged), ``{name}_d`` (deduped survivors) and
    ``{name}`` (cleaned, active filter applied)."""
    active = f" WHERE coalesce({spec.active_col} = TRUE, FALSE)" if spec.active_col else ""
    return (
        f"{name}_t AS (SELECT *, {reason_sql(spec)} AS reason__ FROM {view}),\n"
        f"{name}_d AS ({dedupe_sql(spec, f'(SELECT * FROM {name}_t WHERE reason__ IS NULL)')}),\n"
        f"{name} AS (SELECT * FROM {name}_d{active})"
    )


def waterfall_sql(spec: TableSpec, view: str) -> tuple[str, str]:
    name = f"w_{spec.source}"
    ctes = clean_ctes(spec, view, name)
    inactive = (
        f"(SELECT count(*) FROM {name}_d WHERE NOT coalesce({spec.active_col} = TRUE, FALSE))"
        if spec.active_col
        else "0"
    )
    t = f"{name}_t"
    row = (
        f"SELECT {_q(spec.source)} AS source, "
        f"(SELECT count(*) FROM {t}) AS original_rows, "
        f"(SELECT count(*) FROM {t} WHERE reason__ = 'missing') AS removed_missing, "
        f"(SELECT count(*) FROM {t} WHERE reason__ = 'domain') AS removed_domain, "
        f"(SELECT count(*) FROM {t} WHERE reason__ = 'range') AS removed_range, "
        f"(SELECT count(*) FROM {t} WHERE reason__ IS NULL) - (SELECT count(*) FROM {name}_d) AS removed_duplicates, "
        f"CAST({inactive} AS BIGINT) AS removed_inactive"
    )
    return ctes, row
