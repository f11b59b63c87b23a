"""DuckDB text of the retail views (mirror of ``mercato.sources.tables``).

Each constant is a list of CTE definitions; ``with_views`` prepends the
ones a query needs.
"""

from __future__ import annotations

CTES = {
    "clicks": """clicks AS (
  SELECT event_id, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         event_type, ts, value
  FROM events)""",
    "purch": """purch AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number,
         o.o_custkey AS user_id, l.l_partkey AS item_id,
         CAST(l.l_quantity AS INTEGER) AS quantity,
         l.l_extendedprice / l.l_quantity AS unit_price,
         l.l_extendedprice AS total_price,
         o.o_orderdate AS purchase_date,
         o.o_orderpriority AS payment_method
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "purch_age": """purch_age AS (
  SELECT p.*, c.c_mktsegment AS age_group
  FROM purch p LEFT JOIN customer c ON p.user_id = c.c_custkey)""",
    "cat": """cat AS (
  SELECT p_partkey AS item_id, p_name AS name, p_type AS category, p_brand AS brand,
         p_retailprice AS price, CAST(p_size AS BIGINT) AS stock,
         CAST(1.0 + (p_size % 9) * 0.5 AS DOUBLE) AS rating,
         CAST((p_partkey * 37) % 1000 AS BIGINT) AS review_count,
         p_size > 1 AS is_active
  FROM part)""",
    "sig": """sig AS (
  SELECT l_partkey AS item_id,
         avg(l_discount) * 10 AS popularity_score,
         avg(l_tax) * 25 - 1 AS avg_sentiment,
         avg(l_quantity) * 2 AS trend_score,
         avg(CASE WHEN l_returnflag = 'R' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS return_rate,
         count(*) AS search_volume_7d
  FROM lineitem GROUP BY l_partkey)""",
}

# Order in which CTEs may reference each other.
_ORDER = ["clicks", "purch", "purch_age", "cat", "sig"]
_DEPS = {"purch_age": ["purch"]}


def with_views(names: list[str], body: str) -> str:
    """``WITH <views>, <body>``; ``body`` continues the CTE list (it may
    start with further ``name AS (...)`` definitions) and ends in a
    SELECT. Pass ``body`` starting with ``SELECT`` for a plain query."""
    need = set(names)
    for n in list(need):
        need.update(_DEPS.get(n, []))
    parts = [CTES[n] for n in _ORDER if n in need]
    head = "WITH " + ",\n".join(parts)
    stripped = body.lstrip()
    if stripped.upper().startswith("SELECT"):
        return head + "\n" + body
    return head + ",\n" + body
