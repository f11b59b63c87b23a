"""Registered lineage queries. Every node that is a
table or view carries its real row count, so the report reads the data it
describes."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.plans import lineage as LG
from mercato.plans.oracle_views import with_views
from mercato.sources import files as L
from mercato.sources import tables as T
from mercato.plans.registry import register
from mercato.session import scratch_dir

_COUNTED = ["events", "lineitem", "orders", "customer", "part", "clickstream", "purchases", "catalog", "signals"]


def node_rows(spark, sf_dir):
    frames = {
        "events": T.table(spark, sf_dir, "events"),
        "lineitem": T.table(spark, sf_dir, "lineitem"),
        "orders": T.table(spark, sf_dir, "orders"),
        "customer": T.table(spark, sf_dir, "customer"),
        "part": T.table(spark, sf_dir, "part"),
        "clickstream": T.clickstream(spark, sf_dir),
        "purchases": T.purchases(spark, sf_dir),
        "catalog": T.catalog(spark, sf_dir),
        "signals": T.signals(spark, sf_dir),
    }
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("node_id"), "rows") for n, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _values(rows, cols) -> str:
    def lit(v):
        return str(v) if isinstance(v, int) else "'" + str(v).replace("'", "''") + "'"

    return "(VALUES " + ", ".join("(" + ", ".join(lit(x) for x in r) + ")" for r in rows) + f") AS t({cols})"


_ORDER = {s: i for i, s in enumerate(LG.STAGES)}
_NODES_SQL = "nodes AS (SELECT * FROM " + _values(
    [(n, s, _ORDER[s], t) for n, s, t in LG.NODES], "node_id, stage, stage_order, asset_type"
) + ")"
_EDGES_SQL = "edges AS (SELECT * FROM " + _values(LG.EDGES, "src, dst, operation") + ")"
_COUNT_SRC = {
    "events": "events", "lineitem": "lineitem", "orders": "orders", "customer": "customer", "part": "part",
    "clickstream": "clicks", "purchases": "purch", "catalog": "cat", "signals": "sig",
}
_ROWS_SQL = "nrows AS (" + " UNION ALL ".join(
    f"SELECT '{n}' AS node_id, count(*) AS rows FROM {v}" for n, v in _COUNT_SRC.items()
) + ")"
_BASE = ["clicks", "purch", "cat", "sig"]


def _report(spark, sf_dir):
    hop = LG.one_hop(LG.nodes_frame(spark), LG.edges_frame(spark))
    return hop.join(node_rows(spark, sf_dir), "node_id", "left")


@register(
    "lineage_hops",
    with_views(
        _BASE,
        f"""{_NODES_SQL}, {_EDGES_SQL}, {_ROWS_SQL},
up AS (SELECT dst AS node_id, string_agg(src, ',' ORDER BY src) AS upstream FROM edges GROUP BY dst),
down AS (SELECT src AS node_id, string_agg(dst, ',' ORDER BY dst) AS downstream FROM edges GROUP BY src)
SELECT n.node_id, n.stage, CAST(n.stage_order AS INTEGER) AS stage_order, n.asset_type, up.upstream, down.downstream, r.rows
FROM nodes n LEFT JOIN up ON n.node_id = up.node_id LEFT JOIN down ON n.node_id = down.node_id
LEFT JOIN nrows r ON n.node_id = r.node_id""",
    ),
)
def q_lineage_hops(spark, sf_dir):
    return _report(spark, sf_dir).select(
        "node_id", "stage", "stage_order", "asset_type", "upstream", "downstream", "rows"
    )


@register(
    "lineage_impact",
    with_views(
        _BASE,
        f"""{_EDGES_SQL}, {_ROWS_SQL},
reach(ancestor, descendant, hops) AS (
  SELECT src, dst, 1 FROM edges
  UNION ALL
  SELECT r.ancestor, e.dst, r.hops + 1 FROM reach r JOIN edges e ON r.descendant = e.src WHERE r.hops < {len(LG.NODES)}),
cl AS (SELECT ancestor, descendant, min(hops) AS hops FROM reach GROUP BY ancestor, descendant)
SELECT cl.ancestor, cl.descendant, CAST(cl.hops AS INTEGER) AS hops, r.rows AS ancestor_rows
FROM cl LEFT JOIN nrows r ON cl.ancestor = r.node_id""",
    ).replace("WITH ", "WITH RECURSIVE ", 1),
)
def q_lineage_impact(spark, sf_dir):
    cl = LG.closure(spark, LG.edges_frame(spark))
    rows = node_rows(spark, sf_dir).withColumnRenamed("node_id", "ancestor").withColumnRenamed("rows", "ancestor_rows")
    return cl.join(rows, "ancestor", "left").select(
        "ancestor", "descendant", F.col("hops").cast("int").alias("hops"), "ancestor_rows"
    )


@register(
    "lineage_stage_report",
    with_views(
        _BASE,
        f"""{_NODES_SQL}, {_ROWS_SQL}
SELECT n.stage, CAST(n.stage_order AS INTEGER) AS stage_order, count(*) AS nodes, CAST(sum(r.rows) AS BIGINT) AS rows
FROM nodes n LEFT JOIN nrows r ON n.node_id = r.node_id GROUP BY n.stage, n.stage_order""",
    ),
)
def q_lineage_stage_report(spark, sf_dir):
    return LG.stage_report(_report(spark, sf_dir)).withColumn("rows", F.col("rows").cast("bigint"))


@register("lineage_assets")
def q_lineage_assets(spark, sf_dir):
    """Fingerprints (md5, KB) of the source table files, plus one asset
    that does not exist to show the FILE_NOT_FOUND path."""
    base = sf_dir.rstrip("/")
    names = [n for n, s, _ in LG.NODES if s == "source"]
    assets = spark.createDataFrame([(n, f"{base}/{n}.parquet") for n in names] + [("missing", f"{base}/missing.parquet")], "node_id string, path string")
    fp = L.asset_fingerprints(spark, assets, base)
    return assets.join(fp, "path", "left").select("node_id", "path", "checksum", "size_kb")


_EXPORTS = {"region": ["r_regionkey", "r_name"], "nation": ["n_nationkey", "n_name", "n_regionkey"]}


def _asset_sql() -> str:
    parts = []
    for t, cols in _EXPORTS.items():
        line = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in cols) + " || chr(10)"
        text = f"string_agg({line}, '' ORDER BY {cols[0]})"
        parts.append(f"SELECT '{t}' AS node_id, md5({text}) AS checksum, round(strlen({text}) / 1024.0, 1) AS size_kb FROM {t}")
    return "\nUNION ALL\n".join([*parts, "SELECT 'missing', 'FILE_NOT_FOUND', 0.0"])


@register("lineage_asset_exports", _asset_sql())
def q_lineage_asset_exports(spark, sf_dir):
    """Fingerprints of the dimension tables' exports (one file each: they are of
    fixed size), beside files that are no asset."""
    base = scratch_dir(spark, "assets")
    for t, cols in _EXPORTS.items():
        line = F.concat_ws(",", *[F.col(c).cast("string") for c in cols])
        T.table(spark, sf_dir, t).select(cols[0], line.alias("line")).coalesce(1).sortWithinPartitions(cols[0]).select("line").write.text(f"{base}/{t}")
    T.table(spark, sf_dir, "region").write.parquet(f"{base}/other")
    assets = spark.createDataFrame([(n, f"{base}/{n}") for n in [*_EXPORTS, "missing"]], "node_id string, path string")
    plain = assets.withColumn("path", F.regexp_replace("path", "^file:", ""))
    return plain.join(L.asset_fingerprints(spark, assets, base), "path").select("node_id", "checksum", "size_kb")
