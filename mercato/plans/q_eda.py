"""Registered EDA and encoding queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from mercato.operators import clean as C
from mercato.operators import eda as E
from mercato.operators.profile import value_distribution
from mercato.operators.transforms import label_encode, log1p_columns, min_max_normalize, one_hot
from mercato.plans import quality_sql as S
from mercato.plans.oracle_views import with_views
from mercato.plans.registry import R, finish, register
from mercato.plans.rulesets import SPECS, SQL_VIEW
from mercato.session import stored
from mercato.sources import tables as T

# Interaction weights of the test-data event types
# (signup stands in for the cart event).
WEIGHTS = {"view": 1, "click": 2, "signup": 3, "purchase": 5}
WEIGHT_SQL = (
    "CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'signup' THEN 3 "
    "WHEN 'purchase' THEN 5 ELSE 0 END"
)
ALL_VIEWS = ["clicks", "purch", "purch_age", "cat", "sig"]


def _pct_sql(num: str, den: str, d: int = 2) -> str:
    return f"CAST(round_even(TRY_CAST(CAST({num} AS DOUBLE) / {den} * 100.0 AS DECIMAL(38,9)), {d}) AS DOUBLE)"


# ---- mixes ------------------------------------------------------------------------


@register(
    "value_distribution",
    with_views(["clicks"], "SELECT event_type, count(*) AS count FROM clicks WHERE event_type IS NOT NULL GROUP BY event_type"),
)
def q_value_distribution(spark, sf_dir):
    return value_distribution(T.clickstream(spark, sf_dir), "event_type")


@register(
    "event_mix",
    with_views(
        ["clicks"],
        f"SELECT event_type, count(*) AS events, {R('count(*) / (SELECT count(*) FROM clicks)', 'share')} "
        "FROM clicks GROUP BY event_type",
    ),
)
def q_event_mix(spark, sf_dir):
    return finish(E.share_of_total(T.clickstream(spark, sf_dir), "event_type", "events"))


@register(
    "payment_mix",
    with_views(
        ["purch"],
        "SELECT payment_method, count(*) AS transactions, "
        f"{R('sum(total_price)', 'revenue')}, {R('avg(total_price)', 'avg_transaction')}, "
        f"{R(_pct_sql('count(*)', '(SELECT count(*) FROM purch)'), 'share_pct')} "
        "FROM purch GROUP BY payment_method",
    ),
)
def q_payment_mix(spark, sf_dir):
    return finish(E.payment_mix(T.purchases(spark, sf_dir)))


@register(
    "category_mix",
    with_views(
        ["cat"],
        f"SELECT category, count(*) AS items, {R(_pct_sql('count(*)', '(SELECT count(*) FROM cat)'), 'share_pct')} "
        "FROM cat GROUP BY category",
    ),
)
def q_category_mix(spark, sf_dir):
    return finish(E.share_of_total(T.catalog(spark, sf_dir), "category", "items", pct=True))


# ---- histograms ----------------------------------------------------------------------


def _hist_sql(views: list[str], values_sql: str, n: int) -> str:
    body = f"""
hv AS (SELECT CAST(x AS DOUBLE) AS v FROM ({values_sql}) WHERE x IS NOT NULL),
hs AS (SELECT min(v) AS lo, max(v) AS hi FROM hv),
hc AS (
  SELECT CAST(CASE WHEN hs.hi = hs.lo THEN 1
              ELSE least(greatest(floor((v - hs.lo) / (hs.hi - hs.lo) * {n}) + 1, 1), {n}) END AS INTEGER) AS bin,
         count(*) AS cnt
  FROM hv, hs GROUP BY 1),
hb AS (SELECT CAST(range AS INTEGER) AS bin FROM range(1, {n + 1}))
SELECT hb.bin, {R(f"hs.lo + (hb.bin - 1) * ((hs.hi - hs.lo) / {n})", "bin_lo")},
       {R(f"hs.lo + hb.bin * ((hs.hi - hs.lo) / {n})", "bin_hi")},
       CAST(coalesce(hc.cnt, 0) AS BIGINT) AS count
FROM hb CROSS JOIN hs LEFT JOIN hc ON hb.bin = hc.bin
WHERE hs.lo IS NOT NULL"""
    return with_views(views, body)


def _item_pop(spark, sf_dir):
    return E.entity_weights(T.clickstream(spark, sf_dir), "item_id", WEIGHTS)


def _user_activity(spark, sf_dir):
    return T.clickstream(spark, sf_dir).groupBy("user_id").agg(F.count(F.lit(1)).alias("total"))


_ITEM_POP_SQL = f"SELECT item_id, sum({WEIGHT_SQL}) AS x FROM clicks GROUP BY item_id"
_USER_ACT_SQL = "SELECT user_id, count(*) AS x FROM clicks GROUP BY user_id"


@register("histogram_popularity", _hist_sql(["clicks"], _ITEM_POP_SQL, 40))
def q_histogram_popularity(spark, sf_dir):
    return finish(E.histogram(_item_pop(spark, sf_dir), "total", 40))


@register("histogram_price", _hist_sql(["purch"], "SELECT unit_price AS x FROM purch", 40))
def q_histogram_price(spark, sf_dir):
    return finish(E.histogram(T.purchases(spark, sf_dir), "unit_price", 40))


@register("histogram_log_price", _hist_sql(["purch"], "SELECT ln(1 + unit_price) AS x FROM purch", 40))
def q_histogram_log_price(spark, sf_dir):
    p = T.purchases(spark, sf_dir).select(F.log1p("unit_price").alias("unit_price_log"))
    return finish(E.histogram(p, "unit_price_log", 40))


@register("histogram_activity", _hist_sql(["clicks"], _USER_ACT_SQL, 35))
def q_histogram_activity(spark, sf_dir):
    return finish(E.histogram(_user_activity(spark, sf_dir), "total", 35))


@register(
    "popularity_summary",
    with_views(
        ["clicks"],
        f"SELECT 'item_popularity' AS metric, count(*) AS entities, {R('avg(x)', 'mean')}, {R('median(x)', 'median')} "
        f"FROM ({_ITEM_POP_SQL}) UNION ALL "
        f"SELECT 'user_activity', count(*), {R('avg(x)', 'mean')}, {R('median(x)', 'median')} FROM ({_USER_ACT_SQL})",
    ),
)
def q_popularity_summary(spark, sf_dir):
    a = E.totals_summary(_item_pop(spark, sf_dir), "total", "item_popularity")
    b = E.totals_summary(_user_activity(spark, sf_dir), "total", "user_activity")
    return finish(a.unionByName(b))


# ---- bins, crosstab, top-k ------------------------------------------------------------


def _rating_bin_sql() -> str:
    edges, labels = E.RATING_EDGES, E.RATING_LABELS
    whens = []
    for i in range(len(labels)):
        lo, hi = edges[i], edges[i + 1]
        cond = f"rating >= {lo} AND rating <= {hi}" if i == 0 else f"rating > {lo} AND rating <= {hi}"
        whens.append(f"WHEN {cond} THEN '{labels[i]}'")
    lab = " UNION ALL ".join(f"SELECT '{x}' AS rating_bin" for x in labels)
    return with_views(
        ["cat"],
        f"""
rb AS (SELECT CASE {' '.join(whens)} END AS rating_bin FROM cat),
rc AS (SELECT rating_bin, count(*) AS items FROM rb WHERE rating_bin IS NOT NULL GROUP BY rating_bin),
lb AS ({lab})
SELECT lb.rating_bin, CAST(coalesce(rc.items, 0) AS BIGINT) AS items FROM lb LEFT JOIN rc ON lb.rating_bin = rc.rating_bin""",
    )


@register("rating_bins", _rating_bin_sql())
def q_rating_bins(spark, sf_dir):
    return E.rating_bins(T.catalog(spark, sf_dir))


_AGE_SQL = """
ua AS (
  SELECT user_id, age_group FROM (
    SELECT user_id, age_group, row_number() OVER (
      PARTITION BY user_id ORDER BY purchase_date, order_id, line_number, age_group) AS rn
    FROM purch_age) WHERE rn = 1),
ct AS (
  SELECT coalesce(ua.age_group, 'Unknown') AS age_group, c.event_type, count(*) AS events
  FROM clicks c LEFT JOIN ua ON c.user_id = ua.user_id GROUP BY 1, 2),
ctl AS (SELECT age_group, event_type, events, events / sum(events) OVER (PARTITION BY age_group) AS share FROM ct)
"""


def _crosstab(spark, sf_dir):
    ages = E.first_attribute_per_user(T.purchases(spark, sf_dir, with_age_group=True), "age_group")
    return E.crosstab_long(T.clickstream(spark, sf_dir), ages, "age_group")


@register(
    "segment_event_crosstab",
    with_views(["clicks", "purch_age"], _AGE_SQL + f"SELECT age_group, event_type, events, {R('share')} FROM ctl"),
)
def q_segment_event_crosstab(spark, sf_dir):
    return finish(_crosstab(spark, sf_dir))


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@register(
    "segment_event_crosstab_wide",
    with_views(
        ["clicks", "purch_age"],
        _AGE_SQL
        + "SELECT age_group, "
        + ", ".join(
            R(f"coalesce(max(CASE WHEN event_type = '{e}' THEN share END), 0.0)", e) for e in _EVENT_TYPES
        )
        + " FROM ctl GROUP BY age_group",
    ),
)
def q_segment_event_crosstab_wide(spark, sf_dir):
    return finish(E.crosstab_wide(_crosstab(spark, sf_dir), "age_group", "event_type", _EVENT_TYPES))


@register(
    "top_items",
    with_views(
        ["purch"],
        "SELECT item_id, CAST(sum(quantity) AS BIGINT) AS units FROM purch GROUP BY item_id ORDER BY units DESC, item_id LIMIT 20",
    ),
)
def q_top_items(spark, sf_dir):
    units = T.purchases(spark, sf_dir).groupBy("item_id").agg(F.sum("quantity").alias("units"))
    return E.top_k(units, "item_id", "units", 20)


@register(
    "recent_events",
    with_views(
        ["clicks"],
        f"SELECT event_id, user_id, item_id, event_type, ts, {R('value')} FROM clicks ORDER BY ts DESC, event_id LIMIT 10",
    ),
)
def q_recent_events(spark, sf_dir):
    c = T.clickstream(spark, sf_dir)
    return finish(c.orderBy(F.desc("ts"), F.asc("event_id")).limit(10))


@register(
    "top_users",
    with_views(
        ["clicks"],
        f"SELECT user_id, CAST(sum({WEIGHT_SQL}) AS BIGINT) AS score FROM clicks GROUP BY user_id ORDER BY score DESC, user_id LIMIT 50",
    ),
)
def q_top_users(spark, sf_dir):
    s = E.entity_weights(T.clickstream(spark, sf_dir), "user_id", WEIGHTS).withColumnRenamed("total", "score")
    return E.top_k(s.withColumn("score", F.col("score").cast("bigint")), "user_id", "score", 50)


_MATRIX_SQL = f"""
ui AS (SELECT user_id, item_id, CAST(sum({WEIGHT_SQL}) AS BIGINT) AS interaction_score FROM clicks GROUP BY user_id, item_id),
tu AS (SELECT user_id FROM ui GROUP BY user_id ORDER BY sum(interaction_score) DESC, user_id LIMIT 50),
ti AS (SELECT item_id FROM ui GROUP BY item_id ORDER BY sum(interaction_score) DESC, item_id LIMIT 100),
cells AS (SELECT * FROM ui WHERE user_id IN (SELECT user_id FROM tu) AND item_id IN (SELECT item_id FROM ti))
"""


def _cells(spark, sf_dir):
    cells = E.interaction_matrix(T.clickstream(spark, sf_dir), WEIGHTS)
    return cells.withColumn("interaction_score", F.col("interaction_score").cast("bigint"))


@register("interaction_matrix", with_views(["clicks"], _MATRIX_SQL + "SELECT user_id, item_id, interaction_score FROM cells"))
def q_interaction_matrix(spark, sf_dir):
    return _cells(spark, sf_dir).select("user_id", "item_id", "interaction_score")


@register(
    "matrix_sparsity",
    with_views(
        ["clicks"],
        _MATRIX_SQL
        + "SELECT count(DISTINCT user_id) AS n_users, count(DISTINCT item_id) AS n_items, "
        "count(*) FILTER (WHERE interaction_score > 0) AS nonzero, "
        + R("1.0 - count(*) FILTER (WHERE interaction_score > 0) / (count(DISTINCT user_id) * count(DISTINCT item_id))", "sparsity")
        + " FROM cells",
    ),
)
def q_matrix_sparsity(spark, sf_dir):
    return finish(E.matrix_sparsity(_cells(spark, sf_dir)))


@register(
    "mention_tiers",
    with_views(
        ["purch", "sig"],
        """
mt AS (SELECT s.item_id, s.trend_score, u.units AS mentions FROM sig s
       JOIN (SELECT item_id, sum(quantity) AS units FROM purch GROUP BY item_id) u ON s.item_id = u.item_id),
tg AS (SELECT CASE WHEN mentions >= 1000 THEN 'viral' WHEN mentions >= 100 AND mentions < 1000 THEN 'popular'
                   WHEN mentions < 100 THEN 'low' END AS tier FROM mt),
tc AS (SELECT tier, count(*) AS items FROM tg GROUP BY tier),
tl AS (SELECT 'viral' AS tier UNION ALL SELECT 'popular' UNION ALL SELECT 'low')
SELECT tl.tier, CAST(coalesce(tc.items, 0) AS BIGINT) AS items, """
        + R(_pct_sql("coalesce(tc.items, 0)", "(SELECT count(*) FROM mt)", 1), "share_pct")
        + ", "
        + R("(SELECT avg(trend_score) FROM mt)", "avg_trend_score")
        + ", CAST((SELECT sum(mentions) FROM mt) AS BIGINT) AS total_mentions FROM tl LEFT JOIN tc ON tl.tier = tc.tier",
    ),
)
def q_mention_tiers(spark, sf_dir):
    units = T.purchases(spark, sf_dir).groupBy("item_id").agg(F.sum("quantity").alias("mentions"))
    df = T.signals(spark, sf_dir).join(units, "item_id")
    return finish(E.mention_tiers(df, "mentions", "trend_score"))


# ---- encodings (C9) ---------------------------------------------------------------------


def _minmax_sql(c: str, out: str) -> str:
    mx, mn = f"max({c}) OVER ()", f"min({c}) OVER ()"
    return R(f"CASE WHEN {mx} IS NOT DISTINCT FROM {mn} THEN 0.0 ELSE ({c} - {mn}) / ({mx} - {mn}) END", out)


def _enc_sql(c: str, out: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {c} NULLS FIRST) - 1 AS INTEGER) AS {out}"


@register(
    "encode_catalog",
    with_views(
        ALL_VIEWS,
        S.clean_ctes(SPECS["catalog"], SQL_VIEW["catalog"], "cc")
        + "\nSELECT item_id, category, brand, "
        + ", ".join(
            [
                _enc_sql("category", "category_enc"),
                _enc_sql("brand", "brand_enc"),
                R("price"),
                "stock",
                "review_count",
            ]
            + [_minmax_sql(c, f"{c}_norm") for c in ("price", "stock", "review_count")]
            + [R(f"ln(1 + {c})", f"{c}_log") for c in ("price", "stock", "review_count")]
        )
        + " FROM cc",
    ),
)
def q_encode_catalog(spark, sf_dir):
    cat = C.clean(T.catalog(spark, sf_dir), SPECS["catalog"]).select(
        "item_id", "category", "brand", "price", "stock", "review_count"
    )
    out = label_encode(cat, {"category": "category_enc", "brand": "brand_enc"})
    out = min_max_normalize(out, ["price", "stock", "review_count"])
    out = log1p_columns(out, ["price", "stock", "review_count"])
    return finish(out)


@register(
    "encode_purchases",
    with_views(
        ALL_VIEWS,
        S.clean_ctes(SPECS["purchases"], SQL_VIEW["purchases"], "cp")
        + "\nSELECT order_id, line_number, payment_method, age_group, quantity, "
        + ", ".join(
            [
                _enc_sql("payment_method", "payment_enc"),
                _enc_sql("age_group", "age_enc"),
                R("unit_price"),
                R("total_price"),
            ]
            + [_minmax_sql(c, f"{c}_norm") for c in ("unit_price", "total_price", "quantity")]
            + [R(f"ln(1 + {c})", f"{c}_log") for c in ("unit_price", "total_price")]
        )
        + " FROM cp",
    ),
)
def q_encode_purchases(spark, sf_dir):
    p = C.clean(T.purchases(spark, sf_dir, with_age_group=True), SPECS["purchases"]).select(
        "order_id", "line_number", "payment_method", "age_group", "quantity", "unit_price", "total_price"
    )
    p = stored(p, "purchases")  # the codes and each bound read it again
    out = label_encode(p, {"payment_method": "payment_enc", "age_group": "age_enc"})
    out = min_max_normalize(out, ["unit_price", "total_price", "quantity"])
    out = log1p_columns(out, ["unit_price", "total_price"])
    return finish(out)


_VALID = ["click", "purchase", "signup", "view"]


@register(
    "encode_clickstream",
    with_views(
        ALL_VIEWS,
        S.clean_ctes(SPECS["clickstream"], SQL_VIEW["clickstream"], "ck")
        + "\nSELECT event_id, event_type, "
        + _enc_sql("event_type", "event_type_enc")
        + ", "
        + ", ".join(f"CAST(event_type = '{v}' AS INTEGER) AS evt_{v}" for v in _VALID)
        + " FROM ck",
    ),
)
def q_encode_clickstream(spark, sf_dir):
    c = C.clean(T.clickstream(spark, sf_dir), SPECS["clickstream"]).select("event_id", "event_type")
    out = label_encode(c, {"event_type": "event_type_enc"})
    return one_hot(out, "event_type", _VALID, prefix="evt")
