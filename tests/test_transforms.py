import random

from pyspark.sql import functions as F

from mercato.operators.quantiles import _distributed_quantile, exact_quantile
from mercato.operators.transforms import label_encode, log1p_columns, min_max_normalize


def test_min_max_regular_and_null(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, None), (4, 6.0)], "id int, x double")
    out = {r.id: r.x_norm for r in min_max_normalize(df, ["x"]).collect()}
    assert out == {1: 0.0, 2: 0.5, 3: None, 4: 1.0}


def test_min_max_constant_and_all_null(spark):
    df = spark.createDataFrame([(1, 3.0, None), (2, 3.0, None), (3, None, None)], "id int, x double, y double")
    out = min_max_normalize(df, {"x": "xn", "y": "yn"}).collect()
    assert all(r.xn == 0.0 and r.yn == 0.0 for r in out)


def test_min_max_empty(spark):
    df = spark.createDataFrame([], "x double")
    assert min_max_normalize(df, ["x"]).count() == 0


def test_log1p(spark):
    df = spark.createDataFrame([(0.0,), (1.0,)], "x double")
    vals = sorted(r.x_log for r in log1p_columns(df, ["x"]).collect())
    assert vals[0] == 0.0 and abs(vals[1] - 0.6931471805599453) < 1e-12


def _expected_codes(values):
    distinct = sorted({v for v in values if v is not None})
    codes = {}
    offset = 1 if any(v is None for v in values) else 0
    for i, v in enumerate(distinct):
        codes[v] = i + offset
    codes[None] = 0
    return codes


def test_label_encode_small_and_distributed_agree(spark):
    rnd = random.Random(7)
    values = [rnd.choice(["b", "a", "d", None, "c", "e", "f"]) for _ in range(300)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, c string")
    exp = _expected_codes(values)
    for limit in (1_000_000, 0):
        got = {r.id: r.c_enc for r in label_encode(df, ["c"], broadcast_limit=limit).collect()}
        assert got == {i: exp[v] for i, v in enumerate(values)}, limit


def test_label_encode_distributed_many_partitions(spark):
    df = spark.range(0, 5000).select((F.col("id") % 997).cast("string").alias("c")).repartition(7)
    exp = {v: i for i, v in enumerate(sorted({str(i) for i in range(997)}))}
    rows = label_encode(df, ["c"], broadcast_limit=10).select("c", "c_enc").distinct().collect()
    assert {r.c: r.c_enc for r in rows} == exp


def test_exact_quantile_paths(spark):
    rnd = random.Random(3)
    xs = [float(rnd.randint(0, 50)) for _ in range(501)] + [None] * 5
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(5)
    vals = sorted(x for x in xs if x is not None)
    for q in (0.1, 0.5, 0.9):
        import math

        k = max(1, math.ceil(q * len(vals)))
        expected = vals[k - 1]
        disc = df.agg(exact_quantile(df, "x", q)[0].alias("m")).first().m
        dist = spark.range(1).select(_distributed_quantile(df, "x", q).alias("m")).first().m
        assert disc == expected and dist == expected, (q, disc, dist, expected)


def test_encode_purchases_cleans_once(spark, monkeypatch):
    """The codes and the bounds read the cleaned rows from a table."""
    from mercato.plans import q_eda
    from mercato.plans.catalog import all_queries

    written = []
    plain = q_eda.stored
    monkeypatch.setattr(q_eda, "stored", lambda df, name: (written.append(name), plain(df, name))[1])
    out = all_queries()["encode_purchases"](spark, "/root/testdata/sf0.001")
    assert written == ["purchases"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan.replace("Window [dense_rank", "")
