"""Property checks on randomised frames (few examples: each one runs Spark)."""

import random

import pytest
from pyspark.sql import functions as F

from mercato.operators import clean as C
from mercato.operators.pairs import co_purchase_pairs
from mercato.operators.rules import TableSpec, in_range, member
from mercato.operators.transforms import label_encode, min_max_normalize


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_waterfall_sums_to_input(spark, seed):
    rnd = random.Random(seed)
    rows = [
        (
            rnd.choice(["k1", "k2", "k3", "k4", None]),
            rnd.choice(["a", "b", "c", "", None]),
            rnd.choice([None, -5.0, 1.0, 50.0, 500.0]),
            rnd.choice([True, False, None]),
        )
        for _ in range(80)
    ]
    df = spark.createDataFrame(rows, "k string, t string, x double, active boolean")
    spec = TableSpec(source="s", rules=[member("t values", "t", ["a", "b"]), in_range("x", 0, 100)], pk=["k"], active_col="active")
    w = C.cleaning_waterfall(df, spec).first()
    assert w.original_rows == 80
    parts = w.removed_missing + w.removed_domain + w.removed_range + w.removed_duplicates + w.removed_inactive
    assert parts == w.total_removed and w.final_rows == 80 - parts
    assert C.clean(df, spec).count() == w.final_rows


@pytest.mark.parametrize("seed", [4, 5])
def test_norm_in_unit_interval_and_codes_dense(spark, seed):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, rnd.uniform(-10, 10)]), rnd.choice(["x", "y", "z", None])) for _ in range(60)]
    df = spark.createDataFrame(rows, "v double, c string")
    out = label_encode(min_max_normalize(df, ["v"]), ["c"]).collect()
    norms = [r.v_norm for r in out if r.v is not None]
    assert norms and min(norms) == 0.0 and max(norms) == 1.0
    codes = sorted({r.c_enc for r in out})
    assert codes == list(range(len(codes)))


@pytest.mark.parametrize("seed", [6, 7])
def test_lift_symmetric_under_item_swap(spark, seed):
    rnd = random.Random(seed)
    lines = [(rnd.randint(0, 15), rnd.randint(0, 6)) for _ in range(120)]
    a = spark.createDataFrame(lines, "order_id long, item_id long")
    # negate item ids: every pair (a, b) becomes (-b, -a)
    b = a.withColumn("item_id", -F.col("item_id"))
    pa = {(r.item_a, r.item_b): r for r in co_purchase_pairs(a, min_lift=0.0).collect()}
    pb = {(-r.item_b, -r.item_a): r for r in co_purchase_pairs(b, min_lift=0.0).collect()}
    assert pa.keys() == pb.keys()
    for k, r in pa.items():
        s = pb[k]
        assert r.co_purchase_count == s.co_purchase_count and r.lift == s.lift and r.support == s.support
        assert r.confidence_a_to_b == s.confidence_b_to_a and r.confidence_b_to_a == s.confidence_a_to_b
