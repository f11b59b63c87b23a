from pyspark.sql import functions as F

from mercato.operators import clean as C
from mercato.operators import profile as P
from mercato.operators.rules import TableSpec, in_range, member, pattern

SCHEMA = "event_id string, user_id string, event_type string, city string, amount double, ts string"
ROWS = [
    ("EVT_000001", "USER_0001", "view", "Pune", 10.0, "2024-01-01 10:00:00"),
    ("EVT_000002", "USER_0002", "click", None, 20.0, "2024-01-01 11:00:00"),  # missing city
    ("EVT_000003", "USER_0003", "bogus", "Delhi", 30.0, "2024-01-01 12:00:00"),  # domain
    ("EVT_000004", "bad", "view", "Delhi", 40.0, "2024-01-01 13:00:00"),  # format
    ("EVT_000005", "USER_0005", None, "Goa", 50.0, "2024-01-01 14:00:00"),  # NULL event_type
    ("EVT_000006", "USER_0006", "view", "", 60.0, "2024-01-01 15:00:00"),  # empty string = missing
    ("EVT_000007", "USER_0007", "view", "Goa", 999.0, "2024-01-01 16:00:00"),  # range
    ("EVT_000001", "USER_0001", "click", "Pune", 11.0, "2024-01-01 09:00:00"),  # duplicate key, earlier
    ("EVT_000008", "USER_0008", "click", "Pune", None, "2024-01-01 17:00:00"),  # NULL amount -> missing
]
SPEC = TableSpec(
    source="clicks",
    numeric_cols=["amount"],
    cardinality_cols=["user_id", "event_type"],
    rules=[
        member("event_type values", "event_type", ["view", "click"]),
        pattern("user_id format", "user_id", r"^USER_\d{4}$"),
        in_range("amount", 0, 100),
    ],
    pk=["event_id"],
    order_by=["ts"],
    keep="first",
)


def test_rule_report_null_is_not_a_violation(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = {r.check_name: r.violations for r in P.rule_violations(df, SPEC).collect()}
    # NULL event_type is not counted by the report ...
    assert got == {"event_type values": 1, "user_id format": 1, "amount range": 1}


def test_waterfall_first_failing_step_and_totals(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    w = C.cleaning_waterfall(df, SPEC).first()
    # the NULL event_type row fails the missing step first (missing runs
    # before domain rules, column by column)
    assert (w.removed_missing, w.removed_domain, w.removed_range) == (4, 2, 1)
    assert w.removed_duplicates == 1 and w.removed_inactive == 0
    assert w.final_rows == 1 and w.original_rows == 9
    assert w.original_rows == w.final_rows + w.total_removed


def test_clean_keeps_first_by_order(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rows = C.clean(df, SPEC).collect()
    assert [(r.event_id, r.event_type) for r in rows] == [("EVT_000001", "click")]


def test_dedupe_keep_last(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "y"), ("a", 2, "z"), ("b", 1, "w")], "k string, t int, v string")
    got = {r.k: r.v for r in C.dedupe(df, ["k"], ["t"], "last").collect()}
    assert got == {"a": "y", "b": "w"}


def test_duplicate_report_compat_vs_null_safe(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", "x"), ("b", "x")], "k string, v string")
    spec = TableSpec(source="t", pk=["k"])
    r = P.duplicate_report(df, spec).first()
    assert r.full_row_duplicates == 2  # NULL-safe
    assert r.duplicate_rows_compat == 3  # countDistinct skips NULL rows
    assert r.pk_duplicates == 2


def test_profile_missing_and_stats(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    prof = {r.column_name: r for r in P.column_profile(df, SPEC).collect()}
    assert prof["city"].missing_count == 2 and prof["city"].missing_pct == 22.22
    assert prof["amount"].missing_count == 1
    assert prof["amount"].median_value == 30.0  # lower median of 8 values
    assert prof["user_id"].cardinality == 8 and prof["city"].cardinality is None


def test_contract_check(spark):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    got = {r.column_name: (r.present, r.null_count, r.status) for r in P.contract_check(df, ["a", "b", "c"]).collect()}
    assert got == {"a": (True, 0, "OK"), "b": (True, 1, "WARN"), "c": (False, None, "MISSING")}


def test_profile_counts_the_values_once(spark, monkeypatch):
    """Slices, cardinalities and medians read one written count of the tagged values."""
    from mercato.operators import profile as PR
    from mercato.operators.rules import TableSpec

    written = []
    plain = PR.stored
    monkeypatch.setattr(PR, "stored", lambda df, name: (written.append(df.columns), plain(df, name))[1])
    df = spark.createDataFrame([(i % 7, float(i % 5), "x" if i % 3 else None) for i in range(50)], "id long, v double, s string")
    spec = TableSpec(source="t", column_types={"id": "long", "v": "double", "s": "string"}, numeric_cols=["v"], cardinality_cols=["id", "s"], pk=[])
    rows = {r.column_name: r for r in PR.profile_tables({"t": df}, {"t": spec}).collect()}
    assert written == [["tag", "slice", "s", "x", "c"]]
    assert rows["v"].median_value == 2.0 and rows["id"].cardinality == 7 and rows["s"].cardinality == 1


def test_duplicate_report_compares_in_full_only_what_may_be_repeated(spark, monkeypatch):
    """Counts as by brute force, with equal digests of unlike rows and a filter that lets
    much pass; rows that are alone are not shuffled in full."""
    from mercato.operators import profile as PR

    rows = [(k, k % 7, "x" * 40 + str(k), None if k % 5 == 0 else 0.5) for k in range(400)]
    rows += rows[::10] + [(3, 3, "other", 0.5), (None, 1, "n", 0.5), (None, 1, "n", 0.5), (None, 2, "n", -0.0), (None, 2, "n", 0.0), (9, None, "m", 1.0)]
    df = spark.createDataFrame(rows, "id long, part int, v string, w double")
    spec = TableSpec(source="t", pk=["id", "part"])
    keys = {(r[0], r[1]) for r in rows if None not in r[:2]}
    want = (len(rows), len(rows) - len(set(rows)), len(rows) - len({r for r in rows if None not in r}), len(rows) - len(keys))
    written = []
    plain = PR.stored
    monkeypatch.setattr(PR, "stored", lambda d, name: (written.append((name, d.columns)), plain(d, name))[1])

    def figures(of):
        return tuple(PR.duplicate_report(of, spec).first())[1:5]

    assert figures(df) == want
    assert written == [("digests", ["__k0", "__k1", "__nulls", "__d", "n"]), ("marked", ["__word", "__bits"])]
    for bits, digest in ((7, None), (26, F.lit(5).cast("long")), (26, F.pmod(F.xxhash64("id", "part"), F.lit(3)))):
        with monkeypatch.context() as m:
            m.setattr(PR, "FILTER_BITS", bits)
            if digest is not None:
                m.setattr(PR, "_row_digest", lambda _, d=digest: d)
            assert figures(df) == want
    assert figures(df.limit(0)) == (0, 0, 0, 0)
