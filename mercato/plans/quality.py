"""Quality pipeline over the four sources: profile, rules, duplicates,
waterfall, cleaned tables, referential integrity and the scorecard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.functions.columns import count_when, missing
from mercato.operators import clean as C
from mercato.operators import profile as P
from mercato.operators.rules import TableSpec


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def referential_integrity(
    clicks: DataFrame, purchases: DataFrame, catalog: DataFrame, signals: DataFrame
) -> DataFrame:
    """Orphan keys across sources (anti joins on distinct keys) and the user
    overlap of clicks and purchases, one row per check."""
    spark = clicks.sparkSession
    cat_ids = catalog.select("item_id").distinct()
    sig_ids = signals.select("item_id").distinct()
    click_items = clicks.select("item_id").distinct()
    txn_items = purchases.select("item_id").distinct()
    click_users = clicks.select("user_id").distinct()
    txn_users = purchases.select("user_id").distinct()

    def n(df: DataFrame):
        return df.select(F.count(F.lit(1))).scalar()

    checks = [
        ("clickstream_items_not_in_catalog", n(click_items.join(cat_ids, "item_id", "left_anti")), True),
        ("transaction_items_not_in_catalog", n(txn_items.join(cat_ids, "item_id", "left_anti")), True),
        ("catalog_items_missing_ext_signals", n(cat_ids.join(sig_ids, "item_id", "left_anti")), True),
        ("user_overlap_click_txn", n(click_users.join(txn_users, "user_id", "inner")), False),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("check_name"),
            cnt.cast("bigint").alias("count"),
            (F.when(cnt == 0, "PASS").otherwise("WARN") if gated else F.lit("INFO")).alias("status"),
        )
        for name, cnt, gated in checks
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def scorecard(frames: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    """Per source: rule checks passed / failed, key-duplicate warning, total
    missing values and the overall verdict (full-row duplicates are not
    counted, as in the reference). Each figure is a scalar subquery over
    one aggregate of the source, so the row is assembled without joins."""
    spark = next(iter(frames.values())).sparkSession
    rows = []
    for name, df in frames.items():
        spec = specs[name]
        rules = list(spec.domain_rules) + list(spec.range_rules)
        types = {f.name: f.dataType for f in df.schema.fields}
        exprs = [
            F.count(F.lit(1)).alias("n"),
            sum((count_when(missing(c, types[c])) for c in df.columns), F.lit(0)).cast("bigint").alias("m"),
            *[count_when(r.report()).alias(f"v{i}") for i, r in enumerate(rules)],
        ]
        if spec.pk:
            exprs.append(F.countDistinct(*[F.col(c) for c in spec.pk]).alias("k"))
        one = df.agg(*exprs)
        failed = sum(((F.col(f"v{i}") > 0).cast("int") for i in range(len(rules))), F.lit(0))
        warned = (F.col("n") > F.col("k")).cast("int") if spec.pk else F.lit(0)
        fig = one.select(
            (F.lit(len(rules)) - failed + 1 - warned).cast("bigint").alias("passed"),
            failed.cast("bigint").alias("failed"),
            warned.cast("bigint").alias("warned"),
            F.col("m").alias("m"),
        )
        rows.append(
            F.struct(
                F.lit(spec.source).alias("source"),
                fig.select("passed").scalar().alias("checks_passed"),
                fig.select("failed").scalar().alias("checks_failed"),
                fig.select("warned").scalar().alias("checks_warned"),
                fig.select("m").scalar().alias("total_missing_values"),
            )
        )
    out = spark.range(1).select(F.inline(F.array(*rows)))
    return out.withColumn("overall", F.when(F.col("checks_failed") == 0, "PASS").otherwise("FAIL"))


def profile_all(frames: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    return P.profile_tables(frames, specs)


def rules_all(frames: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    return union_all([P.rule_violations(df, specs[n]) for n, df in frames.items()])


def duplicates_all(frames: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    return union_all([P.duplicate_report(df, specs[n]) for n, df in frames.items()])


def waterfall_all(frames: dict[str, DataFrame], specs: dict[str, TableSpec]) -> DataFrame:
    return C.waterfall_with_total([C.cleaning_waterfall(df, specs[n]) for n, df in frames.items()])
