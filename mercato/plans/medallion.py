"""Batch job: materialise bronze -> silver -> features -> store tables.

Each layer is written once as parquet under ``warehouse`` and the next
layer reads the written files, so every step has a short lineage (a lost
executor recomputes from the last written layer, not from the raw
tables) and no table is recomputed for each consumer. Run on a cluster
with a shared ``warehouse`` path:

    python -m mercato.plans.medallion --sf-dir <tables> --warehouse <path>
"""

from __future__ import annotations

import argparse
import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from mercato.operators import clean as C
from mercato.operators.pairs import co_purchase_pairs
from mercato.plans import features as FT
from mercato.plans import quality as Q
from mercato.plans import store as ST
from mercato.plans.rulesets import SPECS
from mercato.sources import tables as T

REFERENCE_DATE = "2024-02-01"


class Job:
    """Writes the layers' tables and notes of each what it was made from."""

    def __init__(self, spark: SparkSession, warehouse: str):
        self.spark, self.warehouse = spark, warehouse.rstrip("/")
        self.tables: list[tuple[str, str]] = []
        self.edges: list[tuple[str, str, str]] = []

    def write(self, df: DataFrame, layer: str, table: str, **made_from: str) -> DataFrame:
        """Write a table and read it back; ``made_from`` maps inputs to operations."""
        path = f"{self.warehouse}/{layer}/{table}"
        df.write.mode("overwrite").parquet(path)
        self.tables.append((table, layer))
        self.edges += [(source, table, operation) for source, operation in made_from.items()]
        return self.spark.read.parquet(path)


def build(spark: SparkSession, sf_dir: str, warehouse: str, as_of: str | None = None) -> dict[str, DataFrame]:
    """Write every layer; returns the written tables read back, the edges of the
    run's lineage among them."""
    as_of = as_of or _dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    out: dict[str, DataFrame] = {}
    job = Job(spark, warehouse)
    bronze = {
        "clickstream": job.write(T.clickstream(spark, sf_dir), "bronze", "clickstream", events="extract item key from props"),
        "purchases": job.write(
            T.purchases(spark, sf_dir, with_age_group=True), "bronze", "purchases",
            lineitem="join orders", orders="join lineitem", customer="join segment",
        ),
        "catalog": job.write(T.catalog(spark, sf_dir), "bronze", "catalog", part="project"),
        "signals": job.write(T.signals(spark, sf_dir), "bronze", "signals", lineitem="aggregate per part"),
    }
    # Quality reports over bronze, then the cleaned silver tables.
    out["column_profile"] = job.write(Q.profile_all(bronze, SPECS), "quality", "column_profile", **dict.fromkeys(bronze, "profile"))
    out["cleaning_waterfall"] = job.write(Q.waterfall_all(bronze, SPECS), "quality", "cleaning_waterfall", **dict.fromkeys(bronze, "tag"))
    out["scorecard"] = job.write(Q.scorecard(bronze, SPECS), "quality", "scorecard", **dict.fromkeys(bronze, "count"))
    how = {"clickstream": "rules, dedupe first", "purchases": "rules, dedupe last", "catalog": "rules, dedupe, active filter", "signals": "rules, dedupe"}
    silver = {n: job.write(C.clean(df, SPECS[n]), "silver", f"{n}_clean", **{n: how[n]}) for n, df in bronze.items()}
    clicks, purchases, catalog, signals = (silver[n] for n in ("clickstream", "purchases", "catalog", "signals"))
    out["referential_integrity"] = job.write(
        Q.referential_integrity(clicks, purchases, catalog, signals), "quality", "referential_integrity",
        **{f"{n}_clean": "anti join" for n in silver},
    )
    roles = T.EVENT_ROLES
    # One shuffle per source: the (user, item) pre-aggregates feed all three
    # feature tables.
    cu = job.write(FT.click_pairs(clicks, roles, "ts"), "features", "click_pairs", clickstream_clean="aggregate per user and item")
    pu = job.write(FT.purchase_pairs(purchases), "features", "purchase_pairs", purchases_clean="aggregate per user and item")
    shared = {"clicks_ui": cu, "purchases_ui": pu}
    uf = job.write(
        FT.user_features(clicks, purchases, catalog, REFERENCE_DATE, device_col="event_type", time_col="ts", roles=roles, **shared),
        "features", "user_features",
        click_pairs="aggregate per user", purchase_pairs="aggregate per user", clickstream_clean="preferred values", purchases_clean="spend", catalog_clean="category mode",
    )
    itf = job.write(
        FT.item_features(clicks, purchases, catalog, signals, roles=roles, **shared), "features", "item_features",
        click_pairs="aggregate per item", purchase_pairs="aggregate per item", catalog_clean="carry attributes", signals_clean="carry signals",
    )
    uif = job.write(
        FT.user_item_features(clicks, purchases, roles=roles, **shared), "features", "user_item_features",
        click_pairs="scores per pair", purchase_pairs="purchase label",
    )
    pairs = job.write(co_purchase_pairs(purchases, order=False), "features", "co_purchase_pairs", purchases_clean="basket pair mining")
    out.update(user_features=uf, item_features=itf, user_item_features=uif, co_purchase_pairs=pairs)
    out["training_dataset"] = job.write(
        ST.training_dataset(uif, uf, itf), "store", "training_dataset", user_item_features="labels", user_features="left join", item_features="left join"
    )
    out["serving_table"] = job.write(
        ST.serving_table(
            {"user": (uf, "user_id", ST.DEFAULT_USER_FEATURES), "item": (itf, "item_id", ST.DEFAULT_ITEM_FEATURES)},
            as_of,
        ),
        "store", "serving_table", user_features="materialise", item_features="materialise",
    )
    versioned = {"user_features": uf, "item_features": itf, "user_item_features": uif, "co_purchase_pairs": pairs}
    v = None
    for n, df in versioned.items():
        part = ST.snapshot_version(df, n)
        v = part if v is None else v.unionByName(part)
    out["feature_versions"] = job.write(v, "store", "feature_versions", **dict.fromkeys(versioned, "row count and checksum"))
    edges = spark.createDataFrame(job.edges, "src string, dst string, operation string")
    out["lineage_edges"] = job.write(edges, "store", "lineage_edges")
    return out


def main() -> None:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf-dir", required=True)
    ap.add_argument("--warehouse", required=True)
    args = ap.parse_args()
    from mercato.session import get_session

    spark = get_session()
    for name, df in build(spark, args.sf_dir, args.warehouse).items():
        print(name, df.count())


if __name__ == "__main__":
    main()
