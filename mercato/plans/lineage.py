"""Lineage of this engine's own pipeline as two tables, nodes and edges.

One-hop upstream/downstream lists are grouped joins; the impact closure
(all ancestors/descendants) is a breadth-first fixpoint of joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.session import stored

# Stage order of the report.
STAGES = ["source", "bronze", "silver", "feature", "store", "quality"]

# The pipeline graph: (node, stage, asset type) and (from, to, operation); the edges
# of written tables are those that the batch job notes as it writes them.
NODES = [
    ("events", "source", "parquet"),
    ("lineitem", "source", "parquet"),
    ("orders", "source", "parquet"),
    ("customer", "source", "parquet"),
    ("part", "source", "parquet"),
    ("clickstream", "bronze", "view"),
    ("purchases", "bronze", "view"),
    ("catalog", "bronze", "view"),
    ("signals", "bronze", "view"),
    ("clickstream_clean", "silver", "table"),
    ("purchases_clean", "silver", "table"),
    ("catalog_clean", "silver", "table"),
    ("signals_clean", "silver", "table"),
    ("click_pairs", "feature", "table"),
    ("purchase_pairs", "feature", "table"),
    ("user_features", "feature", "table"),
    ("item_features", "feature", "table"),
    ("user_item_features", "feature", "table"),
    ("co_purchase_pairs", "feature", "table"),
    ("feature_catalogue", "store", "table"),
    ("feature_versions", "store", "table"),
    ("training_dataset", "store", "table"),
    ("serving_table", "store", "table"),
    ("serving_vectors", "store", "table"),
    ("column_profile", "quality", "table"),
    ("cleaning_waterfall", "quality", "table"),
    ("referential_integrity", "quality", "table"),
    ("scorecard", "quality", "table"),
]
EDGES = [
    ("events", "clickstream", "extract item key from props"),
    ("lineitem", "purchases", "join orders"),
    ("orders", "purchases", "join lineitem"),
    ("customer", "purchases", "join segment"),
    ("part", "catalog", "project"),
    ("lineitem", "signals", "aggregate per part"),
    ("clickstream", "clickstream_clean", "rules, dedupe first"),
    ("purchases", "purchases_clean", "rules, dedupe last"),
    ("catalog", "catalog_clean", "rules, dedupe, active filter"),
    ("signals", "signals_clean", "rules, dedupe"),
    ("clickstream_clean", "click_pairs", "aggregate per user and item"),
    ("purchases_clean", "purchase_pairs", "aggregate per user and item"),
    ("click_pairs", "user_features", "aggregate per user"),
    ("purchase_pairs", "user_features", "aggregate per user"),
    ("clickstream_clean", "user_features", "preferred values"),
    ("purchases_clean", "user_features", "spend"),
    ("catalog_clean", "user_features", "category mode"),
    ("click_pairs", "item_features", "aggregate per item"),
    ("purchase_pairs", "item_features", "aggregate per item"),
    ("catalog_clean", "item_features", "carry attributes"),
    ("signals_clean", "item_features", "carry signals"),
    ("click_pairs", "user_item_features", "scores per pair"),
    ("purchase_pairs", "user_item_features", "purchase label"),
    ("purchases_clean", "co_purchase_pairs", "basket pair mining"),
    ("user_features", "feature_versions", "row count and checksum"),
    ("item_features", "feature_versions", "row count and checksum"),
    ("user_item_features", "feature_versions", "row count and checksum"),
    ("co_purchase_pairs", "feature_versions", "row count and checksum"),
    ("user_features", "feature_catalogue", "schema"),
    ("item_features", "feature_catalogue", "schema"),
    ("user_item_features", "feature_catalogue", "schema"),
    ("user_item_features", "training_dataset", "labels"),
    ("user_features", "training_dataset", "left join"),
    ("item_features", "training_dataset", "left join"),
    ("user_features", "serving_table", "materialise"),
    ("item_features", "serving_table", "materialise"),
    ("user_item_features", "serving_vectors", "candidates"),
    ("user_features", "serving_vectors", "join"),
    ("item_features", "serving_vectors", "join"),
    ("clickstream", "column_profile", "profile"),
    ("purchases", "column_profile", "profile"),
    ("catalog", "column_profile", "profile"),
    ("signals", "column_profile", "profile"),
    ("clickstream", "cleaning_waterfall", "tag"),
    ("purchases", "cleaning_waterfall", "tag"),
    ("catalog", "cleaning_waterfall", "tag"),
    ("signals", "cleaning_waterfall", "tag"),
    ("clickstream_clean", "referential_integrity", "anti join"),
    ("purchases_clean", "referential_integrity", "anti join"),
    ("catalog_clean", "referential_integrity", "anti join"),
    ("signals_clean", "referential_integrity", "anti join"),
    ("clickstream", "scorecard", "count"),
    ("purchases", "scorecard", "count"),
    ("catalog", "scorecard", "count"),
    ("signals", "scorecard", "count"),
]


def nodes_frame(spark: SparkSession) -> DataFrame:
    order = {s: i for i, s in enumerate(STAGES)}
    return spark.createDataFrame(
        [(n, s, order[s], t) for n, s, t in NODES], "node_id string, stage string, stage_order int, asset_type string"
    )


def edges_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(EDGES, "src string, dst string, operation string")


def one_hop(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Each node with its sorted upstream and downstream node lists."""
    up = edges.groupBy(F.col("dst").alias("node_id")).agg(
        F.array_join(F.array_sort(F.collect_list("src")), ",").alias("upstream")
    )
    down = edges.groupBy(F.col("src").alias("node_id")).agg(
        F.array_join(F.array_sort(F.collect_list("dst")), ",").alias("downstream")
    )
    return nodes.join(up, "node_id", "left").join(down, "node_id", "left")


def closure(spark: SparkSession, edges: DataFrame, max_depth: int | None = None) -> DataFrame:
    """(ancestor, descendant, hops) of all reachable pairs with the least hop count.

    Breadth first: each step extends only the pairs that the last one found by
    one edge, keeps every pair once and drops those that are known, so work
    grows with the pairs and not with the paths, and cycles end. Steps are
    written, one per hop of the longest shortest path."""
    step = stored(edges.select(F.col("src").alias("via"), F.col("dst").alias("to")).distinct(), "edges")
    newest = step.select(F.col("via").alias("ancestor"), F.col("to").alias("descendant"))
    found = newest.withColumn("hops", F.lit(1))
    hops = 1
    while max_depth is None or hops < max_depth:
        further = newest.join(step, F.col("descendant") == F.col("via")).select("ancestor", F.col("to").alias("descendant")).distinct()
        newest = further.join(found.select("ancestor", "descendant"), ["ancestor", "descendant"], "left_anti")
        newest = stored(newest, "reach")
        if newest.isEmpty():
            break
        hops += 1
        found = found.unionByName(newest.withColumn("hops", F.lit(hops)))
    return found


def stage_report(report: DataFrame) -> DataFrame:
    """Nodes and rows per stage in stage order."""
    return (
        report.groupBy("stage", "stage_order")
        .agg(F.count(F.lit(1)).alias("nodes"), F.sum("rows").alias("rows"))
        .orderBy("stage_order")
    )
