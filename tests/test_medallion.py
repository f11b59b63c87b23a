import tempfile

from mercato.plans import lineage as LG
from mercato.plans.medallion import build


def test_medallion_build_writes_every_layer(spark, sf_small):
    wh = tempfile.mkdtemp(prefix="mercato-wh-")
    out = build(spark, sf_small, wh, as_of="2024-02-01 00:00:00")
    counts = {n: df.count() for n, df in out.items()}
    assert counts["user_features"] > 0 and counts["item_features"] > 0
    assert counts["training_dataset"] == counts["user_item_features"]
    assert counts["cleaning_waterfall"] == 5 and counts["scorecard"] == 4
    wf = {r.source: r for r in out["cleaning_waterfall"].collect()}
    assert wf["TOTAL"].original_rows == sum(r.original_rows for s, r in wf.items() if s != "TOTAL")
    assert counts["feature_versions"] == 4
    edges = {(r.src, r.dst) for r in out["lineage_edges"].collect()}
    assert set(map(tuple, out["lineage_edges"].collect())) <= set(LG.EDGES)
    reach = {(r.ancestor, r.descendant) for r in LG.closure(spark, out["lineage_edges"]).collect()}
    assert ("clickstream_clean", "click_pairs") in edges and ("clickstream", "user_features") not in edges
    assert {d for a, d in reach if a == "part"} >= {"catalog", "catalog_clean", "item_features", "training_dataset", "feature_versions"}
