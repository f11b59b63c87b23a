import datetime as dt
import random

from pyspark.sql import functions as F

from mercato.functions.digests import multiset_digest
from mercato.plans import lineage as LG
from mercato.plans import store as ST
from mercato.operators import eda as E


def test_as_of_join_matches_bruteforce(spark):
    rnd = random.Random(11)
    base = dt.datetime(2024, 1, 1)
    snaps = [(k, base + dt.timedelta(hours=rnd.randint(0, 24 * 6)), rnd.randint(0, 99)) for k in range(4) for _ in range(8)]
    labels = [(i, rnd.randint(0, 4), base + dt.timedelta(hours=rnd.randint(0, 24 * 7))) for i in range(60)]
    s = spark.createDataFrame(snaps, "user_id int, snapshot_ts timestamp, v int")
    l = spark.createDataFrame(labels, "label_id int, user_id int, ts timestamp")
    got = {r.label_id: (r.snapshot_ts, r.v) for r in ST.as_of_join(l, s, "user_id", "ts", "snapshot_ts", ["v"]).collect()}
    for lid, uid, ts in labels:
        cands = [(t, v) for k, t, v in snaps if k == uid and t <= ts]
        exp = max(cands, key=lambda x: (x[0], x[1])) if cands else (None, None)
        if cands:
            best_t = exp[0]
            assert got[lid][0] == best_t
            assert got[lid][1] in {v for k, t, v in snaps if k == uid and t == best_t}
        else:
            assert got[lid] == (None, None)


def test_as_of_join_with_a_hot_key(spark):
    """One key holds half of the rows: partitions stay alike, results exact."""
    rnd = random.Random(12)
    base = dt.datetime(2024, 1, 1)

    def at():
        return base + dt.timedelta(minutes=rnd.randrange(0, 4000, 7))

    def key():
        return 1 if rnd.random() < 0.5 else rnd.randint(2, 40)

    snaps = [(key(), at(), rnd.randint(0, 9), f"s{rnd.randint(0, 9)}") for _ in range(900)] + [(None, at(), 1, "x"), (1, None, 1, "x")]
    labels = [(i, key(), at(), "a") for i in range(1500)] + [(9000, None, at(), "b"), (9001, 1, None, "c"), (3, 1, at(), "a"), (3, 99, at(), "a")]
    s = spark.createDataFrame(snaps, "user_id int, snapshot_ts timestamp, v int, w string")
    lab = spark.createDataFrame(labels, "label_id int, user_id int, ts timestamp, v string")
    sizes = [r["count"] for r in ST.spread_by_time(lab, s, "user_id", "ts", "snapshot_ts", ["v", "w"], 12).groupBy("_p").count().collect()]
    assert len(sizes) >= 10 and max(sizes) <= 2 * sum(sizes) / len(sizes)
    got = sorted(((r[0], r[1], r[2], r[4], r[5], r[6]) for r in ST.as_of_join(lab, s, "user_id", "ts", "snapshot_ts", ["v", "w"], 12).collect()), key=str)
    want = []
    for i, k, t, _ in labels:
        found = [(ts, v, w) for kk, ts, v, w in snaps if kk == k and k is not None and t is not None and ts is not None and ts <= t]
        want.append((i, k, t, *(max(found) if found else (None, None, None))))
    assert got == sorted(want, key=str)
    assert ST.as_of_join(lab, s.limit(0), "user_id", "ts", "snapshot_ts", ["v", "w"]).where("snapshot_ts IS NULL").count() == len(labels)


def test_closure_of_a_ladder_counts_hops_not_paths(spark):
    layers = 40  # 2^40 paths from end to end
    edges = [(f"n{k}{a}", f"n{k + 1}{b}", "x") for k in range(layers - 1) for a in "ab" for b in "ab"]
    got = {(r.ancestor, r.descendant): r.hops for r in LG.closure(spark, spark.createDataFrame(edges, "src string, dst string, operation string")).collect()}
    assert got == {(f"n{i}{a}", f"n{j}{b}"): j - i for i in range(layers) for j in range(i + 1, layers) for a in "ab" for b in "ab"}


def test_closure_ends_on_cycles(spark):
    edges = spark.createDataFrame([("a", "b", ""), ("b", "c", ""), ("c", "a", ""), ("c", "d", ""), ("a", "d", "")], "src string, dst string, operation string")
    got = {(r.ancestor, r.descendant): r.hops for r in LG.closure(spark, edges).collect()}
    assert got[("a", "a")] == 3 and got[("b", "d")] == 2 and got[("a", "d")] == 1 and len(got) == 12
    assert {r.hops for r in LG.closure(spark, edges, 2).collect()} == {1, 2}


def test_multiset_digest(spark):
    rows = [(i % 7, i / 3, None if i % 5 == 0 else f"t{i}", dt.datetime(2024, 1, 1, 0, 0, i % 60, 12)) for i in range(200)]
    df = spark.createDataFrame(rows, "a int, b double, c string, d timestamp")
    one = lambda x: x.agg(multiset_digest(x).alias("h")).first().h
    assert one(df) == one(df.repartition(7, "b")) == one(df.select("d", "c", "b", "a"))
    assert one(df) != one(df.withColumn("a", F.when(F.col("b") == 1.0, 99).otherwise(F.col("a"))))
    assert one(df) != one(df.unionByName(df.limit(1))) and one(df.limit(0)) == "0:0"
    assert one(spark.createDataFrame([("a", None)], "x string, y string")) != one(spark.createDataFrame([(None, "a")], "x string, y string"))


def test_upsert_and_delete(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c")], "k int, v string")
    assert sorted(map(tuple, ST.upsert(old, new, ["k"]).collect())) == [(1, "a"), (2, "B"), (3, "c")]
    assert sorted(map(tuple, ST.delete_keys(old, new, ["k"]).collect())) == [(1, "a")]


def test_serving_lookup(spark):
    users = spark.createDataFrame([(1, 0.5, float("nan"))], "user_id long, a double, b double")
    serving = ST.serving_table({"user": (users, "user_id", ["a", "b", "_hidden"] if False else ["a", "b"])}, "2024-02-01 00:00:00", 60)
    cells = {r.feature_name: r.feature_value for r in serving.collect()}
    assert cells == {"a": 0.5, "b": None}
    req = spark.createDataFrame([("user", 1), ("user", 2)], "namespace string, entity_id long")
    off = spark.createDataFrame([("user", 2)], "namespace string, entity_id long")
    early = {r.entity_id: r.source for r in ST.lookup(req, serving, off, "2024-02-01 00:00:30").collect()}
    late = {r.entity_id: r.source for r in ST.lookup(req, serving, off, "2024-02-01 00:02:00").collect()}
    assert early == {1: "online", 2: "offline"} and late == {1: "none", 2: "offline"}
    st = ST.lookup_stats(ST.lookup(req, serving, off, "2024-02-01 00:00:30")).first()
    assert (st.cache_hits, st.cache_misses, st.hit_rate) == (1, 1, 0.5)


def test_lineage_closure(spark):
    cl = {(r.ancestor, r.descendant): r.hops for r in LG.closure(spark, LG.edges_frame(spark)).collect()}
    assert cl[("events", "clickstream")] == 1
    assert cl[("events", "training_dataset")] == 4
    assert ("training_dataset", "events") not in cl


def test_rating_bins_edges(spark):
    df = spark.createDataFrame([(1.0,), (1.5,), (1.51,), (4.5,), (5.0,), (None,)], "rating double")
    got = {r.rating_bin: r.items for r in E.rating_bins(df).collect()}
    assert got["1.0"] == 2 and got["1.5"] == 1 and got["4.0"] == 1 and got["4.5"] == 1 and got["5.0"] == 0


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    got = {r.bin: r["count"] for r in E.histogram(df, "x", 2).collect()}
    assert got == {1: 1, 2: 2}


def test_serving_vectors_read_stored_pairs(spark, tmp_path):
    """The (user, item) pre-aggregates are tables read by column, and features are
    rounded before the join, to the same values as behind it."""
    from mercato.plans import q_store as QS
    from mercato.plans.registry import finish

    at = dt.datetime(2024, 1, 2, 3)
    rows = {
        "events": ([(k, at + dt.timedelta(hours=k), k % 4, ["view", "click", "signup", "purchase"][k % 4], 1.5, f'{{"k": {k % 5}}}') for k in range(40)], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"),
        "orders": ([(k, k % 4, at + dt.timedelta(days=k), "1-URGENT") for k in range(8)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": ([(k % 8, k, k % 5, 1, 3.0, 10.0 / (k + 3), 0.07, 0.02, "R") for k in range(30)], "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string"),
        "part": ([(k, f"p{k}", f"t{k % 2}", f"b{k % 3}", 7.0 / (k + 1), k + 1) for k in range(5)], "p_partkey long, p_name string, p_type string, p_brand string, p_retailprice double, p_size int"),
    }
    for name, (data, schema) in rows.items():
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = QS._tables(spark, str(tmp_path))
    files = " ".join(t["user_item_features"][0].inputFiles())
    assert "click-pairs" in files and "purchase-pairs" in files
    got = QS.q_serving_vectors(spark, str(tmp_path))
    want = finish(ST.serving_vectors(t["user_item_features"][0], t["user_features"][0], t["item_features"][0]))
    assert got.columns == want.columns and got.count() == 20
    assert got.agg(multiset_digest(got)).first()[0] == want.agg(multiset_digest(want)).first()[0]
