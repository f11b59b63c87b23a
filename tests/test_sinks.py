import tempfile
import uuid

import pytest

from mercato.sources import sinks as K


def test_append_with_additive_evolution(spark):
    path = tempfile.mkdtemp(prefix="mercato-sink-") + "/t"
    K.append_path(spark.createDataFrame([(1, "a")], "id int, v string"), path)
    K.append_path(spark.createDataFrame([(2, "b", 2.5)], "id int, v string, w double"), path, sort_within=["id"])
    got = sorted(map(tuple, K.read_evolving(spark, path).select("id", "v", "w").collect()))
    assert got == [(1, "a", None), (2, "b", 2.5)]


def test_replace_table_that_is_being_read(spark):
    name = f"t_{uuid.uuid4().hex[:8]}"
    spark.createDataFrame([(1,), (2,)], "id int").write.format("parquet").saveAsTable(name)
    K.replace_table(spark.table(name).where("id > 1"), name)
    assert [r.id for r in spark.table(name).collect()] == [2]
    spark.sql(f"DROP TABLE {name}")


def test_export_and_load_csv(spark):
    path = tempfile.mkdtemp(prefix="mercato-csv-") + "/out"
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id int, v string").coalesce(1)
    K.export_csv(df, path, sort_within=["id"])
    back = K.load_csv(spark, path, df.schema)
    assert [r.id for r in back.collect()] == [1, 2, 3]


def test_read_features_and_subset(spark):
    t = spark.createDataFrame([(1, 0.1, 5), (2, 0.2, 6), (3, 0.3, 7)], "user_id long, a double, b int")
    keys = spark.createDataFrame([(2,), (3,), (3,)], "k long")
    got = sorted(map(tuple, K.read_features(t, "user_id", keys, ["a"]).collect()))
    assert got == [(2, 0.2), (3, 0.3)]
    got_shuffled = sorted(map(tuple, K.read_features(t, "user_id", keys, ["a"], broadcast_limit=0).collect()))
    assert got_shuffled == got
    assert K.feature_subset(t, ["a", "zzz"]).columns == ["a"]
    with pytest.raises(KeyError):
        K.feature_subset(t, ["a", "zzz"], strict=True)
