import tempfile

import pytest

from mercato.sources.keyed import ConflictError, KeyedTable

SCHEMA = "k long, v string"


def table(spark, buckets=5, keys=("k",)):
    return KeyedTable(spark, tempfile.mkdtemp(prefix="mercato-keyed-") + "/t", list(keys), buckets)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_upsert_delete_and_versions(spark):
    t = table(spark)
    assert t.version() == 0 and t.read(schema=SCHEMA).count() == 0
    assert t.upsert(spark.createDataFrame([(i, "a") for i in range(20)], SCHEMA)) == 1
    assert t.upsert(spark.createDataFrame([(3, "b"), (30, "b"), (None, "n")], SCHEMA)) == 2
    assert t.upsert(spark.createDataFrame([(None, "m")], SCHEMA)) == 3
    assert t.delete(spark.createDataFrame([(4,), (99,), (5,)], "k long")) == 4
    want = [(i, "b" if i == 3 else "a") for i in range(20) if i not in (4, 5)] + [(30, "b"), (None, "m")]
    assert rows(t.read()) == sorted(want, key=str)
    assert rows(t.read(1)) == sorted([(i, "a") for i in range(20)], key=str)
    assert rows(t.read_keys(spark.createDataFrame([(3,), (77,), (None,)], "k long"))) == sorted([(3, "b"), (None, "m")], key=str)
    assert t.overwrite(spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA), ["v"]) == 5
    assert rows(t.read()) == [(1, "y")]
    assert t.delete(spark.createDataFrame([(1,)], "k long")) == 6 and t.read(schema=SCHEMA).count() == 0
    assert t.delete(spark.createDataFrame([(1,)], "k long")) == 7


def test_only_touched_buckets_are_rewritten(spark):
    t = table(spark, buckets=16)
    t.upsert(spark.createDataFrame([(i, "a") for i in range(200)], SCHEMA))
    before = {r.bucket for r in t.manifest().collect()}
    t.upsert(spark.createDataFrame([(7, "b")], SCHEMA))
    written = t.manifest().where("version = 2").collect()
    assert len(before) == 16 and len(written) == 1
    assert spark.read.parquet(written[0].folder).count() < 200


def test_columns_are_added(spark):
    t = table(spark)
    t.upsert(spark.createDataFrame([(i, "a") for i in range(10)], SCHEMA))
    t.upsert(spark.createDataFrame([(3, "b", 1.5)], "k long, v string, w double"))
    assert {r.k: r.w for r in t.read().collect()} == {i: 1.5 if i == 3 else None for i in range(10)}


def test_a_failure_before_the_commit_leaves_the_old_version(spark, monkeypatch):
    t = table(spark)
    t.upsert(spark.createDataFrame([(1, "a"), (2, "a")], SCHEMA))

    def fail(*_):
        raise OSError("lost")

    monkeypatch.setattr(t, "_commit", fail)
    for change in (lambda: t.upsert(spark.createDataFrame([(1, "b")], SCHEMA)), lambda: t.delete(spark.createDataFrame([(1,)], "k long"))):
        with pytest.raises(OSError):
            change()
    assert t.version() == 1 and rows(t.read()) == [(1, "a"), (2, "a")]
    monkeypatch.undo()
    assert t.upsert(spark.createDataFrame([(1, "b")], SCHEMA)) == 2


def test_a_second_writer_is_noticed(spark):
    t = table(spark)
    t.upsert(spark.createDataFrame([(1, "a")], SCHEMA))
    t.upsert(spark.createDataFrame([(2, "a")], SCHEMA))
    with pytest.raises(ConflictError):
        t._commit([(0, None)], 1)
