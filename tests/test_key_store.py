from __future__ import annotations

import re

import pytest

from stratalog.operators import key_store
from stratalog.session import scratch_path


@pytest.fixture
def store(spark):
    made = key_store.create(spark, scratch_path(spark, "store"), 8)
    yield made
    made.close()


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id long, key string")


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_three_appends(spark, store):
    one = rows(spark, (1, "a"), (2, "a"), (3, "b"), (4, None))
    two = rows(spark, (5, "a"), (6, "c"), (7, None), (8, "c"))
    three = rows(spark, (9, "c"), (10, "d"), (11, "b"))
    got = [ids(key_store.append(store, b, scratch_path(spark, "batch"))) for b in (one, two, three)]
    assert got == [[1, 2, 3, 4], [6, 7, 8], [10]]
    assert sorted(r["key"] for r in store.keys().collect()) == ["a", "b", "c", "d"]


def test_another_session_opens_it(spark, store):
    key_store.add(store, rows(spark, (1, "a"), (2, "b")))
    again = key_store.open_store(spark, store.path)
    assert again.buckets == 8 and ids(key_store.fresh(again, rows(spark, (3, "a"), (4, "x")))) == [4]
    again.close()


def test_an_append_runs_again(spark, store):
    new = rows(spark, (1, "a"), (2, "b"))
    path = scratch_path(spark, "batch")
    key_store.fresh(store, new).write.parquet(path)
    assert ids(key_store.append(store, new, path)) == [1, 2]
    key_store.add(store, new)
    assert ids(key_store.fresh(store, rows(spark, (3, "a"), (4, "c")))) == [4]


def test_empty_tables(spark, store):
    none = spark.createDataFrame([], "id long, key string")
    assert ids(key_store.append(store, none, scratch_path(spark, "batch"))) == []
    assert ids(key_store.fresh(store, rows(spark, (1, "a")))) == [1]


def test_hot_key_and_other_columns(spark, store):
    new = spark.range(20_000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as key", "id * 2 as buckets")
    assert key_store.append(store, new, scratch_path(spark, "batch")).count() == 20_000
    later = spark.range(20_000, 30_000).selectExpr("id", "if(id % 3 = 0, 'hot', cast(id as string)) as key", "id as buckets")
    left = key_store.fresh(store, later)
    assert left.columns == ["key", "id", "buckets"]
    assert left.where("key = 'hot'").isEmpty() and left.count() == later.where("key != 'hot'").count()


def test_stored_side_is_not_shuffled(spark, store):
    """Below the scan of the store there is no exchange; the two exchanges belong to the new keys."""
    key_store.add(store, spark.range(1000).selectExpr("cast(id as string) as key"))
    new = spark.range(500, 1500).selectExpr("id", "cast(id as string) as key")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = key_store.seen(store, new)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert found.count() == 500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Bucketed: true" in plan
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 2
    scan = plan[plan.index("SortMergeJoin") :].split("FileScan")[0]
    stored = scan.split("Range")[-1]
    assert "Exchange" not in stored
