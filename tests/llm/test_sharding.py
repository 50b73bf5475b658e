from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from stratalog.llm import sharding
from stratalog.llm.sharding import ShardConfig


def test_turns_claim_the_first_free_slot():
    names, slots = ["b", "a", "c"], 13
    got = sharding.lookup_table(names, slots)
    orders = {}
    for name in names:
        start, skip = sharding._number(f"{name}/offset") % slots, sharding._number(f"{name}/skip") % (slots - 1) + 1
        orders[name] = [(start + j * skip) % slots for j in range(slots)]
        assert sorted(orders[name]) == list(range(slots))
    owner = {}
    while len(owner) < slots:
        for name in sorted(names):
            free = [s for s in orders[name] if s not in owner]
            if free:
                owner[free[0]] = name
    assert [names[i] for i in got] == [owner[s] for s in range(slots)]


def test_even_and_stable():
    shards = [f"s{i}" for i in range(20)]
    full = [shards[i] for i in sharding.lookup_table(shards, 2_003)]
    assert set(Counter(full).values()) == {100, 101}
    less = [(shards[:7] + shards[8:])[i] for i in sharding.lookup_table(shards[:7] + shards[8:], 2_003)]
    moved = sum(a != b for a, b in zip(full, less, strict=True) if a != "s7")
    assert moved < 0.25 * 2_003
    assert full == [shards[::-1][i] for i in sharding.lookup_table(shards[::-1], 2_003)]


def test_refuses_bad_tables():
    for shards, slots in ((["a"], 10), (["a", "a"], 11), ([], 11), (["a"] * 3, 2)):
        with pytest.raises(ValueError):
            sharding.lookup_table(shards, slots)


def test_hard_rows(spark):
    data = [(1, None, "x", "y"), (1, None, "x", "y"), (None, "t", None, None), (2, "w" * 100_000, "q", "r")]
    docs = spark.createDataFrame(data, "doc_id long, text string, slot string, _slot string")
    got = sharding.sharded(docs, F.col("doc_id"), ShardConfig(("a", "b"), 101))
    assert got.columns == ["doc_id", "text", "_slot", "slot", "shard"]
    rows = got.collect()
    assert len(rows) == 4 and len({r["shard"] for r in rows if r["doc_id"] == 1}) == 1
    assert all(r["shard"] in "ab" and 0 <= r["slot"] < 101 for r in rows)
    assert sharding.sharded(docs.limit(0), F.col("doc_id")).count() == 0
