"""Hot keys give the same result as a plain pass in Python."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalog.config import SkewConfig
from stratalog.operators import lifetimes, mix, skew

HOT = SkewConfig(max_rows=40)


@pytest.fixture(scope="module")
def frame(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 else f"k{rnd.randrange(30)}"
        rows.append((key, rnd.randrange(400), i, rnd.choice([None, 1.0, 2.5, 4.0]), rnd.choice("abc")))
    return rows, spark.createDataFrame(rows, "key string, at long, i long, v double, c string")


def test_scan_in_blocks(frame):
    check_scan(*frame)


def test_scan_of_one_key_with_few_times(spark):
    """Nearly all rows have one key and three order values; only the tie column tells them apart."""
    rows = [("hot" if i % 50 else "k", i % 3, (i * 37) % 1_000, [None, 1.0, 2.5][i % 3], "a") for i in range(1_000)]
    df = spark.createDataFrame(rows, "key string, at long, i long, v double, c string")
    blocks = skew.mark_blocks(df, ["key"], ["at", "i"], HOT).where("key = 'hot'").groupBy(skew.BLOCK).count()
    assert max(r["count"] for r in blocks.collect()) < 4 * HOT.max_rows
    check_scan(rows, df)


def check_scan(rows, df):
    assert skew.BLOCK in skew.mark_blocks(df, ["key"], ["at", "i"], HOT).columns
    out = skew.scan(
        df, ["key"], ["at", "i"], HOT,
        prev=skew.lag(F.col("v")), total=skew.running_sum(F.coalesce("v", F.lit(0.0))),
        n=skew.position(), known=skew.last_known(F.col("v")), low=skew.running_min(F.col("v")),
        before=skew.tail(F.struct("i"), 3),
    )
    got = {r["i"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for key in {r[0] for r in rows}:
        prev = known = low = None
        total, past = 0.0, []
        for _, _, i, v, _ in sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])):
            r = got[i]
            assert r["prev"] == prev
            total += v or 0.0
            known = v if v is not None else known
            low = v if low is None else low if v is None else min(low, v)
            assert (r["total"], r["known"], r["low"], r["n"]) == (total, known, low, len(past) + 1)
            assert [b["i"] for b in r["before"]] == past[-3:]
            past.append(i)
            prev = v


def walked(rows, ttl):
    """Starts per key, one time after the other."""
    want = set()
    for key in {r[0] for r in rows}:
        last = None
        for t in sorted({r[1] for r in rows if r[0] == key and r[1] is not None}):
            if last is None or t - last > ttl:
                want.add((key, t))
                last = t
    return want


@pytest.mark.parametrize("max_rows", [3, 5, 40, 1_000_000])
def test_lifetimes(spark, max_rows):
    """Keys of all sizes in one way: null keys, one time in most rows, blocks without any start."""
    rnd = random.Random(9)
    second = 1_000_000
    rows = [(k, rnd.randrange(200) * 10_000 + rnd.choice([0, 0, 10])) for k in "aab" for _ in range(60)]
    rows += [("c", 0), ("c", second), ("c", second + 10), ("c", None), ("d", None)]
    rows += [("e", 50 * second)] * 70 + [("e", 51 * second + 1), ("e", 49 * second)]
    rows += [(None, rnd.randrange(30 * second)) for _ in range(150)]
    rows += [("f", i * 37_000) for i in range(300)] + [("g", i * second * 3) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, us long").select("k", F.timestamp_micros("us").alias("t"))
    starts = lifetimes.lifetime_starts(df, ["k"], "t", 1, SkewConfig(max_rows=max_rows))
    got = [(r["k"], r["t"]) for r in starts.collect()]
    want = walked(rows, second)
    assert len(got) == len(want) and set(got) == want
    assert ("c", second) not in want and ("c", second + 10) in want


def test_first_starts_have_one_last_start():
    rnd = random.Random(2)
    for _ in range(50):
        times = sorted(rnd.randrange(300) for _ in range(rnd.randint(1, 60)))
        first, last = lifetimes.last_starts(np.array(times), 20)
        for after in range(times[0] - 25, times[0]):
            own = lifetimes.walk(times, 0, len(times), after + 20, 20)
            if own:
                at = first.tolist().index(times[own[0]])
                assert last[at] == times[own[-1]]


@pytest.mark.parametrize("max_rows", [20, 1_000_000])
def test_null_key_is_a_key(spark, max_rows):
    rows = [(None if i % 3 else "k", i, i) for i in range(120)]
    df = spark.createDataFrame(rows, "key string, at long, i long")
    out = skew.scan(df, ["key"], ["at"], SkewConfig(max_rows=max_rows), n=skew.position(), before=skew.tail(F.struct("i"), 2))
    got = {r["i"]: r for r in out.collect()}
    assert len(got) == len(rows)
    for key in (None, "k"):
        own = [r[2] for r in rows if r[0] == key]
        for n, i in enumerate(own):
            assert got[i]["n"] == n + 1 and [b["i"] for b in got[i]["before"]] == own[max(0, n - 2) : n]


@pytest.mark.parametrize("take", [1, 7, 450, 999, 1000])
def test_smallest_is_exact(spark, take):
    df = spark.range(1000).withColumn("h", F.sha2(F.concat(F.col("id").cast("string"), F.lit("|1")), 256))
    got = {r["id"] for r in df.where(skew.smallest(df, "h", "id", F.lit(take))).collect()}
    want = [r["id"] for r in df.orderBy("h", "id").limit(take).collect()]
    assert got == set(want)


def test_top_per_group_with_a_hot_group(frame):
    rows, df = frame
    got = skew.top_per_group(df, ["key"], [F.col("at").desc(), F.col("i")], 4, ["i"], salts=4)
    found = {}
    for r in got.collect():
        found.setdefault(r["key"], {})[r["rank"]] = r["i"]
    for key in {r[0] for r in rows}:
        best = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[1], r[2]))[:4]
        assert [found[key][n + 1] for n in range(len(best))] == [b[2] for b in best]


def test_split_exact_truncates_like_int(spark):
    for n, fraction in ((100, 0.29), (1, 0.5), (50, 0.02), (10, 0.03)):
        split = mix.split_exact(spark.range(n), "id", fraction, 42)
        assert split.where("split = 'val'").count() == max(1, int(n * fraction))


def test_split_does_not_depend_on_partitioning(spark):
    a = mix.split_exact(spark.range(500), "id", 0.1, 42)
    b = mix.split_exact(spark.range(500).repartition(7), "id", 0.1, 42)
    assert {tuple(r) for r in a.collect()} == {tuple(r) for r in b.collect()}


def test_blocks_are_cut_inside_few_ranges(spark):
    """Blocks of five rows: thousands of them, still no more files than a shuffle has tasks."""
    rows = spark.range(20_000).select((F.col("id") % 3).alias("key"), F.hash("id").alias("at"), "id")
    marked = skew.mark_blocks(rows, ["key"], ["at", "id"], SkewConfig(max_rows=5))
    assert len(marked.where(F.col(skew.BLOCK) >= 0).inputFiles()) <= 4
    blocks = marked.groupBy(skew.BLOCK).agg(F.count("*").alias("n"), F.countDistinct("key").alias("keys")).collect()
    assert len(blocks) >= 4_000 and max(r["n"] for r in blocks) <= 5
    placed = sorted((r["key"], r["at"], r["id"], r[skew.BLOCK]) for r in marked.collect())
    assert [r[3] for r in placed] == sorted(r[3] for r in placed)


def test_blocks_hold_as_many_rows_as_asked_where_a_task_holds_fewer(spark):
    rows = spark.range(1_000).select(F.lit(1).alias("key"), "id")
    cfg = SkewConfig(max_rows=300, task_rows=10)
    marked = skew.mark_blocks(rows, ["key"], ["id"], cfg)
    assert len(marked.inputFiles()) <= 4
    out = skew.scan(rows, ["key"], ["id"], cfg, n=skew.position())
    assert all(r["n"] == r["id"] + 1 for r in out.collect())
