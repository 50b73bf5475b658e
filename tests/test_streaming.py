"""Streams give the batch result, also when rows arrive late but before the watermark."""

from __future__ import annotations

import pickle
import random
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from stratalog.bindings import streams
from stratalog.functions.times import micros
from stratalog.operators import series, sessions
from stratalog.streaming import states

MIN = 60 * 1_000_000
DAY = 24 * 60 * MIN  # the watermark starts at 1970, where a row would be late


def run(spark, folder, batches, schema, build):
    """One file per micro-batch, in the given order."""
    source = folder / "in"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(source / f"b{i}"))
    stream = (
        spark.readStream.schema(spark.createDataFrame([], schema).schema)
        .option("maxFilesPerTrigger", 1).parquet(str(source / "*"))
    )
    states.state_store(spark)
    job = (
        build(stream).writeStream.format("memory").queryName(folder.name.replace("-", "_"))
        .option("checkpointLocation", str(folder / "ck")).outputMode("append")
        .trigger(availableNow=True).start()
    )
    job.awaitTermination()
    return spark.table(folder.name.replace("-", "_"))


EVENTS = [
    ("s", 0, "chat", None), ("s", 60 * MIN, "prediction", "w1"), ("s", 61 * MIN, "chat", None),
    ("t", 30 * MIN, "prediction", "w5"), ("s", 240 * MIN, "chat", None), ("s", 240 * MIN + 1, "chat", None),
    ("s", 250 * MIN, "prediction", "w2"), ("s", 251 * MIN, "chat", None), ("t", 600 * MIN, "chat", None),
    ("z", 900 * MIN, "chat", None), ("z", 2000 * MIN, "chat", None),
]


@pytest.fixture(params=["UTC", "America/New_York"])
def zone(spark, request):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("order", [
    [[0, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10]],
    [[0, 2, 3], [1], [5, 4], [7, 6], [8], [9], [10]],  # 1 and 6 come after later rows
])
def test_session_context(spark, tmp_path, order, zone):
    schema = "session_id string, us long, kind string, well_name string"
    batches = [[EVENTS[i] for i in b] for b in order]
    out = run(
        spark, tmp_path, batches, schema,
        lambda s: states.session_context(s.withColumn("ts", F.timestamp_micros(F.col("us") + DAY)).drop("us")),
    )
    got = {(r["session_id"], r["u"]): (r["c"], r["has_context"], r["well_name"]) for r in out.select(
        "session_id", micros("ts").alias("u"), micros("created_at").alias("c"), "has_context", "well_name"
    ).collect()}
    batch = sessions.with_context(
        spark.createDataFrame(EVENTS, schema).withColumn("ts", F.timestamp_micros(F.col("us") + DAY)).drop("us")
    ).where(F.col("session_id") != "z")
    want = {(r["session_id"], r["u"]): (r["c"], r["has_context"], r["well_name"]) for r in batch.select(
        "session_id", micros("ts").alias("u"), micros("created_at").alias("c"), "has_context", "well_name"
    ).collect()}
    assert {k: v for k, v in got.items() if k[0] != "z"} == want


def test_served_values(spark, tmp_path, zone):
    schema = "series string, us long, ok boolean, value double"
    rows = [("p", i * 13 * MIN, i % 4 != 1, float(i)) for i in range(40)]
    end = [("p", 100_000 * MIN, False, 0.0)]
    shuffled = [rows[i ^ 1] for i in range(40)]
    out = run(
        spark, tmp_path, [shuffled[:21], shuffled[21:], end], schema,
        lambda s: states.served_values(
            s.withColumn("fetched_at", F.timestamp_micros(F.col("us") + DAY)).drop("us"), delay="15 minutes"
        ),
    )
    df = spark.createDataFrame(rows, schema).withColumn("fetched_at", F.timestamp_micros(F.col("us") + DAY)).drop("us")
    columns = (micros("fetched_at").alias("u"), "served_value", "state")
    want = {tuple(r) for r in series.served(df, ["series"]).select(*columns).collect()}
    assert {tuple(r) for r in out.select(*columns).collect()} == want


class Store:
    """A state store in memory for one group, counting calls."""

    def __init__(self):
        self.calls, self.maps, self.timers, self.largest = 0, {}, set(), 0

    def getMapState(self, name, *_):
        return State(self, self.maps.setdefault(name, {}))

    def getValueState(self, name, *_):
        return State(self, self.maps.setdefault(name, {}))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


class State:
    def __init__(self, store, rows):
        self.store, self.rows = store, rows

    def get(self):
        return self.getValue(())

    def update(self, value):
        self.updateValue((), value)

    def getValue(self, key):
        self.store.calls += 1
        return self.rows.get(key)

    def updateValue(self, key, value):
        self.store.calls += 1
        self.store.largest = max(self.store.largest, len(pickle.loads(value[0])) if isinstance(value[0], bytes) else 0)
        self.rows[key] = value

    def removeKey(self, key):
        self.store.calls += 1
        del self.rows[key]

    def iterator(self):
        self.store.calls += 1
        return iter(list(self.rows.items()))


def fed(batches, delay, ttl, piece):
    """Batches of ``(us, key, word)`` through the processor; the output, the store, and held values."""
    store = Store()

    def step(held, us, row):
        first = held[0] if held and us - held[0] <= ttl else us
        return (first, row[0]), (us, first, row[0])

    processor = states.InOrder("k string, us long, first long, word string", "k", ["word"], "first long, word string", step, ttl, piece)
    processor.init(store)
    out, mark = [], 0
    for rows in batches:
        if rows:
            frame = pd.DataFrame(rows, columns=["at_us", "k", "word"])
            processor.handleInputRows((0,), iter([frame]), None)
        for at in sorted(t for t in store.timers if t <= mark):
            for part in processor.handleExpiredTimer((0,), SimpleNamespace(getCurrentWatermarkInMs=lambda now=mark: now), None):
                out += part.itertuples(index=False, name=None)
            store.timers.discard(at)
        mark = max([mark, *((us - delay) // 1000 for us, _, _ in rows)])
    return out, store


@pytest.mark.parametrize("keys", [1, 700])
def test_rows_wait_in_pieces_and_calls_are_not_by_row(keys):
    """One key with all rows, and many keys with few: late rows come in order, equal times as they came."""
    rng = random.Random(3)
    ttl, delay, n = 50_000_000, 40_000_000, 20_000
    rows = [(1_000_000_000 + i // 3 * 60_000, f"k{rng.randrange(keys)}", str(i)) for i in range(n)]
    came = sorted(range(n), key=lambda i: rows[i][0] + rng.randrange(delay))
    batches = [[rows[i] for i in came[a : a + 1_700]] for a in range(0, n, 1_700)] + [[(10**13, "end", "")], [], []]
    out, store = fed(batches, delay, ttl, 256)
    want, first, order = [], {}, {i: at for at, i in enumerate(came)}
    for i in sorted(range(n), key=lambda i: (rows[i][0], order[i])):
        us, k, word = rows[i]
        if us - first.get(k, -ttl - 1) > ttl:
            first[k] = us
        want.append((k, us, first[k], word))
    assert out == want
    assert store.largest <= 256
    assert store.calls < (0.1 if keys == 1 else 0.8) * n  # a few for each piece and each key held, none by row


def test_held_values_go_when_their_time_is_over():
    rows = [[(1_000_000 * (i + 1), f"k{i}", "x")] for i in range(300)]
    out, store = fed(rows + [[(10**10, "end", "")], [], [(10**11, "end", "")], [], []], 1_000_000, 5_000_000, 16)
    assert len(out) == 301 and len(store.maps["held"]) <= 1 and len(store.maps["pieces"]) == 1


def test_held_values_lie_in_parts():
    """Calls to the store are not by key held, a part has a bound, and parts go with their values."""
    keys, second = 5_000, 1_000_000
    rows = [(second * (1 + turn * 60) + i, f"k{i}", f"{turn}") for turn in range(3) for i in range(keys)]
    batches = [rows[a : a + keys] for a in range(0, len(rows), keys)] + [[(10**11, "end", "")], [], [(10**12, "end", "")], [], []]
    out, store = fed(batches, 0, 100 * second, 1_000)
    first = {f"k{i}": second + i for i in range(keys)}
    restarted = {f"k{i}": second * 121 + i for i in range(keys)}
    assert out == [(k, us, first[k] if us - first[k] <= 100 * second else restarted[k], word) for us, k, word in rows] + [("end", 10**11, 10**11, "")]
    assert store.calls < 0.1 * len(rows)
    assert store.largest <= 1_000 and len(store.maps["held"]) <= 1 and store.maps["book"][()][2] == 1


def test_served_null_and_nan(spark, tmp_path):
    """A fetched value may be null or NaN; either is served as it is."""
    rows = [("p", 0, True, None), ("p", MIN, True, 1.0), ("q", 0, True, float("nan")), ("q", MIN, False, None), ("r", 0, None, 2.0)]
    out = run(
        spark, tmp_path, [rows, [("end", 100_000 * MIN, False, 0.0)]], "series string, us long, ok boolean, value double",
        lambda s: states.served_values(s.withColumn("fetched_at", F.timestamp_micros(F.col("us") + DAY)).drop("us")),
    )
    got = {(r["series"], r["u"] // MIN): (r["ok"], repr(r["served_value"]), r["state"]) for r in out.select(
        "series", (micros("fetched_at") - DAY).alias("u"), "ok", "served_value", "state").collect()}
    assert got == {
        ("p", 0): (True, "None", "refreshed"), ("p", 1): (True, "None", "cached"), ("q", 0): (True, "nan", "refreshed"),
        ("q", 1): (False, "nan", "cached"), ("r", 0): (None, "None", "failed"),
    }


def test_files_in_time_order(spark, tmp_path):
    """Every row with a time is in one file, and each file is later than the one written before it."""
    rows = [(f"k{i}", (i * 7919) % 500) for i in range(500)] + [("twice", 20)] * 40 + [("none", None)]
    df = spark.createDataFrame(rows, "k string, s long").withColumn("ts", F.timestamp_seconds(F.col("s"))).repartition(3)
    streams.in_time_order(df, "k", "ts", str(tmp_path / "out"))
    files = sorted((tmp_path / "out").glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    found = [spark.read.parquet(str(p)).select("k", "s").collect() for p in files]
    assert [r["k"] for r in found.pop()] == [streams.END] and len(found) == streams.PIECES
    assert sorted((r["k"], r["s"]) for part in found for r in part) == sorted(r for r in rows if r[1] is not None)
    assert all(max(r["s"] for r in a) < min(r["s"] for r in b) for a, b in zip(found, found[1:]))


@pytest.mark.parametrize("settable", [True, False])
def test_a_range_of_times_is_one_task(spark, tmp_path, settable):
    """One job writes all files where times can be set, and each file has a time of its own; elsewhere a job writes
    one file. The rows are the same, and rows of equal times keep their order."""
    rows = [(f"k{i}", i // 4) for i in range(240)]
    df = spark.createDataFrame(rows, "k string, s long").withColumn("ts", F.timestamp_seconds("s")).coalesce(1)
    out = str(tmp_path / "out")
    streams.in_time_order(df, "k", "ts", out, settable)
    files = sorted((tmp_path / "out").glob("*.parquet"), key=lambda p: p.stat().st_mtime_ns)
    found = [[(r["k"], r["s"]) for r in spark.read.parquet(str(p)).select("k", "s").collect()] for p in files]
    assert found.pop() == [(streams.END, None)] and sum(found, []) == rows
    assert len({p.stat().st_mtime_ns // 1_000_000 for p in files}) == len(files) == streams.PIECES + 1
    # the job of a file is in its name; the closing row has its own
    assert len({p.name.split("-", 2)[2] for p in files}) == (2 if settable else len(files))


def test_partitions_of_the_state_have_a_bound(spark, tmp_path, monkeypatch):
    """A session with many shuffle partitions does not give a stream as many; the setting stays as it was."""
    rows = [(f"k{i % 7}", i * 60) for i in range(40)]
    df = spark.createDataFrame(rows, "session_id string, s long").select(
        "session_id", F.timestamp_seconds(F.col("s") + 86_400).alias("ts"), F.lit("chat").alias("kind"), F.lit("w").alias("well_name"))
    monkeypatch.setattr(streams, "PIECES", 2)
    monkeypatch.setattr(streams, "scratch_path", lambda _, name: str(tmp_path / name))
    spark.conf.set("spark.sql.shuffle.partitions", "1000")
    try:
        out = streams.drained(df, "session_id", "ts", states.session_context, "few")
        assert out.count() == 40 and spark.conf.get("spark.sql.shuffle.partitions") == "1000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(list((tmp_path / "few-checkpoint" / "state" / "0").glob("[0-9]*"))) == 8
