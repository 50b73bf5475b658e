from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from stratalog import config as C
from stratalog.config import SeriesConfig, SessionConfig, SkewConfig
from stratalog.operators import series, sessions
from stratalog.operators.capped import capped_events

HOT = SkewConfig(max_rows=3)
H = 3600 * 1_000_000
EVENTS = "id long, session_id string, us long, kind string, well_name string, summary string, n_zones long, dominant_lithology string"


def events(spark):
    rows = [
        (1, "s", 0, "chat", None, None, None, None),
        (2, "s", H, "prediction", "w1", "one", 4, "Shale"),
        (3, "s", 4 * H - 1, "chat", None, None, None, None),
        (4, "s", 4 * H, "prediction", "w2", "two", 0, None),
        (5, "s", 4 * H, "chat", None, None, None, None),
        (6, "s", 4 * H + 1, "chat", None, None, None, None),
        (7, "s", 8 * H + 1, "prediction", "w3", "three", 1, "Sand"),
        (8, "t", 4 * H, "prediction", "w9", "nine", 2, "Lime"),
    ]
    df = spark.createDataFrame(rows, EVENTS)
    return df.withColumn("ts", F.timestamp_micros("us")).drop("us")


@pytest.mark.parametrize("skew", [SkewConfig(), HOT])
def test_context(spark, skew):
    seen = sessions.with_context(events(spark), ["ts", "id"], skew=skew)
    got = {r["id"]: (r["has_context"], r["well_name"], r["dominant_lithology"]) for r in seen.collect()}
    assert got == {
        1: (False, None, None), 2: (True, "w1", "Shale"), 3: (True, "w1", "Shale"),
        4: (True, "w2", None), 5: (True, "w2", None),  # a prediction without zones resets the class
        6: (False, None, None), 7: (True, "w3", "Sand"), 8: (True, "w9", "Lime"),
    }


def test_sessions_live_from_creation(spark, values):
    created = sessions.sessions(events(spark))
    got = values(created.select("session_id", F.unix_micros("created_at").alias("t")), "session_id", "t")
    assert got == [("s", 0), ("s", 4 * H + 1), ("t", 4 * H)]
    alive = sessions.live_sessions(created, F.timestamp_micros(F.lit(8 * H)))
    assert values(alive.select("session_id", F.unix_micros("created_at").alias("t")), "session_id", "t") == [
        ("s", 4 * H + 1), ("t", 4 * H),
    ]
    many = spark.range(501).select(
        F.col("id").cast("string").alias("session_id"), F.timestamp_micros("id").alias("created_at")
    )
    kept = sessions.live_sessions(many, F.timestamp_micros(F.lit(1000)))
    assert kept.count() == 500 and kept.where("session_id = '0'").count() == 0


def test_info(spark):
    got = sessions.session_info(sessions.attached(events(spark), ["ts", "id"])).orderBy("created_at", "session_id").collect()
    assert [tuple(r) for r in got] == [
        ("s", True, "w2", 0, "1970-01-01T00:00:00Z"), ("s", True, "w3", 1, "1970-01-01T04:00:00Z"),
        ("t", True, "w9", 2, "1970-01-01T04:00:00Z"),
    ]


@pytest.mark.parametrize("skew", [SkewConfig(), HOT])
def test_history(spark, skew):
    turns = [(1, 0, "system", "sys")] + [(1, i, "user" if i % 2 else "assistant", f" t{i}\n") for i in range(1, 12)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    got = {r["turn"]: r["history"] for r in sessions.history(df, skew=skew).collect()}
    assert got[1] is None and 0 not in got
    assert got[3] == "Earlier in this conversation:\nUser: t1\nAssistant: t2"
    assert got[11].split("\n")[1:] == [f"{'User' if i % 2 else 'Assistant'}: t{i}" for i in range(5, 11)]


def test_prompt_budget(spark):
    def build(question, summary, history, system="SYS", cfg=SessionConfig()):
        df = spark.createDataFrame([(question, summary, history)], "question string, summary string, history string")
        return sessions.message(df, system, cfg).first()

    r = build(" why? ", "sum", "hist")
    assert r["message"] == "\n\n---\n\n".join(
        [C.CONTEXT_FRAME.format("sum"), "hist", "SYS\n\nQuestion: why?"]
    ) + "\n\n" + C.LITHOLOGY_RULES
    assert not r["trimmed"] and not r["over_budget"]
    plain = build("why?", None, None)
    assert plain["message"] == "SYS\n\nQuestion: why?"
    # exactly 700 estimated tokens stay, one more character of the fourth kind drops the history
    room = 700 * 4 + 3 - len("SYS\n\nQuestion: q") - len("\n\n---\n\n")
    assert not build("q", None, "h" * room)["trimmed"]
    over = build("q", None, "h" * (room + 1))
    assert over["trimmed"] and over["message"] == "SYS\n\nQuestion: q" and not over["over_budget"]
    assert build("q" * 3000, None, "h")["over_budget"]
    assert build("q", "sum", None, system=None)["message"].endswith("Question: q")


def test_route_and_answer_prompt(spark):
    df = spark.createDataFrame([("a.las", "old"), (None, "old"), (None, None)], "file string, prior_summary string")
    got = [(r["route"], r["summary"]) for r in sessions.route(df).collect()]
    assert got == [("lithology", None), ("chat", "old"), ("chat", None)]
    q = spark.createDataFrame([(" why ", "sum"), ("why", "")], "question string, summary string")
    rows = sessions.answer_prompt(q, "SYS").collect()
    assert rows[0]["user"] == C.SHOWN_FRAME.replace("{}", "sum", 1).replace("{}", "why")
    assert rows[0]["system"] == f"SYS\n\n{C.LITHOLOGY_RULES}" and rows[1]["system"] == "SYS"
    assert rows[1]["user"] == "why" and rows[1]["prompt_tokens"] == 0


def prices(spark):
    return spark.createDataFrame(
        [("RWTC", "2026-01-01", 70.0), ("RWTC", "2026-01-02", 71.555), ("RBRTE", "2026-01-01", 75.0),
         ("X", "2026-01-01", 1.0), ("X", "2026-01-02", None), ("N", None, 2.0)],
        "series string, period string, value double",
    )


def test_quote(spark, values):
    wanted = spark.createDataFrame([("RWTC",), ("RBRTE",), ("X",), ("none",), ("N",)], "series string")
    good, bad = series.latest_checked(prices(spark), wanted)
    assert values(good, "series", "value") == [("RBRTE", 75.0), ("RWTC", 71.555)]
    assert {r["series"] for r in bad.collect()} == {"X", "none", "N"}
    line = series.quote_line(series.quote(good)).first()["line"]
    assert line.startswith("WTI: $71.56/bbl (as of 2026-01-02), Brent: $75.00/bbl (as of 2026-01-01)")
    assert series.quote(good.where("series = 'RWTC'")).count() == 0


def fold_requests(rows, ttl):
    at = value = None
    out = {}
    for i, t, ok, v in sorted(rows, key=lambda r: (r[1], r[0])):
        due = at is None or t - at > ttl
        if due and ok:
            at, value, state = t, v, "refreshed"
        else:
            state = "failed" if at is None else "stale" if due else "cached"
        out[i] = (value, state)
    return out


@pytest.mark.parametrize("skew", [SkewConfig(), HOT])
def test_served(spark, skew):
    rows = [
        (1, 0, False, 1.0), (2, 5, True, 2.0), (3, 5, True, 3.0), (4, H + 5, True, 4.0),
        (5, H + 6, False, 5.0), (6, H + 7, True, 6.0), (7, 2 * H + 7, False, 7.0), (8, 9 * H, False, 8.0),
        (9, 9 * H + 1, True, 9.0), (10, 9 * H + 2, False, 10.0),
    ]
    df = spark.createDataFrame([("s", *r) for r in rows], "series string, i long, us long, ok boolean, value double")
    df = df.withColumn("fetched_at", F.timestamp_micros("us")).drop("us")
    got = series.served(df, ["series"], ["fetched_at", "i"], SeriesConfig(), skew)
    assert {r["i"]: (r["served_value"], r["state"]) for r in got.collect()} == fold_requests(rows, H)


def test_times_without_zone(spark):
    from stratalog.functions.times import micros

    df = spark.createDataFrame([(dt.datetime(1970, 1, 1, 0, 0, 1),)], "t timestamp_ntz")
    assert df.select(micros("t")).first()[0] == 1_000_000


def reference_cap(rows, ttl, cap):
    """Every session alive in a list, every event in order."""
    live, seen, ended = [], {}, []
    for i, s, t in sorted(rows, key=lambda r: (r[2], r[0])):
        live = [x for x in live if t - x[1] <= ttl]
        while len(live) > cap:
            ended.append((*live.pop(0), t))
        own = [c for k, c in live if k == s]
        if not own:
            live.append((s, t))
        seen[i] = own[0] if own else t
    return seen, sorted(ended, key=str)


@pytest.mark.parametrize("max_rows", [7, 60, 1_000_000])
@pytest.mark.parametrize("cap", [1, 5, 500])
def test_cap_ends_sessions(spark, cap, max_rows):
    """In blocks of a few events, and in one; a null id, equal times, bursts and silence."""
    rnd = random.Random(cap)
    second = 1_000_000
    rows = [(i, rnd.choice([None, *"abcdefghijkl"]), rnd.choice([0, 600, 601]) * second + rnd.randrange(60) * second) for i in range(200)]
    df = spark.createDataFrame([(*r, "k") for r in rows] + [(900, "a", None, "k")], "id long, session_id string, us long, kind string")
    df = df.withColumn("ts", F.timestamp_micros("us")).drop("us")
    cfg = SessionConfig(ttl_seconds=20, max_sessions=cap)
    seen, ended = capped_events(df, ["ts", "id"], cfg, SkewConfig(max_rows=max_rows))
    want, gone = reference_cap(rows, 20 * second, cap)
    assert {r["id"]: r["t"] for r in seen.select("id", F.unix_micros("created_at").alias("t")).collect()} == want
    got = ended.select("session_id", F.unix_micros("created_at"), F.unix_micros("ended_at")).collect()
    assert sorted((tuple(r) for r in got), key=str) == gone and bool(gone) == (cap < 500)


def test_cap_over_no_events(spark):
    df = spark.createDataFrame([], "id long, session_id string, ts timestamp")
    seen, ended = capped_events(df, ["ts", "id"])
    assert seen.collect() == [] and ended.collect() == []
