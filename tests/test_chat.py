from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from stratalog.config import SYSTEM_PROMPT, ChatTemplate, MixConfig, TokenConfig
from stratalog.functions import messages as M
from stratalog.operators import chat, clean, mix, profile, tokens

U, A, S = "user", "assistant", "system"


def frame(spark, *examples):
    rows = [
        (i, None if m is None else [{"role": r, "content": c} for r, c in m])
        for i, m in enumerate(examples)
    ]
    return spark.createDataFrame(rows, f"id long, messages {M.MESSAGES}")


CASES = [
    ([(U, "q"), (A, "a")], None),
    (None, "messages missing or not a list"),
    ([], "no user or assistant message"),
    ([(U, "q")], "no user or assistant message"),
    ([(U, "q"), ("tool", "x"), (A, "")], "unknown role: tool"),
    ([(U, "q"), (A, "　\x1c"), ("tool", "x")], "blank content in role assistant"),
    ([(U, None), (A, "a")], "blank content in role user"),
    ([(U, "q"), (None, "x"), (A, "a")], "unknown role: none"),
    ([(U, "q"), (A, "a"), (U, "again")], "last message is not from assistant"),
    ([(S, "s"), (S, "t"), (U, "q"), (A, "a"), (U, "r"), (A, "b")], None),
]


def test_validation_order(spark):
    checked = chat.validated(frame(spark, *[c[0] for c in CASES])).orderBy("id").collect()
    assert [r["error"] for r in checked] == [c[1] for c in CASES]
    good, bad = chat.split_valid(frame(spark, *[c[0] for c in CASES]))
    assert (good.count(), bad.count()) == (2, 8)


#: sha256 of "é q||r###a||b"
KEY = "22d0dc441dc7df6fd2d490626a83b159a6707c3594f547159a0b22784b83c3c8"


def test_key_ignores_system(spark):
    plain = [(U, "é q"), (A, "a"), (U, "r"), (A, "b")]
    df = chat.with_key(frame(spark, plain, [(S, "other"), *plain])).collect()
    assert df[0]["key"] == df[1]["key"] == KEY


def test_dedup_keeps_file_then_line_order(spark):
    same = [(U, "q"), (A, "a")]
    df = frame(spark, same, same, [(U, "q"), (A, "b")]).withColumn(
        "rank", F.when(F.col("id") == 0, 1).otherwise(0)
    )
    for carry in (False, True):
        got = chat.dedup_examples(df, ["rank", "id"], carry)
        assert {r["id"] for r in got.collect()} == {1, 2}


def test_system_normalised_and_counted(spark):
    two = [(S, SYSTEM_PROMPT), (S, "x"), (U, "q"), (A, "a")]
    df = frame(spark, two, [(S, "x"), (U, "q"), (A, "a")], [(U, "q"), (A, "a")])
    assert profile.system_conformance(df).first()["n_nonstandard"] == 2
    for r in chat.normalise_system(df).collect():
        assert [m["role"] for m in r["messages"]] == [S, U, A]
        assert r["messages"][0]["content"] == SYSTEM_PROMPT


def test_to_chat(spark):
    df = spark.createDataFrame(
        [("t", None, "ask", "more", "out"), ("t", "c", "ask", "", "out"), ("t", "c", "ask", None, "out")],
        "type string, category string, instruction string, input string, output string",
    )
    rows = chat.to_chat(df, "src").collect()
    assert [r["messages"][1]["content"] for r in rows] == ["ask\n\nmore", "ask", "ask"]
    assert rows[0]["meta"].asDict() == {"type": "t", "category": None, "source": "src"}
    assert len(chat.to_chat(df, "src", "").first()["messages"]) == 2


def test_prompt_target(spark):
    r = chat.prompt_target(frame(spark, [(S, "s"), (U, "q"), (A, "a")])).first()
    assert (r["target"], r["question"], len(r["prompt"])) == ("a", "q", 2)


def test_no_conversation_is_too_large(spark):
    """One very long conversation among short ones is assembled, checked and keyed like them."""
    turns = [(1, i, A if i % 2 else U, f"turn {i}") for i in range(60_000)]
    turns += [(2, 0, U, "q"), (2, 1, A, "a"), (3, 0, U, "q"), (3, 1, A, " "), (4, 0, U, "q" * 20_000_000), (4, 1, A, "a")]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    made = chat.assemble(df)
    got = {r["conv_id"]: r["n"] for r in made.select("conv_id", F.size("messages").alias("n")).collect()}
    assert got == {1: 60_000, 2: 2, 3: 2, 4: 2}
    rows = {r["conv_id"]: r for r in chat.checked_conversations(df).collect()}
    assert {c: r["error"] for c, r in rows.items()} == {1: None, 2: None, 3: "blank content in role assistant", 4: None}
    texts = ["||".join(t for _, i, _, t in turns[:60_000] if i % 2 == side) for side in (0, 1)]
    assert rows[1]["key"] == hashlib.sha256("###".join(texts).encode()).hexdigest()
    assert rows[2]["key"] == hashlib.sha256(b"q###a").hexdigest()


@pytest.mark.parametrize("size,kept", [(9, 0), (10, 1)])
def test_short_answers(spark, size, kept):
    df = frame(spark, [(U, "q"), (A, "x" * size)])
    assert clean.long_enough_answer(df, MixConfig()).count() == kept


def test_oversample_and_unknown(spark, values):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, None)], "i int, source string")
    factors = spark.createDataFrame([("a", 5), ("b", 0), ("z", 2)], "source string, factor int")
    got = mix.oversample(df, factors).groupBy("i").count()
    assert values(got, "i", "count") == [(1, 5), (2, 1), (3, 1), (4, 1)]
    assert values(mix.unknown_sources(df, factors), "source") == [("z",)]


def test_append(spark):
    def keyed(*keys):
        return spark.createDataFrame([(k,) for k in keys], "key string")

    new = keyed("v", "t", "both", "n", "n", "m")
    grown, report = mix.append_new(keyed("t", "both", "old"), keyed("v", "both"), new, 5)
    assert {r["key"]: r["count"] for r in grown.groupBy("key").count().collect()} == {
        "t": 1, "both": 1, "old": 1, "n": 10, "m": 5,
    }
    assert tuple(report.first()) == (2, 1, 3)
    none, _ = mix.append_new(keyed("t"), keyed("v"), new, 0)
    assert none.count() == 1


def test_leakage_with_a_hot_key(spark, values):
    rows = [("hot", "train")] * 50 + [("hot", "val")] * 3 + [("a", "val"), ("a", "test"), ("b", "train")]
    df = spark.createDataFrame(rows, "key string, split string")
    got = mix.leakage(df)
    assert values(got, "split_a", "split_b", "n_keys", "rows_a", "rows_b") == [
        ("test", "val", 1, 1, 1), ("train", "val", 1, 50, 3),
    ]


def test_subsets(spark):
    df = spark.range(600)
    one = {r["id"] for r in mix.subset(df, "id", 450, 42).collect()}
    assert len(one) == 450 and mix.subset(spark.range(5), "id", 450, 42).count() == 5
    rounds = mix.subset_per_round(df, "id", 3, 50, 42).groupBy("round").agg(
        F.sort_array(F.collect_list("id")).alias("ids")
    ).collect()
    assert [len(r["ids"]) for r in rounds] == [50] * 3
    assert len({tuple(r["ids"]) for r in rounds}) == 3


def test_group_holdout_keeps_groups_together(spark):
    df = mix.group_holdout(spark.range(2000).withColumn("g", F.col("id") % 100), "g", 0.3, 42)
    sides = df.groupBy("g").agg(F.count_distinct("split").alias("n"), F.min("split").alias("s")).collect()
    assert all(r["n"] == 1 for r in sides)
    assert 15 <= sum(r["s"] == "test" for r in sides) <= 45


def test_token_measure(spark):
    t = ChatTemplate("<", ">", ";", "<go>")
    df = frame(spark, [(S, "s" * 10), (U, "q" * 10), (A, "a" * 10), (U, "r" * 10), (A, "b" * 10)])
    r = tokens.measure(df, t, count=F.length).first()
    full = sum(len(f"<{role}>") + 11 for role in (S, U, A, U, A))
    asked = sum(len(f"<{role}>") + 11 for role in (S, U, U)) + 4
    assert (r["total_tokens"], r["prompt_tokens"], r["assistant_tokens"]) == (full, asked, full - asked)


def test_caps(spark, values):
    rows = [(1024,)] * 99 + [(1025,)]
    df = spark.createDataFrame(rows, "total_tokens long")
    got = {r["cap"]: (r["n_ok"], r["n_over"], r["pct"]) for r in tokens.coverage(df).collect()}
    assert got[512] == (0, 100, 0.0) and got[1024] == (99, 1, 99.0) and got[1536] == (100, 0, 100.0)
    assert tuple(tokens.recommend(df).first()) == (1024, 1)
    big = spark.createDataFrame([(9999,)], "total_tokens long")
    assert tuple(tokens.recommend(big).first()) == (None, None)
    measured = df.withColumn("messages", F.lit(None).cast(M.MESSAGES))
    kept, dropped = tokens.within_cap(measured)
    assert kept.count() == 99 and [r["n_tokens"] for r in dropped.collect()] == [1025]


def test_distribution_is_linear_interpolation(spark):
    import numpy as np

    data = [("a", i * i % 97, i % 13, i) for i in range(200)] + [("b", 5, 1, 4)]
    df = spark.createDataFrame(data, "source string, total_tokens long, prompt_tokens long, assistant_tokens long")
    got = {(r["scope"], r["measure"]): r for r in tokens.distribution(df).collect()}
    totals = [d[1] for d in data]
    want = np.quantile(totals, [p / 100 for p in TokenConfig.percentiles])
    assert np.allclose(got[("all", "total_tokens")]["percentiles"], want)
    assert got[("source:b", "total_tokens")]["n_rows"] == 1
    assert got[("all", "total_tokens")]["mean_v"] == pytest.approx(np.mean(totals))
