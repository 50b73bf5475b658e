from __future__ import annotations

from pyspark.sql import functions as F

from stratalog.config import CleanConfig, SkewConfig
from stratalog.functions import text as T
from stratalog.operators import clean, profile

SCHEMA = "row_id long, type string, category string, instruction string, input string, output string"
OK = "a long enough answer"


def rows(spark):
    return spark.createDataFrame(
        [
            (1, "geo", "a.b", "ask", "", OK),
            (2, "geo", "a.b", "ask", "", OK),
            (3, "chat", "a.b", "ask", "", OK),
            (4, None, "a.b", "ask", "", OK),
            (5, "geoqa", "gso.wikipedia.x", "ask", "", OK),
            (6, "self", "gso.wordnet.y", "ask", "", OK),
            (7, "self", None, "ask", None, OK),
            (8, "geo", "", "Related PAPER please", "", OK),
            (9, "geo", "a", None, "in", OK),
            (10, "geo", "a", "q", "", "It MEANS that 12 rocks are here"),
            (11, "geo", "a", "q", "", "It is that ٤٢ rocks are here"),
            (12, "geo", "a", "q", "", "It is that many rocks are here"),
            (13, "geo", "a", "q", "", "No Corresponding Information found"),
            (14, "geo", "a", "q", "", "\x1c 14 characters \t"),
            (15, "geo", "a", "q", "", "exactly 15 char"),
            (16, "geo", "a", "q", "", "x" * 2500),
            (17, "geo", "a", "q", "", "x" * 2501),
            (18, "geo", "a", "q", "", None),
            (19, "geo", "a", "q", "", " a\n\n\n\nb  c\t\td\te long text  "),
        ],
        SCHEMA,
    )


def test_filter_and_clean(spark):
    out = clean.filter_and_clean(rows(spark), ["row_id"]).orderBy("row_id").collect()
    # 7 has the same cleaned texts as 1: a null input cleans to an empty one
    assert [r["row_id"] for r in out] == [1, 9, 12, 15, 16, 19]
    by_id = {r["row_id"]: r for r in out}
    assert by_id[19]["output"] == "a\n\nb c d\te long text"
    assert by_id[9]["instruction"] == ""


def test_funnel_adds_up(spark):
    got = {r["rule"]: (r["removed"], r["remaining"]) for r in clean.funnel(rows(spark)).collect()}
    assert got["type"] == (2, 17)
    assert got["category"] == (2, 15)
    assert got["instruction"] == (1, 14)
    assert got["broken"] == (2, 12)
    assert got["placeholder"] == (1, 11)
    assert got["short"] == (2, 9)
    assert got["long"] == (1, 8)
    assert got["duplicate"] == (2, 6)


def test_rules_can_be_switched_off(spark):
    cfg = CleanConfig(
        drop_prefixes=(), instruction_pattern=None, broken_pattern=None, placeholder_pattern=None,
        max_output=0,
    )
    got = {r["row_id"] for r in clean.filter_and_clean(rows(spark), ["row_id"], cfg).collect()}
    assert got == {1, 8, 9, 10, 11, 12, 13, 15, 16, 17, 19}


def test_strip_agrees_with_python(spark):
    points = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000]
    texts = [(c, f"{chr(c)}x{chr(c)}") for c in points]
    df = spark.createDataFrame(texts, "c int, t string")
    got = df.select("c", T.strip(F.col("t")).alias("s"), T.is_blank(F.expr("substr(t, 1, 1)")).alias("b"))
    for r in got.collect():
        assert r["s"] == texts[points.index(r["c"])][1].strip(), hex(r["c"])
        assert r["b"] == (chr(r["c"]).strip() == ""), hex(r["c"])


def test_matches_folds_like_a_pattern(spark):
    df = spark.createDataFrame([("RELATED KPAPER",), ("related paper",), (None,)], "t string")
    got = [r[0] for r in df.select(T.matches(F.col("t"), "related paper")).collect()]
    assert got == [False, True, False]
    df = spark.createDataFrame([("poſİ",), ("POSI",), ("pos",)], "t string")
    plain = [r[0] for r in df.select(T.matches(F.col("t"), "pos")).collect()]
    pattern = [r[0] for r in df.select(T.matches(F.col("t"), "(?:pos)")).collect()]
    assert plain == pattern == [True, True, True]


def test_row_key_is_not_ambiguous(spark):
    df = spark.createDataFrame([(1, "a||b", "", "c"), (2, "a", "b", "c")],
                               "row_id long, instruction string, input string, output string")
    assert clean.dedup_rows(df, ["row_id"]).count() == 2


def test_first_rows_keeps_the_first_of_a_hot_group(spark, values):
    df = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50))
    want = {}
    for i in range(3000):
        want.setdefault(-1 if i % 3 == 0 else i % 50, i)
    for carry in (False, True):
        got = clean.first_rows(df, F.col("k").cast("string"), ["id"], carry)
        assert {r["k"]: r["id"] for r in got.collect()} == want


def test_null_meta(spark):
    df = spark.createDataFrame([(1, float("nan"), "a"), (2, 1.5, None)], "i int, v double, s string")
    got = clean.null_meta(df, ["v", "s"]).orderBy("i").collect()
    assert [(r["v"], r["s"]) for r in got] == [(None, "a"), (1.5, None)]


def test_profiles(spark):
    shares = {r["type"]: (r["n"], r["pct"]) for r in profile.value_shares(rows(spark), "type").collect()}
    assert shares[None] == (1, 100 / 19) and shares["self"] == (2, 200 / 19)
    top = profile.top_prefixes(rows(spark)).collect()
    assert [(r["prefix"], r["n"]) for r in top] == [("a", 15), ("gso", 2), ("", 1)]
    size = profile.length_summary(rows(spark)).first()
    assert (size["min_chars"], size["max_chars"], size["n_short"]) == (0, 2501, 1)
    assert profile.text_report(rows(spark)).count() == 5 + 3 + 5


def test_mark_blocks_leaves_cold_frames_alone(spark):
    from stratalog.operators.skew import mark_blocks

    df = spark.range(100).withColumn("k", F.col("id") % 7)
    assert mark_blocks(df, ["k"], ["id"], SkewConfig()) is df


def test_first_row_without_order(spark):
    """A row whose order column is null is a first row like any other."""
    df = spark.createDataFrame([(None, "a"), (1, "b"), (None, "c"), (2, "c"), (3, "b")], "n long, text string")
    got = sorted((r["n"] or 0, r["text"]) for r in clean.first_rows(df, F.col("text"), ["n"]).collect())
    assert got == [(0, "a"), (1, "b"), (2, "c")]
