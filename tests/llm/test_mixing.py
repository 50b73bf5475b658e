from __future__ import annotations

import re
from collections import defaultdict

import pytest

from stratalog.llm import mixing
from stratalog.llm.mixing import MixConfig

SCHEMA = "doc_id long, text string, source string, sid string, copies int"


def targets(sizes, weights=(5, 2, 1), most=3):
    """Reshare the excess over the sources that are not full, again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    got = dict.fromkeys(names, 0.0)
    rest, free = float(sum(sizes.values())), set(names)
    while rest > 1e-9 and free:
        total = sum(weight[s] for s in free)
        for s in list(free):
            got[s] += rest * weight[s] / total
        rest = 0.0
        for s in list(free):
            if got[s] >= most * sizes[s]:
                rest += got[s] - most * sizes[s]
                got[s] = most * sizes[s]
                free.discard(s)
    return got


def rows(n):
    out = []
    for i in range(n):
        source = [None, "b", "é", "a", "z"][min(4, i % 17)]
        out.append((i, " ".join(["w"] * (1 + i * 7 % 53)), source, "x", 1))
    return out


def test_targets_equal_repeated_resharing(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 1, None: 50}, {"a": 0, "b": 0}, {"x": 5}, {str(i): i * i for i in range(20)}):
        frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
        want = targets(sizes)
        assert got.keys() == want.keys()
        assert all(got[s] == pytest.approx(want[s], abs=1e-6) for s in want)


@pytest.mark.parametrize("block", [50, 10_000])
def test_totals_come_near_their_targets(spark, block):
    docs = spark.createDataFrame(rows(1_500), SCHEMA)
    got = mixing.mix_table(docs, MixConfig(block_rows=block)).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(1_500))
    taken, copies, target, n = defaultdict(int), defaultdict(int), {}, defaultdict(int)
    for r in got:
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        copies[r["source"]] += r["copies"]
        n[r["source"]] += 1
        target[r["source"]] = (r["target"], r["source_size"])
    for s, (want, size) in target.items():
        assert abs(taken[s] - want) <= 60
        assert abs(copies[s] - n[s] * want / size) <= 3


def test_a_few_huge_documents_do_not_spoil_the_total(spark):
    data = [(i, "w " * (9_000 if i in (3, 44) else 1 + i % 90), "ab"[i % 2], "x", 1) for i in range(600)]
    got = mixing.mix_table(spark.createDataFrame(data, SCHEMA), MixConfig(weights=(3, 2))).collect()
    for s in "ab":
        own = [r for r in got if r["source"] == s]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 0.01 * own[0]["source_size"]
        assert max(r["copies"] for r in own) <= 3


def test_same_result_however_rows_lie(spark):
    docs = spark.createDataFrame(rows(900), SCHEMA)
    cfg = MixConfig(block_rows=100)
    one = sorted(map(tuple, mixing.mix_table(docs, cfg).collect()), key=str)
    two = sorted(map(tuple, mixing.mix_table(docs.repartition(7, "text"), cfg).collect()), key=str)
    assert one == two


def test_flight_keeps_totals():
    import random

    rng = random.Random(1)
    for _ in range(200):
        units = [[rng.uniform(0.1, 0.9), rng.choice([0, 3, 3, 8, 100])] for _ in range(3)]
        number, words = sum(u[0] for u in units), sum(u[0] * u[1] for u in units)
        mixing._moved(*units, rng.random())
        assert sum(u[0] for u in units) == pytest.approx(number)
        assert sum(u[0] * u[1] for u in units) == pytest.approx(words)
        assert any(u[0] in (0.0, 1.0) for u in units)


def test_hard_rows(spark):
    data = [(None, None, None, "s", 9), (None, None, None, "s", 9), (2**60 + 1, "", "a", "s", 9)]
    data += [(5, "one two", "a", "s", 9)] * 7 + [(6, "word " * 50_000, "b", "s", 9), (None, "x y", None, None, None)]
    docs = spark.createDataFrame(data, SCHEMA)
    got = mixing.mix_table(docs).collect()
    assert len(got) == len(data)
    assert {r["doc_id"] for r in got} == {None, 2**60 + 1, 5, 6}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    taken = defaultdict(int)
    for r in out.collect():
        taken[r["doc_id"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    want = defaultdict(int)
    for r in got:
        want[r["doc_id"]] += r["taken"]
    assert {k: v for k, v in taken.items() if v} == {k: v for k, v in want.items() if v}
    assert mixing.mix_table(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.limit(0)).count() == 0
