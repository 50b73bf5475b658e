from __future__ import annotations

import re

import pytest

from stratalog.llm import decontam as D
from stratalog.llm.decontam import DecontamConfig

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items, size=13):
    words, hit, ids = split(text), set(), set()
    for name, item in items:
        said = split(item)
        for w in [said] if 0 < len(said) < size else [said[i : i + size] for i in range(len(said) - size + 1)]:
            for i in range(len(words) - len(w) + 1):
                if w and words[i : i + len(w)] == w:
                    hit |= set(range(i, i + len(w)))
                    if name is not None:
                        ids.add(str(name))
    return len(words), len(hit), sorted(ids), bool(hit) and 20 * len(hit) >= len(words)


def spans_of(text, items, size=13):
    """Runs of hit words as offsets, from the plain places of all windows."""
    words, hit = split(text), set()
    for _, item in items:
        said = split(item)
        for w in [said] if 0 < len(said) < size else [said[i : i + size] for i in range(len(said) - size + 1)]:
            hit |= {j for i in range(len(words) - len(w) + 1) if w and words[i : i + len(w)] == w for j in range(i, i + len(w))}
    at, runs = [m.span() for m in WORD.finditer((text or "").translate(LOWER))], []
    for j in sorted(hit):
        if runs and runs[-1][1] == j:
            runs[-1][1] = j + 1
        else:
            runs.append([j, j + 1])
    return [(at[a][0], at[b - 1][1]) for a, b in runs]


LONG = " ".join(f"w{i}" for i in range(30))
ITEMS = [(1, LONG), (2, "Kürz, OK"), (3, ""), (4, None), (5, LONG[4:]), (None, "lone Item"), (1, LONG), (10, " ".join(["a"] * 15))]
DOCS = [
    (1, LONG.upper(), "x"), (2, "pre " * 300 + LONG[10:70] + " post" * 200, "x"), (3, None, None), (4, "", "x"),
    (5, "kürz-ok! KÜRZ ok kürz...ok", "x"), (6, " ".join(["A"] * 40), "x"), (7, "say: lone item", "x"), (None, "nothing here", "x"),
    (8, "a b " * 50_000 + LONG, "x"), (8, "a b " * 50_000 + LONG, "x"), (9, " ".join(["a"] * 12), "x"),
]


@pytest.mark.parametrize("part", [200_000, 10])
def test_hits_equal_brute_force(spark, part):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, spans string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = D.checked(docs, bench, DecontamConfig(part_words=part))
    assert got.columns == ["doc_id", "text", "n_words", "n_hit", "items", "spans", "contaminated"]
    rows = got.collect()
    assert len(rows) == len(DOCS)
    for r in rows:
        assert (r["n_words"], r["n_hit"], r["items"], r["contaminated"]) == brute(r["text"], ITEMS), r["doc_id"]
        covered = sum(len(split(r["text"][s["start"] : s["end"]])) for s in r["spans"])
        assert covered == r["n_hit"]
        assert [(a["start"], a["end"]) for a in r["spans"]] == spans_of(r["text"], ITEMS), r["doc_id"]


def test_adjacent_windows_give_one_span_in_parts_too(spark):
    one, two = (" ".join(f"{c}{i}" for i in range(13)) for c in "ab")
    docs = spark.createDataFrame([(1, f"x {one} {two} y")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, one), (2, two)], "item_id long, text string")
    got = {p: D.checked(docs, bench, DecontamConfig(part_words=p)).first().asDict() for p in (200_000, 10)}
    assert got[200_000] == got[10] and len(got[10]["spans"]) == 1 and got[10]["items"] == ["1", "2"]


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string, spans string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert not any(r["contaminated"] for r in D.checked(docs, bench.limit(0)).collect())
    assert D.checked(docs.limit(0), bench).count() == 0
