from __future__ import annotations

import hashlib
import os
import random
from collections import Counter

import pytest

from stratalog.llm import queries
from stratalog.llm import suffix_dedup as S
from stratalog.llm.suffix_dedup import SuffixConfig

SF = "/root/testdata/sf0.01"


def brute(texts, length=200):
    """Every string of every text counted."""
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        spans, at = [], 0
        while (a := gone.find(1, at)) >= 0:
            b = gone.find(0, a)
            at = b if b >= 0 else len(gone)
            spans.append((a, at))
        left = bytes(c for c, g in zip(t, gone) if not g)
        out.append((len(t), sum(gone), spans, hashlib.sha256(left).hexdigest(), left))
    return out


def got(spark, texts, cfg, kind="string"):
    data = [(i, t, i, "k") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(data, f"doc_id long, text {kind}, spans long, s1 string").repartition(3)
    rows = {r["doc_id"]: r for r in S.without_repeats(docs, cfg=cfg).collect()}
    assert len(rows) == len(texts) and all(r["s1"] == "k" for r in rows.values())
    return [
        (r["n_bytes"], r["n_removed"], [tuple(s) for s in r["spans"]], r["kept_sha256"], bytes(r["kept"]))
        for r in (rows[i] for i in range(len(texts)))
    ]


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(2, 6))) for _ in range(n))


def test_planted_repeats(spark):
    rng = random.Random(3)
    base = [words(rng, rng.randint(20, 200)) for _ in range(12)]
    texts = list(base) + [base[0], base[0], base[1]]  # copies
    for _ in range(25):  # parts of other texts between own words, of all lengths around the limit
        a = rng.choice(base)
        i = rng.randrange(max(1, len(a) - 230))
        texts.append(words(rng, rng.randint(0, 30)) + a[i : i + rng.choice([150, 198, 199, 200, 201, 215, 400])] + words(rng, rng.randint(0, 30)))
    texts += [base[2][:300] + "x" + base[2][301:], words(rng, 40) * 3, "a" * 199, "b" * 200, "c" * 201, "d" * 500, "xy" * 160, None, "", "e"]
    texts += ["d" * 210]
    want = brute([(t or "").encode() for t in texts])
    assert got(spark, texts, SuffixConfig()) == want
    # long texts in pieces, few anchors held at once, and other sizes of nodes
    assert got(spark, texts, SuffixConfig(chunk=300, held=7, sizes=(151, 1))) == want


def test_many_variants_of_one_text(spark):
    rng = random.Random(4)
    base = words(rng, 150)
    texts = []
    for _ in range(60):
        t = list(base)
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(len(t))] = "#"
        texts.append("".join(t))
    assert got(spark, texts, SuffixConfig()) == brute([t.encode() for t in texts])


def test_short_strings_and_bytes(spark):
    rng = random.Random(5)
    texts = [bytes(rng.choices(range(3), k=rng.randint(0, 60))) + b"\xff" for _ in range(30)]
    cfg = SuffixConfig(length=12, gram=4, sizes=(8, 2, 1))
    assert got(spark, texts, cfg, "binary") == brute(texts, 12)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    out = S.without_repeats(docs, texts=False)
    assert out.collect() == [] and out.columns == ["doc_id", "n_bytes", "n_removed", "spans", "kept_sha256"]
    lone = spark.createDataFrame([(None,), ("a",)], "text string")
    assert [r["n_removed"] for r in S.without_repeats(lone).collect()] == [0, 0]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = brute([(d["text"] or "").encode() for d in docs])
    want = {d["doc_id"]: (w[0], w[1], len(w[2]), w[3]) for d, w in zip(docs, want, strict=True)}
    rows = queries.op12_suffix_dedup(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"]]
