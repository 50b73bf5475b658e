from __future__ import annotations

import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalog.llm import toxicity as T
from stratalog.llm.common import bucket_of

SF = "/root/testdata/sf0.1"


def test_index_finds_the_exact_nearest():
    rng = random.Random(2)
    idf = np.array([rng.uniform(0.5, 6) for _ in range(40)])

    def vector():
        places = sorted(rng.sample(range(40), rng.randint(1, 6)))
        return places, [rng.randint(1, 4) for _ in places]

    vectors = [vector() for _ in range(500)]
    index = T.BlockMaxIndex.build(list(range(500)), [i % 2 for i in range(500)], [1.0] * 500, vectors, idf, 16)
    dense = np.zeros((500, 40))
    for at, place in enumerate(index.ids):
        p, v = T.unit(vectors[place], idf)
        dense[at, p] = v
    for _ in range(100):
        p, v = T.unit(vector(), idf)
        query = np.zeros(40)
        query[p] = v
        cosine = dense @ query
        order = [i for i in np.lexsort((np.arange(500), -np.round(cosine, 12))) if cosine[i] > 0][:7]
        at, got = index.nearest((p, v), 7)
        assert at.tolist() == order and np.allclose(got, cosine[order])


def test_words_are_runs_of_letters():
    rng = random.Random(3)
    odd = [None, "", "Two_words and3more\x1cI'm", "GRÜSSE İstanbul ẞ x²y", "".join(map(chr, range(128)))]
    odd += ["".join(chr(rng.randrange(of)) for _ in range(300)) for of in (128, 600, 0x3000) for _ in range(20)]
    for text in odd:
        assert T.words_of(text) == T.WORD.findall((text or "").lower())


def test_calibration_rises_and_follows_outcomes():
    votes = [(0.05, 0, 1.0)] * 90 + [(0.05, 1, 1.0)] * 10 + [(0.95, 1, 1.0)] * 50 + [(0.5, 1, 1.0), (0.6, 0, 1.0)]
    edges, rates = T._calibrated(votes, 10)
    assert (np.diff(rates) >= 0).all() and abs(rates[0] - 0.1) < 0.02 and rates[-1] > 0.9 and len(edges) == len(rates)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    held = F.coalesce(bucket_of(F.col("doc_id"), 5) == 0, F.lit(False))
    got = T.toxicity_scores(docs, labels, ~held)
    rows = got.join(labels, "doc_id").where(held).select("toxic", "score", "predicted").collect()
    toxic = [r for r in rows if r["toxic"]]
    assert sum(r["predicted"] for r in toxic) >= 0.9 * len(toxic)  # one toxic document in 25 has no word that tells it
    assert sum(r["predicted"] == r["toxic"] for r in rows) >= 0.98 * len(rows)


def test_hard_rows(spark):
    texts = [(i, f"fine words number{i} here " * 3 + ("vileword you " if i % 4 == 0 else ""), "x") for i in range(200)]
    texts += [(1_000, None, None), (1_001, "", "x"), (None, "vileword", "x"), (1_002, "go " * 100_000 + "Vileword!", "x"), (2_000, "vileword", "x"), (2_000, "vileword", "x")]
    docs = spark.createDataFrame(texts, "doc_id long, text string, label string")
    marks = [(i, int(i % 4 == 0)) for i in range(200)] + [(None, 1), (3, None), (5, 0), (9_999, 1), (1_001, 0)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    rows = T.toxicity_scores(docs, labels, F.lit(True)).collect()
    assert len(rows) == len(texts)
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert all(0 < e["cosine"] <= 1 + 1e-9 for e in r["evidence"])
    assert by[None][0]["predicted"] == by[1_002][0]["predicted"] == 1 and by[1_002][0]["evidence"]
    assert [r["predicted"] for r in by[2_000]] == [1, 1] and by[7][0]["predicted"] == 0
    assert by[1_000][0]["predicted"] == by[1_001][0]["predicted"] == 0
    assert {r["score"] for r in T.toxicity_scores(docs, labels.limit(0), F.lit(True)).collect()} == {0.0}
    assert T.toxicity_scores(docs.limit(0), labels, F.lit(True)).count() == 0


def test_no_term_is_dropped(spark):
    """More telling words than any cap, each too seldom to pass a test of its own, and clean ones."""
    rng = random.Random(4)
    draw = lambda of: "".join(rng.choice("bcdfghklmnprst") + rng.choice("aeiou") for _ in range(of))
    toxic, clean = ([draw(5) for _ in range(600)] for _ in range(2))
    texts = [(i, " ".join(rng.sample(toxic if i % 2 else clean, 20))) for i in range(1_000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1_000)], "doc_id long, toxic int")
    rows = T.toxicity_scores(docs, labels, F.col("doc_id") < 800).where("doc_id >= 800").collect()
    assert len(rows) == 200 and all(r["predicted"] == r["doc_id"] % 2 and r["evidence"] for r in rows)


def test_blocks_that_cannot_win_stay_closed():
    """Examples of twenty topics; a text of one topic opens few blocks and misses nothing."""
    rng = random.Random(9)
    idf = np.ones(400)
    vectors = [(sorted(rng.sample(range(20 * (i % 20), 20 * (i % 20) + 20), 10)), [1] * 10) for i in range(2_000)]
    index = T.BlockMaxIndex.build(list(range(2_000)), [0] * 2_000, [1.0] * 2_000, vectors, idf, 20, seldom=40)
    dense = np.zeros((2_000, 400))
    for at, place in enumerate(index.ids):
        dense[at, vectors[place][0]] = T.unit(vectors[place], idf)[1]
    queries = [T.unit(v, idf) for v in vectors[:40]]
    for (p, v), (at, got, _) in zip(queries, index.search(queries, 5), strict=True):
        cosine = dense[:, p] @ v
        order = np.lexsort((np.arange(2_000), -np.round(cosine, 12)))[:5]
        assert at.tolist() == order.tolist() and np.allclose(got, cosine[order])
    assert index.opened < 0.15 * index.asked * len(index.common)


def test_evidence_is_the_brute_force_of_texts(spark):
    """Ids and cosines against TF-IDF vectors made anew from texts and labels."""
    rng = random.Random(5)
    words = [f"{rng.choice('abcdefgh')}{'xyzw'[i % 4]}ord{'abcdefghij'[i % 10] * (i % 7 + 1)}" for i in range(80)]
    texts = {i: " ".join(rng.choices(words, k=rng.randint(3, 12)) + ["vile"] * (i % 3 == 0)) for i in range(150)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(100)], "doc_id long, toxic int")
    cfg = T.ToxicityConfig(neighbours=6, block=4)
    rows = T.toxicity_scores(docs, labels, F.lit(True), cfg).collect()
    half = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(2)) == 0
    fit = [r["doc_id"] for r in labels.where(half).select("doc_id").collect()]

    def counts(text):
        out = {}
        for w in text.split():
            for t in [w] + [w[:n] + "*" for n in (4, 5, 6, 7) if len(w) > n]:
                out[t] = out.get(t, 0) + 1
        return out

    vectors = {i: counts(t) for i, t in texts.items()}
    clean = [i for i in fit if i % 3]
    known = {t for i in fit for t in vectors[i]}
    idf = {t: np.log((1 + len(clean)) / (1 + sum(t in vectors[i] for i in clean))) + 0.1 for t in known}

    def scaled(i):
        out = {t: (1 + np.log(n)) * idf[t] for t, n in vectors[i].items() if t in known}
        norm = np.sqrt(sum(v * v for v in out.values())) or 1.0
        return {t: v / norm for t, v in out.items()}

    examples = {i: scaled(i) for i in fit}
    assert len(rows) == 150
    for r in rows:
        mine = scaled(r["doc_id"])
        cosine = {i: sum(v * one.get(t, 0.0) for t, v in mine.items()) for i, one in examples.items()}
        best = sorted((c for c in cosine.values() if c > 0), reverse=True)[:6]
        assert np.allclose([e["cosine"] for e in r["evidence"]], best)
        assert all(abs(cosine[e["doc_id"]] - e["cosine"]) < 1e-9 for e in r["evidence"])


def test_copies_of_an_id_count_once_in_the_sample(spark):
    texts = [(i, "vile talk" if i % 2 else "kind talk") for i in range(60)] + [(1, "vile talk")] * 3_000
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("label", F.lit("other"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    rows = T.toxicity_scores(docs, labels, F.lit(True)).collect()
    assert len(rows) == 3_060 and all(r["predicted"] == r["doc_id"] % 2 for r in rows)


def test_votes_count_telling_terms_and_little_work():
    """Votes against sums over all shared terms made anew; common postings are not gathered one by one."""
    rng = random.Random(6)
    idf = np.array([rng.uniform(0.5, 6) for _ in range(60)])
    telling = np.array([rng.uniform(0.1, 9) for _ in range(60)])
    vectors = [(sorted(rng.sample(range(6), 3)) + sorted(rng.sample(range(6, 60), rng.randint(1, 4))), None) for _ in range(300)]
    vectors = [(places, [rng.randint(1, 4) for _ in places]) for places, _ in vectors]
    labels, weights = [i % 3 == 0 for i in range(300)], [1.0 + i % 2 for i in range(300)]
    index = T.BlockMaxIndex.build(list(range(300)), np.array(labels, dtype=int), weights, vectors, idf, 16, telling)
    dense = np.zeros((300, 60))
    for i, v in enumerate(vectors):
        dense[i, v[0]] = T.unit(v, idf)[1]
    queries = [T.unit(v, idf) for v in vectors[:50]]
    for (p, v), (share, ids, cosine) in zip(queries, index.votes(queries, 9), strict=True):
        close = dense[ids][:, p] @ (v * telling[p]) * np.array(weights)[ids]
        assert np.isclose(share, (close * np.array(labels)[ids]).sum() / close.sum())
        assert np.allclose(cosine, dense[ids][:, p] @ v)
    assert index.common.flags["C_CONTIGUOUS"] and index.common.shape[1] == 16  # by example: its common terms lie together


def test_rows_of_postings_are_as_narrow_as_their_number_allows():
    vectors = [([i % 50], [1]) for i in range(300)]
    index = T.BlockMaxIndex.build(list(range(300)), [0] * 300, [1.0] * 300, vectors, np.ones(50), 16)
    assert index.rows.dtype == np.uint16 and len(index.rows) == 300
    assert len(index.nearest((np.array([7]), np.array([1.0])), 9)[0]) == 6
