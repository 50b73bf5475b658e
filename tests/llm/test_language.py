from __future__ import annotations

import os
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalog.llm import language as L
from stratalog.llm.common import bucket_of

SF = "/root/testdata/sf0.01"


def naive(text, known, size):
    """Longest matches found by substring search; a character past a match belongs to its phrase
    only if it is unknown."""
    n = 0
    for start in range(0, len(text), size):
        part, i = text[start : start + size], 0
        n += 1
        phrase = ""
        for c in part:
            if phrase + c in known:
                phrase += c
                continue
            n += 1
            phrase = c if c in known else ""
    return n


def test_phrases_are_longest_matches():
    rng = np.random.default_rng(3)
    draw = lambda n, of: "".join(rng.choice(list(of), n))
    samples = {"x": [draw(300, "abc ")], "y": [draw(400, "bcd ")]}
    model = L.fitted(samples)
    texts = [draw(n, "abcd zq") for n in (1, 5, 63, 64, 65, 500)]
    got, lengths = L.phrase_counts(texts, model, 64)
    assert lengths.tolist() == [len(t) for t in texts]
    unknown = {c: "#" for c in "zq"}
    for k, name in enumerate(model.languages):
        for i, t in enumerate(texts):
            plain = "".join(unknown.get(c, c) for c in t)
            assert got[i, k] == naive(plain, samples[name][0], 64), (name, t)


def test_many_scripts():
    """Letters of every script stay apart, however many more frequent ones there are."""
    rng = np.random.default_rng(5)

    def words(first, letters, n):
        return " ".join("".join(chr(first + c) for c in rng.integers(0, letters, size)) for size in rng.integers(2, 7, n))

    common = {"el": (0x3B1, 17), "en": (0x61, 26), "ru": (0x430, 32)}
    rare = {"ja": (0x3042, 40), "ka": (0x10D0, 33), "th": (0xE01, 40), "zh": (0x4E00, 3_000), "zz": (0x20000, 3_000)}
    samples = {name: [words(*of, 4_000)] for name, of in common.items()} | {name: [words(*of, 600)] for name, of in rare.items()}
    model = L.fitted(samples)
    texts = {name: words(*of, 80) for name, of in (common | rare).items()}
    got = L._predictions(list(texts.values()), model, 512)
    assert [g[0] for g in got] == list(texts)
    counts, _ = L.phrase_counts(list(texts.values()), model, 512)
    for k, name in enumerate(model.languages):
        known = "".join(c if c.isalpha() else " " for c in samples[name][0])
        assert counts[:, k].tolist() == [naive(t, known, 512) for t in texts.values()]


def test_states_with_many_edges_find_a_place():
    codes = np.random.default_rng(7).integers(0, 250, 20_000).tolist()
    table = L.parse_table(codes, 250)
    assert len(table.edges) < 40 * len(codes)
    state = table.root
    for code in codes[5_000:6_000]:
        edge = int(table.edges[state + code])
        assert edge >> 32 == state
        state = edge & 0xFFFFFFFF


def test_a_language_keeps_its_sample_whatever_the_others():
    text = "".join(np.random.default_rng(6).choice(list("abcdefgh "), 20_000))
    alone = L.fitted({"a": [text]})
    among = L.fitted({"a": [text]} | {f"b{i}": ["xyz"] for i in range(9)})
    for model in (alone, among):
        assert L.phrase_counts([text[-512:]], model, 512)[0][0, 0] == 1


def test_automaton_knows_exactly_the_factors():
    text = [1, 2, 1, 1, 2, 3, 1, 2, 1]
    moves = L.suffix_automaton(text)
    factors = {tuple(text[i:j]) for i in range(len(text)) for j in range(i, len(text) + 1)}

    def walk(state, said):
        yield said
        for c, to in moves[state].items():
            yield from walk(to, (*said, c))

    assert set(walk(0, ())) == factors


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = bucket_of(F.col("doc_id"), 4) == 2
    got = L.identified(docs, ~held).where(held & F.col("lang").isNotNull()).select("lang", "lang_pred").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in got) >= 0.97 * len(got)


def test_hard_rows(spark):
    data = [(i, w * 40, lang, 1) for i, (w, lang) in enumerate([("the of and ", "en"), ("der die und ", "de")] * 3)]
    data += [(50, None, "en", 1), (51, "", None, 1), (None, "the and of " * 30_000, None, None), (52, "12 34", "de", 1)]
    data += [(53, "the of", None, 1)] * 2
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, score int")
    got = L.identified(docs, F.lit(True))
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    rows = got.collect()
    assert len(rows) == len(data)
    by = Counter((r["doc_id"], r["lang_pred"]) for r in rows)
    assert by[None, "en"] == 1 and by[53, "en"] == 2 and by[50, "und"] == by[51, "und"] == by[52, "und"] == 1
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {r["lang_pred"] for r in L.identified(docs, F.lit(False)).collect()} == {"und"}
    assert L.identified(docs.limit(0), F.lit(True)).count() == 0


def test_texts_without_letters_take_no_place(spark):
    """Thousands of null, empty and letterless texts before a few real ones of a language."""
    data = [(i, [None, "", "12 34 !"][i % 3], "fr") for i in range(3_000)]
    data += [(5_000 + i, "le chat et la souris dans la maison " * 9, "fr") for i in range(5)]
    data += [(6_000 + i, "the cat and the mouse in the house " * 9, "en") for i in range(5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string")
    assert L.learn(docs, F.lit(True)).languages == ["en", "fr"]
    got = {r["doc_id"]: r["lang_pred"] for r in L.identified(docs, F.lit(True)).where("doc_id >= 5000").collect()}
    assert all(p == ("fr" if i < 6_000 else "en") for i, p in got.items())


def test_samples_come_from_the_whole_text(spark):
    """What only the end of a long text shows is learned, within the same number of characters."""
    docs = spark.createDataFrame([(1, "a" * 50_000 + "xyz" * 400, "one"), (2, "b" * 99, "two")], "doc_id long, text string, lang string")
    model = L.learn(docs, F.lit(True))
    counts, _ = L.phrase_counts(["xyzxyzxyz"], model, 512)
    assert counts[0].tolist()[0] == 1 < counts[0].tolist()[1]
