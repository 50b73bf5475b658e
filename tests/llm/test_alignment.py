from __future__ import annotations

import hashlib
import os
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratalog.llm import alignment as A
from stratalog.llm.alignment import AlignConfig, Aligner, Postings

CFG = AlignConfig()
pytestmark = pytest.mark.skipif(not os.path.exists(CFG.byte_level), reason="no vocabularies here")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def both():
    """Both libraries by the book: the JSON file as it is, pieces by their text."""
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(CFG.byte_level)
    one.encode_special_tokens = True
    return one, sentencepiece.SentencePieceProcessor(model_file=CFG.pieces)


def plain_tokens(text, both):
    one, two = both
    if not text:
        return None
    letters = A.byte_alphabet()
    a = [(i, bytes(letters[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in two.encode(text):
        p = two.id_to_piece(i)
        b.append((i, bytes([int(p[3:5], 16)]) if two.is_byte(i) else p.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else None


def spans(tokens):
    at = 0
    for i, t in tokens:
        yield i, at, at + len(t)
        at += len(t)


def brute(texts, both):
    """Every pair of tokens of a text compared by its byte ranges."""
    docs, counts = [], Counter()
    for text in texts:
        tokens = plain_tokens(text, both)
        if tokens is None:
            docs.append(None)
            continue
        a, b = list(spans(tokens[0])), list(spans(tokens[1]))
        links = [(i, j) for i, s, e in a for j, t, f in b if max(s, t) < min(e, f)]
        counts.update(set(links))
        common = sorted({e for _, _, e in a} & {f for _, _, f in b})
        groups, low = [], 0
        for c in common:
            groups.append(",".join(str(i) for i, s, e in a if low <= s and e <= c) + "|" + ",".join(str(j) for j, t, f in b if low <= t and f <= c))
            low = c
        docs.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    top = defaultdict(int)
    for (i, _), n in counts.items():
        top[i] = max(top[i], n)
    out = []
    for d in docs:
        if d is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
        else:
            best = sum(counts[i, j] == top[i] for i, j in d[3])
            out.append((d[0], d[1], d[2], len(d[3]), best, sum(counts[p] for p in d[3]), d[4]))
    return out


TEXTS = [
    "plain words of one text", "plain words of one text", "plain words of another  text\n\twith tabs", None, "", " ", "\n",
    "<|endoftext|> and </s> <s> <unk> are words here", "a▁b is not given back", "▁", "Grüße, 你好, Здравствуйте \U0001f600\U0001f468‍\U0001f469",
    "the the the the the cat sat on the the mat", "x" * 500, "   lead", "trail   ", " 　 odd spaces", "a\x00b",
]


@pytest.mark.parametrize("cfg", [{}, {"block_docs": 3}, {"block_entries": 5, "chunk_bytes": 40}])
def test_equal_to_brute_force(spark, both, cfg):
    data = [(i, t, i * 10, "mine", 1.0) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_a long, row string, block double").coalesce(2)
    found = {r["doc_id"]: r for r in A.alignments(docs, AlignConfig(**cfg)).collect()}
    want = brute(TEXTS, both)
    for i, w in enumerate(want):
        assert tuple(found[i][c] for c in COLUMNS) == w, TEXTS[i]
    assert found[0]["row"] == "mine" and found[0]["block"] == 1.0
    assert [i for i, t in enumerate(TEXTS) if want[i][0] == 0] == [3, 4, 8, 9]


def test_pair_counts(spark, both):
    docs = spark.createDataFrame([(t,) for t in TEXTS], "text string")
    links = defaultdict(Counter)
    for k, t in enumerate(TEXTS):
        tokens = plain_tokens(t, both)
        if tokens:
            for i, s, e in spans(tokens[0]):
                for j, u, f in spans(tokens[1]):
                    if max(s, u) < min(e, f):
                        links[i, j][k] += 1
    for cfg in (AlignConfig(), AlignConfig(block_docs=2)):
        got = {(r["a"], r["b"]): (r["count"], r["links"]) for r in A.pair_counts(A.aligned_blocks(docs, cfg)).collect()}
        assert got == {p: (len(c), sum(c.values())) for p, c in links.items()}


def test_only_the_blocks_are_written_out(spark, monkeypatch):
    written, kept = [], A.kept
    monkeypatch.setattr(A, "kept", lambda df, name: written.append(name) or kept(df, name))
    docs = spark.createDataFrame([(1, "same"), (2, "same words")], "doc_id long, text string")
    assert A.alignments(docs).count() == 2
    assert written == ["alignment"]


def test_empty_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "same")] * 3 + [(None, "same")], "doc_id long, text string")
    assert A.alignments(docs.limit(0)).collect() == []
    rows = A.alignments(docs).collect()
    assert len(rows) == 4 and len({r["count_sum"] for r in rows}) == 1 and rows[0]["count_sum"] == 4 * rows[0]["n_links"]


def test_bytes_that_are_no_text(spark):
    docs = spark.createDataFrame([(1, bytearray(b"ab\xff"))], "doc_id long, text binary")
    row = A.alignments(docs).first()
    assert row["n_a"] == 0 and row["groups_sha256"] == ""


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 300), st.integers(1, 9)), min_size=1, max_size=400))
def test_postings_give_back_their_entries(entries):
    entries = sorted({(p, d): t for p, d, t in entries}.items())
    pair, doc = (np.array([e[0][k] for e in entries]) for k in (0, 1))
    times = np.array([e[1] for e in entries])
    p = Postings.of(pair, doc, times)
    own, got_doc, got_times = p.entries()
    assert (p.pair[own] == pair).all() and (got_doc == doc).all() and (got_times == times).all()
    assert p.n_links.sum() == times.sum()


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_ids_are_those_of_the_libraries(text):
    import sentencepiece
    from tokenizers import Tokenizer

    cache = test_ids_are_those_of_the_libraries.__dict__
    if "made" not in cache:
        one = Tokenizer.from_file(CFG.byte_level)
        one.encode_special_tokens = True
        with open(CFG.byte_level, "rb") as f, open(CFG.pieces, "rb") as g:
            cache["made"] = one, sentencepiece.SentencePieceProcessor(model_file=CFG.pieces), Aligner(f.read(), g.read())
    one, two, aligner = cache["made"]
    assert aligner.encode_a(" " + text).tolist() == one.encode(" " + text, add_special_tokens=False).ids
    assert aligner.encode_b(text).tolist() == two.encode(text)
