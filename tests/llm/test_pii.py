from __future__ import annotations

import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stratalog.llm import pii as P

RULES = (
    ("email", re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
    ("ip", re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")),
    ("card", re.compile(r"[0-9]([\x20-]?[0-9])+")),
    ("phone", re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")),
)


def valid(kind, found):
    digits = [int(c) for c in found if "0" <= c <= "9"]
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        pairs = [d * 2 if i % 2 else d for i, d in enumerate(digits[::-1])]
        return 16 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in pairs) % 10 == 0
    return kind == "email" or 8 <= len(digits) <= 15


def plain(text):
    return [(k, *m.span()) for k, p in RULES for m in p.finditer(text) if valid(k, m.group())]


@settings(max_examples=400, deadline=None)
@given(st.text("ab@.-+ ()0129éé", max_size=60))
def test_seed_spans_equal_the_plain_patterns(text):
    assert P.seed_spans(text) == plain(text)


def test_known_entities():
    for text in (
        "a@b.c@d.e x@y", "1.2.3.4.5.6.7.8", "001.002.003.0255", "9999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112",
        "+1 (017) 555-7713 +1(((", "+12345678901234567", "a@b@c.dd", "é@x.y", "x" * 300 + "@mail.example.com", "1." * 5_000, "0" * 100_000,
    ):
        assert P.seed_spans(text) == plain(text)
    assert [k for k, _, _ in P.seed_spans("mail a@b.cd, 10.0.0.1, 4111 1111 1111 1111 or +1 (017) 555-7713")] == list(P.KINDS)


WORD = re.compile(r"[^\W_]+")
STRING = re.compile(r"[^\s\"'<>()\[\]{},;:|=]+")


def plain_context(text, start, n):
    before = [m.group().lower() for m in WORD.finditer(text) if m.end() <= start]
    return " ".join(before[-n:])


@settings(max_examples=400, deadline=None)
@given(st.text("abZ@.-+ (0129é_", max_size=80), st.integers(1, 3), st.sampled_from([0, 3, 200]))
def test_edges_equal_the_plain_way(text, n, look):
    """Words before a place however far back, and candidates of any length."""
    was, P._LOOK = P._LOOK, look
    try:
        seeds = P.seed_spans(text)
        edges = P.graph_edges(text, seeds, P.PiiConfig(context_words=n))
    finally:
        P._LOOK = was
    for kind, pattern, entity, a, b in edges:
        assert (pattern, entity) == (plain_context(text, a, n), text[a:b].lower())
    assert [(k, a, b) for k, _, _, a, b in edges if k] == seeds
    taken = [(a, b) for _, a, b in seeds]
    open_ = []
    for m in STRING.finditer(text):
        a, b = m.start(), m.start() + len(m.group().rstrip(".!?-"))
        if re.search("[0-9@]", m.group()) and not any(x < b and a < y for x, y in taken):
            open_.append((a, b))
    assert [(a, b) for k, _, _, a, b in edges if not k] == open_


def test_long_strings_and_far_words():
    """Two long strings with one beginning are two; words count however far before a place."""
    cfg = P.PiiConfig()
    x, y = ("7" * 5_000 + c for c in "ab")
    edges = P.graph_edges(f"mail to {x} {' ' * 10_000}{y}", [], cfg)
    assert edges[0][1] == "mail to" and edges[0][2] != edges[1][2] and len(edges[0][2]) == 65
    assert P.graph_edges("mail to" + " ." * 50_000 + " q@", [], cfg)[0][1] == "mail to"
    for text in ("@ " * 200_000, "a" * 1_000_000, "w" * 500_000 + " @" * 100_000, "b4111111111111111" * 30_000):
        P.graph_edges(text, P.seed_spans(text), cfg)


def plain_scores(edges, cfg):
    """The same rounds over dictionaries."""
    pairs = {(k, p, e) for k, p, e in edges if p}
    seeds = {}
    for k, p, e in pairs:
        if k:
            seeds.setdefault((k, p), set()).add(e)
    good = {kp for kp, es in seeds.items() if len(es) >= cfg.min_seeds}
    links = [(k, p, e, float(own == k), own is None) for k, p in good for own, q, e in pairs if q == p]
    strings = {}
    for k, _, e, seed, _ in links:
        strings[k, e] = max(strings.get((k, e), 0.0), seed)
    own = dict(strings)
    patterns = {}
    for _ in range(cfg.rounds):
        said = {}
        for k, p, e, _, _ in links:
            said.setdefault((k, p), []).append(strings[k, e])
        patterns = {kp: sum(v) / (len(v) + cfg.doubt) for kp, v in said.items()}
        missed = {}
        for k, p, e, _, _ in links:
            missed[k, e] = missed.get((k, e), 1.0) * (1 - min(patterns[k, p], 0.999))
        strings = {ke: max(own[ke], 1 - m) for ke, m in missed.items()}
    return patterns, strings


def test_graph_scores_equal_plain_rounds(spark):
    draw, cfg = random.Random(7), P.PiiConfig(min_seeds=2)
    edges = []
    for _ in range(400):
        kind = draw.choice(["email", "phone", None, None])
        edges.append((kind, draw.choice(["", "p1", "p2", "p3", "p4", "p5"]), f"{kind or ''}{draw.randrange(25)}"))
    patterns, strings = P.scored_graph(spark.createDataFrame(edges, "kind string, pattern string, entity string"), cfg)
    want_patterns, want_strings = plain_scores(edges, cfg)
    got = {(r["kind"], r["pattern"]): r["score"] for r in patterns.collect()}
    assert got == {k: pytest.approx(v) for k, v in want_patterns.items()} and got
    got = {(r["kind"], r["entity"]): r["score"] for r in strings.collect()}
    assert got == {k: pytest.approx(v) for k, v in want_strings.items()} and got


def test_patterns_find_unseen_identifiers(spark):
    data = [(i, f"please mail to u{i}@mail.example.com now and then 9{i}12345", "x") for i in range(30)]
    data += [(100, "please mail to someone7@intranet now", "x"), (101, "then 7712345", "x"), (102, None, None), (102, "", "x")]
    data += [(103, "please mail to someone7@intranet now", "x")] * 2 + [(None, "go " * 100_000 + "mail to other88@intranet", "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, digest string")
    rows = P.personal_data(docs).collect()
    assert len(rows) == len(data)
    extra = {r["doc_id"]: [tuple(s) for s in r["extra"]] for r in rows}
    assert extra[100] == extra[103] == [("email", 15, 32)]
    assert extra[None] == [("email", 300_008, 300_024)]
    assert all(not extra[i] for i in (0, 5, 101, 102))
    for r in rows:
        text = next(t for i, t, _ in data if i == r["doc_id"]) or ""
        assert [tuple(s) for s in r["base"]] == plain(text)
    assert P.personal_data(docs.limit(0)).count() == 0
