"""Personal data by bootstrapped contextual extraction.

Entities that the seed rules find (mail addresses, network addresses, card and phone numbers) induce
patterns: the two words before them. Every other identifier-like string is a candidate, and patterns
and strings form a graph. Spark scores it in rounds: a pattern is as good as the strings it comes
with, a string as good as the patterns it is seen in, seeds being certain. Strings that high-scoring
patterns point to become new spans of the pattern's kind.

The texts are read once; seed spans and graph are tables from then on.
"""

from __future__ import annotations

import hashlib
import re
from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import join_spread, kept, text_or_empty

#: fixed values: the kinds of the seed rules, in the order in which spans are listed
KINDS = ("email", "ip", "card", "phone")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
#: from the beginning of a string only, so that a long one without a digit is read once
_CANDIDATE = re.compile(
    r"(?<![^\s\"'<>()\[\]{},;:|=])[^\s\"'<>()\[\]{},;:|=0-9@]*+[0-9@][^\s\"'<>()\[\]{},;:|=]*+"
)
_CONTEXT = re.compile(r"[^\W_]+")
_NOT_DIGIT = re.compile(r"[^0-9]")
#: characters looked at first for the words before a place
_LOOK = 200


@dataclass(frozen=True)
class PiiConfig:
    """A pattern needs ``min_seeds`` different seed entities before it counts; patterns and strings
    need ``accept`` of 1 to give new spans."""

    context_words: int = 2
    min_seeds: int = 5
    accept: float = 0.8
    doubt: float = 0.5
    rounds: int = 3


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@`` outwards: the local part reaches back to the end of the last match."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        free = m.end() if m else at + 1
        if m:
            yield start, free
        at = text.find("@", free)


def _is_ip(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in found.split("."))


def luhn(digits: str) -> bool:
    """Every second digit from the right counts twice, its digits added; the sum ends in 0."""
    double = str.maketrans("0123456789", "0246813579")
    back = digits[::-1]
    return sum(map(int, back[0::2] + back[1::2].translate(double))) % 10 == 0


def _is_card(found: str) -> bool:
    digits = _NOT_DIGIT.sub("", found)
    return 16 <= len(digits) <= 19 and luhn(digits)


def _is_phone(found: str) -> bool:
    return 8 <= len(_NOT_DIGIT.sub("", found)) <= 15


def seed_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the seed rules in code points, by kind and start. Per kind, matches are leftmost and
    don't overlap; a match that fails its check is dropped."""
    out = [("email", a, b) for a, b in _emails(text)]
    for kind, pattern, valid in (("ip", _IP, _is_ip), ("card", _CARD, _is_card), ("phone", _PHONE, _is_phone)):
        out += [(kind, *m.span()) for m in pattern.finditer(text) if valid(m.group())]
    return out


def key_of(text: str) -> str:
    """A string as a key of the graph: itself, or a digest of all of it where it is long."""
    return text if len(text) <= 64 else "#" + hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=32).hexdigest()


def contexts(text: str, starts: Iterable[int], n: int) -> dict[int, str]:
    """Per place, the key of the last ``n`` whole words that end at or before it, lower-case.

    A word that the place lies in is no word before it. The places are met in order and what lies
    between two of them is read at most twice, so a text is read in linear time, however far back the
    words are. Mostly a look at the characters just before the place is enough.
    """
    out: dict[int, str] = {}
    words: deque[str] = deque(maxlen=n)
    at, key, held = 0, "", None
    for start in sorted(set(starts)):
        if held is not None and held[1] <= start:
            words.append(text[held[0] : held[1]].lower())
            at, key, held = held[1], None, None
        if held is None:
            found = []
            if start - at > _LOOK:
                found = list(_CONTEXT.finditer(text, start - _LOOK, start))
                # the first may be the rest of a longer word
                found = found[1:] if found and found[0].start() == start - _LOOK else found
            if len(found) <= n:
                found = deque(_CONTEXT.finditer(text, at, start), maxlen=n + 1)
            if found and found[-1].end() == start and _CONTEXT.match(text, start):
                held = _CONTEXT.match(text, found.pop().start()).span()
            if found:
                words.extend(m.group().lower() for m in found)
                key = None
            at = start
        if key is None:
            key = key_of(" ".join(words))
        out[start] = key
    return out


def graph_edges(text: str, seeds: list[tuple[str, int, int]], cfg: PiiConfig) -> list[tuple]:
    """``(kind, pattern, entity, start, end)`` of the seeds and, with kind null, of the candidates:
    strings with a digit or ``@``, of any length, apart from all seeds."""
    found = list(seeds)
    taken = sorted((a, b) for _, a, b in seeds)
    at = 0
    for m in _CANDIDATE.finditer(text):
        start, end = m.start(), m.end()
        while end > start and text[end - 1] in ".!?-":
            end -= 1
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        near = (t for t in taken[max(0, at - len(KINDS)) :] if t[0] < end) if at < len(taken) else ()
        if not any(a < end and start < b for a, b in near):
            found.append((None, start, end))
    before = contexts(text, (a for _, a, _ in found), cfg.context_words)
    return [(k, before[a], key_of(text[a:b].lower()), a, b) for k, a, b in found]


_SPAN = "array<struct<kind:string,start:int,end:int>>"
_EDGE = "array<struct<kind:string,pattern:string,entity:string,start:int,end:int>>"


def extracted(text: Column, cfg: PiiConfig = PiiConfig()) -> Column:
    """Seed spans and graph edges of a text; null counts as empty."""

    @F.pandas_udf(f"base {_SPAN}, edges {_EDGE}")
    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch:
                seeds = seed_spans(text or "")
                out.append((seeds, graph_edges(text or "", seeds, cfg)))
            yield pd.DataFrame(out, columns=["base", "edges"])

    return extract(text)


def scored_graph(edges: DataFrame, cfg: PiiConfig = PiiConfig()) -> tuple[DataFrame, DataFrame]:
    """``(kind, pattern, score)`` and ``(kind, entity, score)`` after the rounds.

    ``edges`` has ``kind`` (null for candidates), ``pattern``, ``entity``. A pattern's score is the
    mean score of the different strings seen in it, with ``doubt`` strings of score 0 added; only
    patterns with enough different seeds count. A string's score is the chance that one of its
    patterns is right. Everything is grouped by pattern or string with partial sums, so frequent
    ones are small.
    """
    pairs = kept(edges.where("pattern != ''").select("kind", "pattern", "entity").distinct(), "pii-pairs")
    seeds = pairs.where("kind is not null")
    induced = seeds.groupBy("kind", "pattern").agg(F.count(F.lit(1)).alias("seeds"))
    induced = kept(induced.where(F.col("seeds") >= cfg.min_seeds), "pii-patterns")
    own = F.col("seed_kind") == F.col("kind")
    links = pairs.withColumnRenamed("kind", "seed_kind").join(induced.select("kind", "pattern"), "pattern")
    links = kept(
        links.select("kind", "pattern", "entity", F.when(own, 1.0).otherwise(0.0).alias("seed"), F.col("seed_kind").isNull().alias("open")),
        "pii-links",
    )
    strings = links.groupBy("kind", "entity").agg(F.max("seed").alias("score"))
    patterns = strings
    for _ in range(cfg.rounds):
        on = links.join(strings, ["kind", "entity"])
        patterns = kept(
            on.groupBy("kind", "pattern").agg((F.sum("score") / (F.count(F.lit(1)) + cfg.doubt)).alias("score")), "pii-scores"
        )
        met = links.join(patterns.withColumnRenamed("score", "of"), ["kind", "pattern"])
        missed = F.sum(F.log1p(-F.least(F.col("of"), F.lit(0.999))))
        strings = kept(
            met.groupBy("kind", "entity").agg(F.greatest(F.max("seed"), 1 - F.exp(missed)).alias("score")), "pii-scores"
        )
    return patterns, strings


def personal_data(docs: DataFrame, cfg: PiiConfig = PiiConfig()) -> DataFrame:
    """One row per document: ``doc_id, base, extra``, both arrays of ``(kind, start, end)``.

    ``base`` are the seed rules' spans by kind and start, ``extra`` what high-scoring patterns found
    besides, never overlapping a base span. Null texts count as empty and repeated rows keep their
    row; an empty table gives no rows.
    """
    read = docs.select(
        "doc_id", F.md5(text_or_empty(F.col("text")).cast("binary")).alias("digest"), extracted(F.col("text"), cfg).alias("x")
    ).select("doc_id", "digest", "x.base", "x.edges")
    read = kept(read, "pii-texts")
    edges = read.where(F.size("edges") > 0).select("digest", F.explode("edges").alias("e")).select("digest", "e.*")
    patterns, strings = scored_graph(edges, cfg)
    good = patterns.where(F.col("score") >= cfg.accept).select("kind", "pattern")
    sure = strings.where(F.col("score") >= cfg.accept).select("kind", "entity")
    open_ = edges.where("kind is null and pattern != ''").drop("kind").distinct()
    new = open_.join(good, "pattern").join(sure, ["kind", "entity"])
    spans = F.array_sort(F.collect_set(F.struct("start", "kind", "end")))
    extra = new.groupBy("digest").agg(
        F.transform(spans, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("extra")
    )
    out = join_spread(read.select("doc_id", "digest", "base"), kept(extra, "pii-extra"), "digest")
    return out.select("doc_id", "base", F.coalesce("extra", F.array().cast(_SPAN)).alias("extra"))
