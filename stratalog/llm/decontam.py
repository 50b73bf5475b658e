"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items become windows of consecutive normalised words; the automaton runs over word numbers,
so a text is split into words once and scanned once. Matches are word ranges, and the ranges are
mapped back to offsets in the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import share, text_or_empty

#: fixed values: characters that are no part of a word, after A-Z are made lower case
_NO_WORD = [*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]
_TABLE = bytearray(range(256))
for _code in _NO_WORD:
    _TABLE[_code] = 0x20
for _code in range(0x41, 0x5B):
    _TABLE[_code] = _code + 0x20
WORD_BYTES = bytes(_TABLE)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


@dataclass(frozen=True)
class DecontamConfig:
    """``part_words`` bounds the words of the items in one automaton; larger benchmarks are scanned
    in parts. ``share``: a document counts as contaminated from one word in so many."""

    window: int = 13
    share: int = 20
    part_words: int = 200_000


def words_of(text: str) -> list[bytes]:
    """Words as UTF-8; bytes of other scripts are left alone, so they are part of words."""
    return text.encode("utf-8", "replace").translate(WORD_BYTES).split()


def windows_of(words: list[bytes], size: int) -> Iterator[tuple[bytes, ...]]:
    if words and len(words) < size:
        yield tuple(words)
    for i in range(len(words) - size + 1):
        yield tuple(words[i : i + size])


def item_parts(benchmark: DataFrame, cfg: DecontamConfig) -> Iterator[list[tuple[object, str]]]:
    """Items as lists of at most about ``part_words`` words."""
    part, size = [], 0
    for row in benchmark.select("item_id", "text").where("text is not null").toLocalIterator():
        part.append((row["item_id"], row["text"]))
        size += len(row["text"]) // 2 + 1
        if size > 2 * cfg.part_words:
            yield part
            part, size = [], 0
    if part:
        yield part


def automaton(items: list[tuple[object, str]], window: int):
    """Word numbers, the automaton over them, and its size; a value is ``(length, items)``."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    owners: dict[tuple[int, ...], set[int]] = {}
    for place, (_, text) in enumerate(items):
        coded = [numbers.setdefault(w, len(numbers) + 1) for w in words_of(text)]
        for one in windows_of(coded, window):
            owners.setdefault(one, set()).add(place)
    machine = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for key, places in owners.items():
        machine.add_word(key, (len(key), tuple(places)))
    machine.make_automaton()
    return numbers, machine


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _scan(text: str, numbers: dict, machine) -> tuple[int, list[tuple[int, int]], list[int]]:
    words = words_of(text)
    ranges, places = [], set()
    if len(machine):
        get = numbers.get
        for end, (length, owners) in machine.iter(tuple([get(w, 0) for w in words])):
            ranges.append((end - length + 1, end + 1))
            places.update(owners)
    return len(words), merged(ranges), sorted(places)


def _spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as offsets in the original text."""
    if not ranges:
        return []
    at = [m.span() for m in WORD.finditer(text)]
    return [(at[a][0], at[b - 1][1]) for a, b in ranges]


HITS = "n_words long, ranges array<struct<start:int,end:int>>, spans array<struct<start:int,end:int>>, items array<string>"


def hits_of(spark, items: list[tuple[object, str]], text: Column, cfg: DecontamConfig) -> Column:
    """Words, hit word ranges (merged, end exclusive), their offsets, and the ids of the items."""
    shared = share(spark, items)
    window = cfg.window

    @F.pandas_udf(HITS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared()
        numbers, machine = automaton(known, window)
        for batch in batches:
            out = []
            for text in batch:
                n, ranges, places = _scan(text or "", numbers, machine)
                ids = sorted({str(known[p][0]) for p in places if known[p][0] is not None})
                out.append((n, ranges, _spans(text, ranges) if ranges else [], ids))
            yield pd.DataFrame(out, columns=["n_words", "ranges", "spans", "items"])

    return find(text)


def placed(text: Column, ranges: Column) -> Column:
    """Number of words, and the offsets of word ranges in the original text."""

    @F.pandas_udf("n_words long, spans array<struct<start:int,end:int>>")
    def place(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for text, told in zip(texts, found):
            pairs = [(r["start"], r["end"]) for r in told] if told is not None else []
            out.append((len(words_of(text or "")), _spans(text, pairs)))
        return pd.DataFrame(out, columns=["n_words", "spans"])

    return place(text, ranges)


def _verdict(found: Column, cfg: DecontamConfig) -> dict[str, Column]:
    n_hit = F.aggregate(found["ranges"], F.lit(0).cast("bigint"), lambda n, r: n + r["end"] - r["start"])
    return {
        "n_words": found["n_words"],
        "n_hit": n_hit,
        "items": found["items"],
        "spans": found["spans"],
        "contaminated": (n_hit > 0) & (F.lit(cfg.share) * n_hit >= found["n_words"]),
    }


def checked(docs: DataFrame, benchmark: DataFrame, cfg: DecontamConfig = DecontamConfig()) -> DataFrame:
    """All rows and columns with ``n_words, n_hit, items, spans, contaminated`` added (replacing
    columns of those names).

    Null and empty texts have no words and are never contaminated. Items without words are ignored;
    an item without id counts as a hit but is not listed. ``items`` are ids as text, sorted and
    different. The benchmark is read in bounded parts: one part is one automaton and one scan; for
    more, each part scans the texts, hits meet by the digest of the text and join back.
    """
    spark = docs.sparkSession
    parts = list(item_parts(benchmark, cfg)) or [[]]
    added = ("n_words", "n_hit", "items", "spans", "contaminated")
    rest = [F.col("_row")[c].alias(c) for c in docs.columns if c not in added]
    row = F.struct("*").alias("_row")
    if len(parts) == 1:
        whole = docs.select(row, hits_of(spark, parts[0], F.col("text"), cfg).alias("_hit"))
    else:
        whole = _in_parts(docs, parts, cfg)
    return whole.select(*rest, *[c.alias(n) for n, c in _verdict(F.col("_hit"), cfg).items()])


def _in_parts(docs: DataFrame, parts: list, cfg: DecontamConfig) -> DataFrame:
    spark = docs.sparkSession
    digest = F.sha2(text_or_empty(F.col("text")), 256)
    found = None
    for items in parts:
        hits = docs.select(digest.alias("_d"), hits_of(spark, items, F.col("text"), cfg).alias("_h"))
        hits = hits.where(F.size("_h.ranges") > 0).dropDuplicates(["_d"])
        found = hits if found is None else found.unionByName(hits)

    all_ = F.array_sort(F.flatten(F.collect_list("_h.ranges")))

    def grow(done: Column, r: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        wider = F.struct(last["start"].alias("start"), F.greatest(last["end"], r["end"]).alias("end"))
        return F.when(
            (F.size(done) > 0) & (r["start"] <= last["end"]),
            F.concat(F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))), F.array(wider)),
        ).otherwise(F.concat(done, F.array(r)))

    joined = found.groupBy("_d").agg(
        F.aggregate(all_, F.slice(all_, 1, 0), grow).alias("ranges"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_h.items")))).alias("items"),
    )
    rows = docs.select(F.struct("*").alias("_row"), digest.alias("_key"))
    met = rows.join(joined, F.col("_key") == F.col("_d"), "left")
    # offsets come from the merged ranges, so they are the same as with one automaton
    met = met.withColumn("_at", placed(F.col("_row")["text"], F.col("ranges")))
    return met.select(
        "_row",
        F.struct(
            F.col("_at.n_words").alias("n_words"),
            F.coalesce("ranges", F.array().cast("array<struct<start:int,end:int>>")).alias("ranges"),
            F.col("_at.spans").alias("spans"),
            F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        ).alias("_hit"),
    )
