"""Language identification by cross-parsing.

Labelled text of each language becomes a suffix automaton. A document is parsed greedily against
each automaton: a phrase goes on as long as the automaton knows it, so phrases are longest matches.
The language that needs the fewest phrases per character wins.

Texts are parsed in stretches of a fixed number of symbols, each begun afresh, which costs every
language the same phrase at most. So all stretches of a batch, long texts or short, step through the
automaton together as one array. Every letter of the samples has a symbol of its own, whatever the
number of scripts; the edges of an automaton lie scattered in one array, so its size follows its
text and not the alphabet.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import kept, share
from stratalog.operators.skew import top_per_group

UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageConfig:
    """The automata are fitted on a bounded sample, the parse covers all text.

    At most ``sample_rows`` documents of a language, all with a letter, and ``piece`` characters of each,
    those of a longer text in ``parts`` stretches from its beginning to its end. An automaton
    of n characters has fewer than ``3 * n`` edges and takes about ``48 * n`` bytes, whatever the
    other languages; more only where many states with hundreds of edges need the room.
    """

    sample_rows: int = 32
    piece: int = 2_048
    parts: int = 4
    stretch: int = 512


@dataclass(frozen=True)
class Table:
    """The edges of one automaton. A state is a place; its edge with a symbol lies that many places
    on, as the owner's place and the next state's in the upper and lower half. ``starts`` is where a
    phrase begun by a symbol leads, the root for symbols the language does not show."""

    edges: np.ndarray
    starts: np.ndarray
    root: int


@dataclass(frozen=True)
class Tables:
    """One automaton per language, and the symbol of each code point."""

    languages: list[str]
    tables: list[Table]
    symbol_of: np.ndarray


def suffix_automaton(codes: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every suffix, hence every factor."""
    links, lengths, moves = [-1], [0], [{}]
    last = 0
    for code in codes:
        new = len(moves)
        moves.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        state = last
        while state >= 0 and code not in moves[state]:
            moves[state][code] = new
            state = links[state]
        if state >= 0:
            target = moves[state][code]
            if lengths[target] == lengths[state] + 1:
                links[new] = target
            else:
                clone = len(moves)
                moves.append(dict(moves[target]))
                lengths.append(lengths[state] + 1)
                links.append(links[target])
                while state >= 0 and moves[state].get(code) == target:
                    moves[state][code] = clone
                    state = links[state]
                links[target] = links[new] = clone
        last = new
    return moves


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "replace"), dtype=np.uint32)


def parse_table(codes: list[int], symbols: int) -> Table:
    """The automaton of a coded text, its states placed so that no two edges meet."""
    moves = suffix_automaton(codes)
    size = 2 * sum(map(len, moves)) + 1
    draw = random.Random(0).random  # half of the places stay free, so a few draws place most states
    owner = [-1] * (size + symbols)
    place = [-1] * len(moves)
    used = set()
    for state in sorted(range(len(moves)), key=lambda a: -len(moves[a])):
        at, drawn = int(draw() * size), 1
        while at in used or any(owner[at + code] >= 0 for code in moves[state]):
            at, drawn = int(draw() * size), drawn + 1
            if drawn % 256 == 0:  # many edges find no gap here: a quarter more room
                owner += [-1] * (size // 4 + 1)
                size += size // 4 + 1
        used.add(at)
        place[state] = at
        for code in moves[state]:
            owner[at + code] = at
    edges = np.array(owner, dtype=np.int64) << 32
    for state, of in enumerate(moves):
        for code, to in of.items():
            edges[place[state] + code] |= place[to]
    starts = np.full(symbols, place[0], dtype=np.int64)
    for code, to in moves[0].items():
        starts[code] = place[to]
    return Table(edges, starts, place[0])


def fitted(samples: dict[str, list[str]]) -> Tables:
    """Automata from sample texts. Each letter of any sample is a symbol, which only the languages
    that show it know; symbol 0 is all other letters, symbol 1 all that is not a letter."""
    languages = sorted(samples)
    texts = {name: " ".join(samples[name]).lower() for name in languages}
    alphabet = sorted({c for text in texts.values() for c in text if c.isalpha()})
    symbol_of = np.zeros(0x110000, dtype=np.int32)
    symbol_of[[i for i in range(0x110000) if not chr(i).isalpha()]] = 1
    for i, char in enumerate(alphabet):
        symbol_of[ord(char)] = i + 2
    symbols = len(alphabet) + 2
    tables = [parse_table(symbol_of[_points(texts[name])].tolist(), symbols) for name in languages]
    return Tables(languages, tables, symbol_of)


def phrase_counts(texts: list[str], model: Tables, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """Phrases per text and language, and symbols per text."""
    coded = [model.symbol_of[_points(t)] for t in texts]
    lengths = np.array([len(c) for c in coded], dtype=np.int64)
    lanes = -(-lengths // stretch)
    owner = np.repeat(np.arange(len(texts)), lanes)
    grid = np.zeros(int(lanes.sum()) * stretch, dtype=np.int32)
    begin = np.concatenate([[0], np.cumsum(lanes)]) * stretch
    for at, codes in zip(begin, coded, strict=False):
        grid[at : at + len(codes)] = codes
    # only the last lane of a text is short; the longest come first, so those still running are a prefix
    filled = np.minimum(stretch, lengths[owner] - (np.arange(len(owner)) * stretch - begin[owner]))
    order = np.argsort(-filled, kind="stable")
    owner, filled = owner[order], filled[order]
    columns = np.ascontiguousarray(grid.reshape(-1, stretch)[order].T)
    running = np.searchsorted(-filled, -np.arange(stretch))
    phrases = np.zeros((len(texts), len(model.languages)), dtype=np.int64)
    for k, table in enumerate(model.tables):
        state = np.full(len(owner), table.root, dtype=np.int64)
        ended = np.zeros(len(owner), dtype=np.int32)
        for column, n in zip(columns, running.tolist(), strict=True):
            if not n:
                break
            code, now = column[:n], state[:n]
            edge = table.edges.take(now + code)
            over = (edge >> 32) != now
            ended[:n] += over
            state[:n] = np.where(over, table.starts.take(code), edge & 0xFFFFFFFF)
        phrases[:, k] = np.bincount(owner, weights=ended + 1, minlength=len(texts))
    return phrases, lengths


def _predictions(texts: list[str], model: Tables, stretch: int) -> list[tuple[str, float]]:
    known = [i for i, t in enumerate(texts) if t is not None and any(map(str.isalpha, t))]
    out = [(UNKNOWN, 0.0)] * len(texts)
    if not known or not model.languages:
        return out
    phrases, lengths = phrase_counts([texts[i] for i in known], model, stretch)
    rates = phrases / np.maximum(lengths, 1)[:, None]
    best = rates.argmin(axis=1)
    for row, i in enumerate(known):
        others = np.delete(rates[row], best[row])
        least = rates[row, best[row]]
        second = others.min() if len(others) else np.inf
        score = 1.0 if not np.isfinite(second) else float(second / (least + second))
        out[i] = (model.languages[best[row]], score)
    return out


def _chunks(texts: list[str], limit: int = 4_000_000) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size >= limit:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def has_letter(text: Column) -> Column:
    """Whether a text holds a letter of any script; false for null."""
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def learn(docs: DataFrame, learned: Column, cfg: LanguageConfig = LanguageConfig()) -> Tables:
    """Automata from a bounded sample of the rows where ``learned`` holds and lang is not null.

    The sample of a language are the documents with the smallest id hashes among those with a letter, so
    null, empty and letterless texts take no one's place; of rows with one id, one counts. No labelled
    rows, an empty table too, give a model without languages, which predicts ``und`` for everything.
    """
    labelled = docs.where(learned & F.col("lang").isNotNull() & has_letter(F.col("text"))).withColumns(
        {"_lang": F.col("lang"), "_h": F.xxhash64("doc_id")}
    )
    ids = labelled.select("_lang", "_h")
    chosen = top_per_group(ids, ["_lang"], [F.col("_h")], cfg.sample_rows, ["_h"]).select("_lang", "_h").distinct()
    chosen = kept(chosen, "language-sample")  # at most sample_rows ids of a language
    size = F.length("text")
    part = cfg.piece // cfg.parts
    begins = [F.floor((size - part) * i / max(1, cfg.parts - 1)).cast("int") + 1 for i in range(cfg.parts)]
    spread = F.array(*[F.substring(F.col("text"), b, F.lit(part)) for b in begins])
    stretches = F.when(size <= cfg.piece, F.array("text")).otherwise(spread)
    pieces = labelled.select("_lang", "_h", stretches.alias("_piece"))
    picked = pieces.join(F.broadcast(chosen), ["_lang", "_h"]).groupBy("_lang", "_h").agg(F.min("_piece").alias("_piece"))
    samples: dict[str, list[str]] = {}
    for row in picked.orderBy("_lang", "_h").collect():
        samples.setdefault(row["_lang"], []).extend(row["_piece"])
    return fitted(samples)


def prediction(spark, model: Tables, text: Column, cfg: LanguageConfig = LanguageConfig()) -> Column:
    """``(lang_pred, score)`` of a text: ``und`` and 0 for null or letterless text.

    The score is the runner-up's share of the phrases of the two best languages: a half for a tie,
    more the clearer the winner. Ties go to the smaller language name.
    """
    shared = share(spark, model)
    stretch = cfg.stretch

    @F.pandas_udf("lang_pred string, score double")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tables = shared()
        for batch in batches:
            texts = batch.tolist()
            rows = [r for a, b in _chunks(texts) for r in _predictions(texts[a:b], tables, stretch)]
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    return parse(text)


def identified(docs: DataFrame, learned: Column, cfg: LanguageConfig = LanguageConfig()) -> DataFrame:
    """All rows and columns with ``lang_pred`` and ``score`` added (replacing columns of that name).

    Repeated rows are rows of their own; an empty table gives no rows. Texts are parsed whole.
    """
    model = learn(docs, learned, cfg)
    rest = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ("lang_pred", "score")]
    parsed = prediction(docs.sparkSession, model, F.col("text"), cfg)
    found = docs.select(F.struct("*").alias("_row"), parsed.alias("_p"))
    return found.select(*rest, "_p.lang_pred", "_p.score")
