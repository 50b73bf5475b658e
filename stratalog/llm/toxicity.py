"""Toxicity by the nearest labelled examples, with exact TF-IDF cosines from a block-max inverted index.

Terms are words and the beginnings of words; the vector space holds every term of the indexed examples,
weighed by TF-IDF, with document frequencies among the indexed examples that are not toxic. Like
examples form blocks. Postings of common terms lie by block, with the largest weight of each term there;
with the sums over seldom terms they bound every block before its common postings are read, and only the
blocks that can still reach the k-th best example found are opened.

The nearest vote by closeness, counted over shared terms by what a term tells about the label (its
likelihood ratio among the examples), and by how many documents of its class an example stands for; a
table of votes against outcomes, from training documents outside the index, turns them into a probability.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import kept, share
from stratalog.operators.skew import top_per_group

WORD = re.compile(r"[^\W\d_]+")
#: of ASCII, the letters stay and all others become blanks
_ASCII = "".join(c if WORD.match(c) else " " for c in map(chr, range(128)))


@dataclass(frozen=True)
class ToxicityConfig:
    """The classifier is fitted on a bounded sample by id hash: at most ``2 * examples`` labelled
    documents of each class, of which a half by another hash goes into the index and the others
    calibrate its votes. Class sizes count all rows. ``least`` is added to each likelihood ratio, so
    that no shared term counts nothing. ``remembered`` bounds the words a task looks up once."""

    prefixes: tuple[int, ...] = (4, 5, 6, 7)
    least: float = 0.1
    examples: int = 2_048
    neighbours: int = 64
    block: int = 64
    bins: int = 10
    remembered: int = 200_000


def words_of(text: str | None) -> list[str]:
    """The words of a text, in lower case."""
    text = (text or "").lower()
    return text.translate(_ASCII).split() if text.isascii() else WORD.findall(text)


def word_terms(word: str, prefixes: tuple[int, ...]) -> list[str]:
    """A word, and its beginnings that more letters follow, marked by ``*``."""
    return [word, *(word[:size] + "*" for size in prefixes if len(word) > size)]


def term_ids(terms: Sequence[str]) -> np.ndarray:
    """64-bit identifiers of terms."""
    return np.fromiter(map(xxhash.xxh64_intdigest, terms), dtype=np.uint64, count=len(terms)).view(np.int64)


def stretches(begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places ``begin .. begin + size`` one after the other, and which stretch each is of."""
    which = np.repeat(np.arange(len(size)), size)
    return np.arange(len(which)) + (begin - (np.cumsum(size) - size))[which], which


def term_vectors(docs: DataFrame, prefixes: tuple[int, ...], kind: str) -> DataFrame:
    """``(doc_id, label, term, n)``: identifiers and counts of all terms of each text."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            terms, counts = [], []
            for text in frame["text"]:
                hits: Counter = Counter()
                for word, n in Counter(words_of(text)).items():
                    for term in word_terms(word, prefixes):
                        hits[term] += n
                terms.append(term_ids(list(hits)))
                counts.append(np.array(list(hits.values()), dtype=np.int32))
            yield frame[["doc_id", "label"]].assign(term=pd.Series(terms, index=frame.index, dtype=object), n=pd.Series(counts, index=frame.index, dtype=object))

    return docs.select("doc_id", "label", "text").mapInPandas(
        read, f"doc_id {kind}, label int, term array<long>, n array<int>"
    )


class _Numbers(dict):
    """Words by number; words met for the first time are noted in ``new``."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Reader:
    """Places and counts of the known terms of texts; the places of a word are remembered."""

    def __init__(self, terms: np.ndarray, cfg: ToxicityConfig):
        self.terms, self.cfg = terms, cfg
        self._forget()

    def _forget(self) -> None:
        self.words, self.begin, self.places = _Numbers(), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64)

    def _look_up(self) -> None:
        new = [word_terms(word, self.cfg.prefixes) for word in self.words.new]
        self.words.new.clear()
        if new and len(self.terms):
            at, known = self.place_of(term_ids([t for terms in new for t in terms]))
            owner = np.repeat(np.arange(len(new)), [len(terms) for terms in new])[known]
            self.places = np.concatenate([self.places, at[known]])
            ends = self.begin[-1] + np.cumsum(np.bincount(owner, minlength=len(new)))
            self.begin = np.concatenate([self.begin, ends])

    def place_of(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each identifier among the known terms, and whether it is one."""
        at = np.minimum(np.searchsorted(self.terms, ids), max(0, len(self.terms) - 1))
        return at, self.terms[at] == ids if len(self.terms) else np.zeros(len(ids), dtype=bool)

    def vectors(self, texts: Sequence[str | None]) -> list[tuple[np.ndarray, np.ndarray]]:
        if not len(self.terms):
            return [(np.zeros(0, dtype=np.int64), np.zeros(0))] * len(texts)
        if len(self.words) > self.cfg.remembered:
            self._forget()
        number = self.words.__getitem__
        read = [np.fromiter(map(number, words_of(t)), dtype=np.int64) for t in texts]
        self._look_up()
        out = []
        for words in read:
            size = self.begin[words + 1] - self.begin[words]
            out.append(np.unique(self.places[stretches(self.begin[words], size)[0]], return_counts=True))
        return out


def label_ratio(clean: np.ndarray, toxic: np.ndarray, totals: tuple[int, int]) -> np.ndarray:
    """Likelihood ratio of each term's presence against the label."""
    n_clean, n_toxic = (float(n) for n in totals)

    def part(seen: np.ndarray, of: float, share: np.ndarray) -> np.ndarray:
        ok = (seen > 0) & (share > 0)
        return np.where(ok, seen * np.log(np.where(ok, seen, 1) / np.where(ok, share * of, 1)), 0.0)

    share = (clean + toxic) / max(1.0, n_clean + n_toxic)
    ratio = part(toxic, n_toxic, share) + part(clean, n_clean, share)
    ratio += part(n_toxic - toxic, n_toxic, 1 - share) + part(n_clean - clean, n_clean, 1 - share)
    return np.maximum(2 * ratio, 0.0)


def like_together(rows: np.ndarray, places: np.ndarray, values: np.ndarray, n: int, n_terms: int, block: int) -> np.ndarray:
    """An order of the examples in which blocks hold like ones: halves along the main direction of a
    sketch of 64 numbers, halved again down to a block."""
    dice = np.random.default_rng(64)
    column, sign = dice.integers(0, 64, n_terms), dice.choice([-1.0, 1.0], n_terms)
    sketch = np.bincount(rows * 64 + column[places], weights=values * sign[places], minlength=n * 64).reshape(n, 64)
    left, done = [np.arange(n)], []
    while left:
        part = left.pop()
        if len(part) <= block:
            done.append(part)
            continue
        middle = sketch[part] - sketch[part].mean(axis=0)
        direction = np.linalg.eigh(middle.T @ middle)[1][:, -1]
        part = part[np.argsort(middle @ direction, kind="stable")]
        half = block * (-(-len(part) // block) // 2)
        left += [part[half:], part[:half]]
    return np.concatenate(done) if done else np.zeros(0, dtype=np.int64)


@dataclass
class BlockMaxIndex:
    """Unit vectors of the examples, by term. Seldom terms have postings ``rows, values``, where those of
    a term are ``begin[t]:begin[t + 1]``. The postings of common terms, with row ``common_at[t]``, lie by
    block in ``common[block, example, term]``, and ``top[term, block]`` is the largest weight there."""

    ids: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    idf: np.ndarray
    telling: np.ndarray
    begin: np.ndarray
    rows: np.ndarray
    values: np.ndarray
    common_at: np.ndarray
    common: np.ndarray
    top: np.ndarray
    opened: int = 0
    asked: int = 0

    @classmethod
    def build(cls, ids, labels, weights, vectors, idf, block, telling=None, seldom=12) -> BlockMaxIndex:
        """``telling`` is what a shared term counts in a vote; without it all count the same. A term of
        more than one in ``seldom`` examples is common."""
        units = [unit(v, idf) for v in vectors]
        rows = np.repeat(np.arange(len(ids)), [len(u[0]) for u in units])
        places, values = (np.concatenate([u[i] for u in units]) for i in (0, 1))
        del units
        order = like_together(rows, places, values, len(ids), len(idf), block)
        rows = np.argsort(order)[rows]
        many = np.flatnonzero(np.bincount(places, minlength=len(idf)) * seldom > len(ids))
        common_at = np.full(len(idf), -1, dtype=np.int32)
        common_at[many] = np.arange(len(many))
        common = np.zeros((-(-len(ids) // block), block, len(many)))
        at = common_at[places]
        often = at >= 0
        common[rows[often] // block, rows[often] % block, at[often]] = values[often]
        places, rows, values = places[~often], rows[~often], values[~often]
        by_term = np.lexsort((rows, places))
        begin = np.concatenate([[0], np.cumsum(np.bincount(places, minlength=len(idf)))])
        return cls(
            np.array(ids)[order], np.array(labels)[order], np.array(weights)[order], idf,
            np.ones(len(idf)) if telling is None else telling, begin,
            rows[by_term].astype(np.min_scalar_type(len(ids))), values[by_term],
            common_at, common, common.max(axis=1).T.copy(),
        )

    def search(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple]:
        """For each query the places and cosines of the k nearest, and their sums over telling terms.

        A block's bound is its best sum over seldom terms, which is exact, and the largest weights of
        the common ones. Eight blocks are opened first, and then all that can still reach the k-th best.
        """
        blocks, size, n = len(self.common), self.common.shape[1], len(self.ids)
        wide = np.zeros((len(queries), len(self.top)))
        told = np.zeros_like(wide)
        sums = np.zeros((len(queries), blocks * size))
        telling = np.zeros_like(sums)
        ranges = [(self.begin[places], self.begin[places + 1] - self.begin[places]) for places, _ in queries]
        most = max((int(many.sum()) for _, many in ranges), default=0)
        steps, rows, found = np.arange(most), np.empty(most, dtype=self.rows.dtype), np.empty(most)
        wider = np.empty(most, dtype=np.intp)
        for q, ((places, values), (begin, many)) in enumerate(zip(queries, ranges, strict=True)):
            at = self.common_at[places]
            often = at >= 0
            wide[q, at[often]] = values[often]
            told[q, at[often]] = values[often] * self.telling[places[often]]
            post = np.repeat(begin - (np.cumsum(many) - many), many)
            post += steps[: len(post)]
            row = wider[: len(post)]
            row[:] = np.take(self.rows, post, out=rows[: len(post)], mode="clip")
            product = np.take(self.values, post, out=found[: len(post)], mode="clip")
            product *= np.repeat(values, many)
            sums[q] = np.bincount(row, weights=product, minlength=blocks * size)
            product *= np.repeat(self.telling[places], many)
            telling[q] = np.bincount(row, weights=product, minlength=blocks * size)
        sums = sums.reshape(len(queries), blocks, size)
        bound = sums.max(axis=2) + wide @ self.top
        full = np.zeros_like(sums)
        best = np.argpartition(-bound, min(7, blocks - 1), axis=1)[:, :8]
        first = np.zeros(bound.shape, dtype=bool)
        np.put_along_axis(first, best, True, axis=1)
        self._open(first, wide, sums, full)
        flat = full.reshape(len(queries), -1)
        seen = np.take_along_axis(full, best[:, :, None], axis=1).reshape(len(queries), -1)
        least = np.partition(seen, -k, axis=1)[:, -k] if seen.shape[1] >= k else np.zeros(len(queries))
        self._open((bound >= least[:, None] - 1e-9) & (bound > 0) & ~first, wide, sums, full)
        self.asked += len(queries)
        by_example = self.common.reshape(blocks * size, -1)
        out = []
        for q, (cosine, floor, close) in enumerate(zip(flat[:, :n], least, telling, strict=True)):
            at = np.flatnonzero(cosine > max(0.0, floor - 2e-12))
            at = at[np.lexsort((at, -np.round(cosine[at], 12)))[:k]]
            often = np.flatnonzero(told[q])
            out.append((at, cosine[at], close[at] + by_example[at[:, None], often] @ told[q, often]))
        return out

    def _open(self, wanted: np.ndarray, wide: np.ndarray, sums: np.ndarray, full: np.ndarray) -> None:
        """Whole cosines of the wanted blocks of each query."""
        self.opened += int(wanted.sum())
        for b in np.flatnonzero(wanted.any(axis=0)):
            who = np.flatnonzero(wanted[:, b])
            full[who, b] = sums[who, b] + wide[who] @ self.common[b].T

    def nearest(self, query: tuple[np.ndarray, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and exact cosines of the k nearest examples, nearest first, ties to the smaller
        place; examples that share no term are not near."""
        return self.search([query], k)[0][:2]

    def votes(self, queries: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[tuple[float | None, list, list[float]]]:
        """Share of the toxic class among the nearest, each weighed by closeness over telling terms and
        by class weight; ids and cosines of the nearest."""
        out: list = []
        for at, cosine, close in self.search(queries, k):
            if not len(at):
                out.append((None, [], []))
                continue
            weight = self.weights[at] * close
            share = float((weight * self.labels[at]).sum() / weight.sum())
            out.append((share, self.ids[at], cosine))
        return out

    def judged(self, vectors: list[tuple], k: int) -> list[tuple[float | None, list, list[float]]]:
        """Votes on vectors of counts; none for an empty one."""
        some = [i for i, v in enumerate(vectors) if len(v[0])]
        out: list = [(None, [], [])] * len(vectors)
        for i, vote in zip(some, self.votes([unit(vectors[i], self.idf) for i in some], k) if some else [], strict=True):
            out[i] = vote
        return out


def unit(vector: tuple, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and weights ``(1 + ln n) * idf`` of a vector, scaled to length 1."""
    places = np.asarray(vector[0], dtype=np.int64)
    values = (1 + np.log(np.asarray(vector[1], dtype=float))) * idf[places] if len(places) else np.zeros(0)
    return places, values / np.sqrt((values**2).sum()) if len(places) else values


def _calibrated(votes: list[tuple[float, int, float]], bins: int) -> tuple[np.ndarray, np.ndarray]:
    """Rising outcome rates over vote bins: weighted, smoothed, and pooled where they would fall."""
    edges = (np.arange(bins) + 0.5) / bins
    hit, all_ = np.zeros(bins), np.zeros(bins)
    for vote, label, weight in votes:
        b = min(bins - 1, int(vote * bins))
        hit[b] += weight * label
        all_[b] += weight
    pooled: list[list[float]] = []
    for b in range(bins):
        pooled.append([hit[b] + edges[b], all_[b] + 1.0, 1])
        while len(pooled) > 1 and pooled[-2][0] / pooled[-2][1] > pooled[-1][0] / pooled[-1][1]:
            h, a, n = pooled.pop()
            pooled[-1] = [pooled[-1][0] + h, pooled[-1][1] + a, pooled[-1][2] + n]
    rates = np.concatenate([np.full(int(n), h / a) for h, a, n in pooled])
    return edges, rates


def _index(examples: DataFrame, weights: dict[int, float], cfg: ToxicityConfig) -> tuple[np.ndarray, BlockMaxIndex | None]:
    """The identifiers of all terms of the bounded examples, sorted, and the index over them."""
    table = examples.where(F.size("term") > 0).orderBy(F.xxhash64("doc_id"), "doc_id").toArrow().combine_chunks()
    if not table.num_rows:
        return np.zeros(0, dtype=np.int64), None
    size = table["n"].combine_chunks().value_lengths().to_numpy()
    terms, place = np.unique(table["term"].combine_chunks().flatten().to_numpy(), return_inverse=True)
    cuts = np.cumsum(size)[:-1]
    vectors = list(zip(np.split(place, cuts), np.split(table["n"].combine_chunks().flatten().to_numpy(), cuts), strict=True))
    labels = table["label"].to_numpy()
    toxic = np.bincount(place, weights=np.repeat(labels, size), minlength=len(terms))
    clean = np.bincount(place, minlength=len(terms)) - toxic
    n_toxic = int(labels.sum())
    n_clean = len(labels) - n_toxic
    idf = np.log((1 + n_clean) / (1 + clean)) + 0.1
    telling = cfg.least + label_ratio(clean, toxic, (n_clean, n_toxic))
    ids = table["doc_id"].to_pylist()
    return terms, BlockMaxIndex.build(ids, labels, [weights[y] for y in labels.tolist()], vectors, idf, cfg.block, telling)


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, learned: Column, cfg: ToxicityConfig = ToxicityConfig()
) -> DataFrame:
    """One row per document: ``doc_id, score, predicted, vote, evidence``; other columns play no part.

    ``labels`` has ``doc_id, toxic``; labels are learned where ``learned`` (over ``doc_id``) holds,
    the larger if an id has several, nulls not at all. ``evidence`` lists the nearest examples with
    their cosine. A text without any term of the examples, empty or null ones too, gets the rate of
    such texts among the labelled; with no labels at all every score is 0. Equal cosines go to the
    example first in index order. Texts are read whole, whatever their length. Repeated rows each get
    a row; of documents with one id, one text is learned from. Empty documents give no rows.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    marks = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & learned)
    marks = marks.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("label"))
    marks = kept(marks.select(F.col("doc_id").alias("_id"), (F.col("label") > 0).cast("int").alias("label")), "toxicity-labels")
    same = F.col("doc_id") == F.col("_id")

    light = kept(docs.select("doc_id").join(marks, same).select("doc_id", "label", F.xxhash64("doc_id", F.lit(5)).alias("_h")), "toxicity-known")
    sizes = {r["label"]: r["count"] for r in light.groupBy("label").count().collect()}
    top = top_per_group(light, ["label"], [F.col("_h"), F.col("doc_id")], 2 * cfg.examples, ["_h", "doc_id"])
    chosen = kept(top.select(F.col("doc_id").alias("_id"), "label").distinct(), "toxicity-sample")
    picked = docs.join(F.broadcast(chosen), same).groupBy("doc_id", "label").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = kept(term_vectors(picked, cfg.prefixes, kind), "toxicity-vectors")
    number = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    weights = {y: sizes[y] / number[y] for y in number}
    in_index = F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(2)) == 0
    terms, index = _index(sample.where(in_index), weights, cfg)
    model = share(spark, (terms, index))

    @F.pandas_udf("double")
    def voted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        terms, index = model()
        read = Reader(terms, cfg)
        for ids, counts in batches:
            found = [(*read.place_of(np.asarray(one, dtype=np.int64)), np.asarray(n)) for one, n in zip(ids, counts, strict=True)]
            known = [(at[ok], n[ok]) for at, ok, n in found]
            some = (known[a : a + 64] for a in range(0, len(known), 64))
            yield pd.Series([v[0] for s in some for v in (index.judged(s, cfg.neighbours) if index else [(None,)] * len(s))], dtype=object)

    votes = sample.where(~in_index).select("label", voted("term", "n").alias("vote")).collect()  # at most 4 * examples numbers
    known = [(r["vote"], r["label"], weights[r["label"]]) for r in votes if r["vote"] is not None]
    edges, rates = _calibrated(known, cfg.bins)
    none = [(r["label"], weights[r["label"]]) for r in votes if r["vote"] is None]
    rate = sizes.get(1, 0) / max(1, sum(sizes.values()))
    bare = (sum(y * w for y, w in none) + 0.5 * rate) / (sum(w for _, w in none) + 0.5)

    @F.pandas_udf(f"score double, vote double, ids array<{kind}>, cosines array<double>")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        terms, index = model()
        read = Reader(terms, cfg)
        for texts in batches:
            out: list = []
            for a in range(0, len(texts), 64):
                vectors = read.vectors(texts.iloc[a : a + 64].tolist())
                for vote, ids, cosines in index.judged(vectors, cfg.neighbours) if index else [(None, [], [])] * len(vectors):
                    out.append((bare if vote is None else float(np.interp(vote, edges, rates)), vote, ids, cosines))
            yield pd.DataFrame(out, columns=["score", "vote", "ids", "cosines"])

    scored = docs.select("doc_id", score("text").alias("_s"))
    return scored.select(
        "doc_id", "_s.score", (F.col("_s.score") >= 0.5).cast("int").alias("predicted"), "_s.vote",
        F.zip_with("_s.ids", "_s.cosines", lambda i, c: F.struct(i.alias("doc_id"), c.alias("cosine"))).alias("evidence"),
    )
