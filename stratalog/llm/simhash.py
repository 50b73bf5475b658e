"""Near-duplicates by SimHash fingerprints, linked through pivot distance tables.

Texts become 64-bit fingerprints; different fingerprints are few next to the rows, and only they take
part in the search. Every fingerprint has a row in the pivot table: its Hamming distances to a number
of reference fingerprints. Distances differ at most as much as the fingerprints themselves, so a pair
whose largest coordinate difference exceeds the limit is discarded without a look at it; survivors
are verified bit by bit.

So that not all pairs meet, fingerprints meet in cells: with the bits in ``max_bits + 2`` blocks, a
linked pair agrees on two blocks at least, and each pair of blocks is one table of cells. A cell
yields a star per connected group, not its links, so many copies of like texts stay linear.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from stratalog.llm.common import join_spread, kept, text_or_empty

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@dataclass(frozen=True)
class SimhashConfig:
    shingle: int = 3
    seed: int = 42
    max_bits: int = 2
    pivots: int = 16
    small_cell: int = 64
    large_cell: int = 2_048


def pivots_of(cfg: SimhashConfig) -> np.ndarray:
    """The reference fingerprints: odd multiples of a 64-bit odd constant, so spread over all bits."""
    golden = 0x9E3779B97F4A7C15
    return np.array([(2 * i + 1) * golden % (1 << 64) for i in range(cfg.pivots)], dtype=np.uint64)


def fingerprint_of(text: bytes, cfg: SimhashConfig = SimhashConfig()) -> int:
    """A bit is set if it is set in over half the hashes of the shingles, repeats included."""
    import xxhash

    words = text.translate(_LOWER).split()
    if not words:
        return 0
    size = min(cfg.shingle, len(words))
    shingles = map(b" ".join, zip(*[words[i:] for i in range(size)], strict=False))
    n = len(words) - size + 1
    hashes = np.fromiter(map(partial(xxhash.xxh64_intdigest, seed=cfg.seed), shingles), dtype=np.uint64, count=n)
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, n, 65_536):
        part = hashes[start : start + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprint(text: Column, cfg: SimhashConfig = SimhashConfig()) -> Column:
    """The fingerprint of a text as a signed long; 0 for a text without words, null too."""

    @F.pandas_udf("long")
    def hashed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            codes = np.fromiter((fingerprint_of(bytes(t), cfg) for t in batch), dtype=np.uint64, count=len(batch))
            yield pd.Series(codes.view(np.int64))

    # so marked, the optimizer doesn't repeat the function below a join to test its result for null
    return hashed.asNondeterministic()(text_or_empty(text).cast("binary"))


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable place for each of ``n`` places linked by the pairs ``(a, b)``."""
    label = np.arange(n)
    while True:
        before = label.copy()
        low = np.minimum(label[a], label[b])
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        while not np.array_equal(label, label[label]):
            label = label[label]
        if np.array_equal(before, label):
            return label


def _linked(codes: np.ndarray, table: np.ndarray, i: np.ndarray, j: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that pass the pivot table, one coordinate at a time, and then the exact count."""
    for k in range(table.shape[1]):
        near = np.abs(table[i, k] - table[j, k]) <= limit
        i, j = i[near], j[near]
    close = np.bitwise_count(codes[i] ^ codes[j]) <= limit
    return i[close], j[close]


def _large_cell(codes: np.ndarray, free: list[int], limit: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a cell with very many members: each looks its possible neighbours up, flipping the
    bits that the cell leaves free, so the work grows with the members and not with their pairs."""
    order = np.argsort(codes)
    ranked = codes[order]
    for flips in range(1, limit + 1):
        for bits in combinations(free, flips):
            wanted = codes ^ np.uint64(sum(1 << b for b in bits))
            at = np.minimum(np.searchsorted(ranked, wanted), len(ranked) - 1)
            hit = np.flatnonzero(ranked[at] == wanted)
            if len(hit):
                yield hit, order[at[hit]]


def _cell_links(frames: Iterator[pd.DataFrame], cfg: SimhashConfig) -> Iterator[pd.DataFrame]:
    """Stars ``(a, b)`` of linked fingerprints; rows come sorted by ``(pairing, cell)``."""
    blocks, pairings = block_bits(cfg)
    pivots = pivots_of(cfg)

    def stars(part: pd.DataFrame) -> pd.DataFrame:
        codes = part["fp"].to_numpy().view(np.uint64)
        table = np.bitwise_count(codes[:, None] ^ pivots[None, :]).astype(np.int16)
        new = np.ones(len(part), dtype=bool)
        new[1:] = (part["pairing"].to_numpy()[1:] != part["pairing"].to_numpy()[:-1]) | (
            part["cell"].to_numpy()[1:] != part["cell"].to_numpy()[:-1]
        )
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(part)))
        own = np.repeat(np.arange(len(starts)), sizes)
        left, right = [], []
        small = np.flatnonzero(sizes[own] <= cfg.small_cell)
        for shift in range(1, min(cfg.small_cell, int(sizes.max()))):
            i = small[small + shift < len(own)]
            i = i[own[i] == own[np.minimum(i + shift, len(own) - 1)]]
            if not len(i):
                break
            a, b = _linked(codes, table, i, i + shift, cfg.max_bits)
            left.append(a)
            right.append(b)
        for start, size in zip(starts, sizes, strict=True):
            if size <= cfg.small_cell:
                continue
            inside = slice(start, start + size)
            if size > cfg.large_cell:
                used = {b for k in pairings[part["pairing"].iloc[start]] for b in blocks[k]}
                free = [b for b in range(64) if b not in used]
                found = _large_cell(codes[inside], free, cfg.max_bits)
            else:
                found = (
                    _linked(codes[inside], table[inside], np.full(size - k - 1, k), np.arange(k + 1, size), cfg.max_bits)
                    for k in range(size - 1)
                )
            label = np.arange(size)
            for a, b in found:
                if (label[a] != label[b]).any():
                    merged = components(size, np.concatenate([np.arange(size), a]), np.concatenate([label, b]))
                    label = merged
            apart = np.flatnonzero(label != np.arange(size))
            left.append(apart + start)
            right.append(label[apart] + start)
        values, place = np.unique(codes, return_inverse=True)
        a, b = place[np.concatenate(left)] if left else place[:0], place[np.concatenate(right)] if right else place[:0]
        root = components(len(values), a, b)
        apart = np.flatnonzero(root != np.arange(len(values)))
        return pd.DataFrame({"a": values[apart].view(np.int64), "b": values[root[apart]].view(np.int64)})

    rest: pd.DataFrame | None = None
    for frame in frames:
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        last = (frame["pairing"] == frame["pairing"].iloc[-1]) & (frame["cell"] == frame["cell"].iloc[-1])
        whole = frame[~last]
        rest = frame[last].reset_index(drop=True)
        if len(whole):
            yield stars(whole.reset_index(drop=True))
    if rest is not None and len(rest):
        yield stars(rest)


def block_bits(cfg: SimhashConfig) -> tuple[list[range], list[tuple[int, int]]]:
    """Bits of each block, and the pairs of blocks that cells are made of."""
    n = cfg.max_bits + 2
    cuts = [64 * i // n for i in range(n + 1)]
    return [range(a, b) for a, b in zip(cuts, cuts[1:], strict=False)], list(combinations(range(n), 2))


def fingerprint_links(codes: DataFrame, cfg: SimhashConfig = SimhashConfig()) -> DataFrame:
    """``(a, b)`` pairs that connect exactly the fingerprints (column ``fp``, all different) that
    chains of links connect."""
    blocks, pairings = block_bits(cfg)
    cells = []
    for place, (x, y) in enumerate(pairings):
        mask = sum(1 << b for k in (x, y) for b in blocks[k])
        signed = mask - (1 << 64) if mask >> 63 else mask
        cells.append(F.struct(F.lit(place).alias("pairing"), F.col("fp").bitwiseAND(F.lit(signed)).alias("cell")))
    placed = codes.select("fp", F.explode(F.array(*cells)).alias("c")).select("fp", "c.pairing", "c.cell")
    sorted_ = placed.repartition("pairing", "cell").sortWithinPartitions("pairing", "cell", "fp")
    return sorted_.mapInPandas(lambda frames: _cell_links(frames, cfg), "a long, b long")


def _starred(edges: DataFrame, large: bool) -> DataFrame:
    """One half round of the star algorithm: neighbours above (large) or up to (small) a node are
    tied to the smallest neighbour."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b").distinct()
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    tied = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    return tied.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """``(a, root)`` for every node with a smaller one in its group; roots have no row.

    Alternates the two half rounds until nothing changes, about the logarithm of the longest chain.
    Each round is a table in the shared folder.
    """
    edges = kept(edges.where("a != b").distinct(), "links")
    print_ = None
    while True:
        edges = kept(_starred(_starred(edges, True), False), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == print_:
            return edges.select("a", F.col("b").alias("root"))
        print_ = now


def clusters(codes: DataFrame, cfg: SimhashConfig = SimhashConfig()) -> DataFrame:
    """``(fp, root, component_id, keeper)`` for every different fingerprint of ``(doc_id, fp)`` rows.

    ``component_id`` is the smallest id in the group, null if it has none; ``keeper`` is the smallest
    ``(doc_id, fp)`` of the group, null ids last.
    """
    first = F.min(F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "fp"))
    distinct = kept(codes.groupBy("fp").agg(first.alias("least")), "fingerprints")
    roots = connected(fingerprint_links(distinct.select("fp"), cfg))
    named = distinct.join(roots, distinct["fp"] == roots["a"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least"
    )
    named = kept(named, "fingerprint-roots")
    least = named.groupBy("root").agg(F.min("least").alias("keeper"))
    return named.select("fp", "root").join(least, "root").select(
        "fp", "root", F.col("keeper.doc_id").alias("component_id"),
        F.struct("keeper.doc_id", "keeper.fp").alias("keeper"),
    )


def near_duplicates(docs: DataFrame, cfg: SimhashConfig = SimhashConfig()) -> DataFrame:
    """One row per document: ``doc_id, fp, component_id``, texts without words linked like others.

    An empty table gives no rows; repeated rows and ids each keep their row.
    """
    codes = kept(docs.select("doc_id", fingerprint(F.col("text"), cfg).alias("fp")), "simhash")
    named = kept(clusters(codes, cfg).select("fp", "component_id"), "simhash-groups")
    return join_spread(codes, named, "fp").select("doc_id", "fp", "component_id")


def one_per_group(docs: DataFrame, cfg: SimhashConfig = SimhashConfig()) -> DataFrame:
    """The document with the smallest id of each group, columns as they were; of equal rows, one.

    Only fingerprints and ids take part in the search. The texts are shuffled once, to meet the list
    of rows that stay.
    """
    codes = kept(docs.select("doc_id", fingerprint(F.col("text"), cfg).alias("fp")), "simhash")
    stay = clusters(codes, cfg).select(F.col("keeper.doc_id").alias("_id"), F.col("keeper.fp").alias("_fp")).distinct()
    rows = docs.select(F.struct("*").alias("_row"), F.col("doc_id").alias("_own"), fingerprint(F.col("text"), cfg).alias("_code"))
    met = rows.join(stay, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_code") == F.col("_fp")))
    turn = F.row_number().over(W.partitionBy("_id", "_fp").orderBy(F.xxhash64("_row.text")))
    return met.withColumn("_turn", turn).where("_turn = 1").select("_row.*")
