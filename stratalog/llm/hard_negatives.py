"""Hard negatives through an inverted multi-index.

Vectors are cut into two halves, and each half-space has a codebook of its own, fitted on a bounded
sample. The pair of nearest codes is a vector's cell. For an anchor, the score of any row of a cell is
at most the sum of two half scores, each the product with the code plus the anchor's length times the
radius of the rows around the code. A heap visits the cells by that sum, largest first, and stops once
the bound of the next cell cannot change the answer any more: first for the anchor's positives, then,
with the positives known, for the window of scores below each of them. So the results are exact.

The index is written in blocks of cells with an even number of rows, anchors in blocks too; a block of
anchors meets a block of rows in one task, and what the blocks found is ranked per anchor.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from stratalog.llm.common import kept, share


@dataclass(frozen=True)
class MiningConfig:
    """``low`` and ``high``: a negative's score in percent of the positive's. The codebooks are fitted
    on at most ``sample`` vectors; everything is indexed."""

    positives: int = 5
    negatives: int = 3
    low: int = 50
    high: int = 95
    scale: int = 256
    sample: int = 8_192
    rows_per_cell: int = 512
    min_codes: int = 4
    max_codes: int = 64
    rounds: int = 12
    row_blocks: int = 48
    min_block: int = 256
    max_block: int = 65_536
    anchor_block: int = 4_096
    chunk: int = 512
    seed: int = 7


@dataclass(frozen=True)
class HalfCodes:
    """Codes of the first and second half of a vector, as rows of a matrix each."""

    first: np.ndarray
    second: np.ndarray

    @property
    def cut(self) -> int:
        return self.first.shape[1]


def finite(vector: Column) -> Column:
    """Not null and without null or non-finite components."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good, F.lit(False))


def scaled(vectors: list, scale: int) -> np.ndarray:
    """``floor(scale * x)`` per component, in doubles while products stay exact there, else as Python
    integers."""
    if not len(vectors):
        return np.zeros((0, 0))
    values = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
    big = np.abs(values).max(initial=0.0) * scale
    if big * big * max(1, values.shape[1]) < 2.0**52:
        return np.floor(values * scale)
    exact = [[math.floor(x * scale) if abs(x) < 2.0**900 else int(x) * scale for x in row] for row in values.tolist()]
    out = np.empty(values.shape, dtype=object)
    for i, row in enumerate(exact):
        out[i] = row
    return out


def _codebook(points: np.ndarray, codes: int, cfg: MiningConfig) -> np.ndarray:
    """Lloyd's rounds from random rows; a code without points stays where it is."""
    rng = np.random.default_rng(cfg.seed)
    centres = points[rng.choice(len(points), size=min(codes, len(points)), replace=False)].copy()
    for _ in range(cfg.rounds):
        near = _nearest_code(points, centres)
        for k in range(len(centres)):
            own = points[near == k]
            if len(own):
                centres[k] = own.mean(axis=0)
    return centres


def _nearest_code(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points @ centres.T - (centres * centres).sum(axis=1) / 2).argmax(axis=1)


def half_codes(sample: np.ndarray, codes: int, cfg: MiningConfig) -> HalfCodes:
    values = sample.astype(np.float64)
    cut = values.shape[1] // 2
    return HalfCodes(_codebook(values[:, :cut], codes, cfg), _codebook(values[:, cut:], codes, cfg))


class CellIndex:
    """Rows of one block by cell, with the radius of the rows around each code."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, codes: HalfCodes):
        values = rows.astype(np.float64)
        first = _nearest_code(values[:, : codes.cut], codes.first)
        second = _nearest_code(values[:, codes.cut :], codes.second)
        order = np.lexsort((ids, second, first))
        self.rows, self.ids, self.labels = rows[order], ids[order], labels[order]
        values, first, second = values[order], first[order], second[order]
        self.codes = codes
        self.used = [np.unique(first), np.unique(second)]
        self.radius = []
        for used, code, part, book in (
            (self.used[0], first, values[:, : codes.cut], codes.first),
            (self.used[1], second, values[:, codes.cut :], codes.second),
        ):
            away = np.sqrt(((part - book[code]) ** 2).sum(axis=1))
            self.radius.append(np.array([away[code == k].max() for k in used]))
        cells = first * (len(codes.second) + 1) + second
        starts = np.flatnonzero(np.diff(cells, prepend=-1))
        self.cell = dict(
            zip(cells[starts].tolist(), zip(starts.tolist(), [*starts[1:].tolist(), len(cells)], strict=True), strict=True)
        )
        self.width = len(codes.second) + 1

    def half_bounds(self, anchors: np.ndarray) -> list[np.ndarray]:
        """Largest half score that any row with a code can have, per anchor and used code. A little is
        added for the rounding of doubles."""
        values, cut = anchors.astype(np.float64), self.codes.cut
        out = []
        for part, book, used, radius in (
            (values[:, :cut], self.codes.first, self.used[0], self.radius[0]),
            (values[:, cut:], self.codes.second, self.used[1], self.radius[1]),
        ):
            length = np.sqrt((part * part).sum(axis=1))[:, None]
            reach = np.sqrt((book[used] ** 2).sum(axis=1)) + radius
            out.append(part @ book[used].T + length * radius + 1e-9 * length * reach + 1e-6)
        return out

    def visits(self, first: np.ndarray, second: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """``(bound, start, end)`` of the cells by the multi-sequence heap, largest bound first."""
        one, two = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
        up, down = first[one].tolist(), second[two].tolist()
        rows, columns = (self.used[0][one] * self.width).tolist(), self.used[1][two].tolist()
        heap = [(-(up[0] + down[0]), 0, 0)]
        while heap:
            bound, i, j = heapq.heappop(heap)
            if j + 1 < len(down):
                heapq.heappush(heap, (-(up[i] + down[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(up):
                heapq.heappush(heap, (-(up[i + 1] + down[0]), i + 1, 0))
            inside = self.cell.get(rows[i] + columns[j])
            if inside:
                yield -bound, *inside

    def batches(self, anchor: np.ndarray, first: np.ndarray, second: np.ndarray, chunk: int) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """``(bound, places, scores)`` of cells visited one after the other, some ``chunk`` rows at a
        time; ``bound`` holds for these and all later rows."""
        places, scores, size, most = [], [], 0, None
        for bound, start, end in self.visits(first, second):
            most = bound if most is None else most
            places.append(np.arange(start, end))
            scores.append(self.rows[start:end] @ anchor)
            size += end - start
            if size >= chunk:
                yield most, np.concatenate(places), np.concatenate(scores)
                places, scores, size, most = [], [], 0, None
        if places:
            yield most, np.concatenate(places), np.concatenate(scores)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best, higher scores first, ties to smaller ids."""
    if len(scores) > 4 * k:
        limit = np.sort(scores)[-k] if scores.dtype == object else np.partition(scores, -k)[-k]
        at = np.flatnonzero(scores >= limit)
    else:
        at = np.arange(len(scores))
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


def best_of(index: CellIndex, anchors: np.ndarray, own: np.ndarray, cfg: MiningConfig) -> Iterator[tuple[int, int, int]]:
    """``(anchor place, id, score)`` of the best rows of an index, the anchors' own ids left out."""
    halves = index.half_bounds(anchors)
    for a in range(len(anchors)):
        scores, ids = np.zeros(0, dtype=index.rows.dtype), np.zeros(0, dtype=np.int64)
        for bound, places, found in index.batches(anchors[a], halves[0][a], halves[1][a], cfg.chunk):
            if len(scores) == cfg.positives and bound < scores[-1]:
                break
            other = index.ids[places] != own[a]
            scores, ids = np.concatenate([scores, found[other]]), np.concatenate([ids, index.ids[places][other]])
            at = _first(scores, ids, cfg.positives)
            scores, ids = scores[at], ids[at]
        for score, id_ in zip(scores.tolist(), ids.tolist(), strict=True):
            yield a, id_, int(score)


def window_of(score: int, cfg: MiningConfig) -> tuple[int, int]:
    """Smallest and largest score of a negative below a positive's score."""
    return -((-cfg.low * score) // 100), (cfg.high * score) // 100


def negatives_of(
    index: CellIndex, anchors: np.ndarray, labels: np.ndarray, positives: list[list[int]], cfg: MiningConfig
) -> Iterator[tuple[int, int, int, int]]:
    """``(anchor place, positive place, id, score)`` of the best rows of other labels per window. The
    search of an anchor ends when every window is certified: full, or above all that is left."""
    halves = index.half_bounds(anchors)
    for a in range(len(anchors)):
        windows = [window_of(p, cfg) for p in positives[a]]
        empty = (np.zeros(0, dtype=index.rows.dtype), np.zeros(0, dtype=np.int64))
        best = [empty if low <= high else None for low, high in windows]
        for bound, places, found in index.batches(anchors[a], halves[0][a], halves[1][a], cfg.chunk):
            open_ = [
                w for w, b in enumerate(best)
                if b is not None and bound >= windows[w][0] and not (len(b[0]) == cfg.negatives and bound < b[0][-1])
            ]
            if not open_:
                break
            other = index.labels[places] != labels[a]
            found, ids = found[other], index.ids[places][other]
            for w in open_:
                low, high = windows[w]
                inside = np.flatnonzero((found <= high) & (found >= low))
                if len(inside):
                    scores, own = np.concatenate([best[w][0], found[inside]]), np.concatenate([best[w][1], ids[inside]])
                    at = _first(scores, own, cfg.negatives)
                    best[w] = scores[at], own[at]
        for w, b in enumerate(best):
            if b is not None:
                for score, id_ in zip(b[0].tolist(), b[1].tolist(), strict=True):
                    yield a, w, id_, int(score)


_LONG = 2**63 - 1


def _long(score: int) -> int:
    return max(-_LONG - 1, min(_LONG, score))


def hard_negatives(vectors: DataFrame, is_anchor: Column, cfg: MiningConfig = MiningConfig()) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` has ``vec_id, label, embedding``; other columns are left out, whatever their names.
    Rows with a null id, label or vector or a null or non-finite component take no part; an empty
    table gives no rows. A score is the product of the vectors in steps of ``1 / scale``, an integer;
    one beyond 64 bits is shown as the nearest long. Ties go to the smaller id. Repeated rows are rows
    of their own, but no row is a partner of an anchor with its id, and of anchors with one id only
    the smallest ``(label, vector)`` asks. Vectors only meet vectors of their own length.
    """
    spark = vectors.sparkSession
    row = F.struct(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("bigint").alias("label"),
        F.col("embedding").alias("embedding"),
    )
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("embedding"))
    good = vectors.where(usable).select(row.alias("r"), F.coalesce(is_anchor, F.lit(False)).alias("asks"))
    good = kept(good.select("r.*", "asks", F.size("r.embedding").alias("dim")), "mining-rows")
    lengths = good.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if lengths is None:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
        )
    dim, total = lengths["dim"], lengths["count"]
    drawn = good.where(F.col("dim") == dim).orderBy(F.xxhash64("vec_id", F.lit(cfg.seed)), "vec_id", "label", "embedding")
    sample = scaled([r["embedding"] for r in drawn.limit(cfg.sample).select("embedding").collect()], cfg.scale)
    size = min(cfg.max_codes, max(cfg.min_codes, round(math.sqrt(total / cfg.rows_per_cell))))
    shared = share(spark, half_codes(sample, size, cfg))

    def codes_for(width: int) -> HalfCodes:
        codes = shared()
        if codes.first.shape[1] + codes.second.shape[1] == width:
            return codes
        return HalfCodes(np.zeros((1, width // 2)), np.zeros((1, width - width // 2)))

    @F.pandas_udf("first int, second int")
    def cell(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = np.zeros((len(batch), 2), dtype=np.int32)
            width = np.array([len(v) for v in batch])
            for w in np.unique(width):
                at, codes = np.flatnonzero(width == w), codes_for(int(w))
                values = scaled(batch.iloc[at].tolist(), cfg.scale).astype(np.float64)
                out[at, 0] = _nearest_code(values[:, : codes.cut], codes.first)
                out[at, 1] = _nearest_code(values[:, codes.cut :], codes.second)
            yield pd.DataFrame(out, columns=["first", "second"])

    per_block = min(cfg.max_block, max(cfg.min_block, -(-total // cfg.row_blocks)))
    celled = good.withColumn("c", cell("embedding")).select("dim", "label", "c.first", "c.second", "vec_id", "embedding")
    dealt = celled.repartitionByRange(-(-total // per_block), "dim", "label", "first", "second", "vec_id")
    rows = kept(dealt.select("dim", "label", "vec_id", "embedding", F.spark_partition_id().alias("rb")), "mining-index")
    blocks = kept(rows.groupBy("dim", "label", "rb").agg(F.count(F.lit(1)).alias("n")), "mining-blocks")

    asks = good.where("asks").groupBy("vec_id").agg(F.min(F.struct("label", "embedding")).alias("a"))
    asks = kept(
        asks.select(F.col("vec_id").alias("anchor_id"), "a.*", F.size("a.embedding").alias("dim")), "mining-anchors"
    )
    anchor_blocks = -(-asks.count() // cfg.anchor_block)
    dealt_at = F.pmod(F.xxhash64("anchor_id"), F.lit(max(1, anchor_blocks))).cast("int")
    asks = asks.withColumn("ab", dealt_at)

    # anchors of a label meet the blocks that hold it, and only its rows there
    groups = asks.select("dim", "label", "ab").distinct().join(blocks.select("dim", "label", "rb"), ["dim", "label"])
    keys = ["dim", "label", "ab", "rb"]
    near_rows = rows.join(groups, ["dim", "label", "rb"])
    near_asks = asks.join(groups, ["dim", "label", "ab"])

    def positives(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(r):
            index = _index(r, codes_for(int(r["dim"].iloc[0])), cfg)
            anchors, own = scaled(a["embedding"].tolist(), cfg.scale), a["anchor_id"].to_numpy()
            out = [(int(own[i]), id_, _long(score), str(score)) for i, id_, score in best_of(index, anchors, own, cfg)]
        return pd.DataFrame(out, columns=["anchor_id", "positive_id", "positive_score", "exact"])

    found = (
        near_asks.groupBy(*keys).cogroup(_anew(near_rows).groupBy(*keys))
        .applyInPandas(positives, "anchor_id long, positive_id long, positive_score long, exact string")
    )
    score = F.col("positive_score")
    order = W.partitionBy("anchor_id").orderBy(F.desc(score), "positive_id")
    top = found.withColumn("place", F.row_number().over(order) - 1).where(F.col("place") < cfg.positives)
    top = kept(top, "mining-positives")
    windows = top.groupBy("anchor_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("place", "exact"))), lambda p: p["exact"]).alias("scores")
    )

    # anchors meet every block that holds another label
    wide = kept(asks.join(windows, "anchor_id"), "mining-windows")
    others = blocks.select("dim", "rb").distinct()
    met = wide.select("dim", "ab").distinct().join(others, "dim")
    keys = ["dim", "ab", "rb"]

    def negatives(a: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(a) and len(r):
            index = _index(r, codes_for(int(r["dim"].iloc[0])), cfg)
            anchors, own = scaled(a["embedding"].tolist(), cfg.scale), a["anchor_id"].to_numpy()
            limits = [[int(s) for s in scores] for scores in a["scores"]]
            for i, place, id_, score in negatives_of(index, anchors, a["label"].to_numpy(), limits, cfg):
                out.append((int(own[i]), place, id_, _long(score)))
        return pd.DataFrame(out, columns=["anchor_id", "place", "negative_id", "negative_score"])

    hard = (
        wide.join(met, ["dim", "ab"]).groupBy(*keys)
        .cogroup(_anew(rows.join(met, ["dim", "rb"])).groupBy(*keys))
        .applyInPandas(negatives, "anchor_id long, place int, negative_id long, negative_score long")
    )
    order = W.partitionBy("anchor_id", "place").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= cfg.negatives)
    return ranked.join(top.drop("exact"), ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )


def _anew(df: DataFrame) -> DataFrame:
    """The frame with column names of its own, so that it can meet one made from the same tables."""
    return df.toDF(*df.columns)


def _index(r: pd.DataFrame, codes: HalfCodes, cfg: MiningConfig) -> CellIndex:
    return CellIndex(
        scaled(r["embedding"].tolist(), cfg.scale), r["vec_id"].to_numpy(), r["label"].to_numpy(), codes
    )
