"""Approximate nearest neighbours through learned partitions.

A bounded sample of the vectors gives an exact neighbour graph. The graph is cut into parts of equal
size with as few edges across as a local search finds, and a small softmax classifier learns to tell
a vector's part. All rows are placed by the classifier; a query goes to its most probable parts,
as many as a held-out piece of the sample needs for the wanted recall, and the rows there are ranked
by exact cosine.

Parts are cut into blocks of bounded size for both queries and rows, so no task holds a part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from stratalog.llm.common import kept, share


@dataclass(frozen=True)
class NeighbourConfig:
    """The model is fitted on at most ``per_part * max_parts`` vectors; everything is indexed."""

    k: int = 5
    rows_per_part: int = 4_096
    min_parts: int = 8
    max_parts: int = 256
    per_part: int = 256
    graph_degree: int = 10
    sweeps: int = 8
    slack: float = 0.05
    steps: int = 300
    recall: float = 0.95
    row_block: int = 16_384
    query_block: int = 4_096
    seed: int = 7


@dataclass(frozen=True)
class Router:
    """``weights`` and ``bias`` of the classifier, and how many parts a query visits."""

    weights: np.ndarray
    bias: np.ndarray
    probes: int

    def ranked(self, units: np.ndarray) -> np.ndarray:
        """Parts of each vector, most probable first."""
        return np.argsort(-(units @ self.weights + self.bias), axis=1, kind="stable")


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, and not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _neighbours(units: np.ndarray, base: np.ndarray, degree: int, own: bool) -> np.ndarray:
    """Places in ``base`` of the nearest of each unit vector, itself left out if it is in there."""
    out = np.zeros((len(units), min(degree, max(1, len(base) - own))), dtype=np.int64)
    for start in range(0, len(units), 1_024):
        near = units[start : start + 1_024] @ base.T
        if own:
            near[np.arange(len(near)), start + np.arange(len(near))] = -np.inf
        out[start : start + len(near)] = np.argpartition(-near, out.shape[1] - 1, axis=1)[:, : out.shape[1]]
    return out


def balanced_parts(units: np.ndarray, graph: np.ndarray, parts: int, cfg: NeighbourConfig) -> np.ndarray:
    """Parts of nearly equal size with few graph edges between them.

    Begins with repeated halving along the widest of a few random directions, then moves nodes to
    the part that holds most of their neighbours while that part has room.
    """
    rng = np.random.default_rng(cfg.seed)
    part = np.zeros(len(units), dtype=np.int64)
    pieces = [(np.arange(len(units)), 0, parts)]
    while pieces:
        members, first, count = pieces.pop()
        part[members] = first
        if count == 1:
            continue
        lines = units[members] @ rng.standard_normal((units.shape[1], 8))
        along = lines[:, lines.var(axis=0).argmax()] if len(members) else lines[:, 0]
        order = members[np.argsort(along, kind="stable")]
        cut = len(order) * (count // 2) // count
        pieces += [(order[:cut], first, count // 2), (order[cut:], first + count // 2, count - count // 2)]
    room = int(np.ceil(len(units) / parts * (1 + cfg.slack)))
    ends = np.concatenate([graph.ravel(), np.repeat(np.arange(len(units)), graph.shape[1])])
    begins = np.concatenate([np.repeat(np.arange(len(units)), graph.shape[1]), graph.ravel()])
    size = np.bincount(part, minlength=parts)
    for _ in range(cfg.sweeps):
        links = np.zeros((len(units), parts), dtype=np.int32)
        np.add.at(links, (begins, part[ends]), 1)
        here = links[np.arange(len(units)), part]
        best = links.argmax(axis=1)
        gain = links.max(axis=1) - here
        moved = 0
        for node in np.argsort(-gain, kind="stable"):
            if gain[node] <= 0:
                break
            to = best[node]
            if size[to] < room:
                size[part[node]] -= 1
                size[to] += 1
                part[node] = to
                moved += 1
        if not moved:
            break
    return part


def fitted(sample: np.ndarray, parts: int, cfg: NeighbourConfig) -> Router:
    """Classifier on the sample's parts; an eighth of the sample is held out to count the probes."""
    units = _units(sample)
    held = max(1, len(units) // 8) if len(units) > 8 else 0
    check, units = units[:held], units[held:]
    graph = _neighbours(units, units, cfg.graph_degree, own=True)
    part = balanced_parts(units, graph, parts, cfg)
    # a vector's target is spread over its own part and those of its neighbours
    target = np.zeros((len(units), parts))
    np.add.at(target, (np.arange(len(units)), part), 1.0)
    for column in graph.T:
        np.add.at(target, (np.arange(len(units)), part[column]), 1.0 / graph.shape[1])
    target /= target.sum(axis=1, keepdims=True)
    weights, bias = np.zeros((units.shape[1], parts)), np.zeros(parts)
    speed = [np.zeros_like(weights), np.zeros_like(bias)]
    for _ in range(cfg.steps):
        logits = units @ weights + bias
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        off = odds / odds.sum(axis=1, keepdims=True) - target
        for one, (value, slope) in enumerate(((weights, units.T @ off / len(units)), (bias, off.mean(axis=0)))):
            speed[one] = 0.9 * speed[one] - (4.0 if one == 0 else 0.5) * slope
            value += speed[one]
    model = Router(weights, bias, parts)
    if not held:
        return model
    placed = model.ranked(units)[:, 0]
    order = model.ranked(check)
    near = placed[_neighbours(check, units, cfg.k, own=False)]
    depth = np.argsort(order, axis=1)[np.arange(held)[:, None], near]
    reached = [(depth < t).mean() for t in range(1, parts + 1)]
    return Router(weights, bias, int(np.searchsorted(reached, cfg.recall)) + 1 if reached[-1] >= cfg.recall else parts)


def exact_cosine(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Cosine of one vector with each row; equal rows get equal values."""
    return (rows * query).sum(axis=1) / (np.sqrt((query * query).sum()) * np.sqrt((rows * rows).sum(axis=1)))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.float64) if len(column) else np.zeros((0, 0))


def _best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """The k nearest rows of a block for each query. A fast product finds all that may be among
    them, ties included; those get their exact cosine."""
    out: list[tuple[int, int, float]] = []
    if len(queries) and len(rows):
        base, ids = _matrix(rows["embedding"]), rows["vec_id"].to_numpy()
        units = _units(base)
        asked, own = _matrix(queries["embedding"]), queries["query_id"].to_numpy()
        for start in range(0, len(asked), 512):
            near = _units(asked[start : start + 512]) @ units.T
            near[own[start : start + 512, None] == ids[None, :]] = -np.inf
            depth = min(k, near.shape[1])
            floor = np.partition(near, -depth, axis=1)[:, -depth]
            for i, limit in enumerate(floor):
                at = np.flatnonzero(near[i] >= max(limit - 1e-9, -2.0))
                cosine = exact_cosine(asked[start + i], base[at])
                order = np.lexsort((ids[at], -cosine))[:k]
                out += [(int(own[start + i]), int(ids[at[o]]), float(cosine[o])) for o in order]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def nearest(
    vectors: DataFrame, is_query: Column, cfg: NeighbourConfig = NeighbourConfig()
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest found for each query, ties to smaller ids.

    ``vectors`` has ``vec_id, embedding``. Vectors that are null, zero or hold null or non-finite
    components take no part, nor do null ids. Vectors of another length than the most common one
    only meet their own length, all of them. A row is no neighbour of a query with its id; of
    queries with one id, the smallest vector asks. Repeated rows are rows of their own.
    """
    spark = vectors.sparkSession
    good = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    good = good.withColumn("embedding", F.col("embedding").cast("array<double>"))
    lengths = good.groupBy(F.size("embedding").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim, total = common["d"], common["count"]
    parts = min(cfg.max_parts, max(cfg.min_parts, total // cfg.rows_per_part))
    drawn = good.where(F.size("embedding") == dim).orderBy(F.xxhash64("vec_id", F.lit(cfg.seed)), "vec_id", "embedding")
    sample = _matrix(pd.Series([r["embedding"] for r in drawn.limit(parts * cfg.per_part).select("embedding").collect()]))
    router = fitted(sample, parts, cfg)
    shared = share(spark, router)

    def routed(depth: int):
        @F.pandas_udf("array<int>")
        def route(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            router = shared()
            for batch in batches:
                out = np.empty(len(batch), dtype=object)
                width = np.array([len(v) for v in batch])
                for at in np.flatnonzero(width != dim):
                    out[at] = [-int(width[at])]
                if len(fit := np.flatnonzero(width == dim)):
                    order = router.ranked(_units(_matrix(batch.iloc[fit])))[:, :depth]
                    for at, row in zip(fit, order.astype(np.int32).tolist(), strict=True):
                        out[at] = row
                yield pd.Series(out)

        return route

    placed = kept(good.withColumn("part", F.element_at(routed(1)("embedding"), 1)), "neighbour-rows")
    asked = good.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    asked = asked.select(F.col("vec_id").alias("query_id"), "embedding")
    asked = kept(asked.withColumn("part", F.explode(routed(router.probes)("embedding"))), "neighbour-queries")
    row_n = placed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / cfg.row_block).alias("row_blocks"))
    ask_n = asked.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / cfg.query_block).alias("ask_blocks"))
    blocks = F.broadcast(kept(row_n.join(ask_n, "part"), "neighbour-blocks"))  # a row per part or length

    def other(count: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(count) - 1))

    rows = (
        placed.join(blocks, "part")
        .withColumn("rb", F.pmod(F.xxhash64("vec_id", "embedding"), F.col("row_blocks")))
        .withColumn("qb", other("ask_blocks"))
    ).select("part", "rb", "qb", "vec_id", "embedding")
    queries = (
        asked.join(blocks, "part")
        .withColumn("qb", F.pmod(F.xxhash64("query_id"), F.col("ask_blocks")))
        .withColumn("rb", other("row_blocks"))
    ).select("part", "rb", "qb", "query_id", "embedding")
    k = cfg.k
    keys = ["part", "rb", "qb"]
    found = (
        queries.groupBy(*keys)
        .cogroup(rows.groupBy(*keys))
        .applyInPandas(lambda q, r: _best(q, r, k), "query_id long, vec_id long, score double")
    )
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
