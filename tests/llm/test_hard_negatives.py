from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalog.llm import hard_negatives as H
from stratalog.llm.hard_negatives import MiningConfig

COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, asked):
    good = [
        (i, c, [math.floor(256 * x) for x in v]) for i, c, v in rows
        if i is not None and c is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    anchors = {}
    for i, c, v in good:
        if asked(i):
            anchors.setdefault(i, []).append((c, v))
    for a, own in anchors.items():
        label, x = min(own)
        scored = [(-sum(p * q for p, q in zip(x, v)), i, c) for i, c, v in good if i != a and len(v) == len(x)]
        near = sorted((s, i) for s, i, c in scored if c == label)[:5]
        for s, i in near:
            inside = sorted((t, j) for t, j, c in scored if c != label and 50 * -s <= 100 * -t <= 95 * -s)
            out += [(a, i, k + 1, j, -s, -t) for k, (t, j) in enumerate(inside[:3])]
    return sorted(out)


def frame(spark, rows):
    kind = "vec_id long, label int, embedding array<double>, rank string, first int, r string"
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], kind)


def got(df, **cfg):
    found = H.hard_negatives(df, F.col("vec_id") % 50 == 0, MiningConfig(**cfg))
    return sorted(tuple(r[c] for c in COLUMNS) for r in found.collect())


@pytest.mark.parametrize("spread", [0.0, 6.0])
def test_equal_to_brute_force(spark, spread):
    """Vectors without any order, and vectors in groups, where the search stops early."""
    rng = np.random.default_rng(5)
    middle = rng.standard_normal((6, 8)) * spread
    rows = [(i, int(rng.integers(4)), (rng.standard_normal(8) + middle[i % 6]).tolist()) for i in range(400)]
    rows += [(500 + i, i % 3, rows[50][2]) for i in range(60)]  # one vector many times: ties by id
    cfg = {"min_codes": 5, "min_block": 40, "anchor_block": 3, "chunk": 16}
    assert got(frame(spark, rows), **cfg) == brute(rows, lambda i: i % 50 == 0)


def test_hard_rows(spark):
    rng = np.random.default_rng(6)
    rows = [(i, i % 2, rng.random(4).tolist()) for i in range(90)]
    rows += [(100, None, [1.0] * 4), (101, 1, None), (102, 1, [None] * 4), (103, 0, [float("nan")] + [1.0] * 3)]
    rows += [(104, 0, [float("inf")] * 4), (None, 0, [1.0] * 4), (105, 0, []), (150, 1, []), (200, 0, [0.5, 0.5])]
    rows += [(201, 0, [0.5, 0.75]), (202, 1, [0.25, 0.5]), (250, 7, [0.0] * 4), (251, 0, [0.0] * 4)]
    rows += [(300, 0, rows[0][2]), (52, 1, rows[52][2])]  # an equal vector, and a row that comes twice
    want = brute(rows, lambda i: i % 50 == 0)
    assert got(frame(spark, rows), min_block=20) == want and any(r[0] == 200 for r in want)
    assert got(frame(spark, rows[:0])) == [] and got(frame(spark, [(101, 1, None)])) == []


def test_scores_beyond_doubles():
    """Products that doubles cannot hold are exact all the same."""
    vectors = [[1e12 + 1, 3.0], [1e12, 2.0], [1e12 - 1, 5.0]]
    values = H.scaled(vectors, 256)
    assert values.dtype == object and values[0].tolist() == [256 * (10**12 + 1), 768]
    codes = H.half_codes(values, 2, MiningConfig())
    index = H.CellIndex(values, np.arange(3), np.zeros(3, dtype=int), codes)
    best = list(H.best_of(index, values[:1], np.array([0]), MiningConfig()))
    exact = [sum(p * q for p, q in zip(values[0], values[k])) for k in (1, 2)]
    assert [(i, s) for _, i, s in best] == [(1, exact[0]), (2, exact[1])]


def test_cells_come_by_bound_and_far_ones_are_left():
    """Bounds hold for every row, fall from visit to visit, and spare the search most of the cells."""
    rng = np.random.default_rng(8)
    values = np.floor(256 * (rng.standard_normal((3_000, 8)) * 0.1 + rng.standard_normal((30, 8))[rng.integers(30, size=3_000)]))
    cfg = MiningConfig(chunk=16)
    index = H.CellIndex(values, np.arange(3_000), np.zeros(3_000, dtype=int), H.half_codes(values, 24, cfg))
    first, second = index.half_bounds(values[:5])
    seen = 0
    for a in range(5):
        last = np.inf
        rows = 0
        for bound, start, end in index.visits(first[a], second[a]):
            assert bound <= last and (index.rows[start:end] @ values[a] <= bound).all()
            last, rows = bound, rows + end - start
        assert rows == 3_000
        read = []
        counted = H.CellIndex.batches

        def batches(self, *args):
            for b in counted(self, *args):
                read.append(len(b[1]))
                yield b

        H.CellIndex.batches = batches
        try:
            list(H.best_of(index, values[a : a + 1], np.array([a]), cfg))
        finally:
            H.CellIndex.batches = counted
        seen += sum(read)
    assert seen < 0.5 * 5 * 3_000
