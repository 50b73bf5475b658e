from __future__ import annotations

import os
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratalog.llm import neighbours as N
from stratalog.llm.neighbours import NeighbourConfig

SF = "/root/testdata/sf0.1"


def brute(rows, asked, k=5):
    good = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v]
    good = [(i, v) for i, v in good if np.isfinite(v).all() and v.any()]
    out = {}
    for q, x in sorted(good, key=lambda r: (r[0], r[1].tolist()), reverse=True):
        if asked(q):
            near = [(-float((x * v).sum() / (np.sqrt((x * x).sum()) * np.sqrt((v * v).sum()))), i) for i, v in good if i != q and len(v) == len(x)]
            out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


@pytest.mark.skipif(not os.path.isdir(SF), reason="no tables here")
def test_recall_on_real_vectors(spark):
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding")
    got = defaultdict(list)
    for r in N.nearest(vectors, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = brute([tuple(r) for r in vectors.collect()], lambda q: q % 50 == 0)
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    for q in want:
        scores = dict(want[q])
        assert all(abs(s - scores[i]) < 1e-12 for i, s in got[q] if i in scores)


def test_hard_rows(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(1, 300)]
    rows += [(400 + i, rows[0][1]) for i in range(80)]  # ties
    rows += [(50, rows[0][1]), (50, rows[3][1]), (51, rows[7][1]), (51, rows[7][1])]
    rows += [(600, None), (601, [0.0] * 8), (602, [float("nan")] + [1.0] * 7), (603, [None] + [1.0] * 7), (604, [float("inf")] * 8)]
    rows += [(605, []), (None, [1.0] * 8), (650, [1.0, 2.0]), (651, [2.0, 1.0]), (700, [3.0, 1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, part string, rank int")
    cfg = NeighbourConfig(recall=1.0, min_parts=4, row_block=50, query_block=3)
    got = defaultdict(list)
    for r in N.nearest(df, F.col("vec_id") % 50 == 0, cfg).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    want = brute(rows, lambda q: q % 50 == 0)
    want = {q: v for q, v in want.items() if v}
    every = {q for q in want if q != 50}
    assert got.keys() == want.keys()
    hits = sum(len(set(got[q]) & set(want[q])) for q in every)
    assert hits >= 0.9 * sum(len(want[q]) for q in every)
    assert got[650] == want[650] and 700 not in got
    assert got[400] == want[400] and [i for i, _ in got[400]] == sorted(i for i, _ in got[400])
    assert N.nearest(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_parts_are_balanced():
    rng = np.random.default_rng(4)
    units = N._units(rng.standard_normal((800, 16)))
    cfg = NeighbourConfig()
    graph = N._neighbours(units, units, 10, own=True)
    part = N.balanced_parts(units, graph, 12, cfg)
    sizes = Counter(part.tolist())
    assert len(sizes) == 12 and max(sizes.values()) <= np.ceil(800 / 12 * 1.05)
    across = (part[graph] != part[:, None]).mean()
    assert across < 11 / 12
