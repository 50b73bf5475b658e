"""Fixed lifetimes: a period begins at a row and covers the rows up to ``ttl`` later.

The next period begins at the first row strictly more than ``ttl`` after the start of the last one.
It is not a gap session, so a start depends on the start before it. Over a block of ordered times the
last start is a function of the last start before the block: only the times up to ``ttl`` after the
block's first can be its first start, and each of them has one last start. These functions of the blocks
of a key are composed by doubling; a key that is not cut is one block. So one way serves keys of any
size, null keys too.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.config import SkewConfig
from stratalog.functions.times import micros
from stratalog.operators.skew import BLOCK, join_on_keys, last_known, mark_blocks, scan
from stratalog.session import scratch_path, shared_root
from stratalog.sources.chat_files import staged

_ANY = -(2**63)  # a block that begins with its first row


def group_starts(batch: pa.RecordBatch, columns: list[str], before: pa.RecordBatch | None) -> list[int]:
    """Rows of a sorted batch where a new group of equal columns begins; ``before`` is the row ahead."""
    n = batch.num_rows
    new = np.zeros(n, dtype=bool)
    for name in columns:
        column = batch.column(name)
        first = pa.nulls(1, column.type) if before is None else before.column(name)
        last = pa.concat_arrays([first, column.slice(0, n - 1)])
        differs = pc.fill_null(pc.not_equal(column, last), False)
        new |= differs.to_numpy(zero_copy_only=False)
        new |= pc.xor(pc.is_null(column), pc.is_null(last)).to_numpy(zero_copy_only=False)
    if before is None and n:
        new[0] = True
    return np.flatnonzero(new).tolist()


def walk(times: list[int], begin: int, end: int, after: int, ttl: int) -> list[int]:
    """Places of the starts among sorted times: the first one above ``after``, then always the first
    more than ``ttl`` later."""
    out = []
    at = bisect_right(times, after, begin, end)
    while at < end:
        out.append(at)
        at = bisect_right(times, times[at] + ttl, at, end)
    return out


def last_starts(times: np.ndarray, ttl: int) -> tuple[np.ndarray, np.ndarray]:
    """The times that can be a block's first start, and the last start of the block for each."""
    entries = int(np.searchsorted(times, times[0] + ttl, "right")) + 1
    following = np.searchsorted(times, times + ttl, "right").tolist()
    last = list(range(len(times)))
    for i in range(len(times) - 1, -1, -1):
        if following[i] < len(times):
            last[i] = last[following[i]]
    return times[:entries], times[last[:entries]]


def _grouped(keys: list[str], emit: Callable) -> Callable:
    """Task function over rows sorted by ``keys``: ``emit(row, times)`` per group, whole."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, head, held = None, None, []
        for batch in batches:
            times = batch.column("t").to_numpy()
            at = 0
            for start in [*group_starts(batch, keys, before), batch.num_rows]:
                if start > at:
                    held.append(times[at:start])
                if start < batch.num_rows:
                    if held:
                        yield emit(head, np.concatenate(held))
                    head, held = batch.slice(start, 1), []
                at = start
            before = batch.slice(batch.num_rows - 1, 1) if batch.num_rows else before
        if held:
            yield emit(head, np.concatenate(held))

    return run


def _entries(blocks: DataFrame, keys: list[str], ttl: int, skew: SkewConfig) -> DataFrame:
    """``(keys, block, entry)``: the first start in each block that has one, for keys in blocks."""
    spark = blocks.sparkSession
    shared_root(spark)
    columns = [*keys, BLOCK]

    def emit(row: pa.RecordBatch, times: np.ndarray) -> pa.RecordBatch:
        first, last = last_starts(times, ttl)
        same = row.select(columns).take(pa.array(np.zeros(len(first), dtype=np.int64)))
        return pa.record_batch([*same.columns, pa.array(first), pa.array(last)], names=[*columns, "t", "last"])

    kinds = blocks.select(*columns, "t").schema.add("last", "long")
    ends = blocks.select(*columns, "t").repartition(*columns).sortWithinPartitions(*columns, "t").mapInArrow(
        _grouped(columns, emit), kinds
    )
    ends = staged(ends.distinct(), scratch_path(spark, "lifetime-blocks"))
    # from a possible first start to the next block's: the first one more than ttl after the last start
    asks = ends.select(
        *keys, (-(F.col("last") + ttl)).alias("_o"), F.lit(0).alias("_k"), F.col("t").alias("_from"),
        F.lit(None).cast("bigint").alias("_at"),
    )
    marks = ends.select(
        *keys, (-F.col("t")).alias("_o"), F.lit(1).alias("_k"), F.lit(None).cast("bigint").alias("_from"), F.col("t").alias("_at"),
    )
    # descending order: the latest row seen is the next time up; an ask precedes an equal time
    linked = scan(asks.unionByName(marks), keys, ["_o", "_k", "_from"], skew, nxt=last_known(F.col("_at")))
    jump = linked.where("_k = 0 and nxt is not null").select(*keys, F.col("_from").alias("t"), "nxt").checkpoint()
    found = ends.groupBy(*keys).agg(F.min("t").alias("t")).checkpoint()
    while not jump.isEmpty():
        reached = join_on_keys(found, jump, [*keys, "t"]).select(*keys, F.col("nxt").alias("t"))
        found = found.unionByName(reached).checkpoint()
        ahead = jump.select(*keys, F.col("t").alias("nxt"), F.col("nxt").alias("_nn"))
        jump = join_on_keys(jump, ahead, [*keys, "nxt"]).select(*keys, "t", F.col("_nn").alias("nxt")).checkpoint()
    placed = join_on_keys(ends.select(*columns, "t").distinct(), found.distinct(), [*keys, "t"], "left_semi")
    # of two blocks with the same time the first one holds the start
    return placed.groupBy(*keys, F.col("t").alias("entry")).agg(F.min(BLOCK).alias(BLOCK))


def lifetime_starts(
    df: DataFrame, keys: list[str], time: str, ttl_seconds: int, skew: SkewConfig = SkewConfig()
) -> DataFrame:
    """``(keys, t)`` with the start of every period in microseconds; rows without a time are left out.

    Keys with more rows than a task should order are cut into blocks; from the functions of the blocks
    follows where each one begins, and then all blocks are walked at once.
    """
    ttl = ttl_seconds * 1_000_000
    times = df.select(*keys, micros(time).alias("t")).where("t is not null")
    # the number spreads rows of one time over blocks
    numbered = times.withColumn("_n", F.monotonically_increasing_id())
    marked = mark_blocks(numbered, keys, ["t", "_n"], skew, times)
    if BLOCK in marked.columns:
        entries = _entries(marked.where(F.col(BLOCK) >= 0), keys, ttl, skew)
        known = join_on_keys(marked, entries, [*keys, BLOCK], "left")
        rows = known.where(F.col(BLOCK).eqNullSafe(F.lit(-1)) | F.col("entry").isNotNull())
        rows = rows.select(*keys, BLOCK, "t", F.coalesce("entry", F.lit(_ANY)).alias("entry"))
    else:
        rows = marked.select(*keys, F.lit(-1).cast("bigint").alias(BLOCK), "t", F.lit(_ANY).alias("entry"))
    columns = [*keys, BLOCK]

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, after = None, _ANY
        for batch in batches:
            times = batch.column("t").to_pylist()
            opened = group_starts(batch, columns, before)
            cuts = [*([0] if not opened or opened[0] else []), *opened, len(times)]
            found = []
            for a, b in zip(cuts, cuts[1:], strict=False):
                if opened and a >= opened[0]:
                    entry = batch.column("entry")[a].as_py()
                    a, after = (bisect_left(times, entry, a, b), _ANY) if entry > _ANY else (a, _ANY)
                own = walk(times, a, b, after, ttl)
                if own:
                    found += own
                    after = times[own[-1]] + ttl
            if len(times):
                before = batch.slice(len(times) - 1, 1)
                yield batch.select([*keys, "t"]).take(pa.array(found, pa.int64()))

    sorted_ = rows.repartition(*columns).sortWithinPartitions(*columns, "t")
    return sorted_.mapInArrow(starts, rows.select(*keys, "t").schema)


def interleaved(df: DataFrame, keys: list[str], time: str, starts: DataFrame) -> DataFrame:
    """The rows (``_mark`` 1) and one marker row per period start (``_mark`` 0, time in ``_start``).

    Ordered by ``(time, _mark)``, the last known ``_start`` is the period of a row: the lookup rides
    on the shuffle of the ordered scan instead of needing a join.
    """
    rows = df.withColumns(
        {"_mark": F.lit(1), "_start": F.lit(None).cast("bigint"), time: F.col(time).cast("timestamp")}
    )
    marks = starts.select(
        *keys, F.timestamp_micros("t").alias(time), F.lit(0).alias("_mark"), F.col("t").alias("_start")
    )
    return rows.unionByName(marks, allowMissingColumns=True)
