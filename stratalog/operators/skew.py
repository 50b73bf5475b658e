"""Ordered per-key computations that do not depend on how rows are spread over keys.

A window over one key runs in one task. So keys are counted first; those with more rows than a task
should order are cut into blocks of consecutive order values. The window then runs inside
``(key, block)`` and the state entering each block is carried in from a summary with one row per hot
block. Without hot keys the plan is the plain window.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from stratalog.config import SkewConfig
from stratalog.session import scratch_path
from stratalog.sources.chat_files import staged

BLOCK = "_block"


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on columns of the same name where a null key meets a null key; the columns come once."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"_right_{k}"]) for k in keys])
    return left.join(other, same, how).drop(*[f"_right_{k}" for k in keys])


def mark_blocks(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    cfg: SkewConfig = SkewConfig(),
    probe: DataFrame | None = None,
) -> DataFrame:
    """The frame as it is if no key is hot, else with ``_block``: -1 for ordinary keys, 0.. for
    consecutive parts of hot ones.

    A pre-aggregated count over the key columns finds the keys with more than ``cfg.max_rows`` rows.
    The rows of hot keys are dealt by ranges over keys and all order columns, so equal times do not
    pile up in one range. A range is a task, so their number follows ``cfg.task_rows`` and the tasks of
    a shuffle, however small the blocks are; its sorted rows are cut at every ``max_rows``. They are
    written to the shared folder, since the ranges come from a sample and every later use must see
    the same ones. ``probe`` is a cheaper frame with the same keys to count.
    """
    probe = df if probe is None else probe
    counts = probe.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where(F.col("_n") > cfg.max_rows)
    total = hot.agg(F.sum("_n")).first()[0]
    if not total:
        return df
    names = hot.select(*keys)
    tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(total / cfg.task_rows))
    ranges = min(math.ceil(total / cfg.max_rows), tasks)
    dealt = join_on_keys(df, names, keys, "left_semi").repartitionByRange(ranges, *keys, *order)
    # the number of a row rises inside a range and over the ranges, so no two of them share a block
    number = F.expr(f"monotonically_increasing_id() div {cfg.max_rows}")
    cut = dealt.sortWithinPartitions(*keys, *order).withColumn(BLOCK, number)
    cut = staged(cut, scratch_path(df.sparkSession, "blocks"))
    plain = join_on_keys(df, names, keys, "left_anti").withColumn(BLOCK, F.lit(-1).cast("bigint"))
    return plain.unionByName(cut)


@dataclass(frozen=True)
class Scan:
    """One running column: its value inside a block, the block's summary, and how they join."""

    kind: str
    value: Column
    size: int = 1


def lag(value: Column) -> Scan:
    """Value of the previous row of the key."""
    return Scan("lag", value)


def running_sum(value: Column) -> Scan:
    return Scan("sum", value)


def position() -> Scan:
    """1-based position of the row in its key."""
    return Scan("sum", F.lit(1).cast("bigint"))


def last_known(value: Column) -> Scan:
    """Latest non-null value up to and including the row."""
    return Scan("last", value)


def running_min(value: Column) -> Scan:
    return Scan("min", value)


def tail(value: Column, size: int) -> Scan:
    """The ``size`` values before the row as an array; ``value`` must not be null."""
    return Scan("tail", value, size)


def _local(s: Scan, w) -> Column:
    upto = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    if s.kind == "lag":
        return F.lag(s.value).over(w)
    if s.kind == "sum":
        return F.sum(s.value).over(upto)
    if s.kind == "last":
        return F.last(s.value, ignorenulls=True).over(upto)
    if s.kind == "min":
        return F.min(s.value).over(upto)
    return F.collect_list(s.value).over(w.rowsBetween(-s.size, -1))


def _summary(s: Scan, at: Column) -> Column:
    if s.kind == "lag":
        return F.max_by(F.struct(s.value.alias("v")), at)
    if s.kind == "sum":
        return F.sum(s.value)
    if s.kind == "last":
        return F.max_by(s.value, F.when(s.value.isNotNull(), at))
    if s.kind == "min":
        return F.min(s.value)
    # only the last rows of a block reach this aggregate, see scan()
    return F.transform(
        F.sort_array(F.collect_list(F.struct(at.alias("at"), s.value.alias("v")))), lambda x: x.v
    )


def _carry(s: Scan, name: str, w) -> Column:
    before = w.rowsBetween(W.unboundedPreceding, -1)
    if s.kind == "lag":
        return F.lag(name).over(w)
    if s.kind == "sum":
        return F.sum(name).over(before)
    if s.kind == "last":
        return F.last(name, ignorenulls=True).over(before)
    if s.kind == "min":
        return F.min(name).over(before)
    # a block may be shorter than the tail, so as many blocks back as the tail is long
    return F.flatten(F.collect_list(name).over(w.rowsBetween(-s.size, -1)))


def _merge(s: Scan, local: Column, carry: Column, first: Column) -> Column:
    if s.kind == "lag":
        return F.when(first & carry.isNotNull(), carry["v"]).otherwise(local)
    if s.kind == "sum":
        return local + F.coalesce(carry, F.lit(0))
    if s.kind == "last":
        return F.coalesce(local, carry)
    if s.kind == "min":
        return F.least(local, carry)
    joined = F.when(carry.isNull(), local).otherwise(F.concat(carry, local))
    return F.when(F.size(joined) > s.size, F.slice(joined, -s.size, s.size)).otherwise(joined)


def scan(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    cfg: SkewConfig = SkewConfig(),
    **columns: Scan,
) -> DataFrame:
    """Add running columns over ``keys`` in the order of ``order``, hot keys cut into blocks."""
    marked = mark_blocks(df, keys, order, cfg)
    return scan_marked(marked, keys, order, **columns).drop(BLOCK)


def scan_marked(df: DataFrame, keys: list[str], order: list[str], **columns: Scan) -> DataFrame:
    """Like :func:`scan` for a frame that :func:`mark_blocks` has already looked at.

    Several scans in a row share one count, and one shuffle.
    """
    if BLOCK not in df.columns:
        w = W.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[_local(s, w).alias(n) for n, s in columns.items()])

    part = W.partitionBy(*keys, BLOCK)
    w = part.orderBy(*order)
    at = F.struct(*order)
    local = df.select(
        "*",
        F.row_number().over(w).alias("_pos"),
        *[_local(s, w).alias(f"_l_{n}") for n, s in columns.items()],
    )

    hot = df.where(F.col(BLOCK) >= 0)
    plain = {n: s for n, s in columns.items() if s.kind != "tail"}
    tails = {n: s for n, s in columns.items() if s.kind == "tail"}
    across = W.partitionBy(*keys).orderBy(BLOCK)
    summary = hot.groupBy(*keys, BLOCK).agg(
        F.count(F.lit(1)).alias("_rows"), *[_summary(s, at).alias(n) for n, s in plain.items()]
    )
    if tails:
        deepest = max(s.size for s in tails.values())
        back = part.orderBy(*[F.col(c).desc() for c in order])
        ends = (
            hot.withColumn("_back", F.row_number().over(back))
            .where(F.col("_back") <= deepest)
            .groupBy(*keys, BLOCK)
            .agg(*[_summary(s, at).alias(n) for n, s in tails.items()])
        )
        summary = join_on_keys(summary, ends, [*keys, BLOCK])
    carries = summary.select(
        *keys, BLOCK, *[_carry(s, n, across).alias(f"_c_{n}") for n, s in columns.items()]
    )
    joined = join_on_keys(local, carries, [*keys, BLOCK], "left")
    first = F.col("_pos") == 1
    return joined.select(
        *df.columns,
        *[
            _merge(s, F.col(f"_l_{n}"), F.col(f"_c_{n}"), first).alias(n)
            for n, s in columns.items()
        ],
    )


def top_per_group(
    df: DataFrame, keys: list[str], order: list[Column], k: int, spread: list[str], salts: int = 64
) -> DataFrame:
    """The first ``k`` rows of each group, adding ``rank``.

    Two rounds: per ``(group, salt)`` and then per group over at most ``k * salts`` rows, so a hot
    group is ranked by many tasks. The salt comes from the row's id columns and is repeatable.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts))
    first = W.partitionBy(*keys, "_salt").orderBy(*order)
    final = W.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_salt", salt)
        .withColumn("rank", F.row_number().over(first))
        .where(F.col("rank") <= k)
        .withColumn("rank", F.row_number().over(final))
        .where(F.col("rank") <= k)
        .drop("_salt")
    )


def smallest(df: DataFrame, hash_col: str, id_col: str, take: Column) -> Column:
    """Condition that holds for exactly ``take`` rows, those smallest by ``(hash, id)``.

    ``take`` may be any share of the table, so nothing is sorted globally: a histogram over the first
    four hex digits (at most 65,536 rows) finds the bucket of the cut, and only that bucket is
    ranked. Needs a hash that differs between rows, such as that of a unique key.
    """
    digit = F.conv(F.substring(hash_col, 1, 4), 16, 10).cast("int")
    rows = df.select(F.col(hash_col).alias("_h"), F.col(id_col).alias("_id"), digit.alias("_d"))
    histogram = rows.groupBy("_d").agg(F.count(F.lit(1)).alias("_n"))
    running = F.sum("_n").over(W.orderBy("_d").rowsBetween(W.unboundedPreceding, W.currentRow))
    cut = (
        histogram.select("_d", (running - F.col("_n")).alias("_before"), "_n")
        .withColumn("_take", take)
        .where((F.col("_before") < F.col("_take")) & (F.col("_take") <= F.col("_before") + F.col("_n")))
        .select("_d", (F.col("_take") - F.col("_before")).alias("_rest"))
    )
    edge = (
        rows.join(F.broadcast(cut), "_d")
        .withColumn("_r", F.row_number().over(W.partitionBy("_d").orderBy("_h", "_id")))
        .where(F.col("_r") == F.col("_rest"))
        .select(F.struct("_h", "_id"))
    )
    return F.struct(F.col(hash_col).alias("_h"), F.col(id_col).alias("_id")) <= edge.scalar()
