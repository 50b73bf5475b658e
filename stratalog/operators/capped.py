"""Sessions under a cap: beyond it the oldest one ends at the next event, whoever sends it.

An event first ends the sessions that are too old, then the oldest ones beyond the cap, and then goes on
with the session of its id or opens one. So what an event meets depends on all events before, but only
through the sessions alive, and these are at most one more than the cap. Events are dealt into blocks
by time; a block is walked from the sessions that the block before it leaves. All blocks run at once
from what is known, and those whose beginning has changed run again, until none has. Sessions that end
by age make that a few rounds; it ends in any case, as every round settles one more block at least.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window as W
from pyspark.sql import functions as F

from stratalog.config import SessionConfig, SkewConfig
from stratalog.functions.times import micros
from stratalog.operators.skew import BLOCK
from stratalog.session import scratch_path
from stratalog.sources.chat_files import staged


class LiveSessions:
    """Sessions alive while events pass in order; at most one more than the cap."""

    def __init__(self, ttl: int, cap: int):
        self.ttl, self.cap = ttl, cap
        self.created: dict = {}  # in order of creation

    def meet(self, session: object, now: int) -> tuple[int, list[tuple[object, int]]]:
        """Creation time of the event's session, and the sessions that the cap ended."""
        while self.created and now - next(iter(self.created.values())) > self.ttl:
            del self.created[next(iter(self.created))]
        ended = []
        while len(self.created) > self.cap:
            oldest = next(iter(self.created))
            ended.append((oldest, self.created.pop(oldest)))
        return self.created.setdefault(session, now), ended


_EVENT, _ENDED, _LEFT = 0, 1, 2


def _pass(blocks: DataFrame, left: DataFrame | None, cfg: SessionConfig) -> DataFrame:
    """Walk the blocks, each from the sessions in ``left``: a row per event with its session's creation
    time, per session that the cap ended, and per session alive at the end of the block."""
    ttl, cap = cfg.ttl_seconds * 1_000_000, cfg.max_sessions
    rows = blocks.withColumns({"created": F.lit(None).cast("bigint"), "seat": F.lit(None).cast("int")})
    if left is not None:
        rows = rows.unionByName(left, allowMissingColumns=True)
    kinds = rows.schema.add("kind", "integer").add("ended", "long")

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        live, block, last = LiveSessions(ttl, cap), None, None

        def extra(kind: int, found: list[tuple[object, int, int | None]], like: pa.RecordBatch, at: int) -> pa.RecordBatch:
            n = len(found)
            columns = {name: pa.nulls(n, like.schema.field(name).type) for name in like.schema.names}
            columns[BLOCK] = pa.array([at] * n, like.schema.field(BLOCK).type)
            columns["session_id"] = pa.array([f[0] for f in found], like.schema.field("session_id").type)
            columns["created"] = pa.array([f[1] for f in found], pa.int64())
            columns["seat"] = pa.array(range(n), pa.int32())
            columns["kind"] = pa.array([kind] * n, pa.int32())
            columns["ended"] = pa.array([f[2] for f in found], pa.int64())
            return pa.record_batch(columns)

        for batch in batches:
            created: list[int | None] = []
            kept: list[int] = []
            ended: list[tuple[int, object, int, int]] = []
            columns = [batch.column(c).to_pylist() for c in (BLOCK, "session_id", "t", "created")]
            for i, (b, session, t, from_) in enumerate(zip(*columns, strict=True)):
                if b != block:
                    if block is not None:
                        yield extra(_LEFT, [(s, c, None) for s, c in live.created.items()], batch, block)
                    live, block = LiveSessions(ttl, cap), b
                if from_ is not None:
                    live.created[session] = from_
                    continue
                at, gone = live.meet(session, t)
                kept.append(i)
                created.append(at)
                ended += [(b, s, c, t) for s, c in gone]
            events = batch.take(pa.array(kept, pa.int64()))
            place = events.schema.get_field_index("created")
            events = events.set_column(place, "created", pa.array(created, pa.int64()))
            n = events.num_rows
            yield pa.record_batch(
                [*events.columns, pa.array([_EVENT] * n, pa.int32()), pa.nulls(n, pa.int64())],
                names=[*events.schema.names, "kind", "ended"],
            )
            for b in sorted({e[0] for e in ended}):
                yield extra(_ENDED, [e[1:] for e in ended if e[0] == b], batch, b)
            last = batch.slice(0, 0)
        if block is not None:
            yield extra(_LEFT, [(s, c, None) for s, c in live.created.items()], last, block)

    # sessions of the block before come first, in the order of their creation
    order = [F.col(c) for c in (BLOCK,)] + [F.col("seat").asc_nulls_last(), F.col("_place")]
    sorted_ = rows.repartition(BLOCK).sortWithinPartitions(*order)
    return sorted_.mapInArrow(walked, kinds)


def _digests(left: DataFrame) -> DataFrame:
    """``(block, digest)`` of the sessions a block begins with; at most one more than the cap each."""
    row = F.struct("seat", F.col("session_id").cast("string").alias("s"), "created")
    return left.groupBy(BLOCK).agg(F.xxhash64(F.array_sort(F.collect_list(row)).cast("string")).alias("digest"))


def capped_events(
    events: DataFrame, order: list[str], cfg: SessionConfig = SessionConfig(), skew: SkewConfig = SkewConfig()
) -> tuple[DataFrame, DataFrame]:
    """Every event with ``created_at`` of its session, and ``(session_id, created_at, ended_at)`` of the
    sessions that the cap ended, ``ended_at`` being the event that found them beyond it.

    ``order`` begins with ``ts`` and tells all events apart; events without a time are left out. A null
    ``session_id`` is a session like any other. Sessions whose age ends them are not listed.
    """
    spark = events.sparkSession
    timed = events.where(F.col("ts").isNotNull())
    place = F.struct(*[F.col(c).alias(f"p{i}") for i, c in enumerate(order)])
    rows = timed.select("session_id", micros("ts").alias("t"), place.alias("_place"), F.struct("*").alias("_row"))
    n = max(1, math.ceil(timed.count() / skew.max_rows))
    dealt = rows.repartitionByRange(n, "_place").withColumn(BLOCK, F.spark_partition_id())
    blocks = staged(dealt, scratch_path(spark, "session-blocks"))

    # empty blocks have no rows, so the one before a block is found by order, a row per block
    follows = blocks.select(BLOCK).distinct().withColumn("_next", F.lead(BLOCK).over(W.orderBy(BLOCK)))
    follows = staged(follows, scratch_path(spark, "session-order"))
    done = staged(_pass(blocks, None, cfg), scratch_path(spark, "session-pass"))
    known = follows.select(F.col("_next").alias(BLOCK), F.lit(None).cast("bigint").alias("digest")).where(F.col(BLOCK).isNotNull())
    while True:
        ends = done.where(F.col("kind") == _LEFT).join(follows, BLOCK).where("_next is not null")
        left = ends.select(F.col("_next").alias(BLOCK), "session_id", "created", "seat")
        now = known.select(BLOCK).join(_digests(left), BLOCK, "left")
        changed = staged(
            now.join(known.withColumnRenamed("digest", "_old"), BLOCK)
            .where(~F.col("digest").eqNullSafe(F.col("_old"))).select(BLOCK, "digest"),
            scratch_path(spark, "session-changed"),
        )
        if changed.isEmpty():
            break
        names = changed.select(BLOCK)
        again = _pass(blocks.join(names, BLOCK, "left_semi"), left.join(names, BLOCK, "left_semi"), cfg)
        done = staged(done.join(names, BLOCK, "left_anti").unionByName(again), scratch_path(spark, "session-pass"))
        old = known.join(names, BLOCK, "left_anti")
        known = staged(old.unionByName(changed), scratch_path(spark, "session-known"))
    seen = done.where(F.col("kind") == _EVENT).select("_row.*", F.timestamp_micros("created").alias("created_at"))
    ended = done.where(F.col("kind") == _ENDED).select(
        "session_id", F.timestamp_micros("created").alias("created_at"), F.timestamp_micros("ended").alias("ended_at")
    )
    return seen, ended
