"""Keyed state on streams: session context and last good values.

Rows are applied in the order of their event times, also when they arrive later than others of their
key, as long as the watermark has not passed them. Keys are dealt by hash into a fixed number of groups,
so that a call to the state store serves many rows of many keys. The rows of a group wait in pieces of
bounded size until an event-time timer says that nothing earlier can come; the pieces are then merged by
time, one open after the other where they do not overlap, and each row is applied to the small value that
its key holds. The held values of a group lie in parts by hash of the key, of some hundred values each, which
are read and written as a whole; the number of parts grows with the values. Held values go when their time is
over. Times cross into Python as microseconds, so neither the session's zone nor a clock change touches them.

Needs the RocksDB state store, see :func:`state_store`.
"""

from __future__ import annotations

import pickle
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from stratalog.config import SeriesConfig, SessionConfig
from stratalog.functions.times import micros
from stratalog.operators.sessions import CONTEXT

CONTEXT_ROW = (
    "session_id string, ts long, kind string, created_at long, has_context boolean, "
    "context string"
)
SERVED_ROW = (
    "series string, fetched_at long, ok boolean, served_value double, has_value boolean, served_at long, "
    "state string"
)
#: groups of keys, fixed for the life of a checkpoint, most rows in one piece, and held values in a part on average
GROUPS, PIECE, PART = 128, 4_096, 256
_STORE = "spark.sql.streaming.stateStore.providerClass"


def state_store(spark: SparkSession) -> None:
    """Map states and timers need this state store; it holds for queries started from now on."""
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def _part(key: Any, parts: int) -> int:
    """The part of a key, the same in all processes."""
    return zlib.crc32(str(key).encode()) % parts


class InOrder(StatefulProcessor):
    """Applies ``step(held, us, row)`` to the rows of each key in the order of their times.

    ``step`` gives the new held value and an output tuple; a held value begins with the microsecond from
    which it matters for ``ttl`` more, or without end where that is None. ``key`` and ``fields`` name the
    columns of a row that are kept with its time; ``held`` says what a held value consists of.
    """

    def __init__(self, out: str, key: str, fields: list[str], held: str, step: Callable, ttl: int | None, piece: int = PIECE):
        self.names = [column.split()[0] for column in out.split(", ")]
        self.columns = ["at_us", key, *fields]
        self.step, self.ttl, self.piece, self.part = step, ttl, piece, min(PART, max(1, piece // 2))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getMapState("held", "part long", "values binary")
        self.pieces = handle.getMapState("pieces", "piece long", "rows binary")
        self.book = handle.getValueState(
            "book",
            "arrived long, held long, parts long, timer long, sweep long, starts array<struct<us:long,n:long,piece:long,size:long>>",
        )

    def _read(self) -> tuple[int, int, int, int | None, int | None, list[tuple]]:
        """Rows arrived, values held and their parts, the timers of rows and of held values, and where each piece begins."""
        arrived, held, parts, timer, sweep, starts = self.book.get() or (0, 0, 1, None, None, [])
        return arrived, held, parts, timer, sweep, [tuple(s) for s in starts]

    def _take(self, piece: int) -> list[tuple]:
        rows = pickle.loads(self.pieces.getValue((piece,))[0])
        self.pieces.removeKey((piece,))
        return rows

    def _keep(self, rows: list[tuple], starts: list[tuple]) -> None:
        """Put rows into new pieces, together with the last one if that has room for them."""
        if rows and starts and starts[-1][3] + len(rows) <= self.piece:
            rows = self._take(starts.pop()[2]) + rows
        rows = sorted(rows)
        for a in range(0, len(rows), self.piece):
            part = rows[a : a + self.piece]
            number = max((s[2] for s in starts), default=0) + 1
            self.pieces.updateValue((number,), (pickle.dumps(part),))
            starts.append((*part[0][:2], number, len(part)))

    def _wake(self, timer: int | None, starts: list[tuple]) -> int | None:
        """A timer for the first millisecond at which the first row waiting has nothing before it to come."""
        due = min(starts)[0] // 1000 + 1 if starts else None
        if due is not None and (timer is None or due < timer):
            self.handle.registerTimer(due)
            return due
        return timer

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        arrived, held, parts, timer, sweep, starts = self._read()
        for frame in rows:
            us, *others = (frame[c].tolist() for c in self.columns)
            self._keep(list(zip(us, range(arrived, arrived + len(us)), *others)), starts)
            arrived += len(us)
        self.book.update((arrived, held, parts, self._wake(timer, starts), sweep, starts))
        return iter([])

    def _due(self, end: int, starts: list[tuple]) -> Iterator[list[tuple]]:
        """Lists of the rows before ``end`` in the order of time and arrival; ``starts`` keeps the others."""
        pieces = sorted(s for s in starts if s[0] < end)
        starts[:] = [s for s in starts if s[0] >= end]
        rows: list[tuple] = []
        for at, (_, _, piece, _) in enumerate(pieces):
            rows = sorted(rows + self._take(piece))
            cut = bisect_left(rows, min([(end,), *(p[:2] for p in pieces[at + 1 : at + 2])]))
            yield rows[:cut]
            rows = rows[cut:]
        self._keep(rows, starts)

    def _values(self, part: int) -> dict:
        stored = self.held.getValue((part,))
        return pickle.loads(stored[0]) if stored else {}

    def _hold(self, read: dict[int, dict], sizes: dict[int, int], n_held: int, parts: int, end: int) -> tuple[int, int]:
        """Write the parts in ``read``, ``sizes`` long as stored, without values whose time is over; gives the
        number of values held and of parts. All are dealt anew where they grow too large, or are read and small."""
        for part, values in read.items():
            if self.ttl is not None:
                read[part] = values = {k: v for k, v in values.items() if v[0] + self.ttl >= end}
            n_held += len(values) - sizes[part]
        wanted = parts
        while n_held > wanted * self.part:
            wanted *= 2
        while len(read) == parts and wanted > 1 and n_held * 4 <= wanted * self.part:
            wanted //= 2
        if wanted != parts:
            for part in range(parts):
                if part not in read:
                    read[part] = self._values(part)
                    sizes[part] = len(read[part])
            dealt: dict[int, dict] = {part: {} for part in range(max(parts, wanted))}
            for values in read.values():
                for k, v in values.items():
                    dealt[_part(k, wanted)][k] = v
            read = dealt
        for part, values in read.items():
            if values:
                self.held.updateValue((part,), (pickle.dumps(values),))
            elif sizes.get(part):
                self.held.removeKey((part,))
        return n_held, wanted

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        end = now * 1000
        arrived, n_held, parts, timer, sweep, starts = self._read()
        sweeping = sweep is not None and sweep <= now
        if not sweeping and not any(s[0] < end for s in starts):
            return
        read = {part: self._values(part) for part in range(parts)} if sweeping and n_held else {}
        sizes = {part: len(values) for part, values in read.items()}
        at: dict = {}  # the part of each key met
        for rows in self._due(end, starts):
            made = []
            for us, _, k, *row in rows:
                held = at.get(k)
                if held is None:
                    part = _part(k, parts)
                    if part not in read:
                        read[part] = self._values(part) if n_held else {}
                        sizes[part] = len(read[part])
                    held = at[k] = read[part]
                value, values = self.step(held.get(k), us, row)
                if value is not None:
                    held[k] = value
                else:
                    held.pop(k, None)
                made.append((k, *values))
            if made:
                yield pd.DataFrame(dict(zip(self.names, zip(*made, strict=True), strict=True)), dtype=object)
        n_held, parts = self._hold(read, sizes, n_held, parts, end)
        if sweep is not None and sweep <= now:
            sweep = None
        if n_held and sweep is None and self.ttl is not None:
            sweep = now + self.ttl // 1000 + 1
            self.handle.registerTimer(sweep)
        timer = self._wake(None if timer is not None and timer <= now else timer, starts)
        self.book.update((arrived, n_held, parts, timer, sweep, starts))

    def close(self) -> None:
        pass


def _in_order(rows: DataFrame, key: str, out: str, processor: InOrder) -> DataFrame:
    grouped = rows.withColumn("key_group", F.pmod(F.xxhash64(key), F.lit(GROUPS))).groupBy("key_group")
    return grouped.transformWithStateInPandas(processor, out, "append", "eventTime")


def _stamped(out: DataFrame, *columns: str) -> DataFrame:
    return out.withColumns({c: F.timestamp_micros(c) for c in columns})


def session_context(
    events: DataFrame, delay: str = "10 minutes", cfg: SessionConfig = SessionConfig()
) -> DataFrame:
    """Stream of ``(session_id, ts, kind, <context>)`` to rows with session and context.

    The context columns that exist travel through the state as one JSON text, so a prediction
    replaces all of them at once, as in batch: one without zones leaves no class behind.
    """
    fields = [events.schema[c] for c in CONTEXT if c in events.columns]
    ttl = cfg.ttl_seconds * 1_000_000

    def step(held: tuple | None, us: int, row: list) -> tuple[tuple, tuple]:
        created, context = held or (None, None)
        kind, given = row
        if created is None or us - created > ttl:
            created, context = us, None
        if kind == "prediction":
            context = given
        return (created, context), (us, kind, created, context is not None, context)

    processor = InOrder(CONTEXT_ROW, "session_id", ["kind", "given"], "created long, context string", step, ttl)
    given = F.when(F.col("kind") == "prediction", F.to_json(F.struct(*[f.name for f in fields])))
    timed = (
        events.withColumns({"at_us": micros("ts"), "given": given})
        .drop(*[f.name for f in fields])
        .withWatermark("ts", delay)
    )
    folded = _in_order(timed, "session_id", CONTEXT_ROW, processor)
    kinds_ = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    read = F.from_json("context", kinds_)
    return _stamped(folded, "ts", "created_at").select(
        *[c for c in folded.columns if c != "context"], *[read[f.name].alias(f.name) for f in fields]
    )


def served_values(
    requests: DataFrame, delay: str = "10 minutes", cfg: SeriesConfig = SeriesConfig()
) -> DataFrame:
    """Stream of ``(series, fetched_at, ok, value)`` to what each request is served.

    A stale value is served until a good one comes, so what a series holds has no end.
    """
    ttl = cfg.ttl_seconds * 1_000_000

    def step(held: tuple | None, us: int, row: list) -> tuple[tuple | None, tuple]:
        at, value = held or (None, None)
        ok, new, known = row
        due = at is None or us - at > ttl
        if due and ok:
            at, value = us, new if known else None
            kind = "refreshed"
        else:
            kind = "failed" if at is None else "stale" if due else "cached"
        return None if at is None else (at, value), (us, ok, value, value is not None, at, kind)

    # a frame cannot tell null from NaN
    processor = InOrder(SERVED_ROW, "series", ["ok", "value", "known"], "at long, value double", step, None)
    timed = requests.withColumns({"at_us": micros("fetched_at"), "known": F.col("value").isNotNull()}).withWatermark("fetched_at", delay)
    served = _stamped(_in_order(timed, "series", SERVED_ROW, processor), "fetched_at", "served_at")
    value = F.when(F.col("has_value"), F.coalesce("served_value", F.lit(float("nan"))))
    return served.withColumn("served_value", value).drop("has_value")
