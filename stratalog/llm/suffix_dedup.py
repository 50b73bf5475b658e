"""Removal of long repeated byte strings by bucket-pointer refinement.

A string of ``length`` bytes is repeated if it starts at two places of the corpus. Every string is put
into the bucket of one q-gram inside it, the one with the smallest identifier; equal strings choose the
same q-gram at the same offset. Buckets of one member need no further look. The others are refined:
the starts that share a place of the q-gram are cut into nodes of neighbouring starts, and a node's
bucket identifier is made of the q-gram's and of the identifiers at later offsets. Two identifiers are
kept for a node: that of the bytes which all its strings have in common, and that of the bytes they
cover together. If the first comes once, none of the strings is repeated; if the second comes twice,
all are. Only nodes in between are refined again, by the same step on nodes a quarter of the size, each
different stretch once however often it comes, down to single starts. Results are passed up the same way.

All identifiers of stretches have 128 bits; those that only drop buckets have 64.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.llm.common import join_spread, kept
from stratalog.session import scratch_path


@dataclass(frozen=True)
class SuffixConfig:
    """``sizes``: starts in a node, from level to level. A task works on about ``chunk`` bytes at a
    time, whatever the texts' lengths, and compares the anchors of ``held`` of them at once."""

    length: int = 200
    gram: int = 50
    sizes: tuple[int, ...] = (64, 16, 4, 1)
    chunk: int = 500_000
    held: int = 300_000

    @property
    def window(self) -> int:
        """Places of a q-gram in a string."""
        return self.length - self.gram + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers spread over the whole number."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = 0x9E3779B97F4A7C15


def gram_identifiers(data: np.ndarray, gram: int, lane: int) -> np.ndarray:
    """64-bit identifier of the q-gram at each place: a polynomial over numbers drawn for the bytes."""
    if len(data) < gram:
        return np.zeros(0, dtype=np.uint64)
    drawn = _mixed((np.arange(256, dtype=np.uint64) + np.uint64(1 + 256 * lane)) * np.uint64(_STEP))
    base = int(_mixed(np.array([(7 + lane) * _STEP % 2**64], dtype=np.uint64))[0]) | 1

    def powers(of: int) -> np.ndarray:
        out = np.full(len(data), of, dtype=np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(drawn[data] * powers(base), dtype=np.uint64)])
    back = powers(pow(base, -1, 2**64))[: len(data) - gram + 1]
    return _mixed((sums[gram:] - sums[:-gram]) * back)


def refined(lane: np.ndarray, bucket: np.ndarray, start: np.ndarray, size: np.ndarray, seed: np.ndarray, gram: int) -> np.ndarray:
    """Identifier of the ``size`` bytes from ``start``: that of the bucket, refined by the q-grams at
    later offsets one after the other, the last one at the end of the bytes."""
    out = _mixed(bucket + seed.astype(np.uint64) * np.uint64(_STEP))
    for k in range(-(-int(size.max(initial=0)) // gram)):
        at = start + np.minimum(k * gram, size - gram)
        out = np.where(k * gram < size, _mixed(out * np.uint64(_STEP) + lane[at]), out)
    return out


def anchors(texts: list[bytes], cfg: SuffixConfig) -> tuple[np.ndarray, ...]:
    """``(text, place, first start, last start, identifier)`` of the chosen q-gram of all strings.

    Neighbouring strings mostly choose the same one; they are one entry.
    """
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ids = gram_identifiers(data, cfg.gram, 0)
    n, w = len(ids), cfg.window
    if n < w:
        return (*[np.zeros(0, dtype=np.int64)] * 4, np.zeros(0, dtype=np.uint64))
    low = np.uint64((1 << 27) - 1)
    keys = np.full(-(-n // w) * w, ~np.uint64(0))
    keys[:n] = (ids & ~low) | np.arange(n, dtype=np.uint64)
    rows = keys.reshape(-1, w)
    up = np.minimum.accumulate(rows, axis=1).ravel()
    down = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    chosen = (np.minimum(down[: n - w + 1], up[w - 1 : n]) & low).astype(np.int64)
    ends = np.cumsum(sizes)
    own = np.repeat(np.arange(len(texts)), sizes)[: len(chosen)]
    start = np.flatnonzero(np.arange(len(chosen)) + cfg.length <= ends[own])
    place, own = chosen[start], own[start]
    new = np.flatnonzero((np.diff(place, prepend=-1) != 0) | (np.diff(own, prepend=-1) != 0))
    last = np.append(new[1:], len(start)) - 1 if len(new) else new
    begin = (ends - sizes)[own[new]]
    return own[new], place[new] - begin, start[new] - begin, start[last] - begin, ids[place[new]]


def pieces(texts: Iterable[bytes], cfg: SuffixConfig) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in lists of about ``chunk`` bytes: their numbers, where each begins, and the bytes. A
    longer text comes in overlapping pieces that together hold each of its strings once."""
    numbers, begins, part, size = [], [], [], 0
    for i, text in enumerate(texts):
        if len(text) < cfg.length:
            continue
        for at in range(0, len(text) - cfg.length + 1, cfg.chunk):
            one = text[at : at + cfg.chunk + cfg.length - 1]
            numbers.append(i)
            begins.append(at)
            part.append(one)
            size += len(one)
            if size >= cfg.chunk:
                yield numbers, begins, part
                numbers, begins, part, size = [], [], [], 0
    if part:
        yield numbers, begins, part


def text_anchors(texts: Iterable[bytes], cfg: SuffixConfig) -> Iterator[tuple[np.ndarray, ...]]:
    """Like :func:`anchors` for texts of any length."""
    for numbers, begins, part in pieces(texts, cfg):
        own, place, first, last, ids = anchors(part, cfg)
        begin = np.array(begins, dtype=np.int64)[own]
        yield np.array(numbers, dtype=np.int64)[own], place + begin, first + begin, last + begin, ids


def nodes(text: np.ndarray, place: np.ndarray, first: np.ndarray, last: np.ndarray, size: int, cfg: SuffixConfig) -> tuple[np.ndarray, ...]:
    """Nodes of ``size`` starts of the anchors in one piece of bytes, as ``(anchor, start, more, x,
    core, one, two)``: strings start at ``start`` to ``start + more``, the anchor ``x`` after it."""
    low, high = place - last, place - first
    count = high // size - low // size + 1
    own = np.repeat(np.arange(len(place)), count)
    number = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count) + (low // size)[own]
    a, b = np.maximum(low[own], number * size), np.minimum(high[own], number * size + size - 1)
    at, more = place[own] - b, b - a
    lanes = [gram_identifiers(text, cfg.gram, lane) for lane in (0, 1)]
    m, most = number * size, np.minimum(number * size + size - 1, cfg.window - 1)
    core = refined(lanes[0], lanes[0][place[own]], place[own] - m, cfg.length - (most - m), 3 + number, cfg.gram)
    seed = 1_000 + b * 512 + more
    one, two = (refined(lane, lane[place[own]], at, cfg.length + more, seed, cfg.gram) for lane in lanes)
    return own, at, more, b, core, one, two


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _blobs(column: pa.Array) -> Iterator[bytes]:
    return (x.as_py() for x in column)


def text_key(text: Column) -> tuple[Column, Column]:
    """128 bits of a text."""
    return F.xxhash64(text).alias("s1"), F.xxhash64(F.lit("second"), text).alias("s2")


def repeated_buckets(texts: DataFrame, cfg: SuffixConfig) -> DataFrame:
    """``(s1, s2, grams)``: the chosen q-grams of each text that are chosen more than once anywhere.

    A task knows of the q-grams that come twice in its own texts; for any q-gram it sends one row to be
    counted, so the most frequent ones send a row per task.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        size = 0
        seen: set[tuple[int, int]] = set()

        def flush() -> pa.RecordBatch:
            s1, s2, ids = (np.concatenate(x) for x in zip(*held, strict=True))
            order = np.lexsort((s2, s1, ids))
            s1, s2, ids = s1[order], s2[order], ids[order]
            new = np.diff(ids, prepend=~ids[0]) != 0
            n = np.diff(np.append(np.flatnonzero(new), len(ids)))
            times = np.repeat(n, n)
            # one row of a text and q-gram is enough
            again = ~new & (np.diff(s1, prepend=0) == 0) & (np.diff(s2, prepend=0) == 0)
            keep = new | ((times > 1) & ~again)
            return pa.record_batch(
                {
                    "gram": _signed(ids[keep]), "s1": pa.array(s1[keep]), "s2": pa.array(s2[keep]),
                    "counted": pa.array(new[keep]), "known": pa.array(times[keep] > 1),
                }
            )

        for batch in batches:
            # of equal texts in a task the first will do
            new = []
            for key in zip(batch.column("s1").to_pylist(), batch.column("s2").to_pylist(), strict=True):
                new.append(key not in seen)
                seen.add(key)
            batch = batch.filter(pa.array(new))
            s1, s2 = batch.column("s1").to_numpy(), batch.column("s2").to_numpy()
            for own, _, _, _, ids in text_anchors(_blobs(batch.column("data")), cfg):
                if len(own):
                    held.append((s1[own], s2[own], ids))
                    size += len(own)
                if size >= cfg.held:
                    yield flush()
                    held, size = [], 0
        if size:
            yield flush()

    rows = texts.select("s1", "s2", "data")
    rows = kept(rows.mapInArrow(found, "gram long, s1 long, s2 long, counted boolean, known boolean"), "suffix-buckets")
    counted = rows.where("counted")
    known = rows.where("known").select("s1", "s2", "gram")
    twice = counted.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.max("known").alias("known")).where("n > 1 or known")
    open_ = counted.where("not known").join(twice.select("gram"), "gram").select("s1", "s2", "gram")
    return known.unionByName(open_).groupBy("s1", "s2").agg(F.collect_set("gram").alias("grams"))


def _strings(texts: DataFrame, buckets: DataFrame, copies: DataFrame, cfg: SuffixConfig) -> DataFrame:
    """``(s1, s2, n, data, place, first, last)``: each different text that has a repeated bucket, with
    its anchors there. The table is bucketed by its key, so later joins leave the texts where they are.
    """

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams = [np.array(g, dtype=np.int64).view(np.uint64) for g in batch.column("grams").to_pylist()]
            lists: list[list[np.ndarray]] = [[np.zeros((3, 0), dtype=np.int64)] for _ in grams]
            for own, place, first, last, ids in text_anchors(_blobs(batch.column("data")), cfg):
                cuts = np.flatnonzero(np.diff(own, prepend=-1))
                for a, b in zip(cuts, np.append(cuts[1:], len(own)), strict=True):
                    at = a + np.flatnonzero(np.isin(ids[a:b], grams[own[a]]))
                    lists[own[a]].append(np.stack([place[at], first[at], last[at]]))
            full = [np.concatenate(x, axis=1) for x in lists]
            columns = {n: batch.column(n) for n in ("s1", "s2", "n", "data")}
            for k, name in enumerate(("place", "first", "last")):
                offsets = np.cumsum([0, *[x.shape[1] for x in full]]).astype(np.int32)
                columns[name] = pa.ListArray.from_arrays(offsets, np.concatenate([x[k] for x in full]).astype(np.int32))
            yield pa.record_batch(columns)

    spark = texts.sparkSession
    one = texts.select("s1", "s2", "data").dropDuplicates(["s1", "s2"])
    joined = one.join(buckets, ["s1", "s2"]).join(copies, ["s1", "s2"])
    kinds = "s1 long, s2 long, n int, data binary, place array<int>, first array<int>, last array<int>"
    out = joined.select("s1", "s2", "n", "data", "grams").mapInArrow(chosen, kinds)
    name = f"suffix_texts_{uuid.uuid4().hex}"
    (
        out.write.format("parquet").option("path", scratch_path(spark, "suffix-texts")).option("compression", "zstd")
        .bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), "s1", "s2").saveAsTable(name)
    )
    return spark.table(name)


def _nodes_of(strings: DataFrame, size: int, cfg: SuffixConfig) -> DataFrame:
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s1, s2, n = (batch.column(c).to_numpy() for c in ("s1", "s2", "n"))
            data = batch.column("data")
            lists = [batch.column(c) for c in ("place", "first", "last")]
            offsets = lists[0].offsets.to_numpy()
            place, first, last = (x.values.to_numpy().astype(np.int64) for x in lists)
            part: list[tuple[int, int, int, int, bytes]] = []  # string, anchors, begin and bytes around them
            width = 0

            def flush() -> pa.RecordBatch:
                begin = np.cumsum([0, *[len(p[4]) for p in part]])
                own = np.concatenate([np.full(b - a, i) for i, a, b, _, _ in part])
                from_ = np.concatenate([np.full(p[2] - p[1], begin[k] - p[3]) for k, p in enumerate(part)])
                at = np.concatenate([np.arange(p[1], p[2]) for p in part])
                text = np.frombuffer(b"".join(p[4] for p in part), dtype=np.uint8)
                k, start, more, x, core, one, two = nodes(text, place[at] + from_, first[at] + from_, last[at] + from_, size, cfg)
                i = own[k]
                return pa.record_batch(
                    {
                        "s1": pa.array(s1[i]), "s2": pa.array(s2[i]), "n": pa.array(n[i]),
                        "at": pa.array((start - from_[k]).astype(np.int32)), "more": pa.array(more.astype(np.int32)),
                        "x": pa.array(x.astype(np.int32)), "core": _signed(core), "h1": _signed(one), "h2": _signed(two),
                    }
                )

            for i in range(len(s1)):
                a, end = int(offsets[i]), int(offsets[i + 1])
                text = data[i].as_py() if end > a else b""
                while a < end:
                    # anchors come in the order of their starts
                    b = int(np.searchsorted(first[a:end], first[a] + cfg.chunk)) + a
                    low, high = max(0, int(first[a]) - cfg.length), int(last[a:b].max()) + 2 * cfg.length
                    part.append((i, a, b, low, text[low:high]))
                    width += len(part[-1][4])
                    a = b
                    if width >= cfg.chunk:
                        yield flush()
                        part, width = [], 0
            if part:
                yield flush()

    kinds = "s1 long, s2 long, n int, at int, more int, x int, core long, h1 long, h2 long"
    return kept(strings.mapInArrow(make, kinds), f"suffix-nodes-{size}")


def _repeats(strings: DataFrame, sizes: tuple[int, ...], cfg: SuffixConfig) -> DataFrame:
    """``(s1, s2, spans)``: ranges of starts ``(from, to)`` of repeated strings for each text that comes
    once; those that come more often are repeated as a whole."""
    found = _nodes_of(strings, sizes[0], cfg)
    place = F.struct("s1", "s2", "at", "more", "x")
    hulls = found.groupBy("core", "h1", "h2").agg(F.sum("n").alias("n"), F.min(place).alias("place"))
    whole = F.array(F.struct(F.lit(0).alias("from"), F.col("place.more").alias("to")))
    if len(sizes) == 1:
        known = hulls.where("n > 1").select("h1", "h2", whole.alias("inner"))
    else:
        hulls = kept(hulls, f"suffix-hulls-{sizes[0]}")
        cores = hulls.groupBy("core").agg(F.sum("n").alias("total"), F.count_if(F.col("n") == 1).alias("single"))
        open_ = hulls.join(cores.where("total > 1 and single > 0").select("core"), "core")
        wanted = open_.groupBy("place.s1", "place.s2").agg(
            F.collect_list(F.struct("h1", "h2", F.least("n", F.lit(2)).cast("int").alias("n"), "place.at", "place.more", "place.x")).alias("w")
        )
        cut = strings.select("s1", "s2", "data").join(wanted, ["s1", "s2"]).select("data", F.explode("w").alias("w"))
        inner = cut.select(
            F.col("w.h1").alias("s1"), F.col("w.h2").alias("s2"), "w.n",
            F.substring("data", F.col("w.at") + 1, F.col("w.more") + cfg.length).alias("data"),
            F.array("w.x").alias("place"), F.array(F.lit(0)).alias("first"), F.array("w.more").alias("last"),
        )
        below = _repeats(kept(inner, f"suffix-strings-{sizes[0]}"), sizes[1:], cfg)
        known = hulls.where("n > 1").select("h1", "h2", whole.alias("inner")).unionByName(
            below.select(F.col("s1").alias("h1"), F.col("s2").alias("h2"), F.col("spans").alias("inner"))
        )
    met = found.where("n = 1").select("s1", "s2", "at", "h1", "h2").join(known, ["h1", "h2"])
    moved = met.select("s1", "s2", "at", F.explode("inner").alias("i")).select(
        "s1", "s2", F.struct((F.col("at") + F.col("i.from")).alias("from"), (F.col("at") + F.col("i.to")).alias("to")).alias("span")
    )
    return moved.groupBy("s1", "s2").agg(F.collect_list("span").alias("spans"))


_FOUND = "s1 long, s2 long, n_removed long, spans array<struct<start:int,end:int>>, kept_sha256 string, kept binary"


def _cut_out(strings: DataFrame, spans: DataFrame, texts: bool, cfg: SuffixConfig) -> DataFrame:
    """Removed byte ranges of each text with repeated strings, and what is left."""
    length = cfg.length

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            ranges = batch.column("spans")
            offsets = ranges.offsets.to_numpy()
            low, high = (ranges.values.field(k).to_numpy() for k in ("from", "to"))
            for i, data in enumerate(batch.column("data")):
                data = np.frombuffer(data.as_py(), dtype=np.uint8)
                own = slice(offsets[i], offsets[i + 1])
                depth = np.zeros(len(data) + 1, dtype=np.int64)
                np.add.at(depth, low[own], 1)
                np.add.at(depth, high[own] + length, -1)
                gone = np.cumsum(depth[:-1]) > 0
                edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                left = data[~gone].tobytes()
                out.append((int(gone.sum()), edges.reshape(-1, 2).tolist(), hashlib.sha256(left).hexdigest(), left if texts else None))
            n, runs, digests, left = zip(*out, strict=True) if out else ((), (), (), ())
            yield pa.record_batch(
                {
                    "s1": batch.column("s1"), "s2": batch.column("s2"), "n_removed": pa.array(n, pa.int64()),
                    "spans": pa.array(
                        [[{"start": a, "end": b} for a, b in r] for r in runs],
                        pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])),
                    ),
                    "kept_sha256": pa.array(digests, pa.string()), "kept": pa.array(left, pa.binary()),
                }
            )

    return strings.where("n = 1").select("s1", "s2", "data").join(spans, ["s1", "s2"]).mapInArrow(cut, _FOUND)


def without_repeats(docs: DataFrame, texts: bool = True, cfg: SuffixConfig = SuffixConfig()) -> DataFrame:
    """All columns but ``text`` with ``n_bytes, n_removed, spans, kept_sha256`` and, if ``texts``,
    ``kept`` (replacing columns of those names); a row per row of ``docs``.

    ``spans`` are the maximal removed byte ranges, ``kept`` the bytes that remain. A null text is empty;
    a text shorter than ``length`` loses nothing; repeated rows are copies of each other, so longer ones
    lose everything. An empty table gives no rows. Texts are worked on whole.
    """
    raw = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    added = ("n_bytes", "n_removed", "spans", "kept_sha256", "kept")
    others = [F.col(f"`{c}`") for c in docs.columns if c != "text" and c not in added] or [F.lit(0).alias("none")]
    texts_ = docs.select(*text_key(raw), raw.alias("data")).where(F.octet_length("data") >= cfg.length)
    codes = docs.select(
        F.struct(*others).alias("row"), F.struct(*text_key(raw)).alias("key"),
        F.octet_length(raw).cast("bigint").alias("n_bytes"), F.sha2(raw, 256).alias("own_sha256"),
        *([raw.alias("own")] if texts else []),
    )
    small = docs.select(*text_key(raw), F.octet_length(raw).alias("size")).where(F.col("size") >= cfg.length)
    copies = small.groupBy("s1", "s2").agg(F.least(F.count(F.lit(1)), F.lit(2)).cast("int").alias("n"))
    copies = kept(copies, "suffix-copies")

    strings = _strings(texts_, repeated_buckets(texts_, cfg), copies, cfg)
    spans = _repeats(strings, cfg.sizes, cfg)
    key = F.struct("s1", "s2").alias("key")
    found = _cut_out(strings, spans, texts, cfg).select(key, F.struct("n_removed", "spans", "kept_sha256", "kept").alias("cut"))
    twice = copies.where("n > 1").select(key, F.lit(None).cast(found.schema["cut"].dataType).alias("cut"))
    known = kept(found.unionByName(twice).withColumn("hit", F.lit(True)), "suffix-found")
    joined = join_spread(codes, known, "key")
    hit, gone = F.col("hit").isNotNull(), F.col("hit").isNotNull() & F.col("cut").isNull()
    none = F.array().cast("array<struct<start:int,end:int>>")
    all_ = F.array(F.struct(F.lit(0).alias("start"), F.col("n_bytes").cast("int").alias("end")))

    def by_case(removed: Column, partly: str, untouched: Column) -> Column:
        return F.when(gone, removed).when(hit, F.col(f"cut.{partly}")).otherwise(untouched)

    out = joined.select(
        *[F.col("row")[c].alias(c) for c in docs.columns if c != "text" and c not in added],
        "n_bytes",
        by_case(F.col("n_bytes"), "n_removed", F.lit(0).cast("bigint")).alias("n_removed"),
        by_case(all_, "spans", none).alias("spans"),
        by_case(F.sha2(F.lit(b""), 256), "kept_sha256", F.col("own_sha256")).alias("kept_sha256"),
        *([by_case(F.lit(b""), "kept", F.col("own")).alias("kept")] if texts else []),
    )
    return out
