"""Mixing sources to target weights by balanced sampling with the cube method.

A source with a target of ``r`` times its size takes ``floor(r)`` copies of every document and draws
the fraction that is left. The draw starts with that fraction as inclusion probability of each
document. The flight phase takes three undecided documents at a time and moves their probabilities
along the null space of the two constraints (number of documents, number of words) until one becomes
0 or 1, so both totals stay exactly what they were. When fewer than three are left, landing gives up
the document count and then the words.

A flight holds three documents in memory, whatever the size of its block. Sources are cut into
blocks of about ``block_rows`` documents by a hash; each block leaves at most two undecided
documents, which meet in the blocks of the next round, until a source fits in one block.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from stratalog.llm.common import kept, text_or_empty

EPSILON = 1e-9


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[float, ...] = (5.0, 2.0, 1.0)
    max_repeat: int = 3
    block_rows: int = 10_000
    large_share: int = 256
    seed: int = 17


def words(text: Column) -> Column:
    """Runs of characters other than space and ``\\t``..``\\r``; 0 for null."""
    return F.regexp_count(text_or_empty(text), F.lit(r"[^ \x09-\x0D]+")).cast("bigint")


def source_targets(sizes: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """Add ``target`` to ``(source, source_size)``: shares of the whole size by weight.

    Weights repeat over the sources in code point order, null last. A target stops at
    ``max_repeat`` times the source's size and the excess goes to the others by weight. With the
    sources ordered by ``cap / weight`` that ends at one level: the first source whose cap exceeds
    its share of what the sources before it have left. One row per source, so the windows over all
    of them are small next to the documents.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(cfg.weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in cfg.weights]), turn + 1)
    capped = (F.lit(cfg.max_repeat) * F.col("source_size")).cast("double")
    by_ratio = W.orderBy("_ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    everything = W.orderBy(F.lit(1)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    leveled = (
        sizes.withColumn("weight", weight)
        .withColumns({"_cap": capped, "_ratio": capped / F.col("weight")})
        .withColumn("_turn", F.row_number().over(by_ratio))
        .withColumns(
            {
                "_rest": F.sum("source_size").over(everything)
                - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
                "_open": F.sum("weight").over(everything)
                - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
            }
        )
        .withColumn("_level", F.col("_rest") / F.col("_open"))
    )
    open_ = F.col("_ratio") > F.col("_level")
    level = F.min_by(F.when(open_, F.col("_level")), F.when(open_, F.col("_turn"))).over(everything)
    target = F.when(level.isNull(), F.col("_cap")).otherwise(F.least(F.col("_cap"), level * F.col("weight")))
    return leveled.withColumn("target", target).select("source", "source_size", "weight", "target")


def _moved(a: list, b: list, c: list, toss: float) -> None:
    """Move three probabilities along the null space of (1, size) until one is decided."""
    u = (c[1] - b[1], a[1] - c[1], b[1] - a[1])
    if not any(u):
        u = (1, -1, 0)
    _along((a, b, c), u, toss)


def _along(units: tuple, u: tuple, toss: float) -> None:
    up = min((1 - x[0]) / d if d > 0 else x[0] / -d for x, d in zip(units, u, strict=True) if d)
    down = min(x[0] / d if d > 0 else (1 - x[0]) / -d for x, d in zip(units, u, strict=True) if d)
    step = up if toss * (up + down) < down else -down
    for x, d in zip(units, u, strict=True):
        p = x[0] + step * d
        x[0] = 0.0 if p < EPSILON else 1.0 if p > 1 - EPSILON else p


def _decided(p: float) -> bool:
    return p in (0.0, 1.0)


def _flight(frames: Iterator[pd.DataFrame], land: bool, seed: int) -> Iterator[pd.DataFrame]:
    """Fly the sorted blocks of one partition; only ``p`` changes, to 0 or 1 but for leftovers."""
    at, held, rng = None, [], random.Random()
    out: list[tuple] = []
    columns: list[str] = []

    def put(unit: list) -> None:
        out.append((*unit[2], unit[0]))

    def close() -> None:
        if land and len(held) == 2:
            a, b = held
            u = (b[1], -a[1]) if a[1] or b[1] else (1, -1)
            _along((a, b), u, rng.random())
        for unit in held:
            if land and not _decided(unit[0]):
                unit[0] = 1.0 if rng.random() < unit[0] else 0.0
            put(unit)
        held.clear()

    for frame in frames:
        columns = [c for c in frame.columns if c != "p"]
        rest = frame[columns].astype(object).where(frame[columns].notna(), None)
        places = (frame["sid"], frame["block"], frame["size"], frame["p"], rest.itertuples(index=False, name=None))
        for sid, block, size, p, row in zip(*places, strict=True):
            if at != (sid, block):
                close()
                at = (sid, block)
                rng.seed(f"{seed}:{sid}:{block}")
            held.append([p, size, row])
            if len(held) == 3:
                _moved(*held, rng.random())
                for unit in [x for x in held if _decided(x[0])]:
                    put(unit)
                    held.remove(unit)
        if out:
            yield pd.DataFrame(out, columns=[*columns, "p"])
            out = []
    close()
    if out:
        yield pd.DataFrame(out, columns=[*columns, "p"])


def _fly(units: DataFrame, counts: DataFrame, turn: int, land: bool, cfg: MixConfig) -> DataFrame:
    """One round: blocks by hash, largest documents first, so that the smallest stay undecided."""
    hashed = F.xxhash64(F.lit(cfg.seed + turn), "doc_id", "size")
    blocks = F.greatest(F.lit(1), F.ceil(F.col("_units") / cfg.block_rows))
    placed = units.drop("block").join(counts, "sid").withColumn("block", F.pmod(hashed, blocks).cast("bigint"))
    placed = placed.select(*units.columns)
    ordered = placed.repartition("sid", "block").sortWithinPartitions(
        "sid", "block", F.col("size").desc(), F.xxhash64("doc_id", "size"), "doc_id", "source"
    )
    last = [c for c in units.columns if c != "p"]
    kinds = {c: units.schema[c].dataType for c in ("doc_id", "source")}
    # ids travel as text: pandas would turn whole numbers with nulls among them into floats
    plain = ordered.withColumns({c: F.col(c).cast("string") for c in kinds}).select(*last, "p")
    flown = plain.mapInPandas(lambda frames: _flight(frames, land, cfg.seed + turn), plain.schema)
    return flown.withColumns({c: F.col(c).cast(kind) for c, kind in kinds.items()}).select(*units.columns)


def _drawn(units: DataFrame, cfg: MixConfig) -> DataFrame:
    """Add ``copies`` to ``(doc_id, source, size, rows, sid, rate)``: whole copies and the draw."""
    due = F.col("rate") * F.col("rows")
    whole = F.floor(due + EPSILON)
    frac = F.greatest(F.lit(0.0), due - whole)
    started = units.withColumns(
        {
            "base": whole.cast("bigint"),
            "block": F.lit(0).cast("bigint"),
            "p": F.when(frac < EPSILON, 0.0).otherwise(frac),
        }
    )
    done = started.where("p = 0.0")
    pending = started.where("p > 0.0")
    turn = 0
    while True:
        counts = kept(pending.groupBy("sid").agg(F.count(F.lit(1)).alias("_units")), "mix-counts")
        most = counts.agg(F.max("_units")).first()[0] or 0
        land = most <= cfg.block_rows
        flown = kept(_fly(pending, counts, turn, land, cfg), "mix-flight")
        done = done.unionByName(flown.where("p in (0.0, 1.0)"))
        if land:
            return done.select(*units.columns, (F.col("base") + F.col("p").cast("bigint")).alias("copies"))
        pending = flown.where("p not in (0.0, 1.0)")
        turn += 1


def mixed_units(units: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """``(doc_id, source, size)`` rows to ``(doc_id, source, size, rows, copies, source_size,
    target)``: how many copies the mix takes of the ``rows`` equal rows together.

    Equal rows are one unit here, so a row repeated any number of times is one row of a block. The
    result depends on the rows and the seed, not on their order or partitioning. An empty table
    gives no rows; a source without words has target 0 and nothing taken.

    A document with a notable part of its source's words would stay undecided to the end of a flight
    and spoil the total when it lands. So those, at most ``large_share`` a source, fly and land
    first, and the others' rate makes up for what they took too much or too little.
    """
    grouped = units.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("rows"))
    grouped = kept(grouped, "mix-units")
    volume = F.col("size") * F.col("rows")
    sizes = grouped.groupBy("source").agg(F.sum(volume).alias("source_size"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    strata = source_targets(sizes, cfg).withColumns(
        {"sid": F.xxhash64("source", F.col("source").isNull()), "rate": rate}
    )
    strata = kept(strata, "mix-strata")
    side = strata.select(F.col("source").alias("_s"), "sid", "rate", "source_size", "target")
    placed = grouped.join(side, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    is_large = F.col("size") * cfg.large_share > F.col("source_size")
    columns = ["doc_id", "source", "size", "rows", "sid", "rate"]
    large = kept(_drawn(placed.where(is_large).select(*columns), cfg), "mix-large")
    took = large.groupBy("sid").agg(
        F.sum(F.col("size") * F.col("copies")).alias("_took"), F.sum(volume).alias("_of")
    )
    left = (F.col("target") - F.col("_took")) / (F.col("source_size") - F.col("_of"))
    evened = F.when(
        F.col("_of") < F.col("source_size"), F.least(F.greatest(left, F.lit(0.0)), F.lit(float(cfg.max_repeat)))
    )
    rates = kept(
        strata.join(took, "sid", "left").select("sid", F.coalesce(evened, "rate").alias("rate")), "mix-rates"
    )
    small = placed.where(~is_large).drop("rate").join(rates, "sid").select(*columns)
    drawn = large.unionByName(_drawn(small, cfg)).drop("rate")
    totals = strata.select("sid", "source_size", "target")
    return drawn.join(totals, "sid").select(
        "doc_id", "source", "size", "rows", "copies", "source_size", "target"
    )


def _share(place: Column) -> Column:
    """Copies of one of ``rows`` equal rows: as even as whole numbers allow."""
    return F.floor(F.col("copies") / F.col("rows")) + (place <= F.pmod(F.col("copies"), F.col("rows"))).cast("int")


def mix_table(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, copies, taken``.

    Null texts have size 0, null ids and sources are values of their own.
    """
    units = docs.select("doc_id", "source", words(F.col("text")).alias("size"))
    plan = mixed_units(units, cfg)
    each = plan.withColumn("_at", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))))
    copies = _share(F.col("_at")).cast("bigint")
    return each.withColumn("copies", copies).select(
        "doc_id", "source", "size", "source_size", "target", "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(docs: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    """The documents of the mix, each as often as it is taken; columns as they were.

    The texts are shuffled once, for the join with the plan; equal rows then take turns in a window
    over the same keys.
    """
    own = docs.select(F.struct("*").alias("_row"))
    units = own.select(
        "_row", F.col("_row.doc_id").alias("_i"), F.col("_row.source").alias("_s"),
        words(F.col("_row.text")).alias("_n"),
    )
    plan = mixed_units(
        units.select(F.col("_i").alias("doc_id"), F.col("_s").alias("source"), F.col("_n").alias("size")), cfg
    ).where("copies > 0")
    same = (
        F.col("_i").eqNullSafe(F.col("doc_id"))
        & F.col("_s").eqNullSafe(F.col("source"))
        & (F.col("_n") == F.col("size"))
    )
    turns = W.partitionBy("doc_id", "source", "size").orderBy(F.xxhash64("_row.text"))
    taken = (
        units.join(plan, same)
        .withColumn("_at", F.row_number().over(turns))
        .withColumn("_copies", _share(F.col("_at")))
        .where("_copies > 0")
    )
    return taken.withColumn("_", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_copies").cast("bigint")))).select("_row.*")
