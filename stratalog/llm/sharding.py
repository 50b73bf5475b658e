"""Sharding by a permutation-filled lookup table.

Every shard has its own preference order over the slots of a table of prime size: it starts at an
offset and steps by a skip, both from a digest of its name. The shards take turns claiming their most
preferred free slot until the table is full, so they hold equal numbers of slots, and when a shard
leaves, few slots of the others change. The table depends on the shard names alone, never on the
data: 65,537 small integers by default. It is broadcast, and a row's place is one digest of its key
and one lookup.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: hex digits of a digest that make a number below 2**60
DIGITS = 15
#: the table is broadcast, so its size has a bound
MAX_SLOTS = 1 << 20


@dataclass(frozen=True)
class ShardConfig:
    shards: tuple[str, ...] = tuple(f"shard-{i:03d}" for i in range(64))
    slots: int = 65_537


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:DIGITS], 16)


def lookup_table(shards: Sequence[str], slots: int) -> list[int]:
    """Place of the owning shard in ``shards`` for each slot."""
    if slots > MAX_SLOTS or slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the number of slots must be a prime from {len(shards)} to {MAX_SLOTS}")
    if not shards or len(set(shards)) < len(shards):
        raise ValueError("shards need different names")
    ranked = sorted(range(len(shards)), key=lambda i: shards[i])  # turns don't depend on the list's order
    place = [_number(f"{shards[i]}/offset") % slots for i in ranked]
    skip = [_number(f"{shards[i]}/skip") % (slots - 1) + 1 for i in ranked]
    owner = [-1] * slots
    free = slots
    while free:
        for turn, shard in enumerate(ranked):
            if not free:
                break
            while owner[place[turn]] >= 0:
                place[turn] = (place[turn] + skip[turn]) % slots
            owner[place[turn]] = shard
            free -= 1
    return owner


def slot_of(key: Column, slots: int) -> Column:
    """Slot of a key given as text; a null key counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint"), F.lit(slots))


def sharded(docs: DataFrame, key: Column, cfg: ShardConfig = ShardConfig()) -> DataFrame:
    """All rows and columns, with ``slot`` and ``shard`` added (replacing columns of that name).

    Equal keys share a shard. There is no shuffle: the table is joined as a broadcast side whose
    size is the checked number of slots. An empty table stays empty.
    """
    spark = docs.sparkSession
    owners = F.split(F.lit(",".join(map(str, lookup_table(cfg.shards, cfg.slots)))), ",").cast("array<int>")
    names = F.array(*[F.lit(s) for s in cfg.shards])
    table = (
        spark.range(1)
        .select(F.posexplode(owners).alias("_slot", "_owner"))
        .select("_slot", F.element_at(names, F.col("_owner") + 1).alias("_shard"))
    )
    rest = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ("slot", "shard")]
    return (
        docs.select(F.struct("*").alias("_row"), slot_of(key, cfg.slots).alias("_place"))
        .join(F.broadcast(table), F.col("_place") == F.col("_slot"))
        .select(*rest, F.col("_place").alias("slot"), F.col("_shard").alias("shard"))
    )
