"""Splits, sampling, oversampling and leak guards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.operators.skew import smallest, top_per_group


def seeded_hash(key: Column, *seed: object) -> Column:
    """A repeatable random order: same row and seed, same place, whatever the partitioning."""
    parts = [key.cast("string")]
    for s in seed:
        parts += [F.lit("|"), s.cast("string") if isinstance(s, Column) else F.lit(str(s))]
    return F.sha2(F.concat(*parts), 256)


def split_exact(df: DataFrame, key: str, fraction: float, seed: int) -> DataFrame:
    """Add ``split``: exactly ``max(1, int(n * fraction))`` rows are ``val``, the others ``train``.

    ``key`` must be unique: split the pool before oversampling it.
    """
    hashed = df.withColumn("_hash", seeded_hash(F.col(key), seed))
    n = df.select(F.count(F.lit(1)).alias("n"))
    take = n.select(
        F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(float(fraction)))).cast("bigint")
    ).scalar()
    in_val = smallest(hashed, "_hash", key, take)
    return hashed.withColumn("split", F.when(in_val, "val").otherwise("train")).drop("_hash")


def oversample(df: DataFrame, factors: DataFrame, source: str = "source") -> DataFrame:
    """Repeat rows of the named sources; a factor of one or less adds no copy.

    ``factors`` is the caller's small ``(source, factor)`` list; Spark picks the join by its size.
    """
    times = F.greatest(F.coalesce(F.col("factor"), F.lit(1)), F.lit(1))
    return (
        df.join(factors, source, "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
        .drop("factor")
    )


def unknown_sources(df: DataFrame, factors: DataFrame, source: str = "source") -> DataFrame:
    """Named sources that do not occur in the rows."""
    return factors.join(df.select(source).distinct(), source, "left_anti")


def without_keys(new: DataFrame, seen: DataFrame, key: str = "key") -> DataFrame:
    """Rows whose key is not in ``seen``; copies inside ``new`` stay.

    The keys are made distinct before the join. No hint: Spark broadcasts them only below its size
    threshold and otherwise joins by key, where adaptive execution splits a hot key of ``new``.
    """
    return new.join(seen.select(key).distinct(), key, "left_anti")


def append_with_factor(train: DataFrame, new: DataFrame, factor: int) -> DataFrame:
    """Existing rows once, new rows ``factor`` times."""
    copies = F.sequence(F.lit(1), F.lit(factor)) if factor > 0 else F.array().cast("array<int>")
    added = new.withColumn("copy", F.explode(copies))
    return train.withColumn("copy", F.lit(1)).unionByName(added)


def append_new(
    train: DataFrame, val: DataFrame, new: DataFrame, factor: int = 5, key: str = "key"
) -> tuple[DataFrame, DataFrame]:
    """The grown train set, and per reason the number of new rows left out."""
    not_val = without_keys(new, val, key)
    fresh = without_keys(not_val, train, key)
    counted = new.join(val.select(key).distinct().withColumn("_v", F.lit(True)), key, "left").join(
        train.select(key).distinct().withColumn("_t", F.lit(True)), key, "left"
    )
    report = counted.agg(
        F.count_if(F.col("_v").isNotNull()).alias("in_val"),
        F.count_if(F.col("_v").isNull() & F.col("_t").isNotNull()).alias("in_train"),
        F.count_if(F.col("_v").isNull() & F.col("_t").isNull()).alias("added"),
    )
    return append_with_factor(train, fresh, factor), report


def shuffled(df: DataFrame, key: list[str], seed: int) -> DataFrame:
    """Rows in a repeatable random order, for sinks that need one (a distributed range sort)."""
    place = seeded_hash(F.concat_ws("|", *[F.col(c).cast("string") for c in key]), seed)
    return df.withColumn("_place", place).orderBy("_place", *key).drop("_place")


def subset(df: DataFrame, key: str, size: int, seed: int) -> DataFrame:
    """A repeatable random subset of fixed size, or all rows if there are no more."""
    return (
        df.withColumn("_hash", seeded_hash(F.col(key), seed))
        .orderBy("_hash", key)
        .limit(size)
        .drop("_hash")
    )


def subset_per_round(df: DataFrame, key: str, rounds: int, size: int, seed: int) -> DataFrame:
    """A fresh subset for each evaluation round; adds ``round``."""
    each = df.withColumn("round", F.explode(F.sequence(F.lit(1), F.lit(rounds))))
    each = each.withColumn("_hash", seeded_hash(F.col(key), seed, F.col("round")))
    picked = top_per_group(
        each.select("round", key, "_hash"), ["round"], [F.col("_hash"), F.col(key)], size, [key]
    )
    return df.join(picked.select("round", key), key)


def leakage(rows: DataFrame, key: str = "key", split: str = "split") -> DataFrame:
    """Keys that occur in more than one split, per pair of splits.

    One aggregation over ``(key, split)``; a key has at most as many entries as there are splits.
    """
    pairs = rows.groupBy(key, split).agg(F.count(F.lit(1)).alias("n"))
    per_key = pairs.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct(F.col(split).alias("s"), "n"))).alias("_s")
    ).where(F.size("_s") > 1)
    exploded = per_key.select(
        F.posexplode("_s").alias("_i", "_a"), "_s"
    ).select("_a", F.explode(F.slice("_s", F.col("_i") + 2, F.size("_s"))).alias("_b"))
    return exploded.groupBy(
        F.col("_a.s").alias("split_a"), F.col("_b.s").alias("split_b")
    ).agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.sum("_a.n").alias("rows_a"),
        F.sum("_b.n").alias("rows_b"),
    )


def group_holdout(df: DataFrame, group: str, fraction: float, seed: int) -> DataFrame:
    """Add ``split`` by group, so all rows of a group fall on one side; no shuffle."""
    bucket = F.conv(F.substring(seeded_hash(F.col(group), seed), 1, 8), 16, 10).cast("double")
    return df.withColumn(
        "split", F.when(bucket < fraction * 2.0**32, "test").otherwise("train")
    )
