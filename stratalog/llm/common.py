"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.session import scratch_path
from stratalog.sources.chat_files import staged


def kept(df: DataFrame, name: str) -> DataFrame:
    """The frame written to the shared folder and read back: lineage ends there."""
    return staged(df, scratch_path(df.sparkSession, name))


def share(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """Broadcast a value with its classes, so that workers need no installed package."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)


def bucket_of(doc_id: Column, buckets: int) -> Column:
    """``crc32`` of the id as text, modulo ``buckets``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % buckets


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def span_list(spans: Column) -> Column:
    """``kind:start:end``, comma-joined in the order given."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def join_spread(rows: DataFrame, table: DataFrame, key: str, parts: int = 2_000) -> DataFrame:
    """Left join of ``rows`` to a table with different values of ``key``, whatever the copies.

    Keys with more than ``1 / parts`` of the rows number fewer than ``parts``; their rows of the
    table are broadcast, and only the other rows are shuffled by key. Rows without a key come back
    unmatched.
    """
    rows = kept(rows, "join-rows")
    counts = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    limit = rows.count() / parts
    heavy = kept(counts.where(F.col("_n") > limit).select(key).join(table, key, "left"), "join-heavy")
    is_heavy = rows.join(F.broadcast(heavy), key)
    light = rows.where(F.col(key).isNotNull()).join(F.broadcast(heavy.select(key)), key, "left_anti")
    bare = rows.where(F.col(key).isNull())
    return is_heavy.unionByName(light.join(table, key, "left")).unionByName(bare, allowMissingColumns=True)
