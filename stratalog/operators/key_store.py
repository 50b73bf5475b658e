"""Keys of all rows kept so far, as a table bucketed by key, so that appends shuffle only what is new.

A store is a folder: ``keys`` holds the bucketed files, ``layout`` the number of buckets. Several appends
add files to the same buckets. The catalog of a session only names the folder; another session opens it
again by its path.
"""

from __future__ import annotations

import os
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KeyStore:
    """A store of text keys, opened by ``create`` or ``open_store``."""

    spark: SparkSession
    path: str
    buckets: int
    name: str

    def keys(self) -> DataFrame:
        """All stored keys; a key that was added twice is there twice."""
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the name in the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def _named(spark: SparkSession, path: str, buckets: int) -> KeyStore:
    name = f"key_store_{uuid.uuid4().hex}"
    place = os.path.join(path, "keys").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} (key STRING) USING parquet CLUSTERED BY (key) INTO {int(buckets)} BUCKETS "
        f"LOCATION '{place}'"
    )
    return KeyStore(spark, path, int(buckets), name)


def create(spark: SparkSession, path: str, buckets: int = 64) -> KeyStore:
    """An empty store in a new folder.

    The number of buckets is fixed for good: choose it so that a bucket of the final store fits in a task.
    """
    layout = spark.range(1).select(F.lit(int(buckets)).alias("buckets"))
    layout.write.mode("errorifexists").parquet(os.path.join(path, "layout"))
    return _named(spark, path, buckets)


def open_store(spark: SparkSession, path: str) -> KeyStore:
    """A store that another session created."""
    return _named(spark, path, spark.read.parquet(os.path.join(path, "layout")).first()["buckets"])


def placed(store: KeyStore, keys: DataFrame) -> DataFrame:
    """The different keys that are not null, partitioned like the store."""
    known = keys.select(F.col("key").cast("string").alias("key")).where("key is not null")
    return known.distinct().repartition(store.buckets, "key")


def seen(store: KeyStore, new: DataFrame) -> DataFrame:
    """The different keys of ``new`` that the store holds.

    The new keys are made distinct on the map side first and then moved to the store's buckets, so a key
    with very many rows is one row per task, and the stored side is read in place.
    """
    return placed(store, new).join(store.keys(), "key", "left_semi")


def fresh(store: KeyStore, new: DataFrame) -> DataFrame:
    """The rows whose key is not stored; copies inside ``new`` stay, and so do rows with a null key.

    Rows meet only the stored keys among their own, at most as many as ``new`` has rows. No hint: Spark
    broadcasts them below its size threshold, otherwise adaptive execution splits a hot key.
    """
    return new.join(seen(store, new), "key", "left_anti")


def add(store: KeyStore, new: DataFrame) -> None:
    """Store the keys of ``new``, one file per bucket.

    Adding is repeatable: if the driver is lost before or after it, the same append may run again, and
    a key held twice drops the same rows as one held once.
    """
    placed(store, new).write.insertInto(store.name)


def append(store: KeyStore, new: DataFrame, path: str) -> DataFrame:
    """Write the rows with unseen keys to ``path`` and store their keys; the rows as written.

    ``path`` is overwritten, so an append that was interrupted between the two writes can run again: its
    keys are not stored yet. Once the keys are stored, the same rows are no longer fresh.
    """
    fresh(store, new).write.mode("overwrite").parquet(path)
    kept = store.spark.read.parquet(path)
    add(store, kept)
    return kept
