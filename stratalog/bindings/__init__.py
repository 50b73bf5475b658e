"""Queries over the given tables, one or more per operator, each with its SQL where one exists.

The tables hold no instruction rows, wells or prices, so operators are bound by shape; the binding
is stated in each query.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.config import SkewConfig

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that must give the same rows."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


#: for queries that take the path of hot keys on tables of any size
SMALL_BLOCKS = SkewConfig(max_rows=50)


def utc(column: str) -> Column:
    """A time without zone as UTC, whatever the zone of the session."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(column))
    return local.cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
