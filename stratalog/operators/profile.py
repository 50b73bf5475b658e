"""Counts and length summaries of a corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.functions.messages import has_system
from stratalog.functions.text import percent


def value_shares(df: DataFrame, column: str) -> DataFrame:
    """Count and percent per value, null as a value of its own."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select(F.sum("n")).scalar()
    return counts.withColumn("pct", percent(F.col("n"), total))


def top_prefixes(df: DataFrame, column: str = "category", k: int = 30) -> DataFrame:
    """Most frequent parts before the first dot; equal counts are ordered by name."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.substring_index(column, ".", 1).alias("prefix"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "prefix")
        .limit(k)
    )


def length_summary(df: DataFrame, column: str = "output", short: int = 15) -> DataFrame:
    """Min, median, mean, max and the number of short texts; null counts as empty.

    The exact median works on (length, count) pairs, counted before the shuffle.
    """
    sizes = df.select(F.length(F.coalesce(F.col(column), F.lit(""))).cast("bigint").alias("size"))
    counts = sizes.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(
        F.min("size").alias("min_chars"),
        F.expr("percentile(size, 0.5, n)").alias("median_chars"),
        (F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean_chars"),
        F.max("size").alias("max_chars"),
        F.coalesce(F.sum(F.when(F.col("size") < short, F.col("n"))), F.lit(0)).alias("n_short"),
    )


def composition(df: DataFrame, source: str = "source") -> DataFrame:
    """Count and percent per source, largest first."""
    return value_shares(df, source).orderBy(F.col("n").desc(), source)


def system_conformance(df: DataFrame) -> DataFrame:
    """How many chat rows have no standard system message."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~has_system(F.col("messages"))).alias("n_nonstandard"),
    )


def text_report(df: DataFrame, cfg_short: int = 15, k: int = 30) -> DataFrame:
    """The profile as rows ``(section, item, n, pct)`` for a report sink."""
    types = value_shares(df, "type").select(
        F.lit("type").alias("section"), F.col("type").alias("item"), "n", "pct"
    )
    prefixes = top_prefixes(df, "category", k).select(
        F.lit("category prefix").alias("section"), F.col("prefix").alias("item"), "n",
        F.lit(None).cast("double").alias("pct"),
    )
    sizes = length_summary(df, "output", cfg_short)
    rows = ["min_chars", "median_chars", "mean_chars", "max_chars", "n_short"]
    lengths = sizes.select(
        F.inline(
            F.array(*[
                F.struct(
                    F.lit("output length").alias("section"),
                    F.lit(r).alias("item"),
                    F.floor(F.col(r)).cast("bigint").alias("n"),
                    F.lit(None).cast("double").alias("pct"),
                )
                for r in rows
            ])
        )
    )
    return types.unionByName(prefixes).unionByName(lengths)
