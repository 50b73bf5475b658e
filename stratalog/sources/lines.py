"""Text files line by line, each line with its place, and line numbers counted over file splits.

A place is ``(file, block, row)``: block is where the file split starts and row rises inside it, so
ordering by the three is the order of the lines. The place is fixed for one read; write the rows out
before using it in two branches of a plan that may be read anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F


def placed_lines(spark: SparkSession, paths: str | list[str], **options: str) -> DataFrame:
    """``(line, source, file, block, row)`` for every line, blank ones too."""
    return (
        spark.read.options(**options)
        .text(paths)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_name").alias("source"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
        )
        .withColumn("row", F.monotonically_increasing_id())
    )


def line_numbers(df: DataFrame, lines: DataFrame) -> DataFrame:
    """Add ``line_no``, from 1, to rows that kept their place in ``lines``.

    Every split is counted, and a running sum over the splits of a file gives the number of lines
    before each: one row per split, whatever the size of the file.
    """
    splits = lines.groupBy("file", "block").agg(F.min("row").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    return (
        df.join(splits, ["file", "block"], "left")
        .withColumn("line_no", F.col("row") - F.col("_first") + F.col("_before") + 1)
        .drop("_first", "_n", "_before")
    )
