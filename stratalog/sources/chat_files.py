"""Chat rows from JSONL and JSON-array files, and back.

Rows keep their place ``(file, block, row)``: block is where the file split starts and row rises
inside it, so ordering by the three is the order of the lines. The place is fixed for one read;
write the rows out before using it in two branches of a plan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.functions.messages import example_error
from stratalog.functions.text import is_blank, strip
from stratalog.sources.lines import line_numbers, placed_lines


def _text(holder: Column, path: str) -> Column:
    """A string field of a variant; null unless it really is a string."""
    field = F.try_variant_get(holder, path, "variant")
    return F.when(
        F.schema_of_variant(field) == "STRING", F.try_variant_get(holder, path, "string")
    )


def parsed(df: DataFrame, json: str = "line") -> DataFrame:
    """Add ``messages``, ``meta`` and ``error`` from one JSON text per row.

    Values are typed: a number as content is an error, not a text. Invalid JSON includes duplicate
    keys and bare NaN.
    """
    v = df.withColumn("_v", F.try_parse_json(json))
    turns = F.expr("try_variant_get(_v, '$.messages', 'array<variant>')")
    out = v.withColumn(
        "messages",
        F.transform(
            turns,
            lambda m: F.struct(
                _text(m, "$.role").alias("role"), _text(m, "$.content").alias("content")
            ),
        ),
    ).withColumn(
        "meta",
        F.struct(
            *[_text(F.col("_v"), f"$.meta.{f}").alias(f) for f in ("type", "category", "source")]
        ),
    )
    return out.withColumn(
        "error",
        F.when(F.col("_v").isNull(), F.lit("invalid JSON")).otherwise(
            example_error(F.col("messages"))
        ),
    ).drop("_v")


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Non-blank lines with source file and place."""
    return placed_lines(spark, paths).where(~is_blank(F.col("line")))


def read_jsonl(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Valid chat rows, and rejects with file, line number, line and error."""
    rows = parsed(read_lines(spark, paths))
    good = rows.where("error is null").drop("error", "line")
    bad = line_numbers(rows.where("error is not null"), placed_lines(spark, paths))
    return good, bad.select("source", "file", "block", "row", "line_no", "line", "error")


def integrity(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Per file: JSON records, and lines that are not JSON."""
    lines = read_lines(spark, paths).withColumn("_ok", F.try_parse_json("line").isNotNull())
    return lines.groupBy("source").agg(
        F.count_if(F.col("_ok")).alias("n_valid"), F.count_if(~F.col("_ok")).alias("n_malformed")
    )


def count_valid(spark: SparkSession, paths: str | list[str]) -> int:
    """Number of records; fails if any line is malformed."""
    row = integrity(spark, paths).agg(
        F.coalesce(F.sum("n_valid"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("n_malformed"), F.lit(0)).alias("bad"),
    ).first()
    if row["bad"]:
        raise ValueError(f"{row['bad']} malformed line(s)")
    return row["n"]


def write_jsonl(df: DataFrame, path: str) -> None:
    """``{"messages": …}`` lines with text as it is; other columns are left out."""
    df.select(F.to_json(F.struct("messages"))).write.mode("errorifexists").text(path)


def write_dropped(dropped: DataFrame, path: str) -> None:
    """``{n_tokens, example}`` lines for rows over the token cap."""
    dropped.select("n_tokens", "example").write.mode("errorifexists").json(path)


def write_table(df: DataFrame, path: str) -> None:
    """Raw, clean and report tables as Parquet."""
    df.write.mode("errorifexists").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def staged(df: DataFrame, path: str) -> DataFrame:
    """Write a table to the shared folder and go on from there.

    Cuts the lineage, and fixes row places, in a way that outlives lost executors.
    """
    write_table(df, path)
    return read_table(df.sparkSession, path)
