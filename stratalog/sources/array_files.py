"""Folders of JSON-array and JSON-lines files, arrays of any size among them."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.config import SkewConfig
from stratalog.functions.text import is_blank, strip
from stratalog.operators.skew import mark_blocks, running_sum, scan_marked
from stratalog.sources.chat_files import parsed, read_jsonl
from stratalog.sources.lines import placed_lines


def first_characters(pieces: DataFrame) -> DataFrame:
    """``(file, first)``: first non-blank character of each file; a file without one has no row."""
    shown = pieces.where(~is_blank(F.col("line")))
    return shown.groupBy("file").agg(
        F.min_by(F.substring(strip(F.col("line")), 1, 1), F.struct("block", "row")).alias("first")
    )


def _brackets(text: Column) -> Column:
    """Opening brackets less closing ones."""
    opened = F.length(text) - F.length(F.translate(text, "[{", ""))
    return opened - (F.length(text) - F.length(F.translate(text, "]}", "")))


def array_items(pieces: DataFrame, skew: SkewConfig = SkewConfig()) -> tuple[DataFrame, DataFrame]:
    """``(file, source, row, line)`` for every item of files that hold one JSON array each, and
    ``(file, source)`` of those whose array does not end. Files may have any size and lines any length.

    ``pieces`` are the files cut at every comma. What a piece does to the text after it is known from
    its characters alone: whether it changes between inside and outside of a string, and how many
    brackets it opens, in either case. Running sums over the pieces, within splits and over them, give
    the state at each comma; one outside of strings in one open bracket ends an item.
    """
    bare = F.regexp_replace("line", r"(?s)\\.", "")
    parts = F.split(bare, '"')
    known = pieces.select(
        "file", "source", "block", "row", "line",
        (F.size(parts) - 1).cast("bigint").alias("quotes"),
        _brackets(F.array_join(F.filter(parts, lambda _, i: i % 2 == 0), "")).cast("bigint").alias("outside"),
        _brackets(F.array_join(F.filter(parts, lambda _, i: i % 2 == 1), "")).cast("bigint").alias("inside"),
    )
    keys, order = ["file"], ["block", "row"]
    marked = mark_blocks(known, keys, order, skew, pieces.select(*keys))
    quoted = scan_marked(marked, keys, order, _quotes=running_sum(F.col("quotes")))
    in_string = (F.col("_quotes") - F.col("quotes")) % 2 == 1
    opened = quoted.withColumns({"_in": in_string, "opens": F.when(in_string, F.col("inside")).otherwise(F.col("outside"))})
    deep = scan_marked(opened, keys, order, _depth=running_sum(F.col("opens")))
    ends = ~F.col("_in") & (F.col("_depth") - F.col("opens") == 1)
    cut = deep.withColumn("_cut", ends.cast("bigint"))
    numbered = scan_marked(cut, keys, order, _item=running_sum(F.col("_cut")))
    last = F.max_by(F.struct("_item", "_depth"), F.struct("block", "row"))
    files = numbered.groupBy("file", "source").agg(last.alias("_last"))
    whole = numbered.groupBy("file", "source", "_item").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "row", "line"))), lambda x: x["line"]), ",").alias("line")
    )
    joined = whole.join(files, ["file", "source"])
    text = F.when(F.col("_item") == 0, F.regexp_replace("line", r"^\s*\[", "")).otherwise(F.col("line"))
    final = (F.col("_item") == F.col("_last._item")) & (F.col("_last._depth") == 0)
    text = F.when(final, F.regexp_replace(text, r"\]\s*$", "")).otherwise(text)
    items = joined.select("file", "source", F.col("_item").alias("row"), text.alias("line"), (F.col("_last._item") == 0).alias("_lone"))
    return (
        items.where(~(F.col("_lone") & is_blank(F.col("line")))).drop("_lone"),
        files.where("_last._depth != 0").select("file", "source"),
    )


def read_flexible(
    spark: SparkSession, paths: str | list[str], skew: SkewConfig = SkewConfig()
) -> tuple[DataFrame, DataFrame]:
    """Like :func:`read_jsonl`, but a file that starts with ``[`` is one JSON array.

    Items are parsed one by one, so neither a file nor an array has a limit in size. An array without
    end is a reject of its own, beside its items. The driver sees names of files only, which it lists
    anyway. ``line_no`` of an array item is its place in the array.
    """
    pieces = placed_lines(spark, paths, lineSep=",")
    starts = first_characters(pieces).withColumn("_array", F.col("first") == "[")
    names = {True: [], False: []}
    for r in starts.select("file", "_array").collect():
        names[r["_array"]].append(unquote(r["file"]))
    if not names[True]:
        return read_jsonl(spark, paths)
    items, open_ = array_items(placed_lines(spark, names[True], lineSep=","), skew)
    zero = F.lit(0).cast("bigint").alias("block")
    found = parsed(items.select("line", "source", "file", zero, "row"))
    number = {"line_no": F.col("row") + 1}
    good, bad = found.where("error is null"), found.where("error is not null").withColumns(number)
    no_end = open_.select("file", "source", F.lit("array without end").alias("error"))
    bad = bad.unionByName(no_end, allowMissingColumns=True)
    if names[False]:
        rows, rejects = read_jsonl(spark, names[False])
        good, bad = good.unionByName(rows, allowMissingColumns=True), bad.unionByName(rejects, allowMissingColumns=True)
    columns = ["source", "file", "block", "row", "line_no", "line", "error"]
    return good.drop("error", "line"), bad.select(*columns)
