"""Well-log files: listing with size and type checks, CSV, and bulk LAS ingest."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window as W
from pyspark.sql import functions as F

from stratalog.config import MAX_UPLOAD_BYTES, NULL_SENTINELS, UPLOAD_EXTENSIONS
from stratalog.functions.text import once, strip
from stratalog.operators.wells import strip_sentinels
from stratalog.session import scratch_path
from stratalog.sources.chat_files import read_table, staged
from stratalog.sources.folders import PIECE_BYTES, files_below, pieces
from stratalog.sources.lines import line_numbers, placed_lines

NULL_WORDS = ("", "NA", "N/A", "NaN", "nan", "null", "NULL", "None", "n/a", "-nan", "<NA>")
NO_DATA = r"^(#|$)"
TEXT_COLUMNS = ("WELL", "GROUP", "FORMATION", "LITHOLOGY")


def upload_errors(
    name: Column, length: Column, max_bytes: int = MAX_UPLOAD_BYTES
) -> Column:
    """Why a file is not read: too large, or neither of the known types; null if it is fine."""
    low = F.lower(name)
    known = F.lit(False)
    for extension in UPLOAD_EXTENSIONS:
        known = known | low.endswith(extension)
    return F.when(
        length > max_bytes, F.lit(f"file exceeds {max_bytes // (1024 * 1024)} MB")
    ).when(
        ~known,
        F.concat(
            F.lit("unsupported file type: '"), low, F.lit("'. Upload a .las or .csv well log.")
        ),
    )


def listing(
    spark: SparkSession, path: str | list[str], max_bytes: int = MAX_UPLOAD_BYTES
) -> DataFrame:
    """``(path, file, length, kind, error)`` per file; contents are not read.

    Mounted folders are listed by tasks; elsewhere Spark's reader holds the names on the driver.
    """
    file = F.regexp_replace("path", r"^.*/", "")
    folders = _mounted_folders(spark, path)
    if folders is None:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    else:
        files = files_below(spark, folders).withColumn("path", F.concat(F.lit("file:"), "path"))
    return files.select(
        "path",
        file.alias("file"),
        "length",
        F.regexp_extract(F.lower(file), r"\.([^.]*)$", 1).alias("kind"),
        upload_errors(file, F.col("length"), max_bytes).alias("error"),
    )


def _local_folder(spark: SparkSession, path: str) -> str | None:
    """The path as the tasks' file system knows it; null for HDFS and object stores."""
    if not re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path):
        default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")
        return path if default.startswith("file:") else None
    return re.sub(r"^file:/+", "/", path) if path.startswith("file:") else None


def _mounted_folders(spark: SparkSession, path: str | list[str]) -> list[str] | None:
    """Folders that tasks can list themselves; null if one is elsewhere, a pattern, a file or not there."""
    found = [_local_folder(spark, p) for p in ([path] if isinstance(path, str) else path)]
    if not found or any(p is None or not p.startswith("/") or re.search(r"[\[\]{}*?\\]", p) or not os.path.isdir(p) for p in found):
        return None
    return list(dict.fromkeys(re.sub("^/+", "/", os.path.normpath(p)) for p in found))


def _part_writer(root: str, extension: str) -> Callable:
    """Task function over sorted rows ``(part, line)``: a file per part; gives their number.

    A file has its name once it is whole, the same in every attempt of a task. Lines are written as by
    Spark's CSV writer, which has two quotes for an empty text and an empty line for null.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        folder = os.path.join(root, f"{TaskContext.get().partitionId():05d}")
        draft = os.path.join(root, f"_{uuid.uuid4().hex}")
        file, part, n = None, None, 0
        os.makedirs(folder, exist_ok=True)

        def finish() -> None:
            file.close()
            os.replace(draft, os.path.join(folder, f"{n:09d}.{extension}"))

        for batch in batches:
            runs = pc.run_end_encode(batch.column("part"))
            lines, start = batch.column("line"), 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                if file is None or name != part:
                    if file is not None:
                        finish()
                        n += 1
                    file, part = open(draft, "w", encoding="utf-8", newline=""), name
                texts = lines.slice(start, end - start).to_pylist()
                file.writelines("\n" if t is None else f"{t}\n" if t else '""\n' for t in texts)
                start = end
        if file is not None:
            finish()
            n += 1
        yield pa.record_batch([pa.array([n], pa.int64())], names=["n"])

    return write


def write_parts(lines: DataFrame, root: str, extension: str) -> None:
    """A text file per ``part`` from rows ``(part, line)`` whose partitions hold whole parts, sorted.

    Where the folder is on a mounted file system the tasks write the files themselves: Hadoop's local
    file system starts several processes for each new file, which thousands of files wait for.
    Elsewhere Spark's writer does it.
    """
    folder = _local_folder(lines.sparkSession, root)
    if folder is not None:
        lines.mapInArrow(_part_writer(folder, extension), "n long").agg(F.sum("n")).collect()
        return
    (
        lines.write.partitionBy("part")
        .option("extension", extension)
        .option("quote", "\u0000")
        .option("sep", "\u0001")
        .option("ignoreLeadingWhiteSpace", "false")
        .csv(root)
    )


def read_csv(
    spark: SparkSession, path: str | list[str], text_columns: tuple[str, ...] = TEXT_COLUMNS
) -> DataFrame:
    """CSV logs with one common header: upper-case names, numeric curves, null markers removed.

    Columns are read as text and cast, so no pass over the data is spent on guessing types. Adds
    ``file`` and the place of the row ``(block, row)``.
    """
    raw = spark.read.option("recursiveFileLookup", "true").csv(path, header=True)
    upper = [c.upper() for c in raw.columns]
    if len(set(upper)) < len(upper):
        raise ValueError(f"column names differ only by case: {raw.columns}")

    def typed(old: str, new: str) -> Column:
        text = F.when(~F.col(f"`{old}`").isin(*NULL_WORDS), F.col(f"`{old}`"))
        return (text if new in text_columns else text.try_cast("double")).alias(new)

    rows = raw.select(
        *[typed(o, n) for o, n in zip(raw.columns, upper)],
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ).withColumn("row", F.monotonically_increasing_id())
    kept = [c for c in rows.columns if c not in ("block", "row")]
    clean = strip_sentinels(rows.select(*kept, F.struct("block", "row").alias("_at")))
    return clean.select(*kept, "_at.block", "_at.row")


def _section(sections: Column, letter: str) -> Column:
    return F.try_element_at(
        F.filter(sections, lambda s: F.upper(F.substring(s, 1, 1)) == letter), F.lit(1)
    )


def _las_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return placed_lines(
        spark, path, recursiveFileLookup="true", pathGlobFilter="*.[lL][aA][sS]"
    ).withColumn("at", F.struct("block", "row"))


def las_files(
    spark: SparkSession, path: str | list[str], lines: DataFrame | None = None, names: DataFrame | None = None
) -> DataFrame:
    """One row per LAS file: what its header declares, where its data lie, and an error or null.

    Only the lines before the data section are gathered, so a file may have any size. ``lines`` are those
    of the files if they have been read already, ``names`` the files if they have been listed.
    """
    lines = _las_lines(spark, path) if lines is None else lines
    marks = lines.where(F.col("line").startswith("~"))
    data = F.upper(F.substring("line", 2, 1)) == "A"
    starts = marks.groupBy("file").agg(F.min(F.when(data, F.col("at"))).alias("start"))
    later = marks.join(starts, "file").where(F.col("at") > F.col("start"))
    ends = later.groupBy("file").agg(F.min("at").alias("end"))
    headers = (
        lines.join(starts.where("start is not null"), "file")
        .where(F.col("at") < F.col("start"))
        .groupBy("file")
        .agg(
            F.split(
                F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "line"))), lambda x: x["line"]), "\n"),
                r"(?m)^~",
            ).alias("_s")
        )
    )
    if names is None:
        names = (
            spark.read.format("binaryFile")
            .option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.[lL][aA][sS]")
            .load(path)
            .select(F.col("_metadata.file_path").alias("file"))
        )
    return _declared(names.join(starts, "file", "left").join(ends, "file", "left").join(headers, "file", "left"))


def _declared(headers: DataFrame) -> DataFrame:
    """What the sections ``_s`` before the data declare; other columns stay."""
    kept = [c for c in headers.columns if c != "_s"]
    parts = headers.select(
        *kept,
        _section(F.col("_s"), "V").alias("v"),
        _section(F.col("_s"), "W").alias("w"),
        _section(F.col("_s"), "C").alias("c"),
    )
    stem = F.regexp_replace(F.regexp_replace("file", r"^.*/", ""), r"(?<=.)\.[^.]*$", "")
    named = strip(F.regexp_extract("w", r"(?im)^[ \t]*WELL[ \t]*\.\S*[ \t]+([^:\n]*):", 1))
    declared = strip(
        F.regexp_extract("w", r"(?im)^[ \t]*NULL[ \t]*\.\S*[ \t]+([^:\n]*)(?::|$)", 1)
    )
    of_curves = F.split("c", "\n")
    curve_lines = F.filter(
        F.slice(of_curves, F.lit(2), F.greatest(F.size(of_curves), F.lit(0))),
        lambda line: line.rlike(r"^[ \t]*[^#\s.][^.]*\."),
    )
    curves = F.transform(
        curve_lines, lambda line: F.upper(strip(F.regexp_extract(line, r"^([^.]*)\.", 1)))
    )
    return parts.select(
        *kept,
        F.coalesce(F.when(named != "", named), stem).alias("well"),
        declared.try_cast("double").alias("null_value"),
        curves.alias("curves"),
        F.when(F.col("c").isNull() | F.col("start").isNull(), F.lit("no curve or data section"))
        .when(F.size(curves) == 0, F.lit("no curves declared"))
        .alias("error"),
        F.coalesce(F.col("v").rlike(r"(?im)^[ \t]*WRAP[ \t]*\.[ \t]*YES"), F.lit(False)).alias("wrapped"),
    )


def _wrapped_records(data: DataFrame) -> DataFrame:
    """Records of files whose records go over several lines: ``values`` and the line where each begins.

    A value's number in its file is the number of values before its line, counted within its split and
    by a running sum over the splits, plus its place in the line; its record is that number divided by
    the number of curves. So a record may begin in one split and end in the next.
    """
    size = F.size("values").cast("bigint")
    inside = W.partitionBy("file", "block").orderBy("row").rowsBetween(W.unboundedPreceding, -1)
    splits = data.groupBy("file", "block").agg(F.sum(size).alias("_n"))
    ahead = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    splits = splits.withColumn("_ahead", F.coalesce(F.sum("_n").over(ahead), F.lit(0))).drop("_n")
    placed = data.withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0))).join(splits, ["file", "block"])
    first = F.col("_ahead") + F.col("_inside")
    each = placed.select(
        "file", "path", "well", "null_value", "curves", "line_no", first.alias("_first"), F.posexplode("values").alias("_i", "_text")
    )
    number = F.col("_first") + F.col("_i")
    return (
        each.withColumn("_record", F.floor(number / F.size("curves")))
        .groupBy("file", "path", "well", "null_value", "curves", "_record")
        .agg(
            F.min("line_no").alias("line_no"),
            # at most as many values as there are curves
            F.transform(F.array_sort(F.collect_list(F.struct(number.alias("n"), "_text"))), lambda v: v["_text"]).alias("values"),
        )
    )


RECORD = ("path", "well", "null_value", "curves", "line_no", "values")


def _records_over_splits(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Records of files read in splits: their lines meet headers and line counts in joins."""
    inside = (F.col("at") > F.col("start")) & (F.col("end").isNull() | (F.col("at") < F.col("end")))
    data = (
        lines.join(files.where("error is null"), "file")
        .where(inside)
        .withColumn("line", strip(F.col("line")))
        .where(~F.col("line").rlike(NO_DATA))
        .withColumn("values", F.split("line", r"\s+"))
    )
    data = line_numbers(data, lines).withColumn("path", F.col("file"))
    return data.where(~F.col("wrapped")).select(*RECORD).unionByName(
        _wrapped_records(data.where("wrapped")).select(*RECORD)
    )


def _whole_files(whole: DataFrame) -> DataFrame:
    """As `las_files`, from rows that hold all lines of a file, which stay; ``start`` and ``end`` are indices."""
    lines = F.col("lines")
    marks = F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.get(lines, i).startswith("~"))
    data = F.filter("_marks", lambda i: F.upper(F.substring(F.get(lines, i), 2, 1)) == "A")
    later = F.filter("_marks", lambda i: i > F.col("start"))
    head = F.split(F.array_join(F.slice(lines, F.lit(1), F.col("start")), "\n"), r"(?m)^~")
    return _declared(
        whole.select("file", "lines", marks.alias("_marks"))
        .withColumn("start", F.get(data, F.lit(0)))
        .select("file", "lines", "start", F.get(later, F.lit(0)).alias("end"), F.when(F.col("start").isNotNull(), head).alias("_s"))
    )


def _records_in_rows(files: DataFrame) -> DataFrame:
    """Records of files whose lines are in one row. A wrapped record has the number of its first value's line."""
    start, n = F.col("start"), F.size("curves")
    lines = F.slice("lines", start + 2, F.coalesce("end", F.size("lines")) - start - 1)
    numbered = F.transform(lines, lambda line, i: F.struct((start + i + 2).cast("bigint").alias("line_no"), strip(line).alias("line")))
    data = F.transform(
        F.filter(numbered, lambda x: ~x["line"].rlike(NO_DATA)),
        lambda x: F.struct(x["line_no"].alias("line_no"), F.split(x["line"], r"\s+").alias("values")),
    )
    each = F.flatten(F.transform("_data", lambda x: F.transform(x["values"], lambda v: F.struct(x["line_no"].alias("line_no"), v.alias("text")))))

    def records(values: Column) -> Column:
        starts = F.when(F.size(values) > 0, F.sequence(F.lit(1), F.size(values), n)).otherwise(F.array().cast("array<int>"))
        return F.transform(
            starts,
            lambda i: F.struct(
                F.get(values, i - 1)["line_no"].alias("line_no"),
                F.transform(F.slice(values, i, n), lambda v: v["text"]).alias("values"),
            ),
        )

    return (
        files.where("error is null")
        .withColumn("_data", data)
        .select(
            F.col("file").alias("path"), "well", "null_value", "curves",
            F.explode(F.when(F.col("wrapped"), once(each, records)).otherwise(F.col("_data"))).alias("_r"),
        )
        .select("path", "well", "null_value", "curves", "_r.line_no", "_r.values")
    )


def _read_folders(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """Records and files of LAS files, from a table of their lines.

    In mounted folders tasks find and read the files: a file up to `PIECE_BYTES` is one row, its header
    and records come from that row; longer files go on in pieces. Elsewhere Spark's reader gives the lines.
    """
    folders = _mounted_folders(spark, path)
    if folders is None:
        lines = staged(_las_lines(spark, path), scratch_path(spark, "las-lines"))
        files = las_files(spark, path, lines)
        return _records_over_splits(lines, files), files.select("file", "error")
    size = min(PIECE_BYTES, spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes())
    names = files_below(spark, folders).where(F.lower(F.substring("path", -4, 4)) == ".las")
    table = scratch_path(spark, "las-lines")
    # rows may have a megabyte: readers take a row group at once, so these stay small
    groups = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "8"}
    pieces(names, size).write.options(**groups).parquet(table)
    read = read_table(spark, table)
    files = _whole_files(read.where("whole"))
    records, checked = _records_in_rows(files), files.select("file", "error")
    long_names = names.where(F.col("length") > size).select("file")
    if not long_names.isEmpty():
        lines = read.where("not whole").select("file", "block", F.posexplode("lines").alias("row", "line"))
        lines = lines.withColumn("at", F.struct("block", "row"))
        files = las_files(spark, path, lines, long_names)
        records = records.unionByName(_records_over_splits(lines, files))
        checked = checked.unionByName(files.select("file", "error"))
    return records, checked


def read_las(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """``(path, well, row, depth, curve, value)`` from a folder of LAS files, and rejected files.

    The first declared curve is the depth; ``row`` is the number of the line in its file. In a wrapped
    file a record goes on until it has a value for each curve, and ``row`` is the line where it begins.
    A line whose number of values differs from the number of curves, or the last record of a wrapped
    file if values lack, is a reject of its own, with its number.
    Files are read by lines in splits, so size has no limit, and every file gives rows or a reject. They
    are opened once for their lines, which go on from a table: headers, data and line numbers need them.
    """
    data, files = _read_folders(spark, path)
    fits = F.size("values") == F.size("curves")
    bad_lines = data.where(~fits).select(
        "path", F.concat(F.lit("wrong number of values in line "), F.col("line_no")).alias("error")
    )
    rest = F.size("curves") - 1
    pairs = F.arrays_zip(
        F.slice("curves", F.lit(2), rest).alias("curve"), F.slice("values", F.lit(2), rest).alias("text")
    )
    number = F.col("_p.text").try_cast("double")
    missing = number.isin(*NULL_SENTINELS) | F.coalesce(
        number == F.col("null_value"), F.lit(False)
    )
    long = (
        data.where(fits)
        .select(
            "path", "well", "null_value", F.col("line_no").alias("row"),
            F.col("values")[0].try_cast("double").alias("depth"),
            F.explode(pairs).alias("_p"),
        )
        .select(
            "path", "well", "row", "depth",
            F.col("_p.curve").alias("curve"),
            F.when(~missing & ~F.isnan(number), number).alias("value"),
        )
    )
    rejects = files.where("error is not null").select(F.col("file").alias("path"), "error")
    return long, rejects.unionByName(bad_lines)


def las_wide(long: DataFrame, curves: list[str]) -> DataFrame:
    """Long curve rows to one column per curve, keyed by ``(path, well, row)``."""
    return (
        long.groupBy("path", "well", "row", F.col("depth").alias("DEPT"))
        .pivot("curve", curves)
        .agg(F.first("value", ignorenulls=True))
    )
