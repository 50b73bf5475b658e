"""Files of mounted folders, listed and read by tasks, so that the driver holds no name of a file.

Spark's readers keep the names and lengths of all files on the driver, which millions of small files outgrow.
Here they lie in a table. Other file systems, file patterns and single files are left to Spark's readers.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import reduce
from itertools import batched

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.session import scratch_path
from stratalog.sources.chat_files import staged

ENTRY = pa.schema([("path", pa.string()), ("file", pa.string()), ("length", pa.int64()), ("folder", pa.bool_())])
PIECE = pa.schema([("file", pa.string()), ("block", pa.int64()), ("whole", pa.bool_()), ("lines", pa.list_(pa.binary()))])
#: a file up to this size is one row with all its lines
PIECE_BYTES = 1 << 20
BATCH_ROWS, BATCH_BYTES = 4_096, 4 << 20
#: what a file URI, as in Spark's ``_metadata.file_path``, has as it is: some ASCII, and letters and marks beyond
PLAIN = re.compile(r"[A-Za-z0-9_\-!.~'()*,;:$&+=@/]*")


def file_uri(path: str) -> str:
    """The path as in ``_metadata.file_path``; spaces, control and other marks of ASCII are quoted."""
    if PLAIN.fullmatch(path):
        return f"file:{path}"
    kept = (c if PLAIN.fullmatch(c) or c > "\x9f" and not c.isspace() else "".join(f"%{b:02X}" for b in c.encode()) for c in path)
    return f"file:{''.join(kept)}"


def _hidden(name: str, folder: bool) -> bool:
    """What Spark's readers pass over."""
    if folder and name.startswith(("_metadata", "_common_metadata")):
        return False
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task function: what lies in folders. A broken link is no entry, nor is a name that is not UTF-8."""

    def entry(at: os.DirEntry) -> tuple | None:
        try:
            at.name.encode()
            folder = at.is_dir()
            length = None if folder else at.stat().st_size
        except (FileNotFoundError, UnicodeEncodeError):
            return None
        return None if _hidden(at.name, folder) else (at.path, file_uri(at.path), length, folder)

    for batch in batches:
        for top in batch.column("path").to_pylist():
            with os.scandir(top) as found:
                for some in batched(found, BATCH_ROWS):
                    rows = [row for row in map(entry, some) if row]
                    if rows:
                        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), ENTRY, strict=True)], schema=ENTRY)


def _tasks(spark: SparkSession, rows: int) -> int:
    return max(1, min(rows, int(spark.conf.get("spark.sql.shuffle.partitions"))))


def files_below(spark: SparkSession, folders: list[str]) -> DataFrame:
    """``(path, file, length)`` of the files below mounted folders, ``file`` being the URI.

    Empty files are passed over, as by Spark's readers. Folders are listed level by level, each level into a table; a task streams what it finds.
    """
    level, n, found = spark.createDataFrame([(f,) for f in folders], "path string"), len(folders), []
    while n:
        entries = staged(
            level.repartition(_tasks(spark, n)).mapInArrow(_entries, "path string, file string, length long, folder boolean"),
            scratch_path(spark, "entries"),
        )
        found.append(entries.where("length > 0").drop("folder"))
        level = entries.where("folder").select("path")
        n = level.count()
    files = reduce(DataFrame.unionByName, found)
    return files if len(folders) == 1 else files.dropDuplicates(["path"])


def _after_line(file, at: int) -> int:
    """Where the line ends that holds byte ``at`` or ends there, with its line end."""
    file.seek(at)
    while chunk := file.read(1 << 16):
        if m := re.search(rb"\r\n?|\n", chunk):
            if m[0] == b"\r" and m.end() == len(chunk) and file.read(1) == b"\n":
                return at + m.end() + 1
            return at + m.end()
        at += len(chunk)
    return at


def _lines(path: str, start: int, end: int, length: int) -> list[bytes]:
    """The lines of a piece, from the first that begins after ``start`` to the one that holds byte ``end``.

    Every line is in one piece, as with Hadoop's line reader; a mark for UTF-8 at the beginning is no text.
    """
    with open(path, "rb") as file:
        first = 0 if start == 0 else _after_line(file, start)
        if first > end:
            return []
        last = length if end >= length else _after_line(file, end)
        file.seek(first)
        text = file.read(last - first)
    return (text.removeprefix(b"\xef\xbb\xbf") if start == 0 else text).splitlines()


def _read_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for batch in batches:
        for r in batch.to_pylist():
            lines = _lines(r["path"], r["block"], r["end"], r["length"])
            rows.append((r["file"], r["block"], r["whole"], lines))
            size += min(r["length"], r["end"] - r["block"])
            if len(rows) == BATCH_ROWS or size >= BATCH_BYTES:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECE, strict=True)], schema=PIECE)
                rows, size = [], 0
    if rows:
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), PIECE, strict=True)], schema=PIECE)


def pieces(files: DataFrame, piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """``(file, block, whole, lines)`` from rows of `files_below`: a row per file of up to ``piece_bytes``.

    Longer files have a row for each piece of that size, ``block`` being where it starts and ``whole``
    false. Texts that are not UTF-8 keep their bytes.
    """
    spark = files.sparkSession
    block = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("length") - 1, F.lit(0)), F.lit(piece_bytes).cast("long"))
    starts = files.select("path", "file", "length", (F.col("length") <= piece_bytes).alias("whole"), F.explode(block).alias("block"))
    starts = starts.withColumn("end", F.col("block") + piece_bytes).repartition(_tasks(spark, starts.count()))
    read = starts.mapInArrow(_read_pieces, "file string, block long, whole boolean, lines array<binary>")
    return read.withColumn("lines", F.col("lines").cast("array<string>"))
