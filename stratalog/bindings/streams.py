"""Keyed state on streams: the whole ``events`` table as a stream, run until nothing is left.

The table is written to files in the order of time, and a micro-batch reads one of them. A stream holds
back rows newer than its watermark, so the last file is one row from the far future: the watermark
passes all events, what was held back comes out, and the result covers the whole table.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.bindings import query, table, utc
from stratalog.bindings.dialogue import SQL_CONTEXT, session_rows
from stratalog.functions.times import micros
from stratalog.session import scratch_path
from stratalog.streaming import states

END = "end of input"
LATEST = "2250-01-01 00:00:00"
PIECES, PIECE_ROWS = 12, 1_000_000


def settable_times(spark: SparkSession, folder: str) -> bool:
    """Whether the file system of a folder lets the time of a file be set, as object stores do not."""
    probe = spark._jvm.org.apache.hadoop.fs.Path(scratch_path(spark, "probe"))
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark._jsc.hadoopConfiguration()
    system = probe.getFileSystem(conf)
    if system.getUri().toString() != at.getFileSystem(conf).getUri().toString():
        return False
    system.create(probe).close()
    system.setTimes(probe, 86_400_000, -1)
    return system.getFileStatus(probe).getModificationTime() == 86_400_000


def written(spark: SparkSession, folder: str) -> tuple[Any, list]:
    """The file system and the data files of a folder in the order of their tasks."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    files = [f for f in system.listStatus(at) if f.getPath().getName().startswith("part-")]
    return system, sorted(files, key=lambda f: f.getPath().getName())


def in_time_order(rows: DataFrame, key: str, time: str, path: str, settable: bool | None = None) -> None:
    """Write files each later than the one before, in time and as files: of about ``PIECE_ROWS`` rows,
    but ``PIECES`` at least, and one with the closing row. One job writes them, a range of times a task, and
    their times are set in order; where a file system cannot do that, they are written again one by one."""
    spark, us = rows.sparkSession, micros(time)
    n = max(PIECES, math.ceil(rows.count() / PIECE_ROWS))
    closing = spark.range(1).select(
        *[
            (F.lit(END) if f.name == key else F.to_timestamp(F.lit(LATEST)) if f.name == time else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in rows.schema
        ]
    )
    if settable is None:
        settable = settable_times(spark, path)
    target = path if settable else scratch_path(spark, "dealt")
    marked = rows.withColumns({"_us": us, "_row": F.monotonically_increasing_id()}).where(F.col("_us").isNotNull())
    ranges = marked.repartitionByRange(n, "_us").sortWithinPartitions("_us", "_row")
    ranges.select(*rows.columns).write.parquet(target)
    system, files = written(spark, target)
    if settable:
        first = min([f.getModificationTime() for f in files], default=0)
        for i, f in enumerate(reversed(files)):
            system.setTimes(f.getPath(), first - 1_000 * i, -1)
    else:
        for f in files:
            spark.read.schema(rows.schema).parquet(f.getPath().toString()).coalesce(1).write.mode("append").parquet(path)
    closing.coalesce(1).write.mode("append").parquet(path)


def drained(
    rows: DataFrame, key: str, time: str, build: Callable[[DataFrame], DataFrame], name: str
) -> DataFrame:
    """Run a stream over all rows, a file of them at a time, into a Parquet folder and read that."""
    spark = rows.sparkSession
    source, out, marks = (scratch_path(spark, f"{name}{part}") for part in ("-in", "", "-checkpoint"))
    in_time_order(rows, key, time, source)
    states.state_store(spark)
    folded = build(spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source))
    # each partition of the state costs a micro-batch some time, and beyond the groups it is empty
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cores = max(8, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", min(partitions, cores, states.GROUPS))
    job = (
        folded.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", marks)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    job.awaitTermination()
    return spark.read.schema(folded.schema).parquet(out).where(F.col(key) != END)


@query(
    "session_context_stream",
    f"""WITH {SQL_CONTEXT} SELECT session_id, t AS event_us, created_us, at_id IS NOT NULL AS has_context,
      'w' || at_id AS well_name, 'summary ' || at_id AS summary, nz AS n_zones,
      CASE WHEN nz > 0 THEN 'class ' || nz END AS dominant_lithology FROM cx""",
)
def session_context_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same columns as in batch."""
    events = session_rows(table(spark, sf, "events").withColumn("ts", utc("ts"))).drop("event_id")
    events = events.withColumn("session_id", F.col("session_id").cast("string"))
    out = drained(events, "session_id", "ts", states.session_context, "session-context")
    return out.select(
        F.col("session_id").cast("bigint").alias("session_id"),
        micros("ts").alias("event_us"),
        micros("created_at").alias("created_us"),
        "has_context", "well_name", "summary", "n_zones", "dominant_lithology",
    )


@query(
    "served_values_stream",
    """WITH RECURSIVE ev AS (SELECT event_id, event_type AS series, epoch_us(ts) AS t, value >= 20 AS ok,
        value FROM events),
      g AS (SELECT series, t FROM ev WHERE ok),
      st AS (SELECT series, min(t) AS t FROM g GROUP BY series
        UNION ALL SELECT st.series, min(g.t) FROM st JOIN g ON g.series = st.series
          AND g.t > st.t + 3600000000 GROUP BY st.series),
      sv AS (SELECT st.series, st.t, ev.value FROM st JOIN ev ON ev.series = st.series AND ev.t = st.t
        AND ev.ok),
      j AS (SELECT ev.*, sv.t AS st, sv.value AS sv FROM ev ASOF LEFT JOIN sv
        ON ev.series = sv.series AND ev.t >= sv.t)
    SELECT series, t AS fetched_us, ok, sv AS served_value, st AS served_us,
      CASE WHEN st IS NULL THEN 'failed' WHEN t - st > 3600000000 THEN 'stale'
        WHEN t = st THEN 'refreshed' ELSE 'cached' END AS state FROM j""",
)
def served_values_stream(spark: SparkSession, sf: str) -> DataFrame:
    requests = table(spark, sf, "events").withColumn("ts", utc("ts")).select(
        F.col("event_type").alias("series"),
        F.col("ts").alias("fetched_at"),
        (F.col("value") >= 20).alias("ok"),
        "value",
    )
    out = drained(requests, "series", "fetched_at", states.served_values, "served-values")
    return out.select(
        "series", micros("fetched_at").alias("fetched_us"), "ok", "served_value",
        micros("served_at").alias("served_us"), "state",
    )
