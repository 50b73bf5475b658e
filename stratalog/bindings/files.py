"""File scans and sinks: whole tables are written to a fresh folder and read back.

The folder lies below the shared checkpoint folder of the session, so executors on any machine can
write and read it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.bindings import query, table
from stratalog.bindings.corpus import SQL_CHATS, SQL_MEASURED, examples, instruction_rows, measured
from stratalog.config import TokenConfig
from stratalog.functions import messages as M
from stratalog.operators import chat, profile, tokens
from stratalog.session import scratch_path
from stratalog.sources import array_files, chat_files, log_files


def _planted_lines(spark: SparkSession, sf: str) -> DataFrame:
    """One JSON line per conversation; some are cut off, blank, or carry a number as content."""
    c = F.col("conv_id")
    line = F.to_json(F.struct("messages"))
    lines = (
        F.when(c % 5 == 0, F.array(line, F.lit('{"messages": [{"role"')))
        .when(c % 7 == 0, F.array(line, F.lit("   ")))
        .when(
            c % 11 == 0,
            F.array(line, F.lit(
                '{"messages": [{"role": "user", "content": 5}, {"role": "assistant", "content": "x"}]}'
            )),
        )
        .otherwise(F.array(line))
    )
    return examples(spark, sf).select("conv_id", F.explode(lines).alias("value"))


_SQL_PLANTED = f"""{SQL_CHATS},
  bad AS (SELECT 'invalid JSON' AS error, count(*) AS n FROM chats WHERE conv_id % 5 = 0
    UNION ALL SELECT 'blank content in role user', count(*) FROM chats
      WHERE conv_id % 5 <> 0 AND conv_id % 7 <> 0 AND conv_id % 11 = 0)"""


@query(
    "scan_chat_lines",
    f"""WITH {_SQL_PLANTED} SELECT key, n_messages, NULL AS error FROM checked WHERE error IS NULL
    UNION ALL SELECT NULL, count(*), error FROM checked WHERE error IS NOT NULL GROUP BY error
    UNION ALL SELECT NULL, n, error FROM bad WHERE n > 0""",
)
def scan_chat_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Valid rows by content key, rejects counted by reason."""
    path = scratch_path(spark, "chat-lines")
    _planted_lines(spark, sf).select("value").write.text(path)
    good, bad = chat_files.read_jsonl(spark, path)
    return good.select(
        M.content_key(F.col("messages")).alias("key"),
        F.size("messages").cast("bigint").alias("n_messages"),
        F.lit(None).cast("string").alias("error"),
    ).unionByName(
        bad.groupBy("error").agg(F.count(F.lit(1)).alias("n_messages")).select(
            F.lit(None).cast("string").alias("key"), "n_messages", "error"
        )
    )


@query(
    "scan_flexible",
    f"WITH {SQL_CHATS} SELECT key, n_messages, conv_id % 2 = 0 AS from_array FROM checked "
    "WHERE error IS NULL",
)
def scan_flexible(spark: SparkSession, sf: str) -> DataFrame:
    """Even conversations in JSON arrays of at most fifty, odd ones in JSON lines."""
    root = scratch_path(spark, "flexible")
    ex = examples(spark, sf).withColumn("value", F.to_json(F.struct("messages")))
    arrays = (
        ex.where(F.col("conv_id") % 2 == 0)
        .groupBy(F.floor(F.col("conv_id") / 100).alias("part"))
        .agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("value"), ",\n"), F.lit("]"))
             .alias("value"))
    )
    arrays.repartition("part").write.partitionBy("part").text(f"{root}/arrays")
    chat_files.write_jsonl(ex.where(F.col("conv_id") % 2 == 1), f"{root}/lines")
    good, _ = array_files.read_flexible(spark, [f"{root}/arrays/*", f"{root}/lines"])
    return good.select(
        M.content_key(F.col("messages")).alias("key"),
        F.size("messages").cast("bigint").alias("n_messages"),
        F.contains("file", F.lit("/arrays/")).alias("from_array"),
    )


@query(
    "table_round_trip",
    "SELECT doc_id, lang, source, sha256(text) AS digest FROM documents",
)
def table_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "documents")
    chat_files.write_table(table(spark, sf, "documents"), path)
    d = chat_files.read_table(spark, path)
    return d.select("doc_id", "lang", "source", F.sha2("text", 256).alias("digest"))


@query(
    "scan_well_csv",
    """SELECT 'w' || l_suppkey AS "WELL", l_orderkey::DOUBLE AS "DEPT", l_linenumber::DOUBLE AS "LINE",
      CASE WHEN l_linenumber <> 2 THEN l_quantity END AS "GR",
      CASE WHEN l_linenumber NOT IN (3, 4) THEN l_discount END AS "NPHI" FROM lineitem""",
)
def scan_well_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Lower-case header; null markers and null words are planted by line number."""
    path = scratch_path(spark, "csv")
    n = F.col("l_linenumber")
    table(spark, sf, "lineitem").select(
        F.concat(F.lit("w"), F.col("l_suppkey")).alias("well"),
        F.col("l_orderkey").alias("dept"),
        n.alias("line"),
        F.when(n == 2, F.lit("-999.25")).otherwise(F.col("l_quantity").cast("string")).alias("gr"),
        F.when(n == 3, F.lit("NA")).when(n == 4, F.lit("-999"))
        .otherwise(F.col("l_discount").cast("string")).alias("nphi"),
    ).write.csv(path, header=True)
    return log_files.read_csv(spark, path).select("WELL", "DEPT", "LINE", "GR", "NPHI")


def _write_las(spark: SparkSession, sf: str, root: str, wrapped: bool = False) -> None:
    """One LAS file per supplier and span of 200,000 orders, so no file grows with a hot supplier.

    Lines are sorted inside the writing task and streamed out, never gathered. A wrapped record has its
    depth on a line of its own and the other values on the next one, or on one line each.
    """
    li = table(spark, sf, "lineitem").select(
        F.concat_ws("_", "l_suppkey", F.floor(F.col("l_orderkey") / 200_000)).alias("part"),
        "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity", "l_discount",
    )
    head = (
        "~Version\\n VERS. 2.0 : v\\n WRAP. NO : one line per depth\\n~Well\\n NULL. -999.25 :\\n"
        " WELL. W{} : name\\n~Curve\\n DEPT.M : depth\\n GR.API : gamma\\n NPHI.V/V : neutron\\n~A DEPT GR NPHI"
    ).replace("\\n", "\n").replace("WRAP. NO : one", "WRAP. YES : some" if wrapped else "WRAP. NO : one").split("{}")
    heads = li.select("part", "l_suppkey").distinct().select(
        "part",
        F.posexplode(
            F.split(F.concat(F.lit(head[0]), F.col("l_suppkey"), F.lit(head[1])), "\n")
        ).alias("i", "line"),
    ).select("part", F.lit(-1.0).alias("depth"), F.col("i").cast("double").alias("i"), "line")
    gr = F.when(F.col("l_linenumber") == 3, F.lit("-999.25")).otherwise(F.col("l_quantity").cast("string"))
    nphi = F.when(F.col("l_linenumber") == 4, F.lit("-999.9")).otherwise(F.col("l_discount").cast("string"))
    depth = F.col("l_orderkey").cast("string")
    if wrapped:
        lines = F.when(F.col("l_linenumber") % 2 == 0, F.array(depth, F.concat_ws("  ", gr, nphi))).otherwise(F.array(depth, gr, nphi))
    else:
        lines = F.array(F.concat_ws("  ", depth, gr, nphi))
    data = li.select(
        "part",
        F.col("l_orderkey").cast("double").alias("depth"),
        F.col("l_linenumber").cast("double").alias("i"),
        F.monotonically_increasing_id().alias("record"),
        F.posexplode(lines).alias("k", "line"),
    )
    ordered = (
        heads.unionByName(data, allowMissingColumns=True)
        .repartition("part")
        .sortWithinPartitions("part", "depth", "i", "record", "k")
        .select("part", "line")
    )
    log_files.write_parts(ordered, root, "las")


SQL_LAS = """SELECT 'W' || l_suppkey AS well, l_orderkey::DOUBLE AS depth, 'GR' AS curve,
      CASE WHEN l_linenumber <> 3 THEN l_quantity END AS value FROM lineitem
    UNION ALL SELECT 'W' || l_suppkey, l_orderkey::DOUBLE, 'NPHI',
      CASE WHEN l_linenumber <> 4 THEN l_discount END FROM lineitem"""


@query("ingest_las_wrapped", SQL_LAS)
def ingest_las_wrapped(spark: SparkSession, sf: str) -> DataFrame:
    """The same curves from files whose records go over two or three lines."""
    root = scratch_path(spark, "las-wrapped")
    _write_las(spark, sf, root, wrapped=True)
    long, _ = log_files.read_las(spark, root)
    return long.select("well", "depth", "curve", "value")


@query("ingest_las", SQL_LAS)
def ingest_las(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "las")
    _write_las(spark, sf, root)
    long, _ = log_files.read_las(spark, root)
    return long.select("well", "depth", "curve", "value")


@query(
    "upload_listing",
    """SELECT 'las' AS kind, NULL AS error, count(DISTINCT (l_suppkey, l_orderkey // 200000)) AS n FROM lineitem
    UNION ALL SELECT 'parquet', 'unsupported type', 1""",
)
def upload_listing(spark: SparkSession, sf: str) -> DataFrame:
    """All LAS files and one Parquet file, counted by kind and reason."""
    root = scratch_path(spark, "uploads")
    _write_las(spark, sf, f"{root}/las")
    table(spark, sf, "nation").coalesce(1).write.parquet(f"{root}/other")
    listed = log_files.listing(spark, root)
    error = F.when(F.col("error").startswith("unsupported"), "unsupported type").otherwise(
        F.col("error")
    )
    return listed.groupBy("kind", error.alias("error")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "upload_size_cap",
    """WITH lines AS (SELECT l_suppkey AS w, l_orderkey // 200000 AS part, l_orderkey || '  ' ||
        CASE WHEN l_linenumber = 3 THEN '-999.25' ELSE CAST(l_quantity AS VARCHAR) END || '  ' ||
        CASE WHEN l_linenumber = 4 THEN '-999.9' ELSE CAST(l_discount AS VARCHAR) END AS line FROM lineitem),
      head AS (SELECT '~Version|' || ' VERS. 2.0 : v|' || ' WRAP. NO : one line per depth|' || '~Well|' ||
        ' NULL. -999.25 :|' || ' WELL. W : name|' || '~Curve|' || ' DEPT.M : depth|' || ' GR.API : gamma|' ||
        ' NPHI.V/V : neutron|' || '~A DEPT GR NPHI|' AS text),
      files AS (SELECT w, part, CAST(sum(length(line) + 1) AS BIGINT) + length(w::VARCHAR) + max(length(text)) AS n
        FROM lines, head GROUP BY w, part)
    SELECT n > 16384 AS too_large, count(*) AS n, min(n) AS min_length, max(n) AS max_length FROM files GROUP BY 1""",
)
def upload_size_cap(spark: SparkSession, sf: str) -> DataFrame:
    """Files over a cap of 16 KB, listed without their contents."""
    root = scratch_path(spark, "capped")
    _write_las(spark, sf, root)
    listed = log_files.listing(spark, root, 16384)
    return listed.groupBy(F.col("error").isNotNull().alias("too_large")).agg(
        F.count(F.lit(1)).alias("n"), F.min("length").alias("min_length"),
        F.max("length").alias("max_length"),
    )


@query(
    "write_chat_lines",
    f"WITH {SQL_CHATS} SELECT conv_id, rendered FROM chats",
)
def write_chat_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Written and parsed back; the conversation is found again by its key."""
    path = scratch_path(spark, "sink")
    ex = examples(spark, sf)
    chat_files.write_jsonl(ex, path)
    back = chat_files.parsed(chat_files.read_lines(spark, path)).select(
        M.render(F.col("messages")).alias("rendered")
    )
    ids = ex.select("conv_id", M.render(F.col("messages")).alias("_r"))
    return back.join(ids, F.sha2("rendered", 256) == F.sha2("_r", 256)).select("conv_id", "rendered")


@query(
    "write_dropped",
    f"WITH {SQL_MEASURED} SELECT total_tokens AS n_tokens, rendered FROM measured JOIN chats "
    "USING (conv_id) WHERE total_tokens > 512",
)
def write_dropped(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "dropped")
    _, dropped = tokens.within_cap(measured(spark, sf), TokenConfig(max_tokens=512))
    chat_files.write_dropped(dropped, path)
    back = spark.read.schema(f"n_tokens bigint, example struct<messages:{M.MESSAGES}>").json(path)
    return back.select("n_tokens", M.render(F.col("example.messages")).alias("rendered"))


@query(
    "integrity_count",
    """SELECT count(DISTINCT conv_id) + count(DISTINCT conv_id) FILTER (WHERE conv_id % 5 <> 0
        AND conv_id % 7 <> 0 AND conv_id % 11 = 0) AS n_valid,
      count(DISTINCT conv_id) FILTER (WHERE conv_id % 5 = 0) AS n_malformed FROM conversations""",
)
def integrity_count(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "integrity")
    _planted_lines(spark, sf).select("value").write.text(path)
    return chat_files.integrity(spark, path).agg(
        F.sum("n_valid").alias("n_valid"), F.sum("n_malformed").alias("n_malformed")
    )


@query(
    "profile_report",
    """SELECT 'type' AS section, lang AS item, count(*) AS n,
      100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct FROM documents GROUP BY lang
    UNION ALL SELECT 'category prefix', source, count(*), NULL FROM documents
      WHERE doc_id % 10 <> 0 GROUP BY source
    UNION ALL SELECT 'output length', unnest(['min_chars', 'median_chars', 'mean_chars', 'max_chars',
      'n_short']), unnest([min(length(text)), CAST(floor(quantile_cont(length(text), 0.5)) AS BIGINT),
      CAST(floor(avg(length(text))) AS BIGINT), max(length(text)),
      count(*) FILTER (WHERE length(text) < 15)]), NULL FROM documents""",
)
def profile_report(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "report")
    chat_files.write_table(profile.text_report(instruction_rows(spark, sf)), path)
    return chat_files.read_table(spark, path)
