"""Corpus queries.

Instruction rows come from ``documents``: type = lang, category = source, instruction = the text for
every third row, else a phrase with the language, output = text. Chat examples come from ``conversations``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.bindings import query, table
from stratalog.config import SYSTEM_PROMPT, CleanConfig, MixConfig, TokenConfig
from stratalog.functions import messages as M
from stratalog.functions.text import clean, count_words, estimate_tokens
from stratalog.operators import chat, clean as rows, key_store, mix, profile, tokens
from stratalog.session import scratch_path

# patterns that occur in the generated texts; word boundaries as explicit ASCII classes
P_INSTRUCTION = "thing and"
P_BROKEN = "(?:^|[^A-Za-z0-9_])(?:of|and) that(?:[^A-Za-z0-9_]|$)"
P_PLACEHOLDER = "nothing|tion, the"
CLEAN = CleanConfig(
    types=("en", "fr", "de"),
    drop_prefixes=("src18", "src19"),
    instruction_pattern=P_INSTRUCTION,
    broken_pattern=P_BROKEN,
    placeholder_pattern=P_PLACEHOLDER,
)


def instruction_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select(
        F.col("doc_id").alias("row_id"),
        F.col("lang").alias("type"),
        F.when(F.col("doc_id") % 10 != 0, F.col("source")).alias("category"),
        F.when(F.col("doc_id") % 3 == 0, F.col("text"))
        .otherwise(F.concat(F.lit("Write in "), F.col("lang")))
        .alias("instruction"),
        F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("input"),
        F.col("text").alias("output"),
    )


SQL_ROWS = """rows_ AS (
  SELECT doc_id AS row_id, lang AS type, CASE WHEN doc_id % 10 <> 0 THEN source END AS category,
         CASE WHEN doc_id % 3 = 0 THEN text ELSE 'Write in ' || lang END AS instruction, CASE WHEN doc_id % 2 = 0 THEN lang END AS input,
         text AS output
  FROM documents)"""


def sql_clean(x: str) -> str:
    strip = rf"regexp_replace(regexp_replace(coalesce({x}, ''), '^\s+', ''), '\s+$', '')"
    return (
        rf"regexp_replace(regexp_replace({strip}, '\n{{3,}}', chr(10) || chr(10), 'g'), "
        rf"'[ \t]{{2,}}', ' ', 'g')"
    )


@query(
    "filter_types",
    "SELECT doc_id AS row_id, lang AS type FROM documents WHERE lang IN ('en', 'fr', 'de')",
)
def filter_types(spark: SparkSession, sf: str) -> DataFrame:
    return rows.keep_types(instruction_rows(spark, sf), CLEAN).select("row_id", "type")


@query(
    "drop_category_prefixes",
    f"""WITH {SQL_ROWS} SELECT row_id, category FROM rows_
    WHERE category IS NULL OR NOT (category LIKE 'src18%' OR category LIKE 'src19%')""",
)
def drop_category_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    return rows.drop_categories(instruction_rows(spark, sf), CLEAN).select("row_id", "category")


def _drop_pattern(column: str, pattern: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        df = instruction_rows(spark, sf)
        return rows.drop_matching(df, column, pattern).select("row_id")

    sql = f"WITH {SQL_ROWS} SELECT row_id FROM rows_ WHERE NOT regexp_matches({column}, '{pattern}', 'i')"
    return sql, run


for _name, _column, _pattern in (
    ("drop_instruction_noise", "instruction", P_INSTRUCTION),
    ("drop_broken_templates", "output", P_BROKEN),
    ("drop_placeholders", "output", P_PLACEHOLDER),
):
    _sql, _run = _drop_pattern(_column, _pattern)
    query(_name, _sql)(_run)

_WIDE = "'  ' || replace(replace(text, '.', '.  '), chr(10), chr(10) || chr(10) || chr(10)) || chr(9)"


def _widened() -> Column:
    """Texts with gaps to clean: doubled blanks, tripled newlines, outer white space."""
    text = F.replace(F.replace("text", F.lit("."), F.lit(".  ")), F.lit("\n"), F.lit("\n\n\n"))
    return F.concat(F.lit("  "), text, F.lit("\t"))


@query(
    "clean_text",
    f"SELECT doc_id AS row_id, {sql_clean('t')} AS output "
    f"FROM (SELECT doc_id, {_WIDE} AS t FROM documents)",
)
def clean_text(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(
        F.col("doc_id").alias("row_id"), _widened().alias("output")
    )
    return rows.clean_text(d, ("output",))


@query(
    "minimum_length",
    f"SELECT doc_id AS row_id, CAST(length({sql_clean('text')}) AS BIGINT) AS n FROM documents "
    f"WHERE length({sql_clean('text')}) >= 15",
)
def minimum_length(spark: SparkSession, sf: str) -> DataFrame:
    d = rows.clean_text(instruction_rows(spark, sf))
    kept = rows.length_between(d, "output", CLEAN.min_output, 0)
    return kept.select("row_id", F.length("output").cast("bigint").alias("n"))


@query(
    "maximum_length",
    f"SELECT doc_id AS row_id, CAST(length({sql_clean('text')}) AS BIGINT) AS n FROM documents "
    f"WHERE length({sql_clean('text')}) BETWEEN 15 AND 2500",
)
def maximum_length(spark: SparkSession, sf: str) -> DataFrame:
    d = rows.clean_text(instruction_rows(spark, sf))
    kept = rows.length_between(d, "output", CLEAN.min_output, CLEAN.max_output)
    return kept.select("row_id", F.length("output").cast("bigint").alias("n"))


@query(
    "dedup_rows",
    f"""WITH {SQL_ROWS} SELECT min(row_id) AS row_id, length(output)::BIGINT AS n FROM rows_
    GROUP BY instruction, coalesce(input, ''), output""",
)
def dedup_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = instruction_rows(spark, sf)
    return rows.dedup_rows(d, ["row_id"]).select(
        "row_id", F.length("output").cast("bigint").alias("n")
    )


_SQL_REASON = f"""CASE
  WHEN type NOT IN ('en', 'fr', 'de') THEN 'type'
  WHEN category LIKE 'src18%' OR category LIKE 'src19%' THEN 'category'
  WHEN regexp_matches(instruction, '{P_INSTRUCTION}', 'i') THEN 'instruction'
  WHEN regexp_matches(output, '{P_BROKEN}', 'i') THEN 'broken'
  WHEN regexp_matches(output, '{P_PLACEHOLDER}', 'i') THEN 'placeholder'
  WHEN length({sql_clean('output')}) < 15 THEN 'short'
  WHEN length({sql_clean('output')}) > 2500 THEN 'long' END"""


@query(
    "filter_and_clean",
    f"""WITH {SQL_ROWS}, c AS (
      SELECT row_id, type, instruction, coalesce(input, '') AS input, {sql_clean('output')} AS output,
             {_SQL_REASON} AS reason FROM rows_)
    SELECT min(row_id) AS row_id, instruction, input, output FROM c WHERE reason IS NULL
    GROUP BY instruction, input, output""",
)
def filter_and_clean(spark: SparkSession, sf: str) -> DataFrame:
    kept = rows.filter_and_clean(instruction_rows(spark, sf), ["row_id"], CLEAN)
    return kept.select("row_id", "instruction", "input", "output")


@query(
    "filter_funnel",
    f"""WITH {SQL_ROWS}, c AS (
      SELECT row_id, instruction, coalesce(input, '') AS i, {sql_clean('output')} AS o,
             {_SQL_REASON} AS reason FROM rows_),
    r(step, rule) AS (VALUES (1, 'type'), (2, 'category'), (3, 'instruction'), (4, 'broken'),
                             (5, 'placeholder'), (6, 'short'), (7, 'long'), (8, 'duplicate')),
    n AS (SELECT step, rule, CASE WHEN rule = 'duplicate'
            THEN (SELECT count(*) - count(DISTINCT (instruction, i, o)) FROM c WHERE reason IS NULL)
            ELSE (SELECT count(*) FROM c WHERE reason = rule) END AS removed FROM r)
    SELECT CAST(step AS BIGINT) AS step, rule, CAST(removed AS BIGINT) AS removed,
           CAST((SELECT count(*) FROM documents) - sum(removed) OVER (ORDER BY step) AS BIGINT)
             AS remaining FROM n""",
)
def filter_funnel(spark: SparkSession, sf: str) -> DataFrame:
    return rows.funnel(instruction_rows(spark, sf), CLEAN)


@query(
    "null_meta",
    "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN value END AS value FROM events",
)
def null_meta(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
        .alias("value"),
    )
    return rows.null_meta(e, ["value"])


# --- profiles -------------------------------------------------------------------------------


@query(
    "type_shares",
    """SELECT lang AS type, count(*) AS n, 100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct
    FROM documents GROUP BY lang""",
)
def type_shares(spark: SparkSession, sf: str) -> DataFrame:
    return profile.value_shares(instruction_rows(spark, sf), "type")


@query(
    "category_prefixes",
    """SELECT split_part(source || '.' || lang, '.', 1) AS prefix, count(*) AS n FROM documents
    GROUP BY 1 ORDER BY n DESC, prefix LIMIT 30""",
)
def category_prefixes(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select(
        F.concat_ws(".", "source", "lang").alias("category")
    )
    return profile.top_prefixes(d)


@query(
    "length_summary",
    """SELECT min(length(text))::BIGINT AS min_chars, quantile_cont(length(text), 0.5) AS median_chars,
    sum(length(text))::DOUBLE / count(*) AS mean_chars, max(length(text))::BIGINT AS max_chars,
    count(*) FILTER (WHERE length(text) < 15) AS n_short FROM documents""",
)
def length_summary(spark: SparkSession, sf: str) -> DataFrame:
    return profile.length_summary(instruction_rows(spark, sf))


@query(
    "source_composition",
    """SELECT 'file' || (conv_id % 3) AS source, count(*) AS n,
    100.0::DOUBLE * count(*) / sum(count(*)) OVER () AS pct
    FROM (SELECT DISTINCT conv_id FROM conversations) GROUP BY 1""",
)
def source_composition(spark: SparkSession, sf: str) -> DataFrame:
    """Source of a conversation = its id modulo 3."""
    return profile.composition(examples(spark, sf).select("source"))


@query(
    "system_conformance",
    """SELECT count(DISTINCT conv_id) AS n_rows,
    count(DISTINCT conv_id) FILTER (WHERE conv_id % 3 <> 0) AS n_nonstandard FROM conversations""",
)
def system_conformance(spark: SparkSession, sf: str) -> DataFrame:
    """Every third conversation gets the standard system message first."""
    standard = M.with_system(F.col("messages"))
    df = examples(spark, sf).withColumn(
        "messages", F.when(F.col("conv_id") % 3 == 0, standard).otherwise(F.col("messages"))
    )
    return profile.system_conformance(df)


# --- chat rows ------------------------------------------------------------------------------


def examples(spark: SparkSession, sf: str) -> DataFrame:
    """One chat example per conversation; source = id modulo 3."""
    chats = chat.assemble(table(spark, sf, "conversations"))
    return chats.withColumn("source", F.concat(F.lit("file"), F.col("conv_id") % 3))


SQL_CHATS = """chats AS (
  SELECT conv_id, count(*) AS n_messages, bool_or(role = 'user') AS u, bool_or(role = 'assistant') AS a,
    arg_max(role, turn) AS last_role, arg_max(text, turn) AS last_text,
    'file' || (conv_id % 3) AS source,
    sha256(coalesce(string_agg(text, '||' ORDER BY turn) FILTER (WHERE role = 'user'), '') || '###' ||
      coalesce(string_agg(text, '||' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS key,
    string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), '' ORDER BY turn)
      AS rendered,
    coalesce(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
      ORDER BY turn) FILTER (WHERE role <> 'assistant'), '') || '<|im_start|>assistant' || chr(10)
      AS asked
  FROM conversations GROUP BY conv_id),
checked AS (SELECT *, CASE WHEN NOT (u AND a) THEN 'no user or assistant message'
    WHEN last_role <> 'assistant' THEN 'last message is not from assistant' END AS error FROM chats)"""


@query(
    "to_chat_rows",
    f"""WITH {SQL_ROWS} SELECT row_id,
    '<|im_start|>system' || chr(10) || '{SYSTEM_PROMPT}' || '<|im_end|>' || chr(10) ||
    '<|im_start|>user' || chr(10) || instruction ||
      CASE WHEN coalesce(input, '') <> '' THEN chr(10) || chr(10) || input ELSE '' END ||
      '<|im_end|>' || chr(10) ||
    '<|im_start|>assistant' || chr(10) || output || '<|im_end|>' || chr(10) AS rendered,
    type AS meta_type, category AS meta_category, 'documents' AS meta_source FROM rows_""",
)
def to_chat_rows(spark: SparkSession, sf: str) -> DataFrame:
    df = chat.to_chat(instruction_rows(spark, sf), "documents")
    return df.select(
        "row_id",
        M.render(F.col("messages")).alias("rendered"),
        F.col("meta.type").alias("meta_type"),
        F.col("meta.category").alias("meta_category"),
        F.col("meta.source").alias("meta_source"),
    )


@query(
    "validate_examples",
    """WITH t AS (SELECT conv_id, turn,
        CASE WHEN conv_id % 11 = 0 AND turn = 1 THEN 'tool' ELSE role END AS role,
        CASE WHEN conv_id % 13 = 0 AND turn = 0 THEN ' ' || chr(9) ELSE text END AS text
      FROM conversations),
    m AS (SELECT conv_id, bool_or(role = 'user') AS u, bool_or(role = 'assistant') AS a,
      arg_max(role, turn) AS last_role,
      arg_min(CASE WHEN role NOT IN ('system', 'user', 'assistant') THEN 'unknown role: ' || role
        ELSE 'blank content in role ' || role END, turn)
        FILTER (WHERE role NOT IN ('system', 'user', 'assistant') OR NOT regexp_matches(text, '\\S'))
        AS first_error
      FROM t GROUP BY conv_id)
    SELECT conv_id, CASE WHEN NOT (u AND a) THEN 'no user or assistant message'
      WHEN first_error IS NOT NULL THEN first_error
      WHEN last_role <> 'assistant' THEN 'last message is not from assistant' END AS error FROM m""",
)
def validate_examples(spark: SparkSession, sf: str) -> DataFrame:
    """Turns with a planted unknown role and a planted blank text."""
    c, n = F.col("conv_id"), F.col("turn")
    t = table(spark, sf, "conversations").withColumns(
        {
            "role": F.when((c % 11 == 0) & (n == 1), "tool").otherwise(F.col("role")),
            "text": F.when((c % 13 == 0) & (n == 0), " \t").otherwise(F.col("text")),
        }
    )
    return chat.checked_conversations(t).select("conv_id", "error")


@query("content_keys", f"WITH {SQL_CHATS} SELECT conv_id, key FROM chats")
def content_keys(spark: SparkSession, sf: str) -> DataFrame:
    return chat.checked_conversations(table(spark, sf, "conversations")).select("conv_id", "key")


@query(
    "dedup_across_sources",
    f"""WITH {SQL_CHATS}, both_ AS (
      SELECT 1 AS rank, conv_id, key FROM checked WHERE error IS NULL
      UNION ALL SELECT 0, conv_id, key FROM checked WHERE error IS NULL AND n_messages > 4),
    r AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY rank, conv_id) AS rn FROM both_)
    SELECT rank, conv_id, key FROM r WHERE rn = 1""",
)
def dedup_across_sources(spark: SparkSession, sf: str) -> DataFrame:
    """A second source, ranked first, repeats the longer conversations."""
    good, _ = chat.split_valid(examples(spark, sf))
    both = good.withColumn("rank", F.lit(1)).unionByName(
        good.where(F.size("messages") > 4).withColumn("rank", F.lit(0))
    )
    return chat.with_key(chat.dedup_examples(both, ["rank", "conv_id"])).select(
        "rank", "conv_id", "key"
    )


@query(
    "composition_after_dedup",
    f"""WITH {SQL_CHATS} SELECT source, count(*) AS n FROM (
      SELECT DISTINCT ON (key) source, key FROM checked WHERE error IS NULL ORDER BY key, conv_id)
    GROUP BY source""",
)
def composition_after_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Assemble, check, deduplicate and count per source."""
    good, _ = chat.split_valid(examples(spark, sf))
    return profile.composition(chat.dedup_examples(good, ["conv_id"])).select("source", "n")


@query(
    "normalise_system",
    f"""SELECT conv_id, '<|im_start|>system' || chr(10) || '{SYSTEM_PROMPT}' || '<|im_end|>' || chr(10)
      || coalesce(string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
      ORDER BY turn) FILTER (WHERE role <> 'system'), '') AS rendered
    FROM conversations GROUP BY conv_id""",
)
def normalise_system(spark: SparkSession, sf: str) -> DataFrame:
    df = chat.normalise_system(examples(spark, sf))
    return chat.rendered(df).select("conv_id", "rendered")


@query("render_chat", f"WITH {SQL_CHATS} SELECT conv_id, rendered FROM chats")
def render_chat(spark: SparkSession, sf: str) -> DataFrame:
    return chat.rendered(examples(spark, sf)).select("conv_id", "rendered")


@query(
    "prompt_target",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS back
      FROM conversations)
    SELECT conv_id, count(*) - 1 AS n_prompt, max(text) FILTER (WHERE back = 1) AS target,
      max(text) FILTER (WHERE back = 2) AS question FROM r GROUP BY conv_id""",
)
def prompt_target(spark: SparkSession, sf: str) -> DataFrame:
    df = chat.prompt_target(examples(spark, sf))
    return df.select(
        "conv_id", F.size("prompt").cast("bigint").alias("n_prompt"), "target", "question"
    )


@query(
    "assemble_conversations",
    """SELECT conv_id, count(*) AS n_messages, string_agg(role, ',' ORDER BY turn) AS roles,
    string_agg(text, chr(10) ORDER BY turn) AS texts FROM conversations GROUP BY conv_id""",
)
def assemble_conversations(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("messages")
    return examples(spark, sf).select(
        "conv_id",
        F.size(m).cast("bigint").alias("n_messages"),
        F.array_join(F.transform(m, lambda x: x.role), ",").alias("roles"),
        F.array_join(F.transform(m, lambda x: x.content), "\n").alias("texts"),
    )


@query(
    "answer_length_filter",
    f"WITH {SQL_CHATS} SELECT conv_id, last_text AS answer FROM chats WHERE length(last_text) >= 200",
)
def answer_length_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept = rows.long_enough_answer(examples(spark, sf), MixConfig(min_answer=200))
    return kept.select("conv_id", M.last(F.col("messages")).content.alias("answer"))


# --- split, sampling, mixing ----------------------------------------------------------------


@query(
    "split_exact",
    """WITH h AS (SELECT doc_id, row_number() OVER (ORDER BY sha256(doc_id || '|42'), doc_id) AS rn
      FROM documents)
    SELECT doc_id, CASE WHEN rn <= greatest(1, floor((SELECT count(*) FROM documents) * 0.02))
      THEN 'val' ELSE 'train' END AS split FROM h""",
)
def split_exact(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id")
    return mix.split_exact(d, "doc_id", 0.02, 42)


@query(
    "oversample_sources",
    """WITH s AS (SELECT DISTINCT conv_id, 'file' || (conv_id % 3) AS source FROM conversations),
    f(source, factor) AS (VALUES ('file0', 5), ('file1', 1), ('file2', 0), ('file9', 3))
    SELECT conv_id, s.source, CAST(copy AS INTEGER) AS copy FROM s LEFT JOIN f USING (source),
      unnest(range(1, greatest(coalesce(factor, 1), 1) + 1)) AS u(copy)""",
)
def oversample_sources(spark: SparkSession, sf: str) -> DataFrame:
    df = examples(spark, sf).select("conv_id", "source")
    return mix.oversample(df, factors(spark)).select("conv_id", "source", "copy")


def factors(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [("file0", 5), ("file1", 1), ("file2", 0), ("file9", 3)], "source string, factor int"
    )


@query(
    "unknown_sources",
    """SELECT source, factor FROM (VALUES ('file0', 5), ('file1', 1), ('file2', 0), ('file9', 3))
    AS f(source, factor)
    WHERE source NOT IN (SELECT 'file' || (conv_id % 3) FROM conversations)""",
)
def unknown_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mix.unknown_sources(examples(spark, sf), factors(spark))


def _text_keys(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "source", F.sha2("text", 256).alias("key"))


_VAL = "('src0', 'src1', 'src2')"
_TRAIN = "('src3', 'src4', 'src5', 'src6')"


@query(
    "leak_guard_val",
    f"""SELECT doc_id, sha256(text) AS key FROM documents
    WHERE text NOT IN (SELECT text FROM documents WHERE source IN {_VAL})
      AND text NOT IN (SELECT text FROM benchmark)""",
)
def leak_guard_val(spark: SparkSession, sf: str) -> DataFrame:
    """New rows = all documents; val = three sources and the benchmark passages."""
    d = _text_keys(spark, sf)
    val = d.where(F.col("source").isin("src0", "src1", "src2")).select("key")
    bench = table(spark, sf, "benchmark").select(F.sha2("text", 256).alias("key"))
    return mix.without_keys(d, val.unionByName(bench)).select("doc_id", "key")


@query(
    "train_guard",
    f"""SELECT doc_id, sha256(text) AS key FROM documents
    WHERE text NOT IN (SELECT text FROM documents WHERE source IN {_TRAIN})""",
)
def train_guard(spark: SparkSession, sf: str) -> DataFrame:
    d = _text_keys(spark, sf)
    train = d.where(F.col("source").isin("src3", "src4", "src5", "src6"))
    return mix.without_keys(d, train).select("doc_id", "key")


@query(
    "append_with_factor",
    f"""WITH n AS (SELECT doc_id FROM documents
      WHERE text NOT IN (SELECT text FROM documents WHERE source IN {_VAL})
        AND text NOT IN (SELECT text FROM documents WHERE source IN {_TRAIN}))
    SELECT doc_id, 1 AS copy FROM documents WHERE source IN {_TRAIN}
    UNION ALL SELECT doc_id, CAST(copy AS INTEGER) FROM n, unnest(range(1, 6)) AS u(copy)""",
)
def append_with_factor(spark: SparkSession, sf: str) -> DataFrame:
    d = _text_keys(spark, sf)
    val = d.where(F.col("source").isin("src0", "src1", "src2"))
    train = d.where(F.col("source").isin("src3", "src4", "src5", "src6"))
    grown, _ = mix.append_new(train, val, d, 5)
    return grown.select("doc_id", "copy")


@query(
    "append_report",
    f"""SELECT count(*) FILTER (WHERE v) AS in_val, count(*) FILTER (WHERE NOT v AND t) AS in_train,
      count(*) FILTER (WHERE NOT v AND NOT t) AS added
    FROM (SELECT text IN (SELECT text FROM documents WHERE source IN {_VAL}) AS v,
      text IN (SELECT text FROM documents WHERE source IN {_TRAIN}) AS t FROM documents)""",
)
def append_report(spark: SparkSession, sf: str) -> DataFrame:
    d = _text_keys(spark, sf)
    val = d.where(F.col("source").isin("src0", "src1", "src2"))
    train = d.where(F.col("source").isin("src3", "src4", "src5", "src6"))
    return mix.append_new(train, val, d, 5)[1]


@query(
    "append_to_store",
    """WITH d AS (SELECT doc_id, text, doc_id % 3 AS batch FROM documents)
    SELECT doc_id, CAST(batch AS INTEGER) AS batch FROM d AS n WHERE NOT EXISTS
      (SELECT 1 FROM d AS o WHERE o.text = n.text AND o.batch < n.batch)""",
)
def append_to_store(spark: SparkSession, sf: str) -> DataFrame:
    """Three appends to one store of keys: each keeps the rows that no earlier one held."""
    d = _text_keys(spark, sf).select("doc_id", "key")
    store = key_store.create(spark, scratch_path(spark, "key-store"))
    grown = None
    for batch in range(3):
        new = d.where(F.col("doc_id") % 3 == batch)
        kept = key_store.append(store, new, scratch_path(spark, "store-rows"))
        kept = kept.select("doc_id", F.lit(batch).alias("batch"))
        grown = kept if grown is None else grown.unionByName(kept)
    store.close()
    return grown


@query(
    "shuffled_rows",
    "SELECT doc_id, sha256(doc_id || '|42') AS place FROM documents",
)
def shuffled_rows(spark: SparkSession, sf: str) -> DataFrame:
    """All documents in the repeatable random order, with the key that places them."""
    d = table(spark, sf, "documents").select("doc_id")
    return mix.shuffled(d, ["doc_id"], 42).withColumn(
        "place", mix.seeded_hash(F.col("doc_id"), 42)
    )


@query(
    "fixed_subset",
    "SELECT doc_id FROM documents ORDER BY sha256(doc_id || '|42'), doc_id LIMIT 450",
)
def fixed_subset(spark: SparkSession, sf: str) -> DataFrame:
    return mix.subset(table(spark, sf, "documents").select("doc_id"), "doc_id", 450, 42)


@query(
    "subset_per_round",
    """WITH e AS (SELECT CAST(round AS INTEGER) AS round, doc_id, row_number() OVER (
        PARTITION BY round ORDER BY sha256(doc_id || '|42|' || round), doc_id) AS rn
      FROM documents, unnest(range(1, 5)) AS u(round))
    SELECT round, doc_id FROM e WHERE rn <= 100""",
)
def subset_per_round(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents").select("doc_id")
    return mix.subset_per_round(d, "doc_id", 4, 100, 42).select("round", "doc_id")


@query(
    "split_leakage",
    """WITH p AS (SELECT sha256(text) AS key, CASE WHEN source IN ('src0', 'src1') THEN 'val'
        WHEN source = 'src2' THEN 'test' ELSE 'train' END AS split, count(*) AS n
      FROM documents GROUP BY 1, 2)
    SELECT a.split AS split_a, b.split AS split_b, count(*) AS n_keys,
      CAST(sum(a.n) AS BIGINT) AS rows_a, CAST(sum(b.n) AS BIGINT) AS rows_b
    FROM p a JOIN p b ON a.key = b.key AND a.split < b.split GROUP BY 1, 2""",
)
def split_leakage(spark: SparkSession, sf: str) -> DataFrame:
    d = _text_keys(spark, sf).withColumn(
        "split",
        F.when(F.col("source").isin("src0", "src1"), "val")
        .when(F.col("source") == "src2", "test")
        .otherwise("train"),
    )
    return mix.leakage(d)


@query(
    "group_holdout",
    """SELECT l_orderkey, l_linenumber, l_suppkey,
      CASE WHEN CAST('0x' || substr(sha256(l_suppkey || '|42'), 1, 8) AS BIGINT) < 0.125 * 4294967296
        THEN 'test' ELSE 'train' END AS split FROM lineitem""",
)
def group_holdout(spark: SparkSession, sf: str) -> DataFrame:
    """Well = supplier; an eighth of the wells is held out."""
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return mix.group_holdout(df, "l_suppkey", 0.125, 42)


# --- token lengths --------------------------------------------------------------------------

SQL_MEASURED = f"""{SQL_CHATS}, measured AS (
  SELECT conv_id, source, CAST(length(rendered) // 4 AS BIGINT) AS total_tokens,
    CAST(length(asked) // 4 AS BIGINT) AS prompt_tokens,
    CAST(length(rendered) // 4 - length(asked) // 4 AS BIGINT) AS assistant_tokens FROM chats)"""


def measured(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.measure(examples(spark, sf))


@query(
    "token_estimate",
    "SELECT doc_id, CAST(length(text) // 4 AS BIGINT) AS tokens FROM documents",
)
def token_estimate(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select("doc_id", estimate_tokens(F.col("text")).alias("tokens"))


@query("token_measure", f"WITH {SQL_MEASURED} SELECT * FROM measured")
def token_measure(spark: SparkSession, sf: str) -> DataFrame:
    return measured(spark, sf).drop("messages")


_PCT = ", ".join(f"CAST(round(1000 * quantile_cont(v, {p / 100})) AS BIGINT)"
                 for p in TokenConfig.percentiles)


@query(
    "token_distribution",
    f"""WITH {SQL_MEASURED}, l AS (
      SELECT source, unnest(['total_tokens', 'prompt_tokens', 'assistant_tokens']) AS measure,
        unnest([total_tokens, prompt_tokens, assistant_tokens]) AS v FROM measured),
    s AS (SELECT 'all' AS scope, measure, v FROM l UNION ALL
      SELECT 'source:' || source, measure, v FROM l)
    SELECT scope, measure, count(*) AS n_rows, min(v) AS min_v,
      CAST(round(1000 * quantile_cont(v, 0.5)) AS BIGINT) AS median_milli,
      CAST(sum(v) AS BIGINT) AS sum_v, max(v) AS max_v,
      concat_ws(',', {_PCT}) AS percentiles_milli FROM s GROUP BY scope, measure""",
)
def token_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Percentiles in thousandths of a token, so both sides compare whole numbers."""
    def milli(c: Column) -> Column:
        return F.round(c * 1000).cast("bigint")

    d = tokens.distribution(measured(spark, sf))
    return d.select(
        "scope", "measure", "n_rows", "min_v",
        milli(F.col("median_v")).alias("median_milli"),
        F.round(F.col("mean_v") * F.col("n_rows")).cast("bigint").alias("sum_v"),
        "max_v",
        F.array_join(F.transform("percentiles", lambda p: milli(p).cast("string")), ",")
        .alias("percentiles_milli"),
    )


_CAPS = ", ".join(f"({c})" for c in TokenConfig.caps)


@query(
    "cap_coverage",
    f"""WITH {SQL_MEASURED}, caps(cap) AS (VALUES {_CAPS})
    SELECT CAST(cap AS BIGINT) AS cap, count(*) FILTER (WHERE total_tokens <= cap) AS n_ok,
      count(*) FILTER (WHERE total_tokens > cap) AS n_over,
      100.0::DOUBLE * count(*) FILTER (WHERE total_tokens <= cap) / count(*) AS pct
    FROM caps, measured GROUP BY cap""",
)
def cap_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.coverage(measured(spark, sf))


@query(
    "cap_recommendation",
    f"""WITH {SQL_MEASURED}, caps(cap) AS (VALUES {_CAPS}), c AS (
      SELECT cap, count(*) FILTER (WHERE total_tokens > cap) AS n_over,
        100.0::DOUBLE * count(*) FILTER (WHERE total_tokens <= cap) / count(*) AS pct
      FROM caps, measured GROUP BY cap)
    SELECT CAST(min(cap) AS BIGINT) AS cap, arg_min(n_over, cap) AS n_over FROM c WHERE pct >= 99""",
)
def cap_recommendation(spark: SparkSession, sf: str) -> DataFrame:
    return tokens.recommend(measured(spark, sf))


@query(
    "token_filter",
    f"""WITH {SQL_MEASURED} SELECT conv_id, total_tokens AS n_tokens,
      CASE WHEN total_tokens <= 512 THEN 'kept' ELSE 'dropped' END AS outcome FROM measured""",
)
def token_filter(spark: SparkSession, sf: str) -> DataFrame:
    kept, dropped = tokens.within_cap(measured(spark, sf), TokenConfig(max_tokens=512))
    return kept.select(
        "conv_id", F.col("total_tokens").alias("n_tokens"), F.lit("kept").alias("outcome")
    ).unionByName(dropped.select("conv_id", "n_tokens", F.lit("dropped").alias("outcome")))


_WORD = r"[\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}]"


@query(
    "word_tokens",
    rf"""SELECT conv_id, turn, CAST(len(regexp_extract_all(text,
      '{_WORD}+|[^\p{{L}}\p{{M}}\p{{Nd}}\p{{Nl}}\p{{Pc}}\s]')) AS BIGINT) AS tokens FROM conversations""",
)
def word_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """Another counter in the place of the estimate."""
    t = table(spark, sf, "conversations")
    return t.select("conv_id", "turn", count_words(F.col("text")).alias("tokens"))


# --- the whole build ------------------------------------------------------------------------


@query(
    "corpus_build",
    f"""WITH {SQL_ROWS}, {SQL_CHATS}, c AS (
      SELECT min(row_id) AS row_id, instruction, input, output FROM (
        SELECT row_id, instruction, coalesce(input, '') AS input, {sql_clean('output')} AS output,
          {_SQL_REASON} AS reason FROM rows_) WHERE reason IS NULL GROUP BY 2, 3, 4),
    i AS (SELECT 0 AS rank, row_id AS row, 'documents' AS source, output AS answer,
        instruction || CASE WHEN input <> '' THEN chr(10) || chr(10) || input ELSE '' END AS asked
      FROM c),
    all_ AS (
      SELECT rank, row, source, sha256(asked || '###' || answer) AS key, answer,
        '<|im_start|>system' || chr(10) || '{SYSTEM_PROMPT}' || '<|im_end|>' || chr(10) ||
        '<|im_start|>user' || chr(10) || asked || '<|im_end|>' || chr(10) ||
        '<|im_start|>assistant' || chr(10) || answer || '<|im_end|>' || chr(10) AS rendered FROM i
      UNION ALL SELECT 1, conv_id, source, key, last_text, rendered FROM checked WHERE error IS NULL),
    u AS (SELECT DISTINCT ON (key) * FROM all_ WHERE length(answer) >= 10 ORDER BY key, rank, row),
    s AS (SELECT *, CASE WHEN row_number() OVER (ORDER BY sha256(key || '|42'), key) <=
        greatest(1, floor((SELECT count(*) FROM u) * 0.03)) THEN 'val' ELSE 'train' END AS split,
        length(rendered) // 4 AS n_tokens FROM u)
    SELECT split, source, CAST(sum(CASE WHEN split = 'train' AND source = 'file0' THEN 5 ELSE 1 END)
      AS BIGINT) AS n, CAST(sum(n_tokens * CASE WHEN split = 'train' AND source = 'file0' THEN 5 ELSE 1
      END) AS BIGINT) AS n_tokens FROM s WHERE n_tokens <= 512 GROUP BY split, source""",
)
def corpus_build(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and conversations through every stage; rows and tokens per split and source."""
    from stratalog.plans import corpus as plan

    pool = plan.instruction_examples(instruction_rows(spark, sf), "documents", CLEAN).unionByName(
        examples(spark, sf).select(
            F.lit(1).alias("rank"), F.lit(0).cast("bigint").alias("block"),
            F.col("conv_id").alias("row"), "source", "messages",
        )
    )
    built = plan.build(pool, factors(spark), MixConfig(), TokenConfig(max_tokens=512))
    both = built.train.select("split", "source", "total_tokens").unionByName(
        built.val.select("split", "source", "total_tokens")
    )
    return both.groupBy("split", "source").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_tokens").alias("n_tokens")
    )
