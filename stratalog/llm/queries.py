"""One query per operator over the given tables, with SQL where it can express the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from stratalog.bindings import table
from stratalog.llm import (
    alignment,
    chat_trees,
    decontam,
    hard_negatives,
    language,
    mixing,
    neighbours,
    pii,
    secret_scan,
    sharding,
    simhash,
    suffix_dedup,
    toxicity,
)
from stratalog.llm.common import bucket_of, kept, span_list
from stratalog.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def held_out(buckets: int, at: int) -> Column:
    """Whether the bucket of ``doc_id`` is ``at``; false for a null id."""
    return F.coalesce(bucket_of(F.col("doc_id"), buckets) == at, F.lit(False))


@query("op1_mixing")
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to weights 5, 2, 1 over the sources."""
    return mixing.mix_table(table(spark, sf_dir, "documents"))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned outside the held-out fifth."""
    scores = toxicity.toxicity_scores(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ~held_out(5, 0)
    )
    return scores.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted", "vote")


@query("op3_neighbours")
def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five nearest rows for every vector whose id is divisible by 50."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


_SHARDS = sharding.ShardConfig()


@query(
    "op4_sharding",
    f"""
    WITH placed AS (
        SELECT doc_id, source,
               CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, {sharding.DIGITS}) AS BIGINT)
                   % {_SHARDS.slots} AS slot
        FROM documents
    ),
    owners AS (
        SELECT string_split('{",".join(map(str, sharding.lookup_table(_SHARDS.shards, _SHARDS.slots)))}', ',') AS shard_of
    )
    SELECT doc_id, source, slot, printf('shard-%03d', CAST(shard_of[slot + 1] AS INTEGER)) AS shard
    FROM placed, owners
    """,
)
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slot and shard of every document by its id."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return sharding.sharded(docs, F.col("doc_id"), _SHARDS)


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


@query(
    "op5_chat_trees",
    """
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
    ),
    escaped AS (
        SELECT *, replace(replace(replace(text, '\\', '\\0'), '<', '\\1'), '[', '\\2') AS coded,
               replace(replace(replace(replace(role, '\\', '\\0'), '<', '\\1'), '[', '\\2'), chr(10), '\\3') AS coded_role
        FROM said
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(length('<|turn|>') + length(coded_role) + 1 + length(coded) + length('<|end|>') + 1) AS BIGINT)
               AS formatted_chars
    FROM escaped GROUP BY conv_id
    """,
)
def op5_chat_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as a reply tree of one branch, formatted and read back."""
    template = chat_trees.TreeTemplate()
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    marked = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    nodes = kept(chat_trees.chain(turns.unionByName(marked)), "op5-nodes")
    out = chat_trees.formatted(nodes, template=template)
    read = chat_trees.read_turns(F.col("formatted"), template)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join(
        F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat_trees.unescaped(s["text"], template)), ""
    )
    return (
        out.withColumns({"turns": read, "learned": learned})
        .select(
            F.col("tree").alias("conv_id"),
            F.size("turns").cast("bigint").alias("n_turns"),
            _sha(F.array_join(lines, "")).alias("turns_sha256"),
            F.length("learned").cast("bigint").alias("loss_chars"),
            _sha(F.col("learned")).alias("loss_sha256"),
            F.length("formatted").cast("bigint").alias("formatted_chars"),
        )
    )


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned outside the held-out quarter."""
    found = language.identified(table(spark, sf_dir, "documents"), ~held_out(4, 2))
    return found.select("doc_id", held_out(4, 2).alias("held_out"), "lang_pred", "score")


def _count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


@query("op7_secret_scan")
def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by way of a ledger that begins empty."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = secret_scan.update_ledger(docs, scratch_path(spark, "secret-ledger"))
    found = secret_scan.findings(docs, ledger)
    base = [r.kind for r in secret_scan.RULES if r.base]
    own = F.filter("spans", lambda s: s["kind"].isin(*base))
    return found.select(
        "doc_id",
        *[_count(F.col("spans"), k).alias(f"n_{k}") for k in base],
        _sha(span_list(own)).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"),
    )


_WORD_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _lower_sql(column: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"translate({column}, '{upper}', '{upper.lower()}')"


@query(
    "op8_decontam",
    f"""
    WITH items AS (
        SELECT item_id, regexp_extract_all({_lower_sql("text")}, '{_WORD_SQL}') AS w FROM benchmark WHERE text IS NOT NULL
    ),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), 13) AS n, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1),
               lambda i: array_to_string(list_slice(w, i, i + 12), ' '))) AS win
        FROM items WHERE len(w) > 0
    ),
    docs AS (
        SELECT row_number() OVER () AS row_id, doc_id,
               regexp_extract_all({_lower_sql("coalesce(text, '')")}, '{_WORD_SQL}') AS w
        FROM documents
    ),
    sizes AS (SELECT DISTINCT n FROM windows),
    places AS (
        SELECT row_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS win
        FROM (SELECT row_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, sizes WHERE len(w) >= n)
    ),
    hits AS (SELECT row_id, p.n, i, item_id FROM places p JOIN windows USING (win)),
    words AS (SELECT row_id, count(DISTINCT place) AS n_hit FROM (SELECT row_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY row_id),
    named AS (
        SELECT row_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
        FROM (SELECT DISTINCT row_id, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY row_id
    )
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM docs LEFT JOIN words USING (row_id) LEFT JOIN named USING (row_id)
    """,
)
def op8_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.checked(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        _sha(F.array_join("items", ",")).alias("items_sha256"),
        "contaminated",
    )


@query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    found = pii.personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    place = F.array(*[F.lit(k) for k in pii.KINDS])
    merged = F.array_sort(
        F.transform(
            F.concat("base", "extra"),
            lambda s: F.struct(F.array_position(place, s["kind"]).alias("place"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")),
        )
    )
    return found.select(
        "doc_id",
        *[_count(F.col("base"), k).alias(f"n_{k}") for k in pii.KINDS],
        _sha(span_list(F.col("base"))).alias("base_sha256"),
        span_list(merged).alias("spans"),
    )


@query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate group of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query(
    "op11_hard_negatives",
    """
    WITH r AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, len(embedding) AS dim,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    s AS (
        SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
        FROM r a JOIN r b ON a.dim = b.dim AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
    ),
    p AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
    )
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
    QUALIFY rank <= 3
    """,
)
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose id is divisible by 50; ids divisible by 7 change their label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


@query("op12_suffix_dedup")
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte strings of 200 that start at two places, removed from every document."""
    found = suffix_dedup.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), texts=False)
    return found.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), "kept_sha256"
    )


@query("op13_alignment")
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned in every document, with counts of the linked ids."""
    return alignment.alignments(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole pipeline over the documents."""
    return corpus_pipeline.run(spark, sf_dir)
