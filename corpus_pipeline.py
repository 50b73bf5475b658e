"""From raw documents to sharded training documents, one operator per stage.

Each stage works on all rows that the stage before kept. Its result is written as Parquet to the
folder the session shares, and read again for the next one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalog.llm import decontam, language, mixing, sharding, simhash
from stratalog.llm.common import bucket_of, kept

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


#: languages to keep; None keeps every language that was learned
WANTED_LANGUAGES: tuple[str, ...] | None = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents in which a wanted language is found; those without any letter go.

    As in the operator's query, the automata are fitted on documents outside the held-out quarter. A
    document that names no language gets the one found. Where no document names one, nothing can be
    learned: then the documents with a letter stay as they are.
    """
    learned = ~F.coalesce(bucket_of(F.col("doc_id"), 4) == 2, F.lit(False))
    model = language.learn(docs, learned)
    if not model.languages:
        return docs.where(language.has_letter(F.col("text")))
    found = docs.select(F.struct("*").alias("_row"), language.prediction(spark, model, F.col("text")).alias("_p"))
    wanted = F.col("_p.lang_pred") != language.UNKNOWN
    if WANTED_LANGUAGES is not None:
        wanted = wanted & F.col("_p.lang_pred").isin(*WANTED_LANGUAGES)
    named = F.coalesce(F.col("_row.lang"), F.col("_p.lang_pred")).alias("lang")
    return found.where(wanted).select(*[named if c == "lang" else F.col("_row")[c].alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near copies."""
    return simhash.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no notable part of a benchmark."""
    checked = decontam.checked(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return checked.where(~F.col("contaminated")).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw the sources to their target weights; a document may come up to three times."""
    return mixing.mixed_documents(docs)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Add the slot and the shard of each document."""
    return sharding.sharded(docs, F.col("doc_id"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]

#: suffix automata, the cube method and connected groups are beyond one SQL statement
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
