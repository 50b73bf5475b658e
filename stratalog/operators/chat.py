"""Chat examples: building, checking, keys and splits into prompt and target."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.config import SYSTEM_PROMPT, ChatTemplate
from stratalog.functions import messages as M
from stratalog.operators.clean import first_rows


def to_chat(df: DataFrame, source: str, system_prompt: str = SYSTEM_PROMPT) -> DataFrame:
    """Instruction rows to ``messages`` and ``meta``; other columns stay."""
    user = F.when(
        F.coalesce(F.col("input"), F.lit("")) != "",
        F.concat(F.col("instruction"), F.lit("\n\n"), F.col("input")),
    ).otherwise(F.col("instruction"))
    turns = [M.message("user", user), M.message("assistant", F.col("output"))]
    if system_prompt:
        turns.insert(0, M.message("system", F.lit(system_prompt)))
    return df.withColumns(
        {
            "messages": F.array(*turns).cast(M.MESSAGES),
            "meta": F.struct("type", "category", F.lit(source).alias("source")),
        }
    ).drop("type", "category", "instruction", "input", "output")


def validated(df: DataFrame) -> DataFrame:
    """Add ``error``: null for a valid example."""
    return df.withColumn("error", M.example_error(F.col("messages")))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid rows, and rejects with their error."""
    checked = validated(df)
    return checked.where("error is null").drop("error"), checked.where("error is not null")


def with_key(df: DataFrame) -> DataFrame:
    return df.withColumn("key", M.content_key(F.col("messages")))


def dedup_examples(df: DataFrame, order: list[str], carry: bool = False) -> DataFrame:
    """First example per content key, in source and line order."""
    return first_rows(df, M.content_key(F.col("messages")), order, carry)


def normalise_system(df: DataFrame, prompt: str = SYSTEM_PROMPT) -> DataFrame:
    return df.withColumn("messages", M.with_system(F.col("messages"), prompt))


def rendered(
    df: DataFrame, template: ChatTemplate = ChatTemplate(), generation: bool = False
) -> DataFrame:
    return df.withColumn("rendered", M.render(F.col("messages"), template, generation))


def prompt_target(df: DataFrame) -> DataFrame:
    """Target is the last message, the prompt all before it, the question the last of those."""
    prompt = M.prompt_messages(F.col("messages"))
    return df.withColumns(
        {
            "prompt": prompt,
            "target": M.last(F.col("messages")).content,
            "question": M.last(prompt).content,
        }
    )


def assemble(turns: DataFrame) -> DataFrame:
    """Turn rows to one chat example ``(conv_id, messages)`` per conversation, of any size.

    A conversation is one record by definition, as in the files it is read from and written to; a
    long one makes a long record, and none is left out or treated in another way.
    """
    said = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return turns.groupBy("conv_id").agg(said.alias("_t")).select(
        "conv_id",
        F.transform("_t", lambda t: F.struct(t.role.alias("role"), t.text.alias("content"))).alias("messages"),
    )


def checked_conversations(turns: DataFrame) -> DataFrame:
    """``(conv_id, error, key)`` for every conversation."""
    return assemble(turns).select(
        "conv_id",
        M.example_error(F.col("messages")).alias("error"),
        M.content_key(F.col("messages")).alias("key"),
    )
