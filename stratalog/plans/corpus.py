"""The corpus build from instruction rows and chat rows to token-filtered train and val rows."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog.config import SYSTEM_PROMPT, CleanConfig, MixConfig, TokenConfig
from stratalog.operators import chat, clean, mix, profile, tokens
from stratalog.session import scratch_path
from stratalog.sources.chat_files import staged, write_dropped, write_jsonl


@dataclass(frozen=True)
class Corpus:
    """The finished splits and everything that was left out or counted on the way."""

    train: DataFrame
    val: DataFrame
    dropped: DataFrame
    rejects: DataFrame
    composition: DataFrame
    unknown_sources: DataFrame
    tables: dict[str, str] = field(default_factory=dict)


def instruction_examples(
    instructions: DataFrame,
    source: str,
    cfg: CleanConfig = CleanConfig(),
    rank: int = 0,
) -> DataFrame:
    """Filtered and cleaned instruction rows as chat rows with their place in the input."""
    kept = clean.filter_and_clean(instructions, ["row_id"], cfg)
    return chat.to_chat(kept, source).select(
        F.lit(rank).alias("rank"), F.lit(0).cast("bigint").alias("block"),
        F.col("row_id").cast("bigint").alias("row"), F.lit(source).alias("source"), "messages",
    )


def build(
    pool: DataFrame,
    factors: DataFrame,
    mix_cfg: MixConfig = MixConfig(),
    token_cfg: TokenConfig = TokenConfig(),
) -> Corpus:
    """``pool(rank, block, row, source, messages)`` to train and val.

    The checked, deduplicated pool is written out once: the split reads it several times, and its
    row places must be the same in each read. The measured rows are used twice and written too.
    """
    spark = pool.sparkSession
    good, rejects = chat.split_valid(pool)
    answered = clean.long_enough_answer(good, mix_cfg)
    unique = chat.dedup_examples(answered, ["rank", "block", "row"], carry=True)
    pool_path = scratch_path(spark, "pool")
    table = staged(chat.with_key(unique), pool_path)

    split = mix.split_exact(table, "key", mix_cfg.merge_val_fraction, mix_cfg.seed)
    measured_path = scratch_path(spark, "measured")
    measured = staged(tokens.measure(split), measured_path)
    kept, dropped = tokens.within_cap(measured, token_cfg)
    train = kept.where("split = 'train'")
    return Corpus(
        train=mix.oversample(train, factors),
        val=kept.where("split = 'val'"),
        dropped=dropped,
        rejects=rejects,
        composition=profile.composition(table),
        unknown_sources=mix.unknown_sources(train, factors),
        tables={"pool": pool_path, "measured": measured_path},
    )


def write(corpus: Corpus, out: str, seed: int = MixConfig.seed) -> None:
    """Train rows in a repeatable random order, val rows, and the rows over the token cap."""
    ordered = mix.shuffled(corpus.train, ["key", "copy"], seed)
    write_jsonl(ordered, f"{out}/train")
    write_jsonl(corpus.val, f"{out}/val")
    write_dropped(corpus.dropped, f"{out}/dropped")


def append(
    new: DataFrame,
    train: DataFrame,
    val: DataFrame,
    out: str,
    factor: int = MixConfig.factor,
    seed: int = MixConfig.seed,
    system_prompt: str = SYSTEM_PROMPT,
) -> tuple[DataFrame, DataFrame]:
    """Grow a train set by the new chat rows that are in neither split; returns report and rejects.

    The new rows are checked and get the standard system message. Train and val rows are checked
    too, since a row without messages has no key. With nothing new, nothing is written.
    """
    good, rejects = chat.split_valid(new)
    standard = chat.with_key(chat.normalise_system(good, system_prompt)).select("messages", "key")
    standard = staged(standard, scratch_path(new.sparkSession, "append"))

    def keyed(df: DataFrame) -> DataFrame:
        return chat.with_key(chat.split_valid(df)[0]).select("messages", "key")

    grown, report = mix.append_new(keyed(train), keyed(val), standard, factor)
    report = staged(report, scratch_path(new.sparkSession, "append-report"))
    if report.first()["added"]:
        write_jsonl(mix.shuffled(grown, ["key", "copy"], seed), out)
    return report, rejects
