"""Row filters, text cleaning and exact deduplication of instruction rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.config import CleanConfig, MixConfig
from stratalog.functions.messages import last
from stratalog.functions.text import clean, matches
from stratalog.session import scratch_path
from stratalog.sources.chat_files import staged

TEXT_COLUMNS = ("instruction", "input", "output")


def type_allowed(types: tuple[str, ...], column: str = "type") -> Column:
    """In the allow-list; in this form the condition reaches the Parquet scan."""
    return F.col(column).isin(*types)


def quiet_category(prefixes: tuple[str, ...], column: str = "category") -> Column:
    """Null or with none of the prefixes; in this form the condition reaches the Parquet scan."""
    if not prefixes:
        return F.lit(True)
    hits = [F.col(column).startswith(p) for p in prefixes]
    return F.col(column).isNull() | ~reduce(lambda a, b: a | b, hits)


def keep_types(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    return df.where(type_allowed(cfg.types))


def drop_categories(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    return df.where(quiet_category(cfg.drop_prefixes))


def drop_matching(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Drop rows whose text matches in any case; null text is kept."""
    return df.where(~matches(F.col(column), pattern))


def clean_text(df: DataFrame, columns: tuple[str, ...] = TEXT_COLUMNS) -> DataFrame:
    return df.withColumns({c: clean(F.col(c)) for c in columns})


def length_between(df: DataFrame, column: str, low: int, high: int) -> DataFrame:
    """Whole rows are kept or dropped, text is never cut; ``high`` 0 means no upper limit."""
    size = F.length(column)
    # one comparison instead of two: a filter computes its input once per comparison
    inside = F.abs(size * 2 - (low + high)) <= high - low
    return df.where(inside if high else size >= low)


def raw_reason(cfg: CleanConfig = CleanConfig()) -> Column:
    """Name of the first rule on raw text that a row fails, or null.

    Branches are evaluated in this order, so the costly ones only run on rows that got there.
    """
    reason = F.when(~F.coalesce(type_allowed(cfg.types), F.lit(False)), "type").when(
        ~quiet_category(cfg.drop_prefixes), "category"
    )
    if cfg.instruction_pattern:
        reason = reason.when(matches(F.col("instruction"), cfg.instruction_pattern), "instruction")
    if cfg.broken_pattern:
        reason = reason.when(matches(F.col("output"), cfg.broken_pattern), "broken")
    if cfg.placeholder_pattern:
        reason = reason.when(matches(F.col("output"), cfg.placeholder_pattern), "placeholder")
    return reason


def with_reason(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Cleaned texts and ``rule``: the first rule a row fails, or null.

    The rules on raw text come first, the length rules look at the cleaned text.
    """
    checked = df.withColumn("rule", raw_reason(cfg))
    cleaned = clean_text(checked)
    size = F.length("output")
    wrong_size = F.when(size < cfg.min_output, "short")
    if cfg.max_output:
        wrong_size = wrong_size.when(size > cfg.max_output, "long")
    return cleaned.withColumn("rule", F.coalesce("rule", wrong_size))


def row_key(columns: tuple[str, ...] = TEXT_COLUMNS) -> Column:
    """Digest of several texts; each is preceded by its length, so the key is not ambiguous."""
    parts: list[Column] = []
    for name in columns:
        text = F.coalesce(F.col(name), F.lit(""))
        parts += [F.length(text).cast("string"), F.lit(":"), text]
    return F.sha2(F.concat(*parts), 256)


def first_rows(df: DataFrame, key: Column, order: list[str], carry: bool = False) -> DataFrame:
    """One row per key, the first in ``order``; the order columns identify the row.

    The minimum is pre-aggregated before the shuffle, so a key with very many copies sends one row
    per task. By default the rows come back by a semi-join on their unique order columns, never by
    the key; ``carry`` takes them through the aggregate instead, in one read of the input, which is
    right when the order columns are only fixed within one read. Rows of one key whose order columns
    are null cannot be told apart: without another row of the key they all stay.
    """
    if carry:
        row = F.min_by(F.struct(*df.columns), F.struct(*order))
        return df.groupBy(key.alias("_key")).agg(row.alias("_row")).select("_row.*")
    keyed = df.select(*order, key.alias("_key"))
    if len(order) == 1:
        firsts = keyed.groupBy("_key").agg(F.min(order[0]).alias(order[0]))
    else:
        firsts = (
            keyed.groupBy("_key")
            .agg(F.min(F.struct(*order)).alias("_first"))
            .select("_key", *[F.col(f"_first.{c}").alias(c) for c in order])
        )
    # a null in the order identifies no row, so there the key must match too
    void = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in order])
    firsts = firsts.select(*[F.col(c).alias(f"_{c}") for c in order], F.when(void, F.col("_key")).alias("_of"))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in order])
    return df.join(firsts, same & (F.col("_of").isNull() | (F.col("_of") == key)), "left_semi")


def dedup_rows(df: DataFrame, order: list[str], columns: tuple[str, ...] = TEXT_COLUMNS) -> DataFrame:
    return first_rows(df, row_key(columns), order)


def filter_and_clean(
    df: DataFrame, order: list[str], cfg: CleanConfig = CleanConfig()
) -> DataFrame:
    """All filters, then cleaning, then first-row-wins deduplication.

    The cleaned rows are written to the shared folder once. The keys are then aggregated by hashing,
    without the texts, and the first rows come back by a semi-join.
    """
    kept = drop_categories(keep_types(df, cfg), cfg)
    if cfg.instruction_pattern:
        kept = drop_matching(kept, "instruction", cfg.instruction_pattern)
    if cfg.broken_pattern:
        kept = drop_matching(kept, "output", cfg.broken_pattern)
    if cfg.placeholder_pattern:
        kept = drop_matching(kept, "output", cfg.placeholder_pattern)
    kept = clean_text(kept)
    kept = length_between(kept, "output", cfg.min_output, cfg.max_output)
    kept = staged(kept.withColumn("_digest", row_key()), scratch_path(df.sparkSession, "cleaned"))
    return first_rows(kept, F.col("_digest"), order).drop("_digest")


def funnel(df: DataFrame, cfg: CleanConfig = CleanConfig()) -> DataFrame:
    """Rows each rule removes and leaves, from one pass: ``(step, rule, removed, remaining)``."""
    keyed = with_reason(df, cfg).select(
        "rule", F.when(F.col("rule").isNull(), row_key()).alias("key")
    )
    per_key = keyed.groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n"))
    counts = per_key.groupBy("rule").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("key").isNotNull(), 1)).alias("distinct")
    )
    rules = ["type", "category", "instruction", "broken", "placeholder", "short", "long"]
    totals = counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("total"),
        *[
            F.coalesce(F.sum(F.when(F.col("rule") == r, F.col("n"))), F.lit(0))
            .cast("bigint").alias(r)
            for r in rules
        ],
        F.coalesce(F.sum(F.when(F.col("rule").isNull(), F.col("n") - F.col("distinct"))), F.lit(0))
        .cast("bigint").alias("duplicate"),
    )
    steps = []
    left = F.col("total")
    for i, rule in enumerate([*rules, "duplicate"], start=1):
        left = left - F.col(rule)
        steps.append(
            F.struct(
                F.lit(i).cast("bigint").alias("step"),
                F.lit(rule).alias("rule"),
                F.col(rule).alias("removed"),
                left.alias("remaining"),
            )
        )
    return totals.select(F.inline(F.array(*steps)))


def null_meta(df: DataFrame, columns: list[str]) -> DataFrame:
    """NaN becomes null; text columns pass through."""
    kinds = dict(df.dtypes)
    return df.withColumns(
        {
            c: F.when(~F.isnan(c), F.col(c)) if kinds[c] in ("double", "float") else F.col(c)
            for c in columns
        }
    )


def long_enough_answer(df: DataFrame, cfg: MixConfig = MixConfig()) -> DataFrame:
    return df.where(F.length(last(F.col("messages")).content) >= cfg.min_answer)
