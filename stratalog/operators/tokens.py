"""Token lengths: measure, distribution, coverage and the length filter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.config import ChatTemplate, TokenConfig
from stratalog.functions import messages as M
from stratalog.functions.text import estimate_tokens, percent

Counter = Callable[[Column], Column]
MEASURES = ("total_tokens", "prompt_tokens", "assistant_tokens")


def measure(
    df: DataFrame, template: ChatTemplate = ChatTemplate(), count: Counter = estimate_tokens
) -> DataFrame:
    """Add the three token counts.

    The prompt is the rendering without any assistant message plus the generation mark. ``count`` is
    any expression from text to a whole number; a ``pandas_udf`` around a tokenizer fits as well.
    """
    everything = M.render(F.col("messages"), template)
    asked = M.render(
        F.filter("messages", lambda m: m.role != "assistant"), template, generation=True
    )
    return df.withColumns(
        {
            "total_tokens": count(everything).cast("bigint"),
            "prompt_tokens": count(asked).cast("bigint"),
        }
    ).withColumn("assistant_tokens", F.col("total_tokens") - F.col("prompt_tokens"))


def distribution(
    measured: DataFrame, cfg: TokenConfig = TokenConfig(), source: str = "source"
) -> DataFrame:
    """Exact summary and percentiles per measure, over all rows and per source (null = all).

    Rows are first counted per distinct value, so a hot source is small before it meets one task.
    """
    long = measured.select(
        source, F.inline(F.array(*[
            F.struct(F.lit(m).alias("measure"), F.col(m).alias("v")) for m in MEASURES
        ]))
    )
    counts = long.groupBy(source, "measure", "v").agg(F.count(F.lit(1)).alias("n"))
    both = counts.withColumn(
        "scope", F.explode(F.array(F.lit("all"), F.concat(F.lit("source:"), F.col(source))))
    )
    shares = ",".join(str(p / 100) for p in cfg.percentiles)
    return both.groupBy("scope", "measure").agg(
        F.sum("n").alias("n_rows"),
        F.min("v").alias("min_v"),
        F.expr("percentile(v, 0.5, n)").alias("median_v"),
        (F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("mean_v"),
        F.max("v").alias("max_v"),
        F.expr(f"percentile(v, array({shares}), n)").alias("percentiles"),
    )


def coverage(measured: DataFrame, cfg: TokenConfig = TokenConfig()) -> DataFrame:
    """Rows within each candidate cap: one aggregate with a column per cap, then unrolled."""
    total = F.col("total_tokens")
    row = measured.agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(total <= c).alias(f"c{c}") for c in cfg.caps]
    )
    return row.select(
        F.inline(
            F.array(*[
                F.struct(
                    F.lit(c).cast("bigint").alias("cap"),
                    F.col(f"c{c}").alias("n_ok"),
                    (F.col("n") - F.col(f"c{c}")).alias("n_over"),
                    percent(F.col(f"c{c}"), F.col("n")).alias("pct"),
                )
                for c in cfg.caps
            ])
        )
    )


def recommend(measured: DataFrame, cfg: TokenConfig = TokenConfig()) -> DataFrame:
    """Smallest cap with enough coverage, or null, and the rows it would drop."""
    fits = coverage(measured, cfg).where(F.col("pct") >= cfg.coverage)
    return fits.agg(F.min("cap").alias("cap"), F.min_by("n_over", "cap").alias("n_over"))


def within_cap(measured: DataFrame, cfg: TokenConfig = TokenConfig()) -> tuple[DataFrame, DataFrame]:
    """Rows up to the cap, and audit rows ``(n_tokens, example)`` for those above it."""
    over = F.col("total_tokens") > cfg.max_tokens
    kept = measured.where(~over)
    dropped = measured.where(over).select(
        F.col("total_tokens").alias("n_tokens"),
        F.struct("messages").alias("example"),
        *[c for c in measured.columns if c in ("split", "source", "conv_id")],
    )
    return kept, dropped
