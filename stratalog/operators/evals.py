"""Training-run and test-set analytics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalog.config import DOMAIN_KEYWORDS, EvalConfig, SkewConfig, WellConfig
from stratalog.functions.times import micros
from stratalog.operators.skew import lag, last_known, mark_blocks, position, running_min, scan_marked


def perplexity(df: DataFrame, loss: str = "loss", by: list[str] | None = None) -> DataFrame:
    """Mean of the losses that are numbers and its exponential; NaN when there is none."""
    real = F.when(~F.isnan(loss), F.col(loss))
    mean = F.coalesce(F.avg(real), F.lit(float("nan")))
    return df.groupBy(*(by or [])).agg(
        F.count(real).alias("n_scored"), mean.alias("avg_loss"), F.exp(mean).alias("perplexity")
    )


def is_domain(text: Column, keywords: tuple[str, ...] = DOMAIN_KEYWORDS) -> Column:
    """The lower-cased text contains any keyword, as a substring."""
    low = F.lower(text)
    return F.coalesce(reduce(lambda a, b: a | b, [low.contains(k) for k in keywords]), F.lit(False))


def domain_slice(
    df: DataFrame, column: str = "question", keywords: tuple[str, ...] = DOMAIN_KEYWORDS
) -> DataFrame:
    return df.where(is_domain(F.col(column), keywords))


def loss_curves(log: DataFrame) -> DataFrame:
    """Log records to ``(run, step, metric, value)``."""
    pairs = F.array(
        F.struct(F.lit("train_loss").alias("metric"), F.col("loss").alias("value")),
        F.struct(F.lit("eval_loss").alias("metric"), F.col("eval_loss").alias("value")),
    )
    return log.select("run", "step", F.inline(pairs)).where("value is not null")


def best_eval(log: DataFrame) -> DataFrame:
    """Lowest evaluation loss per run and the first step that reached it."""
    seen = log.where("eval_loss is not null")
    return seen.groupBy("run").agg(
        F.min("eval_loss").alias("best_eval_loss"),
        F.min_by("step", F.struct("eval_loss", "step")).alias("best_step"),
    )


def early_stop(
    log: DataFrame, cfg: EvalConfig = EvalConfig(), skew: SkewConfig = SkewConfig()
) -> DataFrame:
    """First step per run with ``patience`` evaluations in a row without a new best, else null."""
    evals = log.where("eval_loss is not null").select("run", "step", "eval_loss")
    evals = mark_blocks(evals, ["run"], ["step"], skew)
    best = scan_marked(evals, ["run"], ["step"], best=running_min(F.col("eval_loss")), n=position())
    prior = scan_marked(best, ["run"], ["step"], prior=lag(F.col("best")))
    improved = F.col("prior").isNull() | (F.col("eval_loss") < F.col("prior"))
    waits = scan_marked(
        prior, ["run"], ["step"], since=last_known(F.when(improved, F.col("n")))
    ).withColumn("waited", F.col("n") - F.col("since"))
    return waits.groupBy("run").agg(
        F.count(F.lit(1)).alias("n_evals"),
        F.min(F.when(F.col("waited") >= cfg.patience, F.col("step"))).alias("stop_step"),
    )


def run_metrics(
    rows: DataFrame, log: DataFrame, results: DataFrame, cfg: EvalConfig = EvalConfig()
) -> DataFrame:
    """One row of named scalars.

    ``rows(split)`` is the corpus, ``log(step, ts, loss, eval_loss)`` one run, ``results(loss)`` the
    scored test set. Each input is reduced to one row by its own aggregate.
    """
    def n(s: str) -> Column:
        return F.count_if(F.col("split") == s).alias(f"n_{s}")

    sizes = rows.agg(n("train"), n("val"), n("test"))
    seconds = (micros(F.max("ts")) - micros(F.min("ts"))) / 1e6
    run = log.agg(
        (seconds / 60).alias("train_runtime_min"),
        (seconds / 3600).alias("train_runtime_h"),
        (seconds / 3600 * cfg.credits_per_hour).alias("estimated_credits"),
        F.avg("loss").alias("final_train_loss"),
        F.min("eval_loss").alias("best_eval_loss"),
    )
    scored = perplexity(results).select(
        F.col("avg_loss").alias("test_avg_loss"), F.col("perplexity").alias("test_perplexity")
    )
    return sizes.select(
        "*",
        *[run.select(c).scalar().alias(c) for c in run.columns],
        *[scored.select(c).scalar().alias(c) for c in scored.columns],
    )


def review_table(df: DataFrame, cfg: EvalConfig = EvalConfig()) -> DataFrame:
    """Test samples cut to display size."""
    def cut(c: str, n: int) -> Column:
        return F.substring(c, 1, n).alias(c)

    kept = [c for c in df.columns if c not in ("question", "reference", "generated")]
    return df.select(
        *kept,
        cut("question", cfg.question_chars),
        cut("reference", cfg.answer_chars),
        cut("generated", cfg.answer_chars),
    )


def calibration(scored: DataFrame) -> DataFrame:
    """Accuracy per confidence band of ``(label, prediction, confidence)``."""
    c = F.col("confidence")
    band = F.when(c >= 0.9, ">=0.9").when(c >= 0.7, "0.7-0.9").otherwise("<0.7")
    return scored.groupBy(band.alias("band")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
    )


def recall_per_class(scored: DataFrame) -> DataFrame:
    return scored.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("recall"),
    )


def blind_spots(scored: DataFrame, cfg: WellConfig = WellConfig()) -> DataFrame:
    """Classes the classifier does not reliably find."""
    return recall_per_class(scored).where(F.col("recall") < cfg.blind_recall)
