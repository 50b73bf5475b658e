"""Audit of a table of generated answers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalog import config as C
from stratalog.config import AuditConfig
from stratalog.functions import audit_rules as R
from stratalog.functions.text import fill, rstrip


def with_fallback(df: DataFrame) -> DataFrame:
    """The generated answer, else the summary, else a fixed text; adds ``llm_used`` and a warning."""
    generated = F.col("answer").isNotNull()
    return df.withColumns(
        {
            "llm_used": generated,
            "warnings": F.when(generated, F.array().cast("array<string>")).otherwise(
                F.array(F.lit(C.WARNING_UNAVAILABLE))
            ),
            "answer": F.coalesce(
                "answer",
                F.when(R.has_text(F.col("summary")), F.col("summary")),
                F.lit(C.ANSWER_UNAVAILABLE),
            ),
        }
    )


def findings(df: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """What each rule finds in ``(question, answer, summary)``."""
    answer, summary = F.col("answer"), F.col("summary")
    claimed = F.size("claimed") > 0
    shown = R.has_text(summary)
    none = F.array().cast("array<string>")
    return df.withColumn("claimed", R.confidence_values(answer, cfg)).withColumns(
        {
            "no_prediction": claimed & ~shown,
            "mismatched": F.when(
                claimed & shown, R.mismatched_confidence(F.col("claimed"), summary, cfg)
            ).otherwise(none),
            "absences": F.when(shown, R.false_absences(answer, cfg)).otherwise(none),
            "formula": shown & R.formula_request(F.col("question"), cfg),
        }
    ).withColumn(
        "quantities",
        F.when(shown & ~F.col("formula"), R.unsupported_quantities(answer, cfg)).otherwise(none),
    )


def corrected(df: DataFrame, cfg: AuditConfig = AuditConfig()) -> DataFrame:
    """Add notes, corrected answer, extended warnings and trace; only generated answers are touched."""
    found = findings(df, cfg)
    audited = F.col("llm_used") & (F.coalesce(F.col("answer"), F.lit("")) != "")

    def joined(name: str):
        return F.array_join(name, ", ")

    notes = F.array_compact(
        F.array(
            F.when(F.col("no_prediction"), F.lit(C.NOTE_NO_PREDICTION)).when(
                F.size("mismatched") > 0, fill(C.NOTE_CONFIDENCE, joined("mismatched"))
            ),
            F.when(F.size("absences") == 1, fill(C.NOTE_ABSENCE_ONE, joined("absences"))).when(
                F.size("absences") > 1, fill(C.NOTE_ABSENCE_MANY, joined("absences"))
            ),
            F.when(F.size("quantities") > 0, fill(C.NOTE_QUANTITIES, joined("quantities"))),
        )
    )
    trace = F.array_compact(
        F.array(
            F.when(
                F.col("no_prediction"), F.lit("guard: confidence claimed with no prediction")
            ).when(
                F.size("mismatched") > 0,
                fill("guard: mismatched confidence ({})", joined("mismatched")),
            ),
            F.when(
                F.size("absences") > 0,
                fill("guard: corrected absence claim ({})", joined("absences")),
            ),
            F.when(
                F.col("formula"), F.lit("guard: skipped quantity check (formula request)")
            ).when(
                F.size("quantities") > 0,
                fill("guard: flagged fabricated quantities ({})", joined("quantities")),
            ),
        )
    )
    empty = F.array().cast("array<string>")
    warnings = F.col("warnings") if "warnings" in df.columns else empty
    out = found.withColumn("notes", F.when(audited, notes).otherwise(empty)).withColumn(
        "trace", F.when(audited, trace).otherwise(empty)
    )
    return out.withColumns(
        {
            "warnings": F.concat(warnings, F.col("notes")),
            "answer": F.when(
                F.size("notes") > 0,
                F.concat_ws("\n\n", rstrip(F.col("answer")), F.array_join("notes", "\n\n")),
            ).otherwise(F.col("answer")),
        }
    )


def totals(audited: DataFrame) -> DataFrame:
    """How often each rule fired, from the trace; the values in brackets do not count."""
    rule = F.regexp_replace("step", r" \([^)]*\)$", "")
    return (
        # the outer form adds no filter on the trace, which would compute it a second time
        audited.select(F.explode_outer("trace").alias("step"))
        .where("step is not null")
        .groupBy(rule.alias("rule"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
