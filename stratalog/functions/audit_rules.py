"""Rules over generated answers, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalog.config import ABSENCE_PATTERNS, QUANTITY_PATTERNS, AuditConfig
from stratalog.functions.text import folded, matches, once


def _found(answer: Column, rules: list[tuple[str, str]]) -> Column:
    """Names whose pattern matches; a pattern only runs where its name occurs at all."""
    def hits(text: Column) -> Column:
        return F.array(*[
            F.when(text.contains(name.lower()) & answer.rlike(f"(?iuU){pattern}"), F.lit(name))
            for name, pattern in rules
        ])

    found = once(F.coalesce(folded(answer), F.lit("")), hits)
    return F.array_compact(found).cast("array<string>")


def false_absences(answer: Column, cfg: AuditConfig = AuditConfig()) -> Column:
    """Classes the answer calls absent: a negation before or after the class, in one sentence."""
    before, after = ABSENCE_PATTERNS
    rules = [
        (
            c,
            f"(?:{before.format(negation=cfg.negation, name=c, gap=cfg.before)}"
            f"|{after.format(negation=cfg.negation, name=c, gap=cfg.after)})",
        )
        for c in cfg.classes
    ]
    return _found(answer, rules)


def unsupported_quantities(answer: Column, cfg: AuditConfig = AuditConfig()) -> Column:
    """Quantities that stand near a digit, sorted."""
    rules = [
        (q, "(?:" + "|".join(p.format(name=rf"\Q{q}\E", gap=cfg.digit_window) for p in QUANTITY_PATTERNS) + ")")
        for q in sorted(cfg.quantities)
    ]
    return _found(answer, rules)


def formula_request(question: Column, cfg: AuditConfig = AuditConfig()) -> Column:
    return matches(question, cfg.formula)


def confidence_values(answer: Column, cfg: AuditConfig = AuditConfig()) -> Column:
    """Every confidence figure on the scale 0 to 1, in order; threshold phrases do not count."""
    pattern = f"(?iuU){cfg.confidence}"
    text = F.coalesce(answer, F.lit(""))
    claims = F.filter(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda m: ~m.rlike(f"(?iuU){cfg.threshold}"),
    )

    def figure(m: Column) -> Column:
        first = F.regexp_extract(m, pattern, 1)
        number = F.when(first != "", first).otherwise(F.regexp_extract(m, pattern, 3))
        sign = F.when(first != "", F.regexp_extract(m, pattern, 2)).otherwise(
            F.regexp_extract(m, pattern, 4)
        )
        value = number.try_cast("double")
        return F.when((sign == "%") | (value > 1), value / 100.0).otherwise(value)

    return F.array_compact(F.transform(claims, figure))


def summary_numbers(summary: Column, cfg: AuditConfig = AuditConfig()) -> Column:
    found = F.regexp_extract_all(
        F.coalesce(summary, F.lit("")), F.lit(f"(?iuU){cfg.summary_number}"), F.lit(1)
    )
    return F.transform(found, lambda m: F.round(m.try_cast("double"), 2))


def mismatched_confidence(
    claimed: Column, summary: Column, cfg: AuditConfig = AuditConfig()
) -> Column:
    """Claims, to two decimals, that the summary does not print: sorted, unique."""
    rounded = F.transform(claimed, lambda c: F.round(c, 2))
    missing = F.array_except(rounded, summary_numbers(summary, cfg))
    return F.array_sort(F.transform(missing, lambda c: F.format_string("%.2f", c)))


def has_text(summary: Column) -> Column:
    return F.coalesce(summary != "", F.lit(False))
