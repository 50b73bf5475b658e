"""Text expressions that agree with Unicode-aware string handling."""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the characters a Unicode-aware strip() removes
WHITE_SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed a single time however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def strip(text: Column) -> Column:
    """Trimming by character set looks at the ends only, unlike a pattern."""
    return F.btrim(text, F.lit(WHITE_SPACE))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    """True for null, empty or white-space-only text."""
    return F.coalesce(F.ltrim(text, F.lit(WHITE_SPACE)) == "", F.lit(True))


def folded(text: Column) -> Column:
    """Lower case, with the letters that a case-insensitive pattern takes for s, i and k."""
    rare = "\u017f\u0131\u0130\u212a"
    found = reduce(lambda a, b: a | b, [text.contains(c) for c in rare])
    return F.lower(F.when(found, F.translate(text, rare, "siik")).otherwise(text))


def matches(text: Column, pattern: str) -> Column:
    """Case-insensitive Unicode search; null text does not match.

    A pattern of plain words is a substring search.
    """
    words = pattern.split("|")
    if all(re.fullmatch(r"[A-Za-z ,]+", w) for w in words):
        found = once(
            folded(text), lambda t: reduce(lambda a, b: a | b, [t.contains(w.lower()) for w in words])
        )
    else:
        found = text.rlike(f"(?iuU){pattern}")
    return F.coalesce(found, F.lit(False))


def clean(text: Column) -> Column:
    """Null to empty, strip, three or more newlines to two, runs of blanks and tabs to one blank."""
    # plain searches decide whether a pattern has anything to do
    def lines(t: Column) -> Column:
        return F.when(t.contains("\n\n\n"), F.regexp_replace(t, r"\n{3,}", "\n\n")).otherwise(t)

    def gaps(t: Column) -> Column:
        found = t.contains("  ") | t.contains("\t\t") | t.contains(" \t") | t.contains("\t ")
        return F.when(found, F.regexp_replace(t, r"[ \t]{2,}", " ")).otherwise(t)

    stripped = strip(F.coalesce(text, F.lit("")))
    return once(once(stripped, lines), gaps)


def estimate_tokens(text: Column) -> Column:
    """About four characters to a token."""
    return F.floor(F.length(text) / 4).cast("bigint")


def count_words(text: Column) -> Column:
    """Words and single punctuation marks; a finer counter with the same signature."""
    return F.size(F.regexp_extract_all(text, F.lit(r"(?U)\w+|[^\w\s]"), 0)).cast("bigint")


def fill(frame: str, *values: Column) -> Column:
    """Put columns into the ``{}`` places of a fixed text."""
    pieces = frame.split("{}")
    out = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        out += [value, F.lit(piece)]
    return F.concat(*out)


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / whole
