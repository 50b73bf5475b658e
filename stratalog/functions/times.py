"""Time expressions that take timestamps with and without time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(value: Column | str) -> Column:
    """Microseconds since 1970; a time without zone is read in the session's zone."""
    column = F.col(value) if isinstance(value, str) else value
    return F.unix_micros(column.cast("timestamp"))
