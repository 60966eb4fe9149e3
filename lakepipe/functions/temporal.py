"""Timestamp and date functions.  Parsing never raises: bad text is NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakepipe.functions._util import ColumnOrName, c

# Fixed value: days reported for a center that never logged in.
NEVER_LOGGED_IN_DAYS = 999


def std_ts(x: ColumnOrName) -> Column:
    """Text (default formats) or timestamp -> ``timestamp``; bad or empty
    text gives NULL instead of an error."""
    col = c(x)
    return F.try_to_timestamp(col.cast("string"))


def day_of(x: ColumnOrName) -> Column:
    return F.to_date(c(x))


def days_since(x: ColumnOrName, as_of: Column, missing: int | None = NEVER_LOGGED_IN_DAYS) -> Column:
    """Whole days from the day of ``x`` to ``as_of``; NULL ``x`` -> ``missing``."""
    d = F.datediff(as_of, F.to_date(c(x)))
    if missing is None:
        return d
    return F.when(c(x).isNull(), F.lit(missing)).otherwise(d)


def duration_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Minutes between two timestamps, whole-second epochs, rounded half-up,
    as double."""
    secs = F.unix_timestamp(c(end)) - F.unix_timestamp(c(start))
    return F.round(secs / F.lit(60)).cast("double")
