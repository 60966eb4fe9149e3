"""Numeric helpers and safe casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakepipe.functions._util import ColumnOrName, c

# Plan length thresholds (days) and the months they span.
YEARLY_DAYS = 365
QUARTERLY_DAYS = 90


def std_cast(x: ColumnOrName, to: str) -> Column:
    """Cast where a bad value becomes NULL.  Whole numbers are cast as they
    are (exact beyond 2^53); fractions go through decimal so ``'12.7'`` gives
    12 (truncation), as a lenient cast would; the rest ('1e3') through double."""
    col = c(x)
    if to in ("int", "integer", "bigint", "long", "smallint", "tinyint"):
        exact = col.cast("string").try_cast(to)
        fraction = F.when(col.cast("string").rlike(r"^\s*[+-]?[0-9]*\.[0-9]*\s*$"), col.try_cast("decimal(38,10)").try_cast(to))
        return F.coalesce(exact, fraction, col.try_cast("double").try_cast(to))
    return col.try_cast(to)


def positive_or_null(x: ColumnOrName) -> Column:
    """The number; NULL where it is <= 0 or no number at all."""
    col = c(x)
    number = col.try_cast("double")
    return F.when(number > 0, col)


def bmi(height_cm: ColumnOrName, weight_kg: ColumnOrName) -> Column:
    """``round(w / (h/100)^2, 2)``; NULL if either input is NULL or <= 0."""
    h = positive_or_null(height_cm).try_cast("double")
    w = positive_or_null(weight_kg).try_cast("double")
    raw = F.round(F.try_divide(w, F.pow(h / 100, 2)), 2)
    return F.when(h.isNull() | w.isNull(), F.lit(None).cast("double")).otherwise(raw)


def monthly_price(duration_days: ColumnOrName, price: ColumnOrName) -> Column:
    """Plan price per month: yearly plans /12, quarterly /3, else as is."""
    d, p = c(duration_days), c(price)
    return (
        F.when(d >= YEARLY_DAYS, p / 12)
        .when(d >= QUARTERLY_DAYS, p / 3)
        .otherwise(p)
    )
