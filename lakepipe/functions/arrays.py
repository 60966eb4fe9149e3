"""Delimited text to ``array<string>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakepipe.functions._util import ColumnOrName, c


def _squeeze_split(s: Column) -> Column:
    return F.split(F.regexp_replace(s, r"\s*,\s*", ","), ",")


def pg_array_to_array(x: ColumnOrName) -> Column:
    """``'{a, b ,c}'`` -> ``[a, b, c]``: braces removed, spaces around commas
    squeezed, split on commas.  ``'{}'`` gives ``['']``, NULL stays NULL."""
    return _squeeze_split(F.regexp_replace(c(x), r"[\{\}]", ""))


def csv_to_array(x: ColumnOrName) -> Column:
    """``' squat ,  press'`` -> ``[squat, press]``."""
    return _squeeze_split(F.trim(c(x)))
