"""Column functions (pure ``Column -> Column``), JVM-side built-ins only."""

from lakepipe.functions.arrays import csv_to_array, pg_array_to_array
from lakepipe.functions.numeric import bmi, monthly_price, positive_or_null, std_cast
from lakepipe.functions.temporal import day_of, days_since, duration_minutes, std_ts
from lakepipe.functions.text import (
    blank_to_null,
    clean_email,
    clean_phone,
    clean_pincode,
    code_norm,
    default_if_null,
    digits_only,
    email_norm,
    full_name,
    is_blank,
    strip_quotes,
    text_norm,
    title_case,
)

__all__ = [
    "blank_to_null", "bmi", "clean_email", "clean_phone", "clean_pincode", "code_norm",
    "csv_to_array", "day_of", "days_since", "default_if_null", "digits_only",
    "duration_minutes", "email_norm", "full_name", "is_blank", "monthly_price",
    "pg_array_to_array", "positive_or_null", "std_cast", "std_ts", "strip_quotes",
    "text_norm", "title_case",
]
