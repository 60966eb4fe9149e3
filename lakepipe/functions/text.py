"""String cleaning functions: pure ``Column -> Column``, usable on batch and
streaming frames, ANSI-safe (no expression here can raise on bad input)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakepipe.functions._util import ColumnOrName, c

# The e-mail shape accepted by the silver layer, and the
# labels substituted for missing user values.
EMAIL_PATTERN = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"
UNKNOWN_EMAIL = "unknown"
DEFAULT_ROLE = "USER"
PHONE_MIN_DIGITS = 9
PHONE_MAX_DIGITS = 11


def text_norm(x: ColumnOrName) -> Column:
    """Strip leading/trailing spaces (spaces only: tabs and newlines stay)."""
    return F.trim(c(x))


def title_case(x: ColumnOrName) -> Column:
    """``initcap(trim(x))``: first letter of each space-separated word upper,
    the rest lower."""
    return F.initcap(F.trim(c(x)))


def code_norm(x: ColumnOrName, trim: bool = True) -> Column:
    """Upper-cased code/label (status, currency, provider ...)."""
    col = c(x)
    return F.upper(F.trim(col) if trim else col)


def email_norm(x: ColumnOrName, trim: bool = True) -> Column:
    col = c(x)
    return F.lower(F.trim(col) if trim else col)


def is_blank(x: ColumnOrName) -> Column:
    return F.length(F.trim(c(x))) == 0


def blank_to_null(x: ColumnOrName, mode: str = "keep") -> Column:
    """NULL when the text is empty after trimming, otherwise

    * ``keep``  – the original text,
    * ``trim``  – the trimmed text,
    * ``title`` – the title-cased text.
    """
    col = c(x)
    kept = {"keep": col, "trim": F.trim(col), "title": title_case(col)}[mode]
    return F.when(is_blank(col), F.lit(None).cast("string")).otherwise(kept)


def digits_only(x: ColumnOrName) -> Column:
    """Every non-digit removed; the input is read as text first."""
    return F.regexp_replace(c(x).cast("string"), r"[^0-9]", "")


def strip_quotes(x: ColumnOrName) -> Column:
    """Leading and trailing runs of double quotes removed."""
    return F.regexp_replace(c(x), r'^"+|"+$', "")


def clean_email(x: ColumnOrName) -> Column:
    """Lower-cased, trimmed address if it has a valid shape, else NULL."""
    e = email_norm(x)
    return F.when(e.rlike(EMAIL_PATTERN), e).otherwise(F.lit(None).cast("string"))


def clean_phone(x: ColumnOrName) -> Column:
    """Digits of the number when there are 9 to 11 of them, else NULL."""
    d = F.regexp_replace(F.trim(c(x).cast("string")), r"[^0-9]", "")
    return F.when(F.length(d).between(PHONE_MIN_DIGITS, PHONE_MAX_DIGITS), d).otherwise(
        F.lit(None).cast("string")
    )


def clean_pincode(x: ColumnOrName) -> Column:
    """Digits of the code, NULL when there are none."""
    d = digits_only(x)
    return F.when(F.length(d) > 0, d).otherwise(F.lit(None).cast("string"))


def full_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    """``first last`` skipping NULL parts (both NULL gives ``''``)."""
    return F.concat_ws(" ", c(first), c(last))


def default_if_null(x: ColumnOrName, default) -> Column:
    col = c(x)
    return F.when(col.isNull(), F.lit(default)).otherwise(col)
