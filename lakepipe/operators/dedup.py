"""Latest row per key and full-row distinct."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNORDERABLE = (T.MapType, T.VariantType) if hasattr(T, "VariantType") else (T.MapType,)


def _orderable(field: T.StructField) -> bool:
    def ok(dt):
        if isinstance(dt, _UNORDERABLE):
            return False
        if isinstance(dt, T.ArrayType):
            return ok(dt.elementType)
        if isinstance(dt, T.StructType):
            return all(ok(f.dataType) for f in dt.fields)
        return True

    return ok(field.dataType)


def latest_order(
    df: DataFrame, keys: Sequence[str], updated_col: str, tie_breakers: Sequence[str] | None = None
) -> list[Column]:
    """Newest ``updated_col`` first (NULL last), then deterministic ties:
    the remaining orderable columns ascending, NULLs last."""
    if tie_breakers is None:
        skip = set(keys) | {updated_col}
        tie_breakers = [f.name for f in df.schema.fields if f.name not in skip and _orderable(f)]
    return [F.col(updated_col).desc_nulls_last()] + [F.col(c).asc_nulls_last() for c in tie_breakers]


def dedup_latest(
    df: DataFrame,
    keys: str | Sequence[str],
    updated_col: str,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key: the one with the newest ``updated_col``.

    Rows with a NULL key are dropped first.  ``row_number() == 1`` over the
    key lets Catalyst insert a partial WindowGroupLimit *before* the shuffle,
    so every map task forwards at most one row per key: a key holding a third
    of the input costs one row per task in the exchange, not a third of it.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    df = df.filter(_all_not_null(keys))
    w = Window.partitionBy(*keys).orderBy(*latest_order(df, keys, updated_col, tie_breakers))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def _all_not_null(keys: Sequence[str]) -> Column:
    cond = F.col(keys[0]).isNotNull()
    for k in keys[1:]:
        cond = cond & F.col(k).isNotNull()
    return cond


def dedup_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (partial aggregation removes copies map-side)."""
    return df.dropDuplicates()
