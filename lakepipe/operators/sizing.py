"""Size checks that gate broadcasting.

A side is broadcast only after a job has counted its rows and summed their
size.  The job is a plain parallel aggregate (one small partial row per
task, no limit and so no single task that gathers rows); callers measure
batches they have cached.  Fixed-width columns count their width, strings
and binaries their actual length, nested values the length of their JSON
text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Default ceilings for a broadcast side (a few narrow key columns).  Every
# executor holds a copy, so the byte bound matters more than the row bound.
DEFAULT_MAX_BROADCAST_ROWS = 2_000_000
DEFAULT_MAX_BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = (
    (T.BooleanType, 1),
    (T.ByteType, 1),
    (T.ShortType, 2),
    (T.IntegerType, 4),
    (T.FloatType, 4),
    (T.DateType, 4),
    (T.LongType, 8),
    (T.DoubleType, 8),
    (T.TimestampType, 8),
    (T.TimestampNTZType, 8),
    (T.DecimalType, 16),
)


def _bytes_of(field: T.StructField) -> Column:
    c = F.col(f"`{field.name}`")
    for kind, width in _FIXED_WIDTH:
        if isinstance(field.dataType, kind):
            return F.lit(width)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0))
    return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))


def measure(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``."""
    width = F.lit(0)
    for f in df.schema.fields:
        width = width + _bytes_of(f)
    row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def has_at_most(df: DataFrame, max_rows: int, max_bytes: int | None = None) -> bool:
    n, b = measure(df)
    return n <= max_rows and (max_bytes is None or b <= max_bytes)


def broadcast_if_small(
    df: DataFrame,
    max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``broadcast(df)`` when it has at most ``max_rows`` rows and
    ``max_bytes`` bytes, else ``df`` unchanged (the join then shuffles;
    AQE may still pick a strategy)."""
    return F.broadcast(df) if has_at_most(df, max_rows, max_bytes) else df
