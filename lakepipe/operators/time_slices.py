"""Hot keys cut along time.

An ordered pass over one key (as-of join, gaps, sessions) is one window
partition, so a key holding a third of the rows would be one task.  Keys above
``max_rows`` get cut points from their own time quantiles; each slice is a
window partition of its own and takes over the state that the slices before it
leave (``carry_last``).  All other keys are one slice.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.operators.sizing import broadcast_if_small
from lakepipe.session import scratch_path

DEFAULT_MAX_ROWS = 1_000_000


def ordinal(df: DataFrame, column: str) -> Column:
    """A time or whole-number column as a long: microseconds, days or the number itself."""
    kind, c = df.schema[column].dataType, F.col(f"`{column}`")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("long")
    if isinstance(kind, T.IntegralType):
        return c.cast("long")
    raise TypeError(f"{column}: {kind.simpleString()} is no time or whole number")


def ordinal_units(df: DataFrame, column: str, amount) -> int:
    """``amount`` of time (a ``timedelta``, or a number in the column's own unit) in units of ``ordinal``."""
    if hasattr(amount, "total_seconds"):
        seconds = amount.total_seconds()
        if isinstance(df.schema[column].dataType, T.DateType):
            return math.floor(seconds / 86_400)
        return round(seconds * 1_000_000)
    return int(amount)


def join_on_keys(rows: DataFrame, other: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """``rows`` with the other columns of ``other`` for equal keys, where NULL equals NULL."""
    named = {k: f"_key{n}" for n, k in enumerate(keys)}
    other = other.select(*[F.col(f"`{c}`").alias(named.get(c, c)) for c in other.columns])
    equal = reduce(lambda a, b: a & b, [F.col(f"`{k}`").eqNullSafe(F.col(n)) for k, n in named.items()])
    return rows.join(broadcast_if_small(other), equal, how).drop(*named.values())


def hot_cuts(rows: DataFrame, keys: Sequence[str], at: str, max_rows: int) -> DataFrame | None:
    """(keys, ``_cuts``) of the keys with more than ``max_rows`` rows, or None without any.

    ``at`` is a long.  A slice holds about ``max_rows`` rows: cut points are
    quantiles of the key's own rows, so equal values may give equal cuts.
    Stored, as a quantile sketch need not come out the same twice.
    """
    spark = rows.sparkSession
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > max_rows)
    path = scratch_path(spark, "hot-keys")
    counts.write.parquet(f"{path}/counts")
    hot = spark.read.parquet(f"{path}/counts")
    most = hot.agg(F.max("_n")).first()[0]
    if most is None:
        return None
    slices = -(-most // max_rows)
    shares = [k / slices for k in range(1, slices)]
    found = (
        join_on_keys(rows, hot.select(*keys), keys, "left_semi")
        .groupBy(*keys)
        .agg(F.percentile_approx(at, shares, 20 * slices).alias("_cuts"))
    )
    found.write.parquet(f"{path}/cuts")
    return spark.read.parquet(f"{path}/cuts")


def cuts_below(cuts: str, at: Column, or_equal: bool = False, digits: int = 20) -> Column:
    """How many of the sorted array ``cuts`` (under 2^``digits``) are less than (or equal to) ``at``, by halving."""

    def step(pos: Column, width: Column) -> Column:
        value = F.try_element_at(F.col(cuts), pos + width)
        return F.when(value <= at if or_equal else value < at, pos + width).otherwise(pos)

    return F.aggregate(F.array(*[F.lit(1 << k) for k in range(digits - 1, -1, -1)]), F.lit(0), step)


def add_slice(rows: DataFrame, keys: Sequence[str], at: str, cuts: DataFrame | None, spread: Column | None = None) -> DataFrame:
    """``rows`` with ``_slice``: null for keys that are not hot.

    A row equal to some cuts fits the slices on either side of them.  Such rows
    go to the first, or where ``spread`` (a hash of the row) is given are dealt
    over all of them.  ``at`` never falls from one slice to the next.
    """
    if cuts is None:
        return rows.withColumn("_slice", F.lit(None).cast("int"))
    joined = join_on_keys(rows, cuts, keys)
    place = cuts_below("_cuts", F.col(at))
    if spread is not None:
        room = cuts_below("_cuts", F.col(at), or_equal=True) - place + 1
        place = place + F.pmod(spread, room).cast("int")
    return joined.withColumn("_slice", F.when(F.col("_cuts").isNotNull(), place)).drop("_cuts")


def carry_last(rows: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """(keys, ``_slice``, ``_carry``): the greatest ``value`` in the slices before each slice of hot keys.

    The value is reduced to one row a slice first (a partial aggregate), so
    the pass along a key reads its slices only.  Slices without an earlier
    value have no row.
    """
    per_slice = rows.where(F.col("_slice").isNotNull()).groupBy(*keys, "_slice").agg(F.max(value).alias("_v"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.select(*keys, "_slice", F.max("_v").over(before).alias("_carry")).where(F.col("_carry").isNotNull())
