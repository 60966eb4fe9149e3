"""As-of join: each left row with the last right row of its key at or before its time.

One union of both sides and one ordered pass that carries the last right row
along: no range condition, so no pairs are formed.  Hot keys are cut into
slices of time (``time_slices``), each starting with the last right row before
it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakepipe.operators.time_slices import DEFAULT_MAX_ROWS, add_slice, carry_last, hot_cuts, ordinal, ordinal_units


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    left_time: str,
    right_time: str,
    take: Sequence[str] | None = None,
    direction: str = "backward",
    allow_equal: bool = True,
    tolerance=None,
    how: str = "left",
    max_rows: int = DEFAULT_MAX_ROWS,
) -> DataFrame:
    """All columns of ``left`` and the ``take`` columns (default: all but the keys) of the matching right row.

    ``backward`` matches the last right row at or before the left time,
    ``forward`` the first at or after it; ``allow_equal=False`` leaves out
    equal times.  Of right rows with one time the greatest in the taken
    columns counts.  ``tolerance`` (a ``timedelta``, or a number in the time's
    own unit) drops matches farther away.  Left rows with a NULL key or time
    match nothing: they stay with NULLs (``how="left"``) or go (``"inner"``).
    Repeated left rows each get their match.  Key columns have one name on
    both sides; other names must differ.
    """
    keys = [on] if isinstance(on, str) else list(on)
    take = [c for c in right.columns if c not in keys] if take is None else list(take)
    if clash := set(take) & set(left.columns):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    if direction not in ("backward", "forward") or how not in ("left", "inner"):
        raise ValueError(f"direction {direction!r}, how {how!r}")
    sign = 1 if direction == "backward" else -1  # forward in time is backward in negated time
    farthest = None if tolerance is None else ordinal_units(left, left_time, tolerance)

    def usable(df, time):
        return reduce(lambda a, b: a & b, [F.col(f"`{c}`").isNotNull() for c in [*keys, time]])

    row = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    value = F.struct(*[F.col(f"`{c}`") for c in take])
    lefts = left.where(usable(left, left_time)).select(*keys, (ordinal(left, left_time) * sign).alias("_o"), row.alias("_row"))
    rights = right.where(usable(right, right_time)).select(*keys, (ordinal(right, right_time) * sign).alias("_o"), value.alias("_value"))

    cuts = hot_cuts(lefts.select(*keys, "_o").unionByName(rights.select(*keys, "_o")), keys, "_o", max_rows)
    lefts = add_slice(lefts, keys, "_o", cuts, spread=F.xxhash64("_row"))
    # Where equal times match, right rows come in the first slice of their time, otherwise in the last.
    rights = add_slice(rights, keys, "_o", cuts) if allow_equal else _last_slice(rights, keys, cuts)
    if cuts is not None:
        rights = _one_a_time(rights, keys)
    first, second = (1, 0) if allow_equal else (0, 1)  # order of left and right rows at one time
    lefts = lefts.withColumn("_side", F.lit(first)).withColumn("_value", F.lit(None).cast(rights.schema["_value"].dataType))
    rights = rights.withColumn("_side", F.lit(second)).withColumn("_row", F.lit(None).cast(lefts.schema["_row"].dataType))
    columns = [*keys, "_slice", "_o", "_side", "_row", "_value"]
    both = lefts.select(columns).unionByName(rights.select(columns))
    if cuts is not None:
        latest = F.when(F.col("_value").isNotNull(), F.struct("_o", "_value"))
        carried = carry_last(both, keys, latest).select(*keys, "_slice", F.col("_carry._o").alias("_o"), F.lit(second).alias("_side"), F.lit(None).cast(both.schema["_row"].dataType).alias("_row"), F.col("_carry._value").alias("_value"))
        both = both.unionByName(carried)
    w = Window.partitionBy(*keys, "_slice").orderBy("_o", "_side", "_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    known = F.last(F.when(F.col("_value").isNotNull(), F.struct("_o", "_value")), ignorenulls=True).over(w)
    passed = both.withColumn("_known", known).where(F.col("_row").isNotNull())
    match = F.col("_known")
    if farthest is not None:
        match = F.when(F.col("_o") - F.col("_known._o") <= farthest, match)
    passed = passed.select("_row", match.getField("_value").alias("_value"))
    if how == "inner":
        passed = passed.where(F.col("_value").isNotNull())
    out = passed.select("_row.*", *[F.col("_value").getField(c).alias(c) for c in take])
    if how == "left":
        alone = left.where(~usable(left, left_time))
        out = out.unionByName(alone.select("*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in take]))
    return out


def _last_slice(rows: DataFrame, keys: Sequence[str], cuts: DataFrame | None) -> DataFrame:
    """The slice after all cuts at a row's time: the first slice of the next larger whole number."""
    moved = add_slice(rows.withColumn("_next", F.col("_o") + 1), keys, "_next", cuts)
    return moved.drop("_next")


def _one_a_time(rights: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The greatest right row of each time of a hot key, so one busy instant is no hot partition."""
    hot = F.col("_slice").isNotNull()
    one = rights.where(hot).groupBy(*keys, "_slice", "_o").agg(F.max("_value").alias("_value"))
    return rights.where(~hot).select(one.columns).unionByName(one)
