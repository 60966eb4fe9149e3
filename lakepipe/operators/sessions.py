"""Gaps, sessions and rolling sums along time.

Gaps and sessions need each row's predecessor; hot keys are cut into slices of
time (``time_slices``) whose first rows take over the edge of the slices before.
Rolling sums are taken over one row a key and unit of time, so the frame never
sees raw rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakepipe.operators.time_slices import DEFAULT_MAX_ROWS, add_slice, carry_last, hot_cuts, join_on_keys, ordinal, ordinal_units


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _sliced(df: DataFrame, keys: Sequence[str], time: str, order: Sequence[str], max_rows: int) -> tuple[DataFrame, object, bool]:
    """Rows with ``_o`` (time as a long) and ``_slice``, the window in time order, and whether any key is hot."""
    usable = df.where(F.col(f"`{time}`").isNotNull()).withColumn("_o", ordinal(df, time))
    cuts = hot_cuts(usable.select(*keys, "_o"), keys, "_o", max_rows)
    # Rows of one instant stay together, so that ``order`` decides among them.
    rows = add_slice(usable, keys, "_o", cuts)
    return rows, Window.partitionBy(*keys, "_slice").orderBy("_o", *order), cuts is not None


def _from_before(rows: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """``rows`` with ``_carry``, the greatest ``value`` in earlier slices of the key."""
    carried = carry_last(rows, keys, value)
    return join_on_keys(rows, carried, [*keys, "_slice"])


def with_previous(
    df: DataFrame, on: str | Sequence[str], time: str, order: Sequence[str] = (), name: str = "previous", max_rows: int = DEFAULT_MAX_ROWS
) -> DataFrame:
    """``df`` with the time of the row before of its key (NULL for the first), rows of one time in the ``order`` columns.

    Rows without a time are left out; a NULL key is a key.
    """
    keys = _keys(on)
    rows, w, hot = _sliced(df, keys, time, order, max_rows)
    before = F.lag(time).over(w)
    if hot:
        # Earlier slices end at the greatest time in them.
        rows = _from_before(rows, keys, F.col(f"`{time}`"))
        before = F.coalesce(F.lag(time).over(w), F.when(F.row_number().over(w) == 1, F.col("_carry")))
    return rows.withColumn(name, before).select(*df.columns, name)


def sessionize(df: DataFrame, on: str | Sequence[str], time: str, gap, max_rows: int = DEFAULT_MAX_ROWS) -> DataFrame:
    """(keys, session_start, session_end, n_rows): runs of rows of a key in which each comes at most ``gap`` after the one before.

    ``gap`` is a ``timedelta`` or a number in the time's own unit.  Rows
    without a time are left out; a NULL key is a key.
    """
    keys = _keys(on)
    rows, w, hot = _sliced(df.select(*keys, time), keys, time, (), max_rows)
    before = F.lag("_o").over(w)
    if hot:
        rows = _from_before(rows, keys, F.col("_o"))
        before = F.coalesce(before, F.when(F.row_number().over(w) == 1, F.col("_carry")))
    starts = before.isNull() | (F.col("_o") - before > ordinal_units(df, time, gap))
    opened = rows.withColumn("_opens", F.when(starts, F.col(f"`{time}`"))).select(*keys, "_slice", "_o", time, "_opens")
    mine = F.last("_opens", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if hot:
        opened = _from_before(opened, keys, F.col("_opens"))
        mine = F.coalesce(mine, F.col("_carry"))
    named = opened.withColumn("session_start", mine)
    return named.groupBy(*keys, "session_start").agg(F.max(time).alias("session_end"), F.count(F.lit(1)).alias("n_rows"))


def rolling_sum(df: DataFrame, on: str | Sequence[str], day: Column, value: Column, days: int, name: str = "rolling") -> DataFrame:
    """(keys, day, total, ``name``): each day's sum and that of the ``days`` days ending with it.

    Only days with rows appear.  Sums are taken map-side first; a key's frame
    reads one row a day.  Rows without a day are left out.
    """
    keys = _keys(on)
    daily = df.select(*keys, day.cast("date").alias("day"), value.alias("_v")).where(F.col("day").isNotNull()).groupBy(*keys, "day").agg(F.sum("_v").alias("total"))
    w = Window.partitionBy(*keys).orderBy(F.unix_date("day")).rangeBetween(-(days - 1), 0)
    return daily.withColumn(name, F.sum("total").over(w))
