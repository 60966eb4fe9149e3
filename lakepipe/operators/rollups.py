"""Totals over several groupings at once, and mergeable sketches.

Rows are reduced to the finest grouping first (map-side), so the copies that a
cube or a list of grouping sets makes are copies of group rows, not of the
input, and the grand total is a sum of group rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def totals(df: DataFrame, by: Mapping[str, Column], sums: Mapping[str, Column], sets: Sequence[Sequence[str]] | str = "cube") -> DataFrame:
    """One row for each group of each grouping: the ``by`` columns (NULL where summed over), ``grouping_id``, the sums.

    ``sets`` is ``"cube"``, ``"rollup"`` or a list of groupings.  ``sums``
    must add up (counts as sums of 1).  A NULL among the values of a ``by``
    column is a group of its own; ``grouping_id`` tells it from a total: it has
    a bit for each ``by`` column, the last one lowest, set where summed over.
    """
    finest = df.groupBy(*[c.alias(n) for n, c in by.items()]).agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    if sets == "cube":
        grouped = finest.cube(*by)
    elif sets == "rollup":
        grouped = finest.rollup(*by)
    else:
        grouped = finest.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in by])
    return grouped.agg(F.grouping_id().cast("long").alias("grouping_id"), *[F.sum(n).alias(n) for n in sums])


def pivoted(df: DataFrame, by: Sequence[str], column: str, values: Sequence, total: Column, name: str = "") -> DataFrame:
    """One row a group, one column for each of the stated ``values`` of ``column`` (named after it) with the sum of ``total``.

    The values are given, so no extra job looks for them and the columns are
    the same on every run; rows of other values count in no column.
    """
    reduced = df.groupBy(*by, column).agg(F.sum(total).alias("_t"))
    return reduced.groupBy(*by).pivot(column, list(values)).agg(F.sum("_t").alias(name) if name else F.sum("_t"))


def sketch_groups(df: DataFrame, by: Sequence[str | Column], distinct: Column, amount: Column, hll_bits: int = 14, kll_k: int = 400) -> DataFrame:
    """One row a group: ``n`` rows, an HLL sketch of ``distinct``, a KLL sketch of ``amount`` (doubles), both as columns to store.

    The relative standard error of a distinct count is about 0.83 / 2^(bits /
    2); the rank error of a quantile is about 2.3 / k^0.9.  NULLs are left out
    of the sketches.
    """
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.hll_sketch_agg(distinct, hll_bits).alias("distinct_sketch"),
        F.kll_sketch_agg_double(amount.cast("double"), kll_k).alias("amount_sketch"),
    )


def merge_sketches(stored: DataFrame, by: Sequence[str | Column], kll_k: int = 400) -> DataFrame:
    """Coarser groups from stored sketches alone: the rows behind them are not read again."""
    return stored.groupBy(*by).agg(
        F.sum("n").alias("n"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        F.kll_merge_agg_double("amount_sketch", kll_k).alias("amount_sketch"),
    )


def sketch_estimates(stored: DataFrame, by: Sequence[str], shares: Mapping[str, float]) -> DataFrame:
    """(``by``, n, distinct, one column a share): what the sketches say."""
    quantiles = [F.kll_sketch_get_quantile_double("amount_sketch", F.lit(share)).alias(name) for name, share in shares.items()]
    return stored.select(*by, "n", F.hll_sketch_estimate("distinct_sketch").alias("distinct"), *quantiles)
