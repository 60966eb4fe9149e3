"""Data-quality gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def not_null_condition(cols):
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in cols])


def require_not_null(df: DataFrame, *cols: str, observation: Observation | None = None) -> DataFrame:
    """Keep rows whose ``cols`` are all present.

    With an ``Observation`` the kept and rejected counts are collected by the
    job that eventually consumes the frame -- no extra pass over the data."""
    cond = not_null_condition(cols)
    if observation is not None:
        df = df.observe(
            observation,
            F.count(F.lit(1)).alias("rows_in"),
            F.count_if(~cond).alias("rows_rejected"),
        )
    return df.filter(cond)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys that occur more than once (a map-side-combined count per key)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def assert_unique(df: DataFrame, *keys: str) -> None:
    dup = duplicate_keys(df, *keys).limit(1).collect()
    if dup:
        raise ValueError(f"duplicate key(s) {keys} in input, e.g. {dup[0].asDict()}")
