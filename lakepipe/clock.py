"""Injectable clock plus the snapshot / audit columns stamped on output tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Clock:
    """``as_of`` pins "now" (``'YYYY-MM-DD[ HH:MM:SS]'`` in the session time
    zone); ``None`` uses the query's own ``current_timestamp()``, which Spark
    folds to one constant per query."""

    as_of: str | None = None

    def ts(self) -> Column:
        if self.as_of is None:
            return F.current_timestamp()
        return F.lit(self.as_of).cast("timestamp")

    def date(self) -> Column:
        if self.as_of is None:
            return F.current_date()
        return F.to_date(F.lit(self.as_of).cast("timestamp"))


SYSTEM_CLOCK = Clock()


def add_snapshot_columns(df: DataFrame, clock: Clock = SYSTEM_CLOCK) -> DataFrame:
    """Gold tables carry the day and instant of the snapshot."""
    return df.withColumns({"snapshot_date": clock.date(), "snapshot_ts": clock.ts()})


def add_audit_columns(
    df: DataFrame, source: str = "postgres_bronze", clock: Clock = SYSTEM_CLOCK
) -> DataFrame:
    """Silver lineage columns: where a row came from and when it was loaded."""
    return df.withColumns({"record_source": F.lit(source), "load_timestamp": clock.ts()})
