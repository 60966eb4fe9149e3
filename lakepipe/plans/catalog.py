"""Query catalogue: every registered query as (Spark builder, DuckDB oracle).

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole driver tables (or over data Spark derived from them).  The oracle, when
present, is DuckDB SQL over the same base tables; views are inlined as CTEs.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakepipe.clock import Clock

AS_OF = "2001-10-01 00:00:00"
CLOCK = Clock(AS_OF)
SNAPSHOT_SQL = "date '2001-10-01' as snapshot_date, timestamp '2001-10-01 00:00:00' as snapshot_ts"


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    covers: str = ""


REGISTRY: dict[str, Query] = {}


def register(name: str, oracle: str | None, covers: str = ""):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, oracle, covers)
        return fn

    return deco


def sround(expr: str, digits: int) -> str:
    """DuckDB form of Spark's HALF_UP ``round(double)`` (rounds the shortest
    decimal text, not the binary value)."""
    return f"cast(round(cast(cast({expr} as varchar) as decimal(38,15)), {digits}) as double)"


def initcap_sql(expr: str) -> str:
    """DuckDB form of Spark's ``initcap`` (space-separated words)."""
    return (
        f"array_to_string(list_transform(string_split(lower({expr}), ' '), "
        f"lambda w: upper(w[1:1]) || w[2:]), ' ')"
    )


def _load_all() -> None:
    # Importing the query modules fills REGISTRY.
    from lakepipe.plans import queries_gold  # noqa: F401
    from lakepipe.plans import queries_ops  # noqa: F401
    from lakepipe.plans import queries_silver  # noqa: F401
    from lakepipe.plans import queries_functions  # noqa: F401
    from lakepipe.plans import queries_time  # noqa: F401
    from lakepipe.plans import queries_totals  # noqa: F401
    from lakepipe.plans import queries_stream  # noqa: F401
    from lakepipe.plans import queries_seed  # noqa: F401


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: q.build for k, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: q.oracle for k, q in REGISTRY.items() if q.oracle is not None}
