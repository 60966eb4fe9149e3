"""Incremental ingestion into bronze with per-table high-water marks.

For each table: look up its watermark, read everything (first run, forced
full load, backfill) or only rows with ``updated > watermark``, append them
to bronze under today's ``ingest_date`` partition, and advance the watermark
to the largest ``updated`` value just written.  Count and max are observed on
the write itself, so the source is scanned once per run.

A *source* is a ``(TableSpec, after) -> DataFrame`` callable returning the
whole source table: a JDBC reader in production (``jdbc_source``), parquet
tables in tests.  ``after`` is the lower bound the incremental predicate
will use (None for a full load); a source may plan its read with it (the
JDBC source takes its range bounds over the new rows only).  The predicate
itself is a DataFrame filter, pushed into the JDBC query or the parquet scan
by Catalyst.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.clock import SYSTEM_CLOCK, Clock
from lakepipe.operators.merge import upsert_df
from lakepipe.sinks.tables import VersionedTable
from lakepipe.sinks.writers import append_bronze
from lakepipe.sources.jdbc import JdbcOptions, partitioning_for, quote_ident, read_jdbc_full, sql_literal
from lakepipe.sources.layout import LakeLayout


@dataclass(frozen=True)
class TableSpec:
    name: str
    updated_column: str | None = "updatedAt"
    full_load: bool = False
    schedule: str = "daily"


# The 15 source tables, their change column and cadence.
TABLE_SPECS = {
    s.name: s
    for s in [
        TableSpec("User", schedule="hourly"),
        TableSpec("UserInfo", schedule="hourly"),
        TableSpec("Booking", schedule="hourly"),
        TableSpec("Payment", schedule="hourly"),
        TableSpec("UserMembership", schedule="hourly"),
        TableSpec("Session", schedule="hourly"),
        TableSpec("TrainerSession", schedule="hourly"),
        TableSpec("SessionFeedback", schedule="hourly"),
        TableSpec("FitnessCenter", schedule="daily"),
        TableSpec("Staff", schedule="daily"),
        TableSpec("Address", schedule="daily"),
        TableSpec("WorkOutDetails", schedule="daily"),
        TableSpec("MembershipPlan", schedule="daily"),
        TableSpec("FitnessCenterSubscription", schedule="weekly"),
        TableSpec("FitnessCenterMembershipPlan", schedule="weekly"),
    ]
}


def select_tables(specs: Iterable[TableSpec], schedule: str | None = None) -> list[TableSpec]:
    return [s for s in specs if schedule is None or s.schedule == schedule]


Source = Callable[[TableSpec, object], DataFrame]


DEFAULT_JDBC_PARTITIONS = 16


def jdbc_source(
    spark: SparkSession,
    opts: JdbcOptions,
    partition_columns: dict[str, str] | None = None,
    num_partitions: int = DEFAULT_JDBC_PARTITIONS,
) -> Source:
    """Whole source tables over JDBC, each read in ``num_partitions`` ranges
    of a column (bounds from one min/max query), so executors fetch in
    parallel instead of one connection reading the table.  The column is the
    one ``partition_columns`` names for a table, else its change column; a
    table with neither is one read.  Rows with a NULL there come with the
    first range."""

    def src(spec: TableSpec, after=None) -> DataFrame:
        part = None
        column = (partition_columns or {}).get(spec.name, spec.updated_column)
        if column and num_partitions > 1:
            where = None
            if after is not None and spec.updated_column:
                where = f"{quote_ident(spec.updated_column)} > {sql_literal(after)}"
            part = partitioning_for(spark, opts, spec.name, column, num_partitions, where)
        return read_jdbc_full(spark, opts, spec.name, part)

    return src


WATERMARK_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("last_ingested_at", T.TimestampType(), True),
        T.StructField("updated_at", T.TimestampType(), True),
    ]
)


class WatermarkStore:
    """One row per table: ``table_name, last_ingested_at, updated_at``.

    Only a missing store means "no watermark"; any other failure raises, so
    an unreadable store never turns into an accidental full reload."""

    def __init__(self, spark: SparkSession, path: str, clock: Clock = SYSTEM_CLOCK, keep: int = 20):
        # Every set() commits a small snapshot; the newest ``keep`` are kept.
        self.spark, self.table, self.clock = spark, VersionedTable(spark, path, keep=keep), clock

    def frame(self) -> DataFrame:
        if not self.table.exists():
            return self.spark.createDataFrame([], WATERMARK_SCHEMA)
        return self.table.read()

    def get(self, table_name: str):
        if not self.table.exists():
            return None
        row = self.table.read().filter(F.col("table_name") == table_name).select("last_ingested_at").first()
        return None if row is None else row[0]

    def set(self, table_name: str, value) -> None:
        new = self.spark.createDataFrame(
            [(table_name, value)], "table_name string, last_ingested_at timestamp"
        ).withColumn("updated_at", self.clock.ts())
        current = self.frame()
        self.table.commit(upsert_df(current, new, "table_name").coalesce(1))


def plan_load(spec: TableSpec, watermark, force_full: bool = False) -> str:
    """``full`` on first run, for forced/flagged full loads or tables without
    a change column; else ``incremental``."""
    if force_full or spec.full_load or spec.updated_column is None or watermark is None:
        return "full"
    return "incremental"


@dataclass
class IngestResult:
    table: str
    mode: str
    rows: int
    watermark: object = None
    metrics: dict = field(default_factory=dict)


class IngestErrors(RuntimeError):
    """Some tables could not be ingested; the others were, watermarks included."""

    def __init__(self, failed: dict[str, Exception], results: list[IngestResult]):
        super().__init__("; ".join(f"{name}: {e}" for name, e in failed.items()))
        self.failed, self.results = failed, results


def ingest_table(
    spark: SparkSession,
    spec: TableSpec,
    source: Source,
    layout: LakeLayout,
    store: WatermarkStore,
    run_date: str,
    force_full: bool = False,
    since=None,
    until=None,
    overlap_seconds: int = 0,
    update_watermark: bool = True,
) -> IngestResult:
    """Ingest one table.  ``overlap_seconds > 0`` re-reads rows updated up
    to that long before the watermark, catching rows committed late with an
    older timestamp; the copies are absorbed by silver's keyed upsert."""
    wm = store.get(spec.name)
    mode = plan_load(spec, wm, force_full)
    after = None
    if mode == "incremental":
        after = wm - dt.timedelta(seconds=overlap_seconds) if overlap_seconds else wm
    df = source(spec, after)
    upd = F.col(spec.updated_column) if spec.updated_column else None
    if mode == "incremental":
        df = df.filter(upd > F.lit(after))
    if upd is not None and since is not None:
        df = df.filter(upd >= F.lit(since).cast("timestamp"))
    if upd is not None and until is not None:
        df = df.filter(upd < F.lit(until).cast("timestamp"))
    report = append_bronze(df, layout.bronze(spec.name), run_date, spec.updated_column)
    rows = int(report.metrics.get("rows", 0) or 0)
    new_wm = report.metrics.get("max_updated")
    if update_watermark and new_wm is not None and (wm is None or new_wm > wm):
        store.set(spec.name, new_wm)
    return IngestResult(spec.name, mode, rows, new_wm if new_wm is not None else wm, report.metrics)


def ingest_all(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    source: Source,
    layout: LakeLayout,
    store: WatermarkStore,
    run_date: str,
    schedule: str | None = None,
    force_full: bool = False,
    parallelism: int = 1,
    since=None,
    until=None,
    overlap_seconds: int = 0,
    scheduler_pool: str | None = None,
) -> list[IngestResult]:
    """Ingest the chosen tables.  ``parallelism > 1`` submits the per-table
    jobs from a thread pool so small tables overlap on the cluster (with the
    FAIR scheduler and ``scheduler_pool`` they share it fairly).

    Each table's watermark is stored as soon as that table is written (one
    store commit at a time).  A failing table does not stop the others:
    ``IngestErrors``, raised at the end, names the failed ones and carries
    the results of the rest."""
    chosen = select_tables(specs, schedule)
    store_lock = Lock()

    def one(spec):
        if scheduler_pool:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", scheduler_pool)
        res = ingest_table(spark, spec, source, layout, store, run_date, force_full, since, until,
                           overlap_seconds, update_watermark=False)
        if res.watermark is not None and res.rows:
            with store_lock:
                old = store.get(spec.name)
                if old is None or res.watermark > old:
                    store.set(spec.name, res.watermark)
        return res

    results, failed = [], {}
    with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
        for spec, job in [(spec, pool.submit(one, spec)) for spec in chosen]:
            try:
                results.append(job.result())
            except Exception as e:  # reported below, for all failed tables together
                failed[spec.name] = e
    if failed:
        raise IngestErrors(failed, results)
    return results


def backfill(
    spark: SparkSession,
    specs: Iterable[TableSpec],
    source: Source,
    layout: LakeLayout,
    store: WatermarkStore,
    run_date: str,
    since=None,
    until=None,
    parallelism: int = 1,
) -> list[IngestResult]:
    """Full reload of the chosen tables (optionally only ``since <= updated
    < until``).  Rows already in bronze are appended again; silver's keyed
    upsert absorbs the copies.  Watermarks only ever move forward."""
    return ingest_all(spark, specs, source, layout, store, run_date, None, True, parallelism, since, until)
