"""Sinks: gold writer, keyed upsert, SCD-2 history, bronze append, JDBC."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakepipe.clock import SYSTEM_CLOCK, Clock
from lakepipe.operators.dedup import dedup_latest
from lakepipe.operators.merge import scd2_df, upsert_df
from lakepipe.operators.quality import not_null_condition
from lakepipe.operators.time_slices import join_on_keys
from lakepipe.sinks.tables import BUCKET_COL, BucketedTable, VersionedTable, open_table
from lakepipe.sources.bronze import read_bronze  # noqa: F401

INGEST_DATE_COL = "ingest_date"
# Rows of one partition value that one writer task takes; a larger value is
# dealt over several.
HOT_PARTITION_ROWS = 5_000_000
# Buckets of a history table that ``write_gold`` creates.
MERGE_BUCKETS = 256


@dataclass
class WriteReport:
    """What a sink did; ``metrics`` come from Observations on the write job."""

    target: str
    action: str  # created | merged | overwritten | appended | skipped-empty
    metrics: dict = field(default_factory=dict)


def _is_empty(df: DataFrame) -> bool:
    return len(df.head(1)) == 0


def write_gold(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_cols: Sequence[str] | None = None,
    primary_key: str | Sequence[str] | None = None,
    dynamic_partitions: bool = False,
    clock: Clock = SYSTEM_CLOCK,
    snapshots: bool = False,
    keep_versions: int = 3,
    hot_partition_rows: int = HOT_PARTITION_ROWS,
    buckets: int = MERGE_BUCKETS,
) -> WriteReport:
    """Write a gold table.

    * empty result -> nothing is written (the previous table stays);
    * ``overwrite`` (default) replaces the whole table, even when
      partitioned; ``dynamic_partitions=True`` replaces only the partitions
      present in ``df``;
    * ``append`` adds the rows;
    * ``merge`` keeps SCD-2 history keyed on ``primary_key``, in ``buckets``
      hash buckets of the key, so a load rewrites the buckets it touches and
      not the history.  A table that exists as snapshots, or one with
      ``partition_cols``, stays a table of snapshots.

    An in-place overwrite removes the old files before the job writes the
    new ones, so readers see an empty or partial table while it runs.  With
    ``snapshots=True`` an overwrite is committed as a new snapshot instead
    (``VersionedTable``: readers keep the previous one until ``_SUCCESS``;
    the newest ``keep_versions`` are kept); the report's ``path`` metric
    names it, e.g. for ``Layer.publish``.  ``keep_versions`` also bounds
    the snapshots of ``merge`` (SCD-2 history) tables.

    The result is persisted for the emptiness check so the plan runs once."""
    if mode.lower() == "merge":
        if not primary_key:
            raise ValueError("primary_key is required for mode='merge'")
        table = open_table(spark, path)
        if isinstance(table, VersionedTable) and (partition_cols or table.exists()):
            # Each load commits the whole history as a new snapshot: keep a few.
            table = VersionedTable(spark, path, partition_cols, keep=keep_versions)
        elif isinstance(table, VersionedTable):
            table = BucketedTable(spark, path, [primary_key] if isinstance(primary_key, str) else list(primary_key), buckets)
        return scd2_apply(spark, df, table, primary_key, clock)
    if snapshots and (mode != "overwrite" or dynamic_partitions):
        raise ValueError("snapshots apply to full overwrites only")
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if partition_cols:
            # One small job over the cached result: emptiness and the size
            # of the largest partition value.
            sizes = df.groupBy(*partition_cols).agg(F.count(F.lit(1)).alias("_n"))
            st = sizes.agg(F.sum("_n").alias("rows"), F.max("_n").alias("largest")).first()
            if not st["rows"]:
                return WriteReport(path, "skipped-empty")
        elif _is_empty(df):
            return WriteReport(path, "skipped-empty")
        obs = Observation()
        out = df.observe(obs, F.count(F.lit(1)).alias("rows"))
        if partition_cols:
            # Rows of one partition value go to one writer task for each
            # ``hot_partition_rows`` of them: one file a directory, or for a
            # large value (a day with a third of the data) as many as its
            # count gives, and values written in parallel.
            cols = [F.col(c) for c in partition_cols]
            if st["largest"] <= hot_partition_rows:
                out = out.repartition(*cols)
            else:
                large = sizes.where(F.col("_n") > hot_partition_rows).withColumn("_n", F.ceil(F.col("_n") / hot_partition_rows))
                salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.coalesce(F.col("_n"), F.lit(1)))
                # A stated number of partitions: AQE would merge many small
                # values into one serial writer.
                tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-st["rows"] // hot_partition_rows))
                salted = join_on_keys(out, large, partition_cols).withColumn("_writer", salt.cast("int"))
                out = salted.repartition(tasks, *cols, "_writer").select(*df.columns)
        if snapshots:
            table = VersionedTable(spark, path, partition_cols, keep=keep_versions)
            v = table.commit(out)
            return WriteReport(path, "overwritten", {**obs.get, "version": v, "path": table.path(v)})
        w = out.write.mode(mode)
        if partition_cols:
            w = w.partitionBy(*partition_cols)
        if dynamic_partitions:
            w = w.option("partitionOverwriteMode", "dynamic")
        w.parquet(path)
        return WriteReport(path, "overwritten" if mode == "overwrite" else mode + "ed", obs.get)
    finally:
        df.unpersist()


def upsert(
    spark: SparkSession,
    batch: DataFrame,
    table: VersionedTable | BucketedTable,
    pk: str | Sequence[str],
    updated_col: str,
    guard_stale: bool = False,
    dedup: bool = True,
) -> WriteReport:
    """Micro-batch upsert: drop NULL keys, keep the latest row per key, then
    insert new keys and replace matched ones (create on first write)."""
    keys = [pk] if isinstance(pk, str) else list(pk)
    batch = batch.filter(not_null_condition(keys))
    if dedup:
        batch = dedup_latest(batch, keys, updated_col)
    # Cached before the emptiness probe: the probe's shuffle output and
    # cached blocks are reused by the writes, so the micro-batch source is
    # read once.  A batch without a single keyed row writes nothing.
    batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if _is_empty(batch):
            return WriteReport(table.root, "skipped-empty")
        if isinstance(table, VersionedTable):
            if not table.exists():
                table.commit(batch)
                return WriteReport(table.root, "created")
            table.commit(upsert_df(table.read(), batch, keys, updated_col, guard_stale))
            return WriteReport(table.root, "merged")
        if not table.exists():
            table.create(batch)
            return WriteReport(table.root, "created")
        table.check_columns(batch)
        b = table.with_bucket(batch)
        touched, n_touched = table.touched(b)
        old = table.read(with_bucket=True).filter(F.col(BUCKET_COL).isin(touched))
        table.replace_buckets(upsert_df(old, b, keys, updated_col, guard_stale))
        return WriteReport(table.root, "merged", {"buckets_rewritten": n_touched})
    finally:
        batch.unpersist()


def scd2_apply(
    spark: SparkSession,
    updates: DataFrame,
    table: VersionedTable | BucketedTable,
    pk: str | Sequence[str],
    clock: Clock = SYSTEM_CLOCK,
    compare_cols: Sequence[str] | None = None,
    expire_missing: bool = False,
) -> WriteReport:
    """Expire + insert in ONE commit of the combined history.

    On a ``BucketedTable`` (keyed on ``pk``) only the buckets holding
    updated keys are rewritten -- all of them when ``expire_missing``."""
    if not pk:
        raise ValueError("primary_key is required for SCD-2")
    # The updates feed the emptiness probe, a uniqueness check, the key
    # flags and the insert: computed once, reused (recomputed from lineage
    # if an executor is lost).
    updates = updates.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if _is_empty(updates):
            return WriteReport(table.root, "skipped-empty")
        if isinstance(table, VersionedTable):
            target = table.read() if table.exists() else None
            table.commit(scd2_df(target, updates, pk, clock, compare_cols, expire_missing))
            return WriteReport(table.root, "created" if target is None else "merged")
        if not table.exists():
            table.create(scd2_df(None, updates, pk, clock))
            return WriteReport(table.root, "created")
        table.check_columns(updates)
        b = table.with_bucket(updates)
        history = table.read(with_bucket=True)
        n_touched = "all"
        if not expire_missing:
            touched, n_touched = table.touched(b)
            history = history.filter(F.col(BUCKET_COL).isin(touched))
        table.replace_buckets(scd2_df(history, b, pk, clock, compare_cols, expire_missing))
        return WriteReport(table.root, "merged",
                           {"buckets_rewritten": n_touched})
    finally:
        updates.unpersist()


def append_bronze(
    df: DataFrame,
    path: str,
    run_date: str,
    updated_col: str | None = None,
) -> WriteReport:
    """Append raw rows under ``ingest_date=<run_date>`` partitions.

    New source columns are simply written; readers merge schemas
    (``mergeSchema``).  Row count and ``max(updated_col)`` are observed on
    the write job itself, so the source is scanned exactly once."""
    obs = Observation()
    aggs = [F.count(F.lit(1)).alias("rows")]
    if updated_col:
        aggs.append(F.max(updated_col).alias("max_updated"))
    (
        df.withColumn(INGEST_DATE_COL, F.lit(run_date).cast("date"))
        .observe(obs, *aggs)
        .write.mode("append")
        .partitionBy(INGEST_DATE_COL)
        .parquet(path)
    )
    m = obs.get
    return WriteReport(path, "appended" if m.get("rows") else "skipped-empty", m)
