"""Bronze -> silver as a Structured Streaming query.

The cleaning is a stateless projection on the stream; each micro-batch then
goes through ``foreachBatch`` into the keyed upsert (latest row per key,
replace matched keys, insert new ones).  Progress lives in the checkpoint,
so a restart continues with unseen files and a replayed batch is harmless
(the upsert is idempotent)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakepipe.sinks.tables import BucketedTable, VersionedTable
from lakepipe.sinks.writers import upsert


def run_silver_stream(
    df_stream: DataFrame,
    spark: SparkSession,
    checkpoint_path: str,
    table: VersionedTable | BucketedTable,
    primary_key: str,
    updated_col: str,
    guard_stale: bool = False,
    available_now: bool = True,
    query_name: str | None = None,
) -> StreamingQuery:
    if not df_stream.isStreaming:
        raise ValueError("run_silver_stream needs a streaming DataFrame")

    def merge_microbatch(batch_df: DataFrame, batch_id: int) -> None:
        upsert(batch_df.sparkSession, batch_df, table, primary_key, updated_col, guard_stale=guard_stale)

    w = (
        df_stream.writeStream.foreachBatch(merge_microbatch)
        .outputMode("update")
        .option("checkpointLocation", checkpoint_path)
    )
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def run_silver_once(*args, **kwargs) -> StreamingQuery:
    """``run_silver_stream`` with ``availableNow``, waited for; raises the
    stream's error if it failed."""
    q = run_silver_stream(*args, available_now=True, **kwargs)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return q


def run_silver_tables(
    spark: SparkSession,
    layout,
    specs,
    table_for,
    guard_stale: bool = False,
    max_files_per_trigger: int | None = None,
) -> dict[str, object]:
    """Run the bronze -> silver stream of every spec once (availableNow).

    ``specs``: iterable of ``SilverSpec``; ``table_for(spec)`` returns the
    silver table object (``VersionedTable`` for small entities,
    ``BucketedTable`` for large ones).  ``max_files_per_trigger`` splits a
    large backlog into several micro-batches, each committed on its own, so
    a failure repeats one batch rather than the whole backlog.  Columns that
    appeared in bronze since the last run join the stream; a bronze table
    without files yet is skipped.  Returns ``{entity: table}``."""
    from lakepipe.sources.bronze import has_files, read_bronze_stream

    out = {}
    for spec in specs:
        table = out[spec.entity] = table_for(spec)
        if not has_files(spark, layout.bronze(spec.bronze)):
            continue
        src = read_bronze_stream(spark, layout.bronze(spec.bronze), layout.schema_dir(spec.bronze),
                                 max_files_per_trigger=max_files_per_trigger)
        stream = spec.clean(src)
        run_silver_once(stream, spark, layout.checkpoint("silver", spec.entity), table, spec.pk, spec.updated_col,
                        guard_stale=guard_stale)
    return out
