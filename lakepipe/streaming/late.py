"""Late rows aside, the others to an accepted table.

A stateful operator drops rows behind its watermark without a word.  Here the
watermark is kept with the stream instead: rows behind it go to a side table,
all others to the accepted table.  A query over the accepted table with the
same delay never has a watermark ahead of the one a row was accepted under, so
it drops none: every input row ends in exactly one of the two.
"""

from __future__ import annotations

import json

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakepipe.sources.bronze import _read_text, _write_text
from lakepipe.sources.layout import hadoop_fs


def split_late(
    stream: DataFrame, spark: SparkSession, time_col: str, delay_seconds: float, accepted: str, late: str, checkpoint: str, available_now: bool = True
) -> StreamingQuery:
    """Start the query that writes each micro-batch to ``accepted/batch=<n>`` and ``late/batch=<n>``.

    The watermark of a batch is the greatest event time of earlier batches
    less the delay; a row behind it, or without a time, is late.  It is stored
    with each batch, and a batch folder that is complete is not written again,
    so a batch that is replayed after a failure comes out the same.
    """
    state = f"{checkpoint.rstrip('/')}-watermarks"

    def write(df: DataFrame, path: str) -> None:
        fs, done = hadoop_fs(spark, f"{path}/_SUCCESS")
        if not fs.exists(done):
            df.write.mode("overwrite").parquet(path)

    def handle(batch: DataFrame, n: int) -> None:
        seen = json.loads(_read_text(spark, f"{state}/{n - 1}.json") or "null") if n else None
        batch = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            micros = F.unix_micros(F.col(time_col).cast("timestamp"))
            newest = batch.agg(F.max(micros)).first()[0]
            on_time = micros >= (seen - round(delay_seconds * 1e6)) if seen is not None else micros.isNotNull()
            write(batch.where(on_time), f"{accepted}/batch={n}")
            write(batch.where(~F.coalesce(on_time, F.lit(False))), f"{late}/batch={n}")
        finally:
            batch.unpersist()
        known = [t for t in (seen, newest) if t is not None]
        _write_text(spark, f"{state}/{n}.json", json.dumps(max(known) if known else None))

    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
