"""Event-time windows, stream-stream joins and keyed state over Structured Streaming."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
JOIN_STATE_FORMAT = "spark.sql.streaming.join.stateFormatVersion"
# Wider bins keep fewer right rows twice, narrower ones spread a busy key over more tasks.
_BIN_WIDTHS = 4


def keep_state_on_disk(spark: SparkSession) -> None:
    """State in RocksDB (local disk, changes in the checkpoint), so it may be larger than memory.

    A provider that the cluster has set stays.
    """
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider"):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def keep_join_state_on_disk(spark: SparkSession) -> None:
    """State of a stream-stream join in one RocksDB a partition (join state format 3) instead of four stores.

    What the session or the cluster has set stays, and a query that goes on
    from a checkpoint keeps the provider and format it was started with.
    """
    keep_state_on_disk(spark)
    if spark.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB and spark.conf.get(JOIN_STATE_FORMAT, None) is None:
        spark.conf.set(JOIN_STATE_FORMAT, "3")


def _named(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def event_windows(
    stream: DataFrame, time_col: str, delay: str, aggs: Sequence[Column], keys: Sequence[str] = (), length: str | None = None, slide: str | None = None, gap: str | None = None
) -> DataFrame:
    """(window_start, window_end, keys, aggregates) over tumbling (``length``), sliding (with ``slide``) or session (``gap``) windows.

    Rows of a key are reduced map-side before they meet, sessions too.  A
    window comes out once, in append mode, when the watermark (greatest event
    time less ``delay``) has passed its end.
    """
    if (length is None) == (gap is None):
        raise ValueError("either length (and slide) or gap")
    window = F.session_window(time_col, gap) if gap else F.window(time_col, length, slide)
    if gap:
        stream.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    grouped = stream.withWatermark(time_col, delay).groupBy(window.alias("w"), *_named(keys)).agg(*aggs)
    rest = [c for c in grouped.columns if c != "w"]
    return grouped.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *rest)


def join_within(
    left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, within: dt.timedelta, delay: str, how: str = "left_outer"
) -> DataFrame:
    """Stream-stream join: right rows of the key at most ``within`` after the left row (or at the same time).

    Both sides are buffered until the watermark shows that no partner can come.
    With ``left_outer`` a left row without a partner comes out then, with
    NULLs.  A left row with a NULL key or time never has one: those with a NULL
    time are not joined at all.  Other column names must differ.

    Rows meet on the key and a bin of time, ``_BIN_WIDTHS`` times ``within``
    long: a left row lies in one, a right row goes to its own and, when a left
    row ``within`` before it lies in the one before, to that too.  So a busy key
    is spread over its bins, each pair still meets once, and of the right rows
    one in ``_BIN_WIDTHS`` is kept twice.  State goes to disk
    (``keep_join_state_on_disk``).
    """
    if clash := (set(left.columns) & set(right.columns)) - set(on):
        raise ValueError(f"columns on both sides: {sorted(clash)}")
    keep_join_state_on_disk(left.sparkSession)
    width = round(within.total_seconds() * 1_000_000)

    def bin_of(time: str, before: int = 0) -> Column:
        return F.floor((F.unix_micros(F.col(time).cast("timestamp")) - before) / F.lit(max(1, _BIN_WIDTHS * width)))

    one = left.where(F.col(left_time).isNotNull()).withWatermark(left_time, delay).withColumn("_l_bin", bin_of(left_time))
    two = right.where(F.col(right_time).isNotNull()).withWatermark(right_time, delay)
    two = two.select(*[F.col(c).alias(f"_r_{c}") if c in on else F.col(c) for c in two.columns], F.explode(F.array_distinct(F.array(bin_of(right_time, width), bin_of(right_time)))).alias("_r_bin"))
    condition = (F.col("_l_bin") == F.col("_r_bin")) & (F.col(right_time) >= F.col(left_time)) & (F.col(right_time) <= F.col(left_time) + F.expr(f"interval {width} microseconds"))
    for c in on:
        condition = condition & (F.col(c) == F.col(f"_r_{c}"))
    return one.join(two, condition, how).drop("_l_bin", "_r_bin", *[f"_r_{c}" for c in on])


class LatestRow(StatefulProcessor):
    """Per key, the newest row seen; what is older is marked stale.

    State is one time per key.  A timer drops it when the watermark has passed
    that time: every row accepted after that is newer, so nothing is forgotten
    that could still matter and the state is bounded by the keys active within
    the watermark's delay.
    """

    def __init__(self, ties: Sequence[str], columns: Sequence[str]):
        self.ties, self.columns = list(ties), list(columns)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", T.StructType([T.StructField("micros", T.LongType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        known = self.newest.get()[0] if self.newest.exists() else None
        best = None
        for part in rows:
            if best is not None:
                part = pd.concat([best, part], ignore_index=True)
            part = part.sort_values(["micros", *self.ties], ascending=[False] + [True] * len(self.ties), na_position="last", kind="stable")
            best = part.iloc[:1]
            if len(part) > 1:
                yield self._out(part.iloc[1:], False)
        if best is None:
            return
        micros = int(best["micros"].iloc[0])
        fresh = known is None or micros >= known
        if fresh:
            self.newest.update((micros,))
            for timer in self.handle.listTimers():
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(micros // 1000 + 1)
        yield self._out(best, fresh)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.newest.clear()
        return iter(())

    def close(self) -> None:
        pass

    def _out(self, part: pd.DataFrame, fresh: bool) -> pd.DataFrame:
        out = part[self.columns].copy()
        out["fresh"] = fresh
        return out


def latest_rows(stream: DataFrame, key: str, time_col: str, delay: str) -> DataFrame:
    """The rows of ``stream`` with ``fresh``: whether the row is the newest of its key so far, across micro-batches.

    Of rows in one batch the newest counts, ties by the other columns in
    ascending order; one as old as the newest known counts as fresh, as a keyed
    upsert would replace it.  Rows need a key and a time (``split_late`` keeps
    the others aside).  A key's rows of one batch pass through its task in
    pieces, one row is kept.
    """
    columns = stream.columns
    keep_state_on_disk(stream.sparkSession)
    # Plain names on the way: the rows pass as named tuples, which rename some columns.
    plain = {c: f"c{i}" for i, c in enumerate(columns)}
    ties = [plain[c] for c in columns if c not in (key, time_col)]
    fields = [T.StructField(plain[f.name], f.dataType) for f in stream.schema.fields]
    passed = (
        stream.where(F.col(key).isNotNull())
        .withWatermark(time_col, delay)
        .select(*[F.col(f"`{c}`").alias(p) for c, p in plain.items()], F.unix_micros(F.col(time_col).cast("timestamp")).alias("micros"))
        .groupBy(plain[key])
        .transformWithStateInPandas(
            LatestRow(ties, list(plain.values())), outputStructType=T.StructType([*fields, T.StructField("fresh", T.BooleanType())]), outputMode="Update", timeMode="EventTime"
        )
    )
    return passed.select(*[F.col(p).alias(c) for c, p in plain.items()], "fresh")


def run_to_table(df: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Append a stream's final rows to a Parquet table, each exactly once."""
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")).start()
