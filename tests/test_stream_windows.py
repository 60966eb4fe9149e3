"""Late rows, windows, keyed state, stream joins and rescued data across several runs."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.sources import bronze
from lakepipe.sources.bronze import by_write_job, tracked_schema
from lakepipe.sources.rescue import read_rescued, run_rescuing_stream
from lakepipe.streaming.late import split_late
from lakepipe.streaming.windows import event_windows, join_within, latest_rows, run_to_table

SCHEMA = "id long, k long, at timestamp"


def at(hour):
    return None if hour is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=hour)


def drop(spark, root, rows):
    spark.createDataFrame([(i, k, at(h)) for i, k, h in rows], SCHEMA).write.mode("append").parquet(f"{root}/in")


def split(spark, root, hours=10):
    stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
    split_late(stream, spark, "at", hours * 3600, f"{root}/accepted", f"{root}/late", f"{root}/split").awaitTermination()


def ids(spark, path):
    return sorted(r.id for r in spark.read.schema(SCHEMA).parquet(f"{path}/batch=*").collect())


def test_every_row_is_accepted_or_late(spark, tmp_root):
    drop(spark, tmp_root, [(1, 1, 50), (2, 1, 0), (3, 1, None)])
    split(spark, tmp_root)
    drop(spark, tmp_root, [(4, 1, 39), (5, 1, 40), (6, 1, 20), (7, 2, 90)])
    split(spark, tmp_root)
    drop(spark, tmp_root, [(8, 1, 79), (9, 1, 80)])
    split(spark, tmp_root)
    # In the first run nothing is known yet; then rows behind 50 - 10 and 90 - 10 are late.
    assert ids(spark, f"{tmp_root}/accepted") == [1, 2, 5, 7, 9]
    assert ids(spark, f"{tmp_root}/late") == [3, 4, 6, 8]


def test_windows_lose_no_accepted_row(spark, tmp_root):
    for rows in ([(1, 1, 0), (2, 1, 5), (3, 2, 30)], [(4, 1, 21), (5, 1, 1), (6, 2, 60)], [(7, 2, 200)]):
        drop(spark, tmp_root, rows)
        split(spark, tmp_root)
        accepted = spark.readStream.schema(SCHEMA).parquet(f"{tmp_root}/accepted/batch=*")
        windows = event_windows(accepted, "at", "10 hours", [F.count(F.lit(1)).alias("n")], ["k"], length="12 hours")
        run_to_table(windows, f"{tmp_root}/w", f"{tmp_root}/wc").awaitTermination()
    got = sorted((r.k, r.window_start, r.n) for r in spark.read.parquet(f"{tmp_root}/w").collect())
    assert got == [(1, at(0), 2), (1, at(12), 1), (2, at(24), 1), (2, at(60), 1)]
    assert ids(spark, f"{tmp_root}/late") == [5]


def test_window_shapes_are_checked(spark, tmp_root):
    stream = spark.readStream.schema(SCHEMA).parquet("/root/testdata/sf0.001/events.parquet")
    with pytest.raises(ValueError, match="length"):
        event_windows(stream, "at", "1 day", [F.count(F.lit(1))])


def test_keyed_state_marks_stale_rows_and_forgets(spark, tmp_root):
    seen, held = [], []
    for n, rows in enumerate(([(1, 1, 50), (2, 1, 48), (3, 2, 40)], [(4, 1, 49), (5, 1, 50), (6, 2, 41)], [(7, 3, 300)], [(8, 1, 301), (9, 3, 299), (10, 3, 300)])):
        drop(spark, tmp_root, rows)
        split(spark, tmp_root, 10)
        accepted = spark.readStream.schema(SCHEMA).parquet(f"{tmp_root}/accepted/batch=*")

        def keep(batch, _):
            seen.extend((n, r.id, r.fresh) for r in batch.collect())

        q = latest_rows(accepted, "k", "at", "10 hours").writeStream.foreachBatch(keep).outputMode("update")
        q = q.option("checkpointLocation", f"{tmp_root}/state").trigger(availableNow=True).start()
        q.awaitTermination()
        held.append([p.stateOperators[0].numRowsTotal for p in q.recentProgress if p.stateOperators][-1])
    assert sorted(seen) == [(0, 1, True), (0, 2, False), (0, 3, True), (1, 4, False), (1, 5, True), (1, 6, True), (2, 7, True), (3, 8, True), (3, 9, False), (3, 10, True)]
    # Keys 1 and 2 are forgotten once the watermark has passed 290 hours; a key's time and its timer are a few rows.
    assert held[2] < held[1] and held[0] == held[1]


def test_stream_join_keeps_unmatched_rows(spark, tmp_root):
    def side(name, rows, schema):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp_root}/{name}")
        return spark.readStream.schema(schema).parquet(f"{tmp_root}/{name}")

    def run():
        left = side("l", lefts, "l long, k long, lt timestamp")
        right = side("r", rights, "r long, k long, rt timestamp")
        joined = join_within(left, right, ["k"], "lt", "rt", dt.timedelta(hours=3), "1 hour")
        run_to_table(joined, f"{tmp_root}/out", f"{tmp_root}/c").awaitTermination()

    lefts, rights = [(1, 1, at(10)), (2, 1, at(20)), (3, None, at(10)), (4, 2, at(10)), (9, 1, None)], [(1, 1, at(13)), (2, 1, at(14)), (3, 2, at(9))]
    run()
    lefts, rights = [(5, 1, at(100))], [(4, 1, at(23)), (5, 1, at(100))]
    run()
    got = sorted(((r.l, r.r) for r in spark.read.parquet(f"{tmp_root}/out").collect()), key=str)
    assert got == sorted([(1, 1), (2, 4), (3, None), (4, None), (5, 5)], key=str)


def test_stream_join_state_is_on_disk_and_bins_lose_no_pair(spark, tmp_root):
    """State goes to RocksDB, not to the heap; pairs up to ``within`` apart meet once on either side of a bin's edge."""
    for key in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.join.stateFormatVersion"):
        spark.conf.unset(key)
    lefts, rights = [(h, h % 2, at(h)) for h in range(0, 40)], [(h, h % 2, at(h)) for h in range(0, 40)]
    for name, rows, schema in (("l", lefts, "l long, k long, lt timestamp"), ("r", rights, "r long, k long, rt timestamp")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_root}/{name}")
    left = spark.readStream.schema("l long, k long, lt timestamp").parquet(f"{tmp_root}/l")
    right = spark.readStream.schema("r long, k long, rt timestamp").parquet(f"{tmp_root}/r")
    joined = join_within(left, right, ["k"], "lt", "rt", dt.timedelta(hours=3), "1 hour")
    run_to_table(joined, f"{tmp_root}/out", f"{tmp_root}/c").awaitTermination()
    got = sorted((r.l, r.r) for r in spark.read.parquet(f"{tmp_root}/out").collect())
    assert got == sorted((x, y) for x, k, _ in lefts for y, j, _ in rights if k == j and 0 <= y - x <= 3)
    kept = {p.suffix for p in pathlib.Path(f"{tmp_root}/c/state").rglob("*") if p.is_file()}
    assert ".delta" not in kept and ".zip" in kept


# ---------------------------------------------------------------- rescue


def test_rescued_rows_of_every_kind(spark, tmp_root):
    frames = [
        spark.createDataFrame([(1, 1.5, "a")], "id long, v double, s string"),
        spark.createDataFrame([(2, "2.5", 7), (3, "x", None)], "id int, v string, s long"),
        spark.createDataFrame([(4, [1, 2], "d", "more")], "id long, v array<int>, s string, extra string"),
        spark.createDataFrame([("5x", "e")], "id string, s string"),
    ]
    for f in frames:
        f.coalesce(1).write.mode("append").parquet(f"{tmp_root}/in")
    schema = T.StructType.fromDDL("id bigint, v double, s string")
    got = []
    run_rescuing_stream(spark, f"{tmp_root}/in", schema, f"{tmp_root}/c", lambda d, n: got.extend(map(tuple, d.collect()))).awaitTermination()
    assert sorted(got, key=str) == sorted(
        [(1, 1.5, "a", None), (2, 2.5, "7", None), (3, None, None, '{"v":"x"}'), (4, None, "d", '{"v":[1,2],"extra":"more"}'), (None, None, "e", '{"id":"5x"}')], key=str
    )
    assert read_rescued(spark, [], schema).columns == ["id", "v", "s", "_rescued_data"]


def test_schema_tracking_reads_new_footers_only(spark, tmp_root, monkeypatch):
    opened = []
    real = bronze.file_schema
    monkeypatch.setattr(bronze, "file_schema", lambda s, f: opened.append(f) or real(s, f))
    path, where = f"{tmp_root}/in", f"{tmp_root}/schema"
    spark.range(100).repartition(5).write.parquet(path)
    assert tracked_schema(spark, path, where, True).fieldNames() == ["id"] and not opened
    import os
    import time

    old = time.time() - 3600
    for f in os.listdir(path):
        os.utime(f"{path}/{f}", (old, old))
    bronze._write_text(spark, f"{where}/{bronze.SEEN_FILE}", str(int((old + 1) * 1000)))
    assert tracked_schema(spark, path, where, True).fieldNames() == ["id"] and not opened
    spark.range(100).withColumn("x", F.lit(1)).repartition(7).write.mode("append").parquet(path)
    assert tracked_schema(spark, path, where, True).fieldNames() == ["id", "x"]
    assert len(opened) == 1  # seven files of one job
    assert len(by_write_job([f for f, _ in bronze.list_parquet(spark, path)])) == 2
