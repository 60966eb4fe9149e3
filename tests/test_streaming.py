"""Bronze file stream -> clean -> foreachBatch upsert, across restarts."""

import datetime as dt

from lakepipe.plans import silver
from lakepipe.sinks.tables import VersionedTable
from lakepipe.sources.bronze import read_bronze_stream, tracked_schema
from lakepipe.sources.layout import LakeLayout
from lakepipe.streaming.silver_stream import run_silver_once

RAW = "id long, userId long, sessionId long, fitnessCenterId long, bookingDate string, status string, " \
      "createdAt string, updatedAt string"


def _drop(spark, rows, path):
    spark.createDataFrame(rows, RAW).write.mode("append").parquet(path)


def _run(spark, lay, table, guard=False):
    stream = silver.clean_booking(read_bronze_stream(spark, lay.bronze("Booking"), lay.schema_dir("Booking")))
    assert stream.isStreaming
    return run_silver_once(stream, spark, lay.checkpoint("silver", "booking"), table, "id", "updatedAt",
                           guard_stale=guard)


def _state(table):
    return sorted((r.id, r.status, r.updatedAt) for r in table.read().collect())


def test_two_drops_restart_and_late_rows(spark, tmp_root):
    lay = LakeLayout(tmp_root)
    table = VersionedTable(spark, lay.silver("booking"))
    b = lay.bronze("Booking")
    _drop(spark, [(1, 10, 5, 1, "2001-01-01", " booked ", "2001-01-01", "2001-01-05 00:00:00"),
                  (1, 10, 5, 1, "2001-01-01", "completed", "2001-01-01", "2001-01-06 00:00:00"),
                  (2, 11, 5, 1, "2001-01-01", "booked", "2001-01-01", "bad"),
                  (3, None, 5, 1, "2001-01-01", "booked", "2001-01-01", "2001-01-01 00:00:00")], b)
    _run(spark, lay, table)
    assert _state(table) == [(1, "COMPLETED", dt.datetime(2001, 1, 6))]
    v = table.current_version()
    _run(spark, lay, table)  # restart with no new files: nothing happens
    assert table.current_version() == v
    # a late, older row for key 1 arrives: default = later batch wins
    _drop(spark, [(1, 10, 5, 1, "2001-01-01", "cancelled", "2001-01-01", "2001-01-02 00:00:00")], b)
    _run(spark, lay, table)
    assert _state(table) == [(1, "CANCELLED", dt.datetime(2001, 1, 2))]


def test_guard_stale_keeps_newer_row(spark, tmp_root):
    lay = LakeLayout(tmp_root)
    table = VersionedTable(spark, lay.silver("booking"))
    b = lay.bronze("Booking")
    _drop(spark, [(1, 10, 5, 1, "2001-01-01", "completed", "2001-01-01", "2001-01-06 00:00:00")], b)
    _run(spark, lay, table, guard=True)
    _drop(spark, [(1, 10, 5, 1, "2001-01-01", "cancelled", "2001-01-01", "2001-01-02 00:00:00")], b)
    _run(spark, lay, table, guard=True)
    assert _state(table) == [(1, "COMPLETED", dt.datetime(2001, 1, 6))]


def test_schema_is_recorded_and_evolves(spark, tmp_root):
    lay = LakeLayout(tmp_root)
    b = lay.bronze("X")
    spark.createDataFrame([(1, "a")], "id long, a string").write.parquet(b + "/ingest_date=2001-01-01")
    s1 = tracked_schema(spark, b, lay.schema_dir("X"))
    spark.createDataFrame([(2, "b", 3)], "id long, a string, extra int").write.parquet(b + "/ingest_date=2001-01-02")
    assert tracked_schema(spark, b, lay.schema_dir("X")).fieldNames() == s1.fieldNames() == ["id", "a", "ingest_date"]
    assert tracked_schema(spark, b, lay.schema_dir("X"), evolve=True).fieldNames() == ["id", "a", "ingest_date", "extra"]


def test_cli_silver_then_gold(spark, tmp_root):
    """Bronze files -> `python -m lakepipe silver` -> `gold` (same session)."""
    from lakepipe.__main__ import main
    from lakepipe.sinks.tables import open_table

    lay = LakeLayout(tmp_root)
    _drop(spark, [(1, 10, 5, 1, "2001-01-01", "completed", "2001-01-01", "2001-01-06 00:00:00"),
                  (2, 11, 5, 1, "2001-01-01", "cancelled", "2001-01-02", "2001-01-06 00:00:00")],
          lay.bronze("Booking"))
    assert main(["silver", "--root", tmp_root, "--entity", "booking", "--buckets", "4"]) == 0
    assert open_table(spark, lay.silver("booking")).read().count() == 2
    assert main(["gold", "--root", tmp_root, "--table", "gold_booking_funnel", "--as-of", "2001-10-01"]) == 0
    got = sorted((str(r.date), r.total_bookings, r.completed, r.cancelled)
                 for r in spark.read.parquet(lay.gold("gold_booking_funnel")).collect())
    assert got == [("2001-01-01", 1, 1, 0), ("2001-01-02", 1, 0, 1)]
    # snapshot commits, published as catalog views
    snap_root = tmp_root + "/snap"
    _drop(spark, [(1, 10, 5, 1, "2001-01-01", "completed", "2001-01-01", "2001-01-06 00:00:00")],
          LakeLayout(snap_root).bronze("Booking"))
    assert main(["silver", "--root", snap_root, "--entity", "booking"]) == 0
    assert main(["gold", "--root", snap_root, "--table", "gold_booking_funnel", "--as-of", "2001-10-01",
                 "--snapshots", "--publish-schema", "lp_cli_gold"]) == 0
    view = spark.table("lp_cli_gold.gold_booking_funnel")
    assert [(str(r.date), r.total_bookings) for r in view.collect()] == [("2001-01-01", 1)]


def test_all_entities_stream_equals_batch(spark, tmp_root):
    """Every raw table -> bronze -> its silver stream equals the batch
    computation clean -> latest per key; then all six gold tables build."""
    from lakepipe.operators.dedup import dedup_latest
    from lakepipe.plans.gold import GOLD_JOBS, run_gold
    from lakepipe.plans.raw_sources import raw_frame
    from lakepipe.plans.silver import SILVER_SPECS
    from lakepipe.sinks.tables import BucketedTable, open_table
    from lakepipe.sinks.writers import append_bronze
    from lakepipe.streaming.silver_stream import run_silver_tables

    sf = "/root/testdata/sf0.001"
    lay = LakeLayout(tmp_root)
    for spec in SILVER_SPECS.values():
        append_bronze(raw_frame(spark, sf, spec.bronze), lay.bronze(spec.bronze), "2001-10-01")
    tables = run_silver_tables(spark, lay, SILVER_SPECS.values(),
                               lambda s: BucketedTable(spark, lay.silver(s.entity), [s.pk], 4))
    for entity, spec in SILVER_SPECS.items():
        if entity == "user_info":
            continue  # carries load_timestamp = now
        got = tables[entity].read()
        want = dedup_latest(spec.clean(raw_frame(spark, sf, spec.bronze)), spec.pk, spec.updated_col,
                            tie_breakers=[c for c in got.columns if c not in (spec.pk, spec.updated_col)])
        cols = sorted(want.columns)
        assert got.select(cols).exceptAll(want.select(cols)).count() == 0, entity
        assert want.select(cols).exceptAll(got.select(cols)).count() == 0, entity
    reports = run_gold(spark, lambda e: open_table(spark, lay.silver(e)).read(), lay.gold)
    assert set(reports) == set(GOLD_JOBS)
    assert all(r.action in ("overwritten", "skipped-empty") for r in reports.values())


def test_backlog_split_into_micro_batches(spark, tmp_root):
    """Three bronze drops, one file per trigger: one committed batch per
    file, the same final table as one batch; the CLI passes the option and
    the range layout through."""
    from lakepipe.__main__ import main
    from lakepipe.sinks.tables import open_table

    lay = LakeLayout(tmp_root)
    b = lay.bronze("Booking")
    for i, st in enumerate(["booked", "completed", "cancelled"]):
        spark.createDataFrame([(1, 10, 5, 1, "2001-01-01", st, "2001-01-01", f"2001-01-0{i + 2} 00:00:00"),
                               (20 + i, 10, 5, 1, "2001-01-01", st, "2001-01-01", "2001-01-02 00:00:00")],
                              RAW).coalesce(1).write.mode("append").parquet(b)
    table = VersionedTable(spark, lay.silver("split"))
    stream = silver.clean_booking(read_bronze_stream(spark, b, lay.schema_dir("Booking"), max_files_per_trigger=1))
    q = run_silver_once(stream, spark, lay.checkpoint("silver", "split"), table, "id", "updatedAt")
    # one batch per file, and each batch's source read once (2 rows each)
    assert [p["numInputRows"] for p in q.recentProgress] == [2, 2, 2]
    want = [(1, "CANCELLED", dt.datetime(2001, 1, 4)), (20, "BOOKED", dt.datetime(2001, 1, 2)),
            (21, "COMPLETED", dt.datetime(2001, 1, 2)), (22, "CANCELLED", dt.datetime(2001, 1, 2))]
    assert _state(table) == want
    assert main(["silver", "--root", tmp_root, "--entity", "booking", "--range", "booking=10",
                 "--max-files-per-trigger", "1"]) == 0
    got = open_table(spark, lay.silver("booking"))
    assert got.range_width == 10 and _state(got) == want
