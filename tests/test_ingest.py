"""Watermarks, load planning, incremental ingest, backfill, schedules."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakepipe.clock import Clock
from lakepipe.plans.ingest import (TABLE_SPECS, TableSpec, WatermarkStore, backfill, ingest_all, ingest_table,
                                   plan_load, select_tables)
from lakepipe.sinks.writers import read_bronze
from lakepipe.sources.jdbc import JdbcOptions, quote_ident
from lakepipe.sources.layout import LakeLayout

SF = "/root/testdata/sf0.001"


def test_registry_and_schedules():
    assert len(TABLE_SPECS) == 15
    sched = {s: len(select_tables(TABLE_SPECS.values(), s)) for s in ("hourly", "daily", "weekly")}
    assert sched == {"hourly": 8, "daily": 5, "weekly": 2}


def test_plan_load():
    s = TableSpec("T")
    assert plan_load(s, None) == "full"
    assert plan_load(s, dt.datetime(2001, 1, 1)) == "incremental"
    assert plan_load(s, dt.datetime(2001, 1, 1), force_full=True) == "full"
    assert plan_load(TableSpec("T", full_load=True), dt.datetime(2001, 1, 1)) == "full"


def test_watermark_store(spark, tmp_root):
    store = WatermarkStore(spark, tmp_root + "/wm", Clock("2001-10-01"))
    assert store.get("A") is None
    store.set("A", dt.datetime(2001, 1, 1))
    store.set("B", dt.datetime(2001, 1, 2))
    store.set("A", dt.datetime(2001, 1, 3))
    assert store.get("A") == dt.datetime(2001, 1, 3) and store.get("B") == dt.datetime(2001, 1, 2)
    assert store.frame().count() == 2


def test_watermark_store_raises_on_corruption(spark, tmp_root):
    store = WatermarkStore(spark, tmp_root + "/wm")
    store.set("A", dt.datetime(2001, 1, 1))
    import glob
    import os
    for f in glob.glob(tmp_root + "/wm/v=*/*.parquet"):
        with open(f, "wb") as fh:
            fh.write(b"garbage")
    assert os.path.exists(tmp_root + "/wm")
    with pytest.raises(Exception):
        store.get("A")


def _src(spark, cut=None, seen=None):
    def src(spec, after=None):
        if seen is not None:
            seen.append(after)
        df = spark.read.parquet(f"{SF}/{spec.name}.parquet").withColumn(
            spec.updated_column, F.col(spec.updated_column).cast("timestamp")) if spec.updated_column else \
            spark.read.parquet(f"{SF}/{spec.name}.parquet")
        if cut is not None and spec.updated_column:
            df = df.filter(F.col(spec.updated_column) < F.lit(cut).cast("timestamp"))
        return df
    return src


def test_incremental_ingest_reads_only_new_rows(spark, tmp_root):
    lay = LakeLayout(tmp_root)
    store = WatermarkStore(spark, lay.watermarks())
    spec = TableSpec("orders", "o_orderdate")
    seen = []
    r1 = ingest_table(spark, spec, _src(spark, "1998-01-01", seen), lay, store, "2001-09-01")
    r2 = ingest_table(spark, spec, _src(spark, None, seen), lay, store, "2001-10-01")
    # the source is told the incremental lower bound (None on the full load)
    assert seen == [None, r1.watermark]
    r3 = ingest_table(spark, spec, _src(spark), lay, store, "2001-10-02")
    total = spark.read.parquet(f"{SF}/orders.parquet").count()
    assert (r1.mode, r2.mode, r3.mode) == ("full", "incremental", "incremental")
    assert r1.rows + r2.rows == total and r3.rows == 0
    assert read_bronze(spark, lay.bronze("orders")).count() == total
    assert store.get("orders") == r2.watermark


def test_backfill_and_parallel_ingest(spark, tmp_root):
    lay = LakeLayout(tmp_root)
    store = WatermarkStore(spark, lay.watermarks())
    specs = [TableSpec("orders", "o_orderdate", schedule="hourly"), TableSpec("nation", None, schedule="weekly")]
    res = ingest_all(spark, specs, _src(spark), lay, store, "2001-09-01", parallelism=2)
    assert [r.mode for r in res] == ["full", "full"]
    wm = store.get("orders")
    back = backfill(spark, specs[:1], _src(spark), lay, store, "2001-10-01", since="1997-01-01")
    assert back[0].mode == "full" and 0 < back[0].rows
    assert store.get("orders") == wm  # never moves backwards
    hourly = ingest_all(spark, specs, _src(spark), lay, store, "2001-10-02", schedule="weekly")
    assert [r.table for r in hourly] == ["nation"]


def test_jdbc_options():
    o = JdbcOptions("db.example", 5432, "app", "u", "secret")
    assert o.url.startswith("jdbc:postgresql://db.example:5432/app?sslmode=require&connectTimeout=60")
    assert "socketTimeout=600" in o.url and "reWriteBatchedInserts=true" in o.url
    assert o.options()["fetchsize"] == "10000" and "secret" not in repr(o)
    assert quote_ident('We"ird') == '"We""ird"'


def test_overlap_window_rereads_recent_rows(spark, tmp_root):
    lay = LakeLayout(tmp_root)
    store = WatermarkStore(spark, lay.watermarks())
    spec = TableSpec("orders", "o_orderdate")
    ingest_table(spark, spec, _src(spark), lay, store, "2001-09-01")
    wm = store.get("orders")
    again = ingest_table(spark, spec, _src(spark), lay, store, "2001-09-02", overlap_seconds=86400 * 3)
    src = _src(spark)(spec)
    want = src.filter(F.col("o_orderdate") > F.lit(wm - dt.timedelta(days=3))).count()
    assert again.rows == want > 0


def test_jdbc_bounds_cover_only_new_rows():
    """Range bounds of an incremental JDBC read come from the new rows."""
    from lakepipe.sources.jdbc import bounds_query, sql_literal

    assert sql_literal(dt.datetime(2001, 1, 2, 3, 4, 5)) == "TIMESTAMP '2001-01-02 03:04:05'"
    assert sql_literal(dt.date(2001, 1, 2)) == "DATE '2001-01-02'"
    assert sql_literal("it's") == "'it''s'" and sql_literal(7) == "7"
    q = bounds_query("Booking", "id", '"updatedAt" > TIMESTAMP \'2001-01-02 00:00:00\'')
    assert q == ('(select min("id") lo, max("id") hi from "Booking" '
                 'where "updatedAt" > TIMESTAMP \'2001-01-02 00:00:00\') b')


def test_a_failing_table_keeps_the_others_watermarks(spark, tmp_root):
    import datetime as dt

    import pytest

    from lakepipe.plans.ingest import IngestErrors, TableSpec, WatermarkStore, ingest_all
    from lakepipe.sources.layout import LakeLayout

    t1 = dt.datetime(2001, 1, 1)

    def source(spec, after):
        if spec.name == "bad":
            raise OSError("no such table")
        return spark.createDataFrame([(1, t1)], "id long, updatedAt timestamp")

    for parallelism in (1, 3):
        lake = LakeLayout(f"{tmp_root}/{parallelism}")
        store = WatermarkStore(spark, lake.watermarks())
        specs = [TableSpec("a"), TableSpec("bad"), TableSpec("b")]
        with pytest.raises(IngestErrors) as e:
            ingest_all(spark, specs, source, lake, store, "2001-01-01", parallelism=parallelism)
        assert list(e.value.failed) == ["bad"] and [r.table for r in e.value.results] == ["a", "b"]
        assert store.get("a") == t1 and store.get("b") == t1 and store.get("bad") is None


def test_silver_skips_a_bronze_table_without_rows(spark, tmp_root):
    from lakepipe.plans.silver import SILVER_SPECS
    from lakepipe.sinks.tables import BucketedTable
    from lakepipe.sinks.writers import append_bronze
    from lakepipe.sources.layout import LakeLayout
    from lakepipe.streaming.silver_stream import run_silver_tables

    lake = LakeLayout(tmp_root)
    empty = spark.createDataFrame([], "id long, createdAt string, updatedAt string")
    append_bronze(empty, lake.bronze("User"), "2001-01-01")
    specs = [SILVER_SPECS["user"], SILVER_SPECS["booking"]]  # an empty first load; no load at all
    tables = run_silver_tables(spark, lake, specs, lambda s: BucketedTable(spark, lake.silver(s.entity), [s.pk], 4))
    assert not any(t.exists() for t in tables.values())


def test_jdbc_reads_are_split_by_default(spark, monkeypatch):
    from lakepipe.plans import ingest
    from lakepipe.sources.jdbc import JdbcPartitioning

    asked = []

    def bounds(spark, opts, table, column, n, where=None):
        asked.append((table, column, n, where))
        return JdbcPartitioning(column, 0, 10, n)

    monkeypatch.setattr(ingest, "partitioning_for", bounds)
    monkeypatch.setattr(ingest, "read_jdbc_full", lambda spark, opts, table, part=None: part)
    src = ingest.jdbc_source(spark, None, {"Booking": "id"})
    assert src(TABLE_SPECS["Booking"]).column == "id" and src(TABLE_SPECS["Payment"]).num_partitions == 16
    assert src(TableSpec("plain", None)) is None
    assert src(TABLE_SPECS["User"], after=1).column == "updatedAt"
    assert asked == [("Booking", "id", 16, None), ("Payment", "updatedAt", 16, None), ("User", "updatedAt", 16, '"updatedAt" > 1')]
    assert ingest.jdbc_source(spark, None, num_partitions=1)(TABLE_SPECS["User"]) is None
