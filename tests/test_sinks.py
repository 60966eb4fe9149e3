"""Storage: versioned and bucketed tables, gold writer modes, bronze append."""

import datetime as dt

from pyspark.sql import functions as F

from lakepipe.sinks.tables import BucketedTable, VersionedTable
from lakepipe.sinks.writers import append_bronze, read_bronze, scd2_apply, upsert, write_gold

T1, T2 = dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)
SCHEMA = "id long, v string, updatedAt timestamp"


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_versioned_table_commits_and_skips_uncommitted(spark, tmp_root):
    t = VersionedTable(spark, tmp_root + "/t")
    assert not t.exists()
    t.commit(spark.createDataFrame([(1, "a", T1)], SCHEMA))
    t.commit(spark.createDataFrame([(2, "b", T1)], SCHEMA))
    assert t.current_version() == 2 and rows(t.read()) == [(2, "b", T1)]
    # a half-written directory (no _SUCCESS) is ignored by readers
    spark.createDataFrame([(9, "x", T1)], SCHEMA).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(tmp_root + "/t/v=00000007")
    import os
    if os.path.exists(tmp_root + "/t/v=00000007/_SUCCESS"):
        os.remove(tmp_root + "/t/v=00000007/_SUCCESS")
    assert t.current_version() == 2
    assert t.commit(spark.createDataFrame([(3, "c", T1)], SCHEMA)) == 8


def test_upsert_sink_both_strategies(spark, tmp_root):
    first = spark.createDataFrame([(1, "a", T1), (2, "b", T1), (2, "b0", None)], SCHEMA)
    batch = spark.createDataFrame([(2, "c", T2), (3, "d", T2), (None, "z", T2)], SCHEMA)
    want = [(1, "a", T1), (2, "c", T2), (3, "d", T2)]
    for table in (VersionedTable(spark, tmp_root + "/v"), BucketedTable(spark, tmp_root + "/b", ["id"], 4)):
        assert upsert(spark, first, table, "id", "updatedAt").action == "created"
        assert upsert(spark, batch, table, "id", "updatedAt").action == "merged"
        assert rows(table.read()) == want
        # replaying the same batch changes nothing
        upsert(spark, batch, table, "id", "updatedAt")
        assert rows(table.read()) == want
        assert upsert(spark, batch.limit(0), table, "id", "updatedAt").action == "skipped-empty"


def test_bucketed_upsert_touches_only_batch_buckets(spark, tmp_root):
    table = BucketedTable(spark, tmp_root + "/b", ["id"], 8)
    upsert(spark, spark.createDataFrame([(i, "a", T1) for i in range(100)], SCHEMA), table, "id", "updatedAt")
    rep = upsert(spark, spark.createDataFrame([(5, "z", T2)], SCHEMA), table, "id", "updatedAt")
    assert rep.metrics["buckets_rewritten"] == 1
    assert table.read().count() == 100
    assert table.read().filter("id = 5").first().v == "z"
    # the staged copy of the rewritten bucket is removed after the swap
    import glob

    from lakepipe.session import checkpoint_root
    assert not glob.glob(checkpoint_root(spark) + "/lakepipe/bucket-stage-*/_bucket=*")


def test_range_layout_new_keys_touch_only_newest_range(spark, tmp_root):
    """Ids that grow with time: new rows land in the newest range, so the
    upsert rewrites it (and the range of the one updated row), not every
    partition as hash buckets would."""
    from lakepipe.sinks.tables import open_table

    table = BucketedTable(spark, tmp_root + "/r", ["id"], range_width=10)
    upsert(spark, spark.createDataFrame([(i, "a", T1) for i in range(100)], SCHEMA), table, "id", "updatedAt")
    batch = spark.createDataFrame([(i, "new", T2) for i in range(100, 106)] + [(5, "z", T2)], SCHEMA)
    rep = upsert(spark, batch, table, "id", "updatedAt")
    assert rep.metrics["buckets_rewritten"] == 2
    got = open_table(spark, tmp_root + "/r")
    assert got.range_width == 10
    assert got.read().count() == 106
    assert {r.id: r.v for r in got.read().filter("v <> 'a'").collect()} == {5: "z", **{i: "new" for i in range(100, 106)}}
    hashed = BucketedTable(spark, tmp_root + "/h", ["id"], 10)
    upsert(spark, spark.createDataFrame([(i, "a", T1) for i in range(100)], SCHEMA), hashed, "id", "updatedAt")
    assert upsert(spark, batch, hashed, "id", "updatedAt").metrics["buckets_rewritten"] > 2
    import pytest

    with pytest.raises(ValueError):
        BucketedTable(spark, tmp_root + "/r", ["id"], 10).exists()
    with pytest.raises(ValueError):  # text keys cannot be ranged
        BucketedTable(spark, tmp_root + "/s", ["v"], range_width=10).with_bucket(batch)


def test_write_gold_modes(spark, tmp_root):
    full = spark.createDataFrame([(d, n) for d, n in [("2001-01-01", 1), ("2001-01-02", 2)]], "date string, n int")
    part = full.filter("date = '2001-01-02'").withColumn("n", F.lit(20))
    p = tmp_root + "/g"
    write_gold(spark, full, p, partition_cols=["date"])
    write_gold(spark, part, p, partition_cols=["date"], dynamic_partitions=True)
    assert sorted((str(r.date), r.n) for r in spark.read.parquet(p).collect()) == [
        ("2001-01-01", 1), ("2001-01-02", 20)]
    write_gold(spark, part, p, partition_cols=["date"])  # static overwrite: other dates gone
    assert spark.read.parquet(p).count() == 1
    assert write_gold(spark, part.limit(0), p).action == "skipped-empty"
    assert spark.read.parquet(p).count() == 1
    write_gold(spark, part, p, mode="append", partition_cols=["date"])
    assert spark.read.parquet(p).count() == 2


def test_write_gold_merge_requires_key(spark, tmp_root):
    import pytest
    with pytest.raises(ValueError):
        write_gold(spark, spark.createDataFrame([(1, "a", T1)], SCHEMA), tmp_root + "/m", mode="merge")


def test_append_bronze_schema_evolution(spark, tmp_root):
    p = tmp_root + "/bronze/T"
    r1 = append_bronze(spark.createDataFrame([(1, T1)], "id long, updatedAt timestamp"), p, "2001-01-01", "updatedAt")
    r2 = append_bronze(spark.createDataFrame([(2, T2, "x")], "id long, updatedAt timestamp, extra string"),
                       p, "2001-01-02", "updatedAt")
    assert r1.metrics["rows"] == 1 and r2.metrics["max_updated"] == T2
    got = sorted((r.id, r.extra, str(r.ingest_date)) for r in read_bronze(spark, p).collect())
    assert got == [(1, None, "2001-01-01"), (2, "x", "2001-01-02")]
    # partition pruning on ingest_date reaches the scan
    plan = read_bronze(spark, p).filter("ingest_date = '2001-01-02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan


def test_layer_catalog_tables(spark, tmp_root):
    from pyspark.sql import types as T

    from lakepipe.sources.catalog import Layer, check_primary_key

    layer = Layer("lp_silver")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("v", T.StringType())])
    assert layer.ensure_table(spark, "t1", schema, location=tmp_root + "/t1") is True
    assert layer.exists(spark, "t1") and layer.ensure_table(spark, "t1", schema) is False
    spark.createDataFrame([(1, "a"), (1, "b"), (None, "c")], schema).write.mode("append").insertInto(
        layer.qualified("t1"))
    assert layer.read(spark, "t1").count() == 3
    bad = {r.id for r in check_primary_key(layer.read(spark, "t1"), "id").collect()}
    assert bad == {1, None}


def test_bucketed_table_rejects_other_bucket_count(spark, tmp_root):
    import pytest

    BucketedTable(spark, tmp_root + "/b", ["id"], 4).create(spark.createDataFrame([(1, "a", T1)], SCHEMA))
    assert BucketedTable(spark, tmp_root + "/b", ["id"], 4).exists()
    with pytest.raises(ValueError):
        BucketedTable(spark, tmp_root + "/b", ["id"], 8).exists()


def test_bucketed_large_bucket_is_split_across_writers(spark, tmp_root):
    import glob

    t = BucketedTable(spark, tmp_root + "/b", ["id"], 2)
    big = spark.range(200_000).selectExpr("id", "'a' as v", "timestamp'2001-01-01' as updatedAt")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        upsert(spark, big, t, "id", "updatedAt")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert t.read().count() == 200_000
    assert len(glob.glob(tmp_root + "/b/_bucket=0/*.parquet")) > 1


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

batches = st.lists(st.lists(st.tuples(st.integers(0, 20), st.sampled_from("xyz"), st.integers(1, 9)),
                            min_size=1, max_size=12), min_size=1, max_size=3)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(batches)
def test_upsert_strategies_match_brute_force(spark, tmp_path_factory, data):
    import datetime as dt

    root = str(tmp_path_factory.mktemp("u"))
    tables = [VersionedTable(spark, root + "/v"), BucketedTable(spark, root + "/b", ["id"], 3),
              BucketedTable(spark, root + "/r", ["id"], range_width=4)]
    expected = {}
    for i, batch in enumerate(data):
        rows_ = [(k, v, dt.datetime(2001, 1, d, i)) for k, v, d in batch]
        latest = {}
        for k, v, t in sorted(rows_, key=lambda r: (r[2], [-ord(ch) for ch in r[1]])):
            latest[k] = (k, v, t)  # newest wins; ties -> smallest v (ascending tie-break)
        expected.update(latest)
        for tb in tables:
            upsert(spark, spark.createDataFrame(rows_, SCHEMA), tb, "id", "updatedAt")
    for tb in tables:
        assert rows(tb.read()) == sorted(expected.values())


def test_write_gold_splits_a_hot_partition(spark, tmp_root):
    """A date is written by as many tasks as its own count asks for, whatever the others hold."""
    import glob

    df = spark.range(200_000).selectExpr(
        "id", "case when id % 10 = 0 then date'2001-01-02' when id % 1000 > 0 then date'2001-01-01' end as date")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        rep = write_gold(spark, df, tmp_root + "/hot", partition_cols=["date"], hot_partition_rows=50_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert rep.metrics["rows"] == 200_000
    assert 2 <= len(glob.glob(tmp_root + "/hot/date=2001-01-01/*.parquet")) <= 4
    assert len(glob.glob(tmp_root + "/hot/date=2001-01-02/*.parquet")) == 1
    got = spark.read.parquet(tmp_root + "/hot")
    assert got.columns == ["id", "date"] and got.exceptAll(df.select("id", "date")).count() == 0 and got.count() == 200_000
    write_gold(spark, df, tmp_root + "/cool", partition_cols=["date"])  # default bound: not hot
    assert len(glob.glob(tmp_root + "/cool/date=2001-01-01/*.parquet")) == 1


def test_write_gold_merge_rewrites_touched_buckets_only(spark, tmp_root):
    import glob

    from lakepipe.clock import Clock
    from lakepipe.sinks.tables import open_table

    p = tmp_root + "/scd"
    write_gold(spark, spark.range(200).selectExpr("id", "'v0' as v"), p, mode="merge", primary_key="id", clock=Clock("2001-01-01"), buckets=16)
    before = set(glob.glob(p + "/_bucket=*/*.parquet"))
    rep = write_gold(spark, spark.createDataFrame([(7, "v1")], "id long, v string"), p, mode="merge", primary_key="id", clock=Clock("2001-01-02"), buckets=16)
    assert rep.metrics["buckets_rewritten"] == 1
    after = set(glob.glob(p + "/_bucket=*/*.parquet"))
    assert {f.rsplit("/", 2)[1] for f in before ^ after} == {f.rsplit("/", 2)[1] for f in after - before} and len(after - before) == 1
    hist = open_table(spark, p).read()
    assert hist.count() == 201 and sorted((r.v, r.is_current) for r in hist.where("id = 7").collect()) == [("v0", False), ("v1", True)]


def test_touched_buckets_are_those_the_table_has(spark, tmp_root):
    t = BucketedTable(spark, tmp_root + "/r", ["id"], range_width=10)
    upsert(spark, spark.createDataFrame([(i, "a", T1) for i in range(30)], SCHEMA), t, "id", "updatedAt")
    batch = spark.createDataFrame([(i, "b", T2) for i in (5, 1000, 2000, 3000)], SCHEMA)
    assert t.touched(t.with_bucket(batch)) == ([0], 4)
    upsert(spark, batch, t, "id", "updatedAt", guard_stale=True)
    got = {r[0]: r[1] for r in t.read().collect()}
    assert len(got) == 33 and got[5] == "b" and got[4] == "a" and got[3000] == "b"


def test_versioned_table_keeps_newest_snapshots(spark, tmp_root):
    import glob

    t = VersionedTable(spark, tmp_root + "/k", keep=2)
    for i in range(4):
        t.commit(spark.createDataFrame([(i, "a", T1)], SCHEMA))
    assert sorted(p.rsplit("=", 1)[1] for p in glob.glob(tmp_root + "/k/v=*")) == ["00000003", "00000004"]
    assert rows(t.read()) == [(3, "a", T1)]


def test_bucket_swap_rolls_forward_after_a_lost_driver(spark, tmp_root):
    """The driver dies mid-swap after deleting a bucket and before moving
    its new content in: the next writer restores it from the stage, and the
    replayed batch then changes nothing."""
    import shutil

    from lakepipe.operators.merge import upsert_df

    t = BucketedTable(spark, tmp_root + "/b", ["id"], 4)
    upsert(spark, spark.createDataFrame([(i, "a", T1) for i in range(40)], SCHEMA), t, "id", "updatedAt")
    batch = spark.createDataFrame([(5, "z", T2)], SCHEMA)
    b = t.with_bucket(batch)
    bucket = b.first()._bucket
    old = t.read(with_bucket=True).filter(F.col("_bucket") == bucket)
    new = upsert_df(old, b, ["id"])
    # simulate: stage written and recorded, then the bucket deleted, then the driver is lost
    from lakepipe.sinks.tables import PENDING_FILE, STAGE_PREFIX
    stage = f"{tmp_root}/b/{STAGE_PREFIX}lost"
    t._clustered(new).write.partitionBy("_bucket").parquet(stage)
    t._write_file(PENDING_FILE, stage)
    shutil.rmtree(f"{tmp_root}/b/_bucket={bucket}")
    # a reader takes the missing bucket from the stage: no rows are lost
    assert t.read().count() == 40
    assert t.read().filter("id = 5").first().v == "z"
    # the replayed batch: the writer first completes the swap
    upsert(spark, batch, t, "id", "updatedAt")
    assert t.read().count() == 40
    assert t.read().filter("id = 5").first().v == "z"
    assert t._read_file(PENDING_FILE) is None


def test_write_gold_snapshots_and_publish(spark, tmp_root):
    """Each overwrite is a new snapshot; the catalog view follows the newest
    one, old snapshots beyond ``keep_versions`` are removed."""
    import glob

    import pytest

    from lakepipe.sinks.tables import open_table
    from lakepipe.sources.catalog import Layer

    layer = Layer("lp_gold_snap")
    p = tmp_root + "/gs"
    for n in (1, 2, 3, 4):
        df = spark.createDataFrame([("2001-01-01", n), ("2001-01-02", n)], "date string, n int")
        rep = write_gold(spark, df, p, partition_cols=["date"], snapshots=True, keep_versions=2)
        assert rep.action == "overwritten" and rep.metrics["version"] == n
        layer.publish(spark, "funnel", rep.metrics["path"])
        assert {r.n for r in layer.read(spark, "funnel").collect()} == {n}
    assert len(glob.glob(p + "/v=*")) == 2
    assert sorted((str(r.date), r.n) for r in open_table(spark, p).read().collect()) == [
        ("2001-01-01", 4), ("2001-01-02", 4)]
    with pytest.raises(ValueError):
        write_gold(spark, df, p, mode="append", snapshots=True)


def test_write_gold_merge_keeps_history_and_bounded_snapshots(spark, tmp_root):
    import glob

    from lakepipe.clock import Clock
    from lakepipe.sinks.tables import open_table

    p = tmp_root + "/scd"
    VersionedTable(spark, p).commit(spark.createDataFrame([], "id long, v string, is_current boolean, effective_date date, end_date date"))
    for i, day in enumerate(["2001-01-01", "2001-01-02", "2001-01-03", "2001-01-04"]):
        df = spark.createDataFrame([(1, f"v{i}")], "id long, v string")
        write_gold(spark, df, p, mode="merge", primary_key="id", clock=Clock(day), keep_versions=2)
    hist = sorted((r.v, r.is_current) for r in open_table(spark, p).read().collect())
    assert hist == [("v0", False), ("v1", False), ("v2", False), ("v3", True)]
    assert len(glob.glob(p + "/v=*")) == 2


def test_bucketed_table_keeps_columns_that_a_batch_added(spark, tmp_root):
    t = BucketedTable(spark, tmp_root + "/b", ["id"], 4)
    upsert(spark, spark.createDataFrame([(i, "a", T1) for i in range(20)], SCHEMA), t, "id", "updatedAt")
    wide = spark.createDataFrame([(3, "b", T2, "x")], SCHEMA + ", extra string")
    upsert(spark, wide, t, "id", "updatedAt")
    assert t.read().filter("extra = 'x'").count() == 1
    for k in range(20, 30):  # later batches lack the column and rewrite every bucket
        upsert(spark, spark.createDataFrame([(k, "c", T2)], SCHEMA), t, "id", "updatedAt")
    got = {r.id: r.extra for r in t.read().collect()}
    assert len(got) == 30 and got.pop(3) == "x" and set(got.values()) == {None}


def test_bucketed_scd2_keeps_columns_that_a_load_added(spark, tmp_root):
    t = BucketedTable(spark, tmp_root + "/b", ["id"], 2)
    scd2_apply(spark, spark.createDataFrame([(1, "a"), (2, "a")], "id long, v string"), t, "id")
    scd2_apply(spark, spark.createDataFrame([(1, "b", 7)], "id long, v string, extra int"), t, "id")
    scd2_apply(spark, spark.createDataFrame([(1, "c"), (2, "c")], "id long, v string"), t, "id")
    got = sorted((r.id, r.v, r.extra, r.is_current) for r in t.read().collect())
    assert got == [(1, "a", None, False), (1, "b", 7, False), (1, "c", None, True),
                   (2, "a", None, False), (2, "c", None, True)]


def test_bucketed_table_widens_types_and_refuses_others(spark, tmp_root):
    import pytest

    t = BucketedTable(spark, tmp_root + "/b", ["id"], 2)
    upsert(spark, spark.createDataFrame([(i, 1, T1) for i in range(8)], "id long, n int, updatedAt timestamp"),
           t, "id", "updatedAt")
    upsert(spark, spark.createDataFrame([(1, 2**40, T2)], "id long, n long, updatedAt timestamp"), t, "id", "updatedAt")
    assert sorted({r.n for r in t.read().collect()}) == [1, 2**40]
    with pytest.raises(ValueError):
        upsert(spark, spark.createDataFrame([(1, "x", T2)], "id long, n string, updatedAt timestamp"),
               t, "id", "updatedAt")
    assert t.read().count() == 8


def test_bucketed_table_refuses_data_without_a_marker(spark, tmp_root):
    import os

    import pytest

    from lakepipe.sinks.tables import BUCKETS_FILE

    t = BucketedTable(spark, tmp_root + "/b", ["id"], 4)
    t.create(spark.createDataFrame([(1, "a", T1)], SCHEMA))
    os.remove(f"{tmp_root}/b/{BUCKETS_FILE}")
    with pytest.raises(ValueError):
        t.exists()
    # what a crashed creation left (no _SUCCESS) is cleared by the next one
    u = BucketedTable(spark, tmp_root + "/c", ["id"], 4)
    u.create(spark.createDataFrame([(1, "a", T1), (2, "a", T1)], SCHEMA))
    os.remove(f"{tmp_root}/c/_SUCCESS")
    assert not u.exists()
    u.create(spark.createDataFrame([(1, "a", T1)], SCHEMA))
    assert u.read().count() == 1


def test_bucketed_create_leaves_other_tables_alone(spark, tmp_root):
    import pytest

    v = VersionedTable(spark, tmp_root + "/t")
    batch = spark.createDataFrame([(1, "a", T1)], SCHEMA)
    v.commit(batch)
    with pytest.raises(ValueError):
        upsert(spark, batch, BucketedTable(spark, tmp_root + "/t", ["id"], 4), "id", "updatedAt")
    assert v.read().count() == 1
