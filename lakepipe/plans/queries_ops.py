"""Operator queries: dedup, quality gate, upsert, SCD-2, writers, bronze,
ingestion, streaming and seed loading.

Queries with a sink write into a fresh folder under the shared checkpoint
location and return the table read back, so the oracle checks what was
stored, not what was meant to be stored."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakepipe.clock import Clock
from lakepipe.operators.dedup import dedup_latest, dedup_rows
from lakepipe.operators.quality import require_not_null
from lakepipe.plans import fixtures as fx
from lakepipe.plans import gold, silver
from lakepipe.plans.catalog import CLOCK, register
from lakepipe.plans.fixtures import Tables, read_table, with_views
from lakepipe.plans.ingest import TableSpec, WatermarkStore, backfill, ingest_all, ingest_table
from lakepipe.plans.queries_silver import SILVER_ORACLES
from lakepipe.plans.raw_sources import raw_frame, raw_sql
from lakepipe.session import scratch_path
from lakepipe.sinks.tables import BucketedTable, VersionedTable
from lakepipe.sinks.writers import append_bronze, read_bronze, scd2_apply, upsert, write_gold
from lakepipe.sources.bronze import read_bronze_stream
from lakepipe.sources.layout import LakeLayout
from lakepipe.sources.seed import read_csv_seed, seed_normalise
from lakepipe.streaming.silver_stream import run_silver_once

DAY1 = Clock("2001-09-01 00:00:00")
DAY2 = Clock("2001-10-01 00:00:00")

# ------------------------------------------------------------------- dedup


@register(
    "dedup_latest",
    with_views(
        """select id, userId, sessionId, status, createdAt from (
  select *, row_number() over (partition by id order by createdAt desc nulls last,
    userId asc nulls last, sessionId asc nulls last, status asc nulls last) rn
  from v_booking where id is not null) where rn = 1""",
        "v_booking",
    ),
    "WN-1 FLT-9 SL-1 SL-3",
)
def q_dedup_latest(spark, sf_dir):
    return dedup_latest(fx.v_booking(Tables(spark, sf_dir)), "id", "createdAt")


@register(
    "dedup_latest_events",
    """select event_id, ts, user_id, event_type, value, props from (
  select *, row_number() over (partition by user_id order by ts desc nulls last, event_id, event_type,
    value, props) rn from events where user_id is not null) where rn = 1""",
    "WN-1",
)
def q_dedup_latest_events(spark, sf_dir):
    return dedup_latest(read_table(spark, sf_dir, "events"), "user_id", "ts")


@register(
    "dedup_rows",
    "select distinct l_orderkey, l_linenumber from lineitem",
    "AG-12",
)
def q_dedup_rows(spark, sf_dir):
    return dedup_rows(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber"))


@register(
    "require_not_null",
    with_views("select * from v_payment where userId is not null and id is not null", "v_payment"),
    "FLT-1 FLT-2",
)
def q_require_not_null(spark, sf_dir):
    return require_not_null(fx.v_payment(Tables(spark, sf_dir)), "userId", "id")


# ------------------------------------------------------------------ upsert
# Target: customers with a non-negative balance.  Batch: two market
# segments with changed values; part of it matches the target (update),
# the rest is new (insert).

def _upsert_target(t):
    c = t.customer
    return c.filter(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("id"), "c_name", "c_mktsegment", "c_acctbal",
        (F.lit("2001-06-01 00:00:00").cast("timestamp")
         + F.make_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("c_custkey") % 30).cast("int"))).alias("updatedAt"),
    )


def _upsert_batch(t):
    c = t.customer
    return c.filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY") | (F.col("c_acctbal") < 0)).select(
        F.col("c_custkey").alias("id"), F.upper("c_name").alias("c_name"), "c_mktsegment",
        (F.col("c_acctbal") + 1).alias("c_acctbal"),
        (F.lit("2001-06-01 00:00:00").cast("timestamp")
         + F.make_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("c_custkey") % 29).cast("int"))).alias("updatedAt"),
    )


_UPSERT_CTES = """with tgt as (
  select c_custkey id, c_name, c_mktsegment, c_acctbal,
         timestamp '2001-06-01' + to_days(cast(c_custkey % 30 as int)) updatedAt
  from customer where c_acctbal >= 0),
bat as (
  select c_custkey id, upper(c_name) c_name, c_mktsegment, c_acctbal + 1 c_acctbal,
         timestamp '2001-06-01' + to_days(cast(c_custkey % 29 as int)) updatedAt
  from customer where (c_mktsegment in ('BUILDING', 'MACHINERY') or c_acctbal < 0))
"""
_UPSERT_SQL = _UPSERT_CTES + "select * from tgt where id not in (select id from bat) union all select * from bat"


def _run_upsert(spark, sf_dir, table_kind: str, guard_stale: bool = False):
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, f"upsert-{table_kind}")
    if table_kind == "versioned":
        table = VersionedTable(spark, root)
    elif table_kind == "range":
        table = BucketedTable(spark, root, ["id"], range_width=1000)
    else:
        table = BucketedTable(spark, root, ["id"], 16)
    upsert(spark, _upsert_target(t), table, "id", "updatedAt")
    upsert(spark, _upsert_batch(t), table, "id", "updatedAt", guard_stale=guard_stale)
    return table.read()


@register("upsert_merge", _UPSERT_SQL, "SNK-3 SNK-4 JN-8 SM-6 SM-8")
def q_upsert_merge(spark, sf_dir):
    return _run_upsert(spark, sf_dir, "versioned")


@register("upsert_bucketed", _UPSERT_SQL, "SNK-4 (bucket-partition strategy)")
def q_upsert_bucketed(spark, sf_dir):
    return _run_upsert(spark, sf_dir, "bucketed")


@register("upsert_replay", _UPSERT_SQL, "SM-8 (a batch applied again changes nothing)")
def q_upsert_replay(spark, sf_dir):
    t = Tables(spark, sf_dir)
    table = BucketedTable(spark, scratch_path(spark, "upsert-replay"), ["id"], 16)
    for batch in (_upsert_target(t), _upsert_batch(t), _upsert_batch(t)):
        upsert(spark, batch, table, "id", "updatedAt")
    return table.read()


@register(
    "upsert_bucketed_evolve",
    _UPSERT_CTES + """, grown as (
  select *, null as segment_note from tgt where id not in (select id from bat)
  union all select *, lower(c_mktsegment) as segment_note from bat)
select id, case when id % 7 = 0 then c_name || '!' else c_name end as c_name, c_mktsegment, c_acctbal, updatedAt,
  case when id % 7 = 0 then null else segment_note end as segment_note
from grown""",
    "SNK-4 (a batch adds a column, a later one lacks it)",
)
def q_upsert_bucketed_evolve(spark, sf_dir):
    t = Tables(spark, sf_dir)
    table = BucketedTable(spark, scratch_path(spark, "upsert-evolve"), ["id"], 16)
    upsert(spark, _upsert_target(t), table, "id", "updatedAt")
    upsert(spark, _upsert_batch(t).withColumn("segment_note", F.lower("c_mktsegment")), table, "id", "updatedAt")
    # Lacks the column and touches every bucket: other rows keep their value.
    last = table.read().filter(F.col("id") % 7 == 0).withColumn("c_name", F.concat("c_name", F.lit("!")))
    upsert(spark, last.drop("segment_note"), table, "id", "updatedAt")
    return table.read()


@register("upsert_range", _UPSERT_SQL, "SNK-4 (key-range partition strategy)")
def q_upsert_range(spark, sf_dir):
    return _run_upsert(spark, sf_dir, "range")


@register(
    "upsert_guard_stale",
    _UPSERT_CTES
    + """select t.* from tgt t join bat b on t.id = b.id where t.updatedAt > b.updatedAt
union all select * from tgt where id not in (select id from bat)
union all select b.* from bat b left join tgt t on t.id = b.id
  where t.id is null or not (t.updatedAt > b.updatedAt)""",
    "SM-6 D9",
)
def q_upsert_guard_stale(spark, sf_dir):
    return _run_upsert(spark, sf_dir, "versioned", guard_stale=True)


@register(
    "upsert_create",
    with_views(
        """select id, userId, sessionId, status, createdAt from (
  select *, row_number() over (partition by id order by createdAt desc nulls last,
    userId asc nulls last, sessionId asc nulls last, status asc nulls last) rn
  from v_booking where id is not null) where rn = 1""",
        "v_booking",
    ),
    "SNK-3 SNK-14",
)
def q_upsert_create(spark, sf_dir):
    table = VersionedTable(spark, scratch_path(spark, "upsert-create"))
    upsert(spark, fx.v_booking(Tables(spark, sf_dir)), table, "id", "createdAt")
    return table.read()


# ------------------------------------------------------------------- SCD-2

_SCD_CTES = """with u1 as (
  select c_custkey id, c_name, c_mktsegment, c_acctbal from customer where c_acctbal >= 0),
u2 as (
  select c_custkey id, upper(c_name) c_name, c_mktsegment, c_acctbal + 1 c_acctbal
  from customer where (c_mktsegment = 'BUILDING' or c_acctbal < 0))
"""


def _scd_updates(t):
    c = t.customer
    u1 = c.filter(F.col("c_acctbal") >= 0).select(F.col("c_custkey").alias("id"), "c_name", "c_mktsegment", "c_acctbal")
    u2 = c.filter((F.col("c_mktsegment") == "BUILDING") | (F.col("c_acctbal") < 0)).select(
        F.col("c_custkey").alias("id"), F.upper("c_name").alias("c_name"), "c_mktsegment",
        (F.col("c_acctbal") + 1).alias("c_acctbal"))
    return u1, u2


@register(
    "scd2_bootstrap",
    _SCD_CTES + "select *, true as is_current, date '2001-09-01' as effective_date, "
    "cast(null as date) as end_date from u1",
    "SNK-9 SNK-13",
)
def q_scd2_bootstrap(spark, sf_dir):
    u1, _ = _scd_updates(Tables(spark, sf_dir))
    table = VersionedTable(spark, scratch_path(spark, "scd2-boot"))
    scd2_apply(spark, u1, table, "id", DAY1)
    return table.read()


@register(
    "scd2_second_load",
    _SCD_CTES
    + """select u1.*, case when u1.id in (select id from u2) then false else true end as is_current,
  date '2001-09-01' as effective_date,
  case when u1.id in (select id from u2) then date '2001-10-01' else cast(null as date) end as end_date
from u1
union all
select *, true, date '2001-10-01', cast(null as date) from u2""",
    "SNK-10 SNK-11 SNK-12 JN-7 EX-1 D10 D11",
)
def q_scd2_second_load(spark, sf_dir):
    u1, u2 = _scd_updates(Tables(spark, sf_dir))
    table = VersionedTable(spark, scratch_path(spark, "scd2-two"))
    scd2_apply(spark, u1, table, "id", DAY1)
    scd2_apply(spark, u2, table, "id", DAY2)
    return table.read()


_SCD_SECOND_SQL = _SCD_CTES + """select u1.*, case when u1.id in (select id from u2) then false else true end as is_current,
  date '2001-09-01' as effective_date,
  case when u1.id in (select id from u2) then date '2001-10-01' else cast(null as date) end as end_date
from u1
union all
select *, true, date '2001-10-01', cast(null as date) from u2"""


@register("scd2_bucketed", _SCD_SECOND_SQL, "SNK-10 SNK-11 SNK-12 (bucket-partition strategy)")
def q_scd2_bucketed(spark, sf_dir):
    u1, u2 = _scd_updates(Tables(spark, sf_dir))
    table = BucketedTable(spark, scratch_path(spark, "scd2-bucketed"), ["id"], 16)
    scd2_apply(spark, u1, table, "id", DAY1)
    scd2_apply(spark, u2, table, "id", DAY2)
    return table.read()


@register(
    "scd2_bucketed_evolve",
    _SCD_CTES
    + """select u1.*, null as segment_note, id not in (select id from u2) and id % 7 <> 0 as is_current,
  date '2001-09-01' as effective_date,
  case when id in (select id from u2) or id % 7 = 0 then date '2001-10-01' end as end_date
from u1
union all
select *, lower(c_mktsegment), id % 7 <> 0, date '2001-10-01',
  case when id % 7 = 0 then date '2001-10-01' end from u2
union all
select c_custkey, c_name, c_mktsegment, c_acctbal, null, true, date '2001-10-01', null
from customer where c_custkey % 7 = 0""",
    "SNK-10 SNK-11 SNK-12 (a load adds a column, a later one lacks it)",
)
def q_scd2_bucketed_evolve(spark, sf_dir):
    t = Tables(spark, sf_dir)
    u1, u2 = _scd_updates(t)
    u3 = t.customer.filter(F.col("c_custkey") % 7 == 0).select(
        F.col("c_custkey").alias("id"), "c_name", "c_mktsegment", "c_acctbal")
    table = BucketedTable(spark, scratch_path(spark, "scd2-evolve"), ["id"], 16)
    scd2_apply(spark, u1, table, "id", DAY1)
    scd2_apply(spark, u2.withColumn("segment_note", F.lower("c_mktsegment")), table, "id", DAY2)
    scd2_apply(spark, u3, table, "id", DAY2)
    return table.read()


# ------------------------------------------------------------- gold writes
# The funnel table, written twice in different ways and read back.  These
# writer-mode probes partition by month (tens of directories); the funnel's
# own daily partitioning is exercised by e2e_booking_funnel.

_FUNNEL = """select cast(createdAt as date) as date,
  cast(date_trunc('month', cast(createdAt as date)) as date) as month, count(*) as total_bookings,
  cast(sum(case when status = 'COMPLETED' then 1 else 0 end) as bigint) as completed,
  cast(sum(case when status = 'CANCELLED' then 1 else 0 end) as bigint) as cancelled,
  date '2001-10-01' as snapshot_date, timestamp '2001-10-01 00:00:00' as snapshot_ts
from v_booking {where} group by 1, 2"""
_LATE = "createdAt >= timestamp '1999-01-01'"


def _funnel(spark, sf_dir, late_only=False):
    b = fx.v_booking(Tables(spark, sf_dir))
    if late_only:
        b = b.filter(F.col("createdAt") >= F.lit("1999-01-01 00:00:00").cast("timestamp"))
    return gold.booking_funnel(b, CLOCK).withColumn("month", F.trunc("date", "month"))


def _read_funnel(spark, path, *extra):
    return spark.read.parquet(path).select(
        "date", *extra, "total_bookings", "completed", "cancelled", "snapshot_date", "snapshot_ts")


@register(
    "write_overwrite_partitioned",
    with_views(_FUNNEL.format(where=f"where {_LATE}"), "v_booking"),
    "SNK-5 SNK-6 SNK-8",
)
def q_write_overwrite_partitioned(spark, sf_dir):
    path = scratch_path(spark, "gold-overwrite")
    write_gold(spark, _funnel(spark, sf_dir), path, partition_cols=["month"])
    write_gold(spark, _funnel(spark, sf_dir, late_only=True), path, partition_cols=["month"])
    return _read_funnel(spark, path, "month")


@register(
    "write_append",
    with_views(
        _FUNNEL.format(where="") + " union all " + _FUNNEL.format(where=f"where {_LATE}"), "v_booking"),
    "SNK-7",
)
def q_write_append(spark, sf_dir):
    path = scratch_path(spark, "gold-append")
    write_gold(spark, _funnel(spark, sf_dir), path, mode="append", partition_cols=["month"])
    write_gold(spark, _funnel(spark, sf_dir, late_only=True), path, mode="append", partition_cols=["month"])
    return _read_funnel(spark, path, "month")


@register(
    "write_dynamic_partitions",
    with_views(
        "select date, month, total_bookings + case when date >= date '1999-01-01' then 1000 else 0 end as total_bookings, "
        "completed, cancelled, snapshot_date, snapshot_ts from (" + _FUNNEL.format(where="") + ")",
        "v_booking",
    ),
    "SNK-6 (dynamic partition overwrite)",
)
def q_write_dynamic_partitions(spark, sf_dir):
    path = scratch_path(spark, "gold-dynamic")
    write_gold(spark, _funnel(spark, sf_dir), path, partition_cols=["month"])
    late = _funnel(spark, sf_dir, late_only=True).withColumn("total_bookings", F.col("total_bookings") + 1000)
    write_gold(spark, late, path, partition_cols=["month"], dynamic_partitions=True)
    return _read_funnel(spark, path, "month")


@register(
    "write_snapshot_publish",
    with_views(_FUNNEL.format(where=f"where {_LATE}"), "v_booking"),
    "SNK-5 SNK-6 SRC-6 (snapshot overwrite + catalog view swap)",
)
def q_write_snapshot_publish(spark, sf_dir):
    from lakepipe.sources.catalog import Layer

    path = scratch_path(spark, "gold-snapshot")
    name = "lakepipe_funnel_" + path.rsplit("-", 1)[-1]
    # The session's existing default schema: publishing a view there
    # creates no warehouse directory.
    layer = Layer("default")
    for late_only in (False, True):
        rep = write_gold(spark, _funnel(spark, sf_dir, late_only), path, partition_cols=["month"], snapshots=True)
        layer.publish(spark, name, rep.metrics["path"])
    return layer.read(spark, name).select(
        "date", "month", "total_bookings", "completed", "cancelled", "snapshot_date", "snapshot_ts")


@register("skip_if_empty", with_views(_FUNNEL.format(where=""), "v_booking"), "SNK-14 D22")
def q_skip_if_empty(spark, sf_dir):
    path = scratch_path(spark, "gold-skip")
    write_gold(spark, _funnel(spark, sf_dir), path, partition_cols=["month"])
    empty = _funnel(spark, sf_dir).filter(F.col("total_bookings") < 0)
    report = write_gold(spark, empty, path, partition_cols=["month"])
    assert report.action == "skipped-empty", report
    return _read_funnel(spark, path, "month")


# ------------------------------------------------------------------ bronze


@register(
    "bronze_append_evolve",
    """select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, cast(null as varchar) as o_orderpriority,
  date '2001-09-01' as ingest_date from orders where o_orderdate < timestamp '1998-01-01'
union all
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority,
  date '2001-10-01' as ingest_date from orders where o_orderdate >= timestamp '1998-01-01'""",
    "SNK-1 SNK-2",
)
def q_bronze_append_evolve(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    path = scratch_path(spark, "bronze-orders")
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp")
    append_bronze(o.filter(F.col("o_orderdate") < cut).drop("o_orderpriority"), path, "2001-09-01", "o_orderdate")
    append_bronze(o.filter(F.col("o_orderdate") >= cut), path, "2001-10-01", "o_orderdate")
    return read_bronze(spark, path).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "ingest_date")


# --------------------------------------------------------------- ingestion
# The "source database" is the driver tables; the first run sees the source
# as it was before a cut-off (rows changed later did not exist yet).

_CUT = "1998-01-01 00:00:00"
_SRC_SPECS = [
    TableSpec("orders", "o_orderdate", schedule="hourly"),
    TableSpec("lineitem", "l_shipdate", schedule="hourly"),
    TableSpec("customer", None, schedule="daily"),
    TableSpec("nation", None, schedule="weekly"),
]


def _source(spark, sf_dir, as_of_cut: bool):
    def src(spec, after=None):
        df = read_table(spark, sf_dir, spec.name)
        if as_of_cut and spec.updated_column:
            df = df.filter(F.col(spec.updated_column) < F.lit(_CUT).cast("timestamp"))
        return df

    return src


def _stored(spark, layout, names):
    """Whole bronze rows of several tables: the columns of each, under its name."""
    parts = [read_bronze(spark, layout.bronze(n)).withColumn("table_name", F.lit(n)) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


@register(
    "ingest_watermark",
    """select o.*, case when o_orderdate < timestamp '1998-01-01' then date '2001-09-01'
                      else date '2001-10-01' end as ingest_date from orders o""",
    "SRC-2 SRC-3 WM-1 WM-2 WM-3 WM-4 D13 D15",
)
def q_ingest_watermark(spark, sf_dir):
    root = scratch_path(spark, "lake")
    layout = LakeLayout(root)
    store = WatermarkStore(spark, layout.watermarks(), DAY2)
    spec = _SRC_SPECS[0]
    first = ingest_table(spark, spec, _source(spark, sf_dir, True), layout, store, "2001-09-01")
    second = ingest_table(spark, spec, _source(spark, sf_dir, False), layout, store, "2001-10-01")
    assert first.mode == "full" and second.mode == "incremental", (first, second)
    return read_bronze(spark, layout.bronze("orders"))


@register(
    "ingest_schedule_subset",
    """select *, 'orders' as table_name, date '2001-10-01' as ingest_date from orders
union all by name select *, 'lineitem' as table_name, date '2001-10-01' as ingest_date from lineitem""",
    "WM-5 WM-6",
)
def q_ingest_schedule_subset(spark, sf_dir):
    layout = LakeLayout(scratch_path(spark, "lake"))
    store = WatermarkStore(spark, layout.watermarks(), DAY2)
    res = ingest_all(spark, _SRC_SPECS, _source(spark, sf_dir, False), layout, store, "2001-10-01",
                     schedule="hourly", parallelism=2)
    return _stored(spark, layout, [r.table for r in res])


@register(
    "backfill_full",
    """select *, 'orders' as table_name, date '2001-09-01' as ingest_date from orders where o_orderdate < timestamp '1998-01-01'
union all by name select *, 'orders' as table_name, date '2001-10-01' as ingest_date from orders
union all by name select *, 'nation' as table_name, date '2001-09-01' as ingest_date from nation
union all by name select *, 'nation' as table_name, date '2001-10-01' as ingest_date from nation""",
    "WM-7 D21",
)
def q_backfill_full(spark, sf_dir):
    layout = LakeLayout(scratch_path(spark, "lake"))
    store = WatermarkStore(spark, layout.watermarks(), DAY2)
    specs = [_SRC_SPECS[0], _SRC_SPECS[3]]
    ingest_all(spark, specs, _source(spark, sf_dir, True), layout, store, "2001-09-01")
    backfill(spark, specs, _source(spark, sf_dir, False), layout, store, "2001-10-01")
    return _stored(spark, layout, ["orders", "nation"])


# --------------------------------------------------------------- streaming
# Raw bookings arrive as two file drops (shipped before / from 1998); each
# drop is processed by one run of the availableNow stream on the same
# checkpoint.  Keys seen in both drops: the later drop wins (default), or
# the newer updatedAt wins (guard_stale).

_B1 = "cast(bookingDate as timestamp) < timestamp '1998-01-01'"


def _stream_oracle(guarded: bool) -> str:
    clean = f"""select id, userId, sessionId, fitnessCenterId, try_cast(bookingDate as timestamp) bookingDate,
    upper(trim(status)) status, try_cast(createdAt as timestamp) createdAt,
    try_cast(updatedAt as timestamp) updatedAt,
    case when {_B1} then 1 else 2 end as drop_no
  from raw where userId is not null and sessionId is not null and fitnessCenterId is not null
    and try_cast(updatedAt as timestamp) is not null and id is not null"""
    order = "updatedAt desc, drop_no desc" if guarded else "drop_no desc, updatedAt desc"
    return f"""with raw as ({raw_sql('Booking')}), c as ({clean})
select id, userId, sessionId, fitnessCenterId, bookingDate, status, createdAt, updatedAt from (
  select *, row_number() over (partition by id order by {order}, userId, sessionId, fitnessCenterId,
    bookingDate, status, createdAt) rn from c) where rn = 1"""


def _run_booking_stream(spark, sf_dir, guarded: bool):
    raw = raw_frame(spark, sf_dir, "Booking")
    root = LakeLayout(scratch_path(spark, "lake"))
    bronze = root.bronze("Booking")
    table = BucketedTable(spark, root.silver("booking"), ["id"], 16)
    first = F.col("bookingDate").cast("timestamp") < F.lit("1998-01-01 00:00:00").cast("timestamp")
    for i, part in enumerate([raw.filter(first), raw.filter(~first | F.col("bookingDate").isNull())]):
        part.write.mode("append").parquet(bronze)
        stream = silver.clean_booking(read_bronze_stream(spark, bronze, root.schema_dir("Booking")))
        run_silver_once(stream, spark, root.checkpoint("silver", "booking"), table, "id", "updatedAt",
                        guard_stale=guarded, query_name=None)
    return table.read()


@register("stream_silver_booking", _stream_oracle(False), "SRC-5 SM-1 SM-2 SM-3 SM-4 SM-5 SM-6 SM-7")
def q_stream_silver_booking(spark, sf_dir):
    return _run_booking_stream(spark, sf_dir, False)


@register("stream_upsert_guarded", _stream_oracle(True), "SM-6 SM-7 D9")
def q_stream_upsert_guarded(spark, sf_dir):
    return _run_booking_stream(spark, sf_dir, True)


# -------------------------------------------------------------------- seed


def _write_seed_csv(spark, sf_dir, path):
    o = read_table(spark, sf_dir, "orders")
    messy = o.select(
        F.col("o_custkey").alias(" Customer_Key "),
        F.col("o_orderstatus").alias("Order_Status"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("Order_Purchase_Timestamp "),
        F.when(F.col("o_orderpriority").startswith("1"), F.lit("not a date"))
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Order_Delivered_Date"),
    )
    # Every row twice: the copies must disappear.
    messy.unionAll(messy).write.mode("overwrite").option("header", "true").csv(path)


_SEED_ROWS = """select distinct cast(o_custkey as varchar) as customer_key, o_orderstatus as order_status,
  o_orderdate as order_purchase_timestamp,
  case when o_orderpriority like '1%' then null else cast(cast(o_orderdate as date) as timestamp) end
    as order_delivered_date
from orders"""


@register("seed_normalise", _SEED_ROWS, "SRC-7 SRC-8 AG-12")
def q_seed_normalise(spark, sf_dir):
    path = scratch_path(spark, "seed-orders")
    _write_seed_csv(spark, sf_dir, path)
    df = seed_normalise(read_csv_seed(spark, path), pk="order_id")
    return df.drop("order_id")


# --------------------------------------------------------------- end to end
# Raw bookings -> bronze (append) -> silver stream (clean, latest per key,
# upsert) -> gold funnel written partitioned by date -> read back.


def _e2e_oracle() -> str:

    order = "updatedAt desc nulls last, userId, sessionId, fitnessCenterId, bookingDate, status, createdAt"
    return f"""with c as ({SILVER_ORACLES['booking']}),
s as (select * from (select *, row_number() over (partition by id order by {order}) rn from c) where rn = 1)
select cast(createdAt as date) as date, count(*) as total_bookings,
  cast(sum(case when status = 'COMPLETED' then 1 else 0 end) as bigint) as completed,
  cast(sum(case when status = 'CANCELLED' then 1 else 0 end) as bigint) as cancelled,
  date '2001-10-01' as snapshot_date, timestamp '2001-10-01 00:00:00' as snapshot_ts
from s group by 1"""


@register("e2e_booking_funnel", _e2e_oracle(), "§3 end to end: SNK-1 SRC-5 SM-2 SNK-4 SNK-5 SNK-8")
def q_e2e_booking_funnel(spark, sf_dir):
    from lakepipe.plans.gold import run_gold
    from lakepipe.streaming.silver_stream import run_silver_tables

    lake = LakeLayout(scratch_path(spark, "lake"))
    append_bronze(raw_frame(spark, sf_dir, "Booking"), lake.bronze("Booking"), "2001-10-01")
    spec = silver.SILVER_SPECS["booking"]
    tables = run_silver_tables(spark, lake, [spec], lambda s: BucketedTable(spark, lake.silver(s.entity), ["id"], 16))
    run_gold(spark, lambda e: tables[e].read(), lake.gold, CLOCK, names=["gold_booking_funnel"])
    return _read_funnel(spark, lake.gold("gold_booking_funnel"))


@register(
    "stream_evolve_user_info",
    f"""select s.*, case when id % 2 = 0 then 'c' || cast(id % 5 as varchar) end as city
from ({SILVER_ORACLES["user_info"]}) s""",
    "SRC-5 SNK-2 SM-2 (a column that appears in the second drop)",
)
def q_stream_evolve_user_info(spark, sf_dir):
    from lakepipe.streaming.silver_stream import run_silver_tables

    raw = raw_frame(spark, sf_dir, "UserInfo")
    late = F.col("id") % 2 == 0
    city = F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))
    lake = LakeLayout(scratch_path(spark, "lake"))
    spec = silver.SilverSpec("user_info", "UserInfo", lambda df: silver.clean_user_info(df, CLOCK))
    drops = [("2001-10-01", raw.filter(~late)), ("2001-10-02", raw.filter(late).withColumn("city", city))]
    for day, drop in drops:
        append_bronze(drop, lake.bronze("UserInfo"), day)
        tables = run_silver_tables(
            spark, lake, [spec], lambda s: BucketedTable(spark, lake.silver(s.entity), ["id"], 16))
    return tables["user_info"].read()
