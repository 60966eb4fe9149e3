"""Streaming queries: event-time windows with late rows aside, stream-stream join, keyed state.

Events arrive in four drops, by day of the month; every eleventh comes two
drops late.  Each drop is one run of the stream over the same checkpoints.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.plans import fixtures as fx
from lakepipe.plans.catalog import register
from lakepipe.plans.fixtures import Tables, read_table, with_views
from lakepipe.session import scratch_path
from lakepipe.sinks.tables import BucketedTable
from lakepipe.sinks.writers import upsert
from lakepipe.sources.rescue import run_rescuing_stream
from lakepipe.streaming.late import split_late
from lakepipe.streaming.windows import event_windows, join_within, latest_rows, run_to_table

_DROPS = 4
_DROP = "least(3, (extract('day' from ts) - 1) // 8 + case when event_id % 11 = 0 then 2 else 0 end)"
# What the stream should make of the drops: rows behind the greatest time of earlier drops less two days are late.
_SPLIT = f"""drops as (select *, {_DROP} as d from events),
marks as (select d, max(max(ts)) over (order by d rows between unbounded preceding and 1 preceding) - interval 2 days as mark from drops group by d),
split as (select drops.*, coalesce(ts < mark, false) or ts is null as late from drops join marks using (d)),
done as (select max(ts) - interval 2 days as mark from events)"""


def _arrivals(spark, sf_dir):
    """The events split into accepted and late rows, drop by drop; the root folder and the events' schema."""
    root = scratch_path(spark, "event-stream")
    events = read_table(spark, sf_dir, "events")
    day = F.floor((F.dayofmonth("ts") - 1) / 8)
    late = F.when(F.col("event_id") % 11 == 0, 2).otherwise(0)
    dropped = events.withColumn("_drop", F.least(F.lit(_DROPS - 1), day + late).cast("int"))
    for d in range(_DROPS):
        dropped.where(F.col("_drop") == d).drop("_drop").write.parquet(f"{root}/in/drop={d}")
        source = spark.readStream.schema(events.schema).parquet(f"{root}/in/drop=*")
        split_late(source, spark, "ts", 2 * 86_400, f"{root}/accepted", f"{root}/late", f"{root}/split").awaitTermination()
    return root, events.schema


def _windows(spark, sf_dir, keys, **shape):
    root, schema = _arrivals(spark, sf_dir)
    accepted = spark.readStream.schema(schema).parquet(f"{root}/accepted/batch=*")
    cents = F.col("value").cast("decimal(18,2)")
    aggs = [F.count(F.lit(1)).alias("n"), F.sum(cents).cast("double").alias("total")]
    run_to_table(event_windows(accepted, "ts", "2 days", aggs, keys, **shape), f"{root}/windows", f"{root}/windows-checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/windows")


@register(
    "stream_tumbling_windows",
    f"""with {_SPLIT}
select date_trunc('day', ts)::timestamp window_start, date_trunc('day', ts)::timestamp + interval 1 day window_end, event_type, count(*) n,
  cast(sum(cast(value as decimal(18,2))) as double) total
from split, done where not late and date_trunc('day', ts) + interval 1 day <= done.mark group by 1, 2, 3""",
    "event-time windows with a watermark: tumbling",
)
def q_stream_tumbling_windows(spark, sf_dir):
    return _windows(spark, sf_dir, ["event_type"], length="1 day")


@register(
    "stream_sliding_windows",
    f"""with {_SPLIT},
w as (select date_trunc('day', ts)::timestamp - to_days(k) window_start, event_type, value from split, (values (0), (1), (2)) s(k) where not late)
select window_start, window_start + interval 3 days window_end, event_type, count(*) n, cast(sum(cast(value as decimal(18,2))) as double) total
from w, done where window_start + interval 3 days <= done.mark group by 1, 2, 3""",
    "event-time windows with a watermark: sliding",
)
def q_stream_sliding_windows(spark, sf_dir):
    return _windows(spark, sf_dir, ["event_type"], length="3 days", slide="1 day")


@register(
    "stream_session_windows",
    f"""with {_SPLIT},
f as (select *, case when ts - lag(ts) over w < interval 36 hours then 0 else 1 end opens from split where not late window w as (partition by user_id order by ts)),
s as (select *, sum(opens) over (partition by user_id order by ts rows unbounded preceding) no from f)
select min(ts) window_start, max(ts) + interval 36 hours window_end, user_id, count(*) n, cast(sum(cast(value as decimal(18,2))) as double) total
from s, done group by user_id, no having max(ts) + interval 36 hours <= max(done.mark)""",
    "event-time windows with a watermark: sessions",
)
def q_stream_session_windows(spark, sf_dir):
    return _windows(spark, sf_dir, ["user_id"], gap="36 hours")


@register(
    "stream_late_rows",
    f"with {_SPLIT} select event_id, ts, user_id, event_type, value, props from split where late",
    "late rows of a stream in a side table",
)
def q_stream_late_rows(spark, sf_dir):
    root, schema = _arrivals(spark, sf_dir)
    return spark.read.schema(schema).parquet(f"{root}/late/batch=*")


@register(
    "stream_keyed_latest",
    f"""with {_SPLIT}
select event_id, ts, user_id, event_type, value, props from split where not late and user_id is not null
qualify row_number() over (partition by user_id order by ts desc, event_id, event_type, value, props) = 1""",
    "custom keyed state with timers: latest row per key across micro-batches, without reading the target for stale rows",
)
def q_stream_keyed_latest(spark, sf_dir):
    root, schema = _arrivals(spark, sf_dir)
    table = BucketedTable(spark, f"{root}/latest", ["user_id"], 16)
    accepted = spark.readStream.schema(schema).parquet(f"{root}/accepted/batch=*")

    def keep(batch, n):
        upsert(spark, batch.where("fresh").drop("fresh"), table, "user_id", "ts")

    changes = latest_rows(accepted, "user_id", "ts", "2 days")
    changes.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", f"{root}/latest-checkpoint").trigger(availableNow=True).start().awaitTermination()
    return table.read()


@register(
    "stream_join_payment_booking",
    with_views(
        """, done as (select least((select max(createdAt) from v_payment), (select max(createdAt) from v_booking)) - interval 132 hours as mark),
m as (select p.id paymentId, p.userId, p.createdAt paidAt, b.id bookingId, b.createdAt bookedAt from v_payment p left join v_booking b
  on p.userId = b.userId and b.createdAt >= p.createdAt and b.createdAt <= p.createdAt + interval 30 days)
select m.* from m, done where bookingId is not null or paidAt + interval 30 days < done.mark""",
        "v_payment",
        "v_booking",
    ),
    "stream-stream join within an interval, unmatched rows after the watermark",
)
def q_stream_join_payment_booking(spark, sf_dir):
    t = Tables(spark, sf_dir)
    root = scratch_path(spark, "stream-join")
    payments = fx.v_payment(t).select(F.col("id").alias("paymentId"), "userId", F.col("createdAt").alias("paidAt"))
    bookings = fx.v_booking(t).select(F.col("id").alias("bookingId"), "userId", F.col("createdAt").alias("bookedAt"))
    payments.write.parquet(f"{root}/payments")
    bookings.write.parquet(f"{root}/bookings")
    left = spark.readStream.schema(payments.schema).parquet(f"{root}/payments")
    right = spark.readStream.schema(bookings.schema).parquet(f"{root}/bookings")
    joined = join_within(left, right, ["userId"], "paidAt", "bookedAt", dt.timedelta(days=30), "132 hours")
    run_to_table(joined, f"{root}/joined", f"{root}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{root}/joined").select("paymentId", "userId", "paidAt", "bookingId", "bookedAt")


@register(
    "stream_rescued_rows",
    """select o_orderkey id, case when o_orderkey % 3 = 1 and o_orderkey % 5 = 0 then null else o_totalprice end amount,
  case when o_orderkey % 3 = 2 then cast(o_orderkey % 4 as varchar) else o_orderstatus end status,
  case when o_orderkey % 3 = 1 and o_orderkey % 5 = 0 then '{"amount":"n/a"}'
    when o_orderkey % 3 = 2 and o_orderkey % 7 > 0 then '{"channel":"c' || o_orderkey % 7 || '"}' end _rescued_data
from orders""",
    "SRC-5 rescued data: files whose types and columns drift",
)
def q_stream_rescued_rows(spark, sf_dir):
    root = scratch_path(spark, "rescue")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    orders = read_table(spark, sf_dir, "orders")
    drops = [
        orders.where(key % 3 == 0).select(key.alias("id"), price.alias("amount"), F.col("o_orderstatus").alias("status")),
        orders.where(key % 3 == 1).select(key.alias("id"), F.when(key % 5 == 0, "n/a").otherwise(price.cast("string")).alias("amount"), F.col("o_orderstatus").alias("status")),
        orders.where(key % 3 == 2).select(
            key.cast("int").alias("id"), price.alias("amount"), (key % 4).alias("status"), F.when(key % 7 > 0, F.concat(F.lit("c"), (key % 7).cast("string"))).alias("channel")
        ),
    ]
    schema = T.StructType.fromDDL("id bigint, amount double, status string")

    def append(batch, n):
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={n}")

    for drop in drops:
        drop.write.mode("append").parquet(f"{root}/in")
        run_rescuing_stream(spark, f"{root}/in", schema, f"{root}/checkpoint", append).awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch")
