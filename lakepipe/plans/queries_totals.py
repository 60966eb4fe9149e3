"""Queries of several groupings at once, sketches that roll up, JSON of drifting shape and co-located tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakepipe.functions.semi import typed_fields
from lakepipe.operators.rollups import merge_sketches, pivoted, sketch_estimates, sketch_groups, totals
from lakepipe.plans import fixtures as fx
from lakepipe.plans.catalog import register
from lakepipe.plans.fixtures import Tables, read_table, with_views
from lakepipe.session import scratch_path
from lakepipe.sinks.colocated import write_colocated

def _money():
    return F.col("amount").cast("decimal(18,2)")


_PAID = "select fitnessCenterId center, cast(createdAt as date) as day, status, cast(amount as decimal(18,2)) amount from v_payment"


def _totals(spark, sf_dir, by, sets):
    known = {"center": F.col("fitnessCenterId"), "day": F.col("createdAt").cast("date"), "status": F.col("status")}
    out = totals(fx.v_payment(Tables(spark, sf_dir)), {k: known[k] for k in by}, {"revenue": _money(), "n": F.lit(1)}, sets)
    return out.withColumn("revenue", F.col("revenue").cast("double"))


@register(
    "totals_cube",
    with_views(
        f"""select center, status, grouping_id(center, status) grouping_id, cast(sum(amount) as double) revenue, count(*) n
from ({_PAID}) group by cube (center, status)""",
        "v_payment",
    ),
    "cube",
)
def q_totals_cube(spark, sf_dir):
    return _totals(spark, sf_dir, ["center", "status"], "cube")


@register(
    "totals_rollup",
    with_views(
        f"""select center, day, grouping_id(center, day) grouping_id, cast(sum(amount) as double) revenue, count(*) n
from ({_PAID}) group by rollup (center, day)""",
        "v_payment",
    ),
    "rollup: revenue by center and date with totals",
)
def q_totals_rollup(spark, sf_dir):
    return _totals(spark, sf_dir, ["center", "day"], "rollup")


@register(
    "totals_grouping_sets",
    with_views(
        f"""select center, day, status, grouping_id(center, day, status) grouping_id, cast(sum(amount) as double) revenue, count(*) n
from ({_PAID}) group by grouping sets ((center, status), (day), ())""",
        "v_payment",
    ),
    "grouping sets",
)
def q_totals_grouping_sets(spark, sf_dir):
    return _totals(spark, sf_dir, ["center", "day", "status"], [["center", "status"], ["day"], []])


@register(
    "pivot_center_status",
    with_views(
        """select fitnessCenterId center, cast(sum(case status when 'SUCCESS' then cast(amount as decimal(18,2)) end) as double) "SUCCESS",
  cast(sum(case status when 'PENDING' then cast(amount as decimal(18,2)) end) as double) "PENDING",
  cast(sum(case status when 'FAILED' then cast(amount as decimal(18,2)) end) as double) "FAILED" from v_payment group by 1""",
        "v_payment",
    ),
    "pivot",
)
def q_pivot_center_status(spark, sf_dir):
    paid = fx.v_payment(Tables(spark, sf_dir)).select(F.col("fitnessCenterId").alias("center"), "status", "amount")
    out = pivoted(paid, ["center"], "status", ["SUCCESS", "PENDING", "FAILED"], _money())
    return out.withColumns({c: F.col(c).cast("double") for c in ("SUCCESS", "PENDING", "FAILED")})


@register(
    "sketch_monthly_payers",
    with_views(
        """select date_trunc('month', createdAt)::date as month, count(*) n, count(distinct userId) payers,
  true as distinct_in_bound, true as median_in_bound, true as p90_in_bound from v_payment group by 1""",
        "v_payment",
    ),
    "mergeable sketches: daily HLL and KLL columns rolled up to months, within their error bounds",
)
def q_sketch_monthly_payers(spark, sf_dir):
    paid = fx.v_payment(Tables(spark, sf_dir)).select("userId", "amount", "createdAt")
    path = scratch_path(spark, "sketches")
    sketch_groups(paid, [F.col("createdAt").cast("date").alias("day")], F.col("userId"), F.col("amount")).write.parquet(path)
    monthly = merge_sketches(spark.read.parquet(path), [F.trunc("day", "month").alias("month")])
    said = sketch_estimates(monthly, ["month"], {"median": 0.5, "p90": 0.9})
    month = F.trunc(F.col("createdAt").cast("date"), "month").alias("month")
    payers = paid.groupBy(month).agg(F.countDistinct("userId").alias("payers"))
    # The share of amounts at or below an estimate is its true rank.
    ranks = paid.withColumn("month", month).join(said, "month").groupBy("month").agg(
        *[F.avg((F.col("amount") <= F.col(c)).cast("double")).alias(f"{c}_rank") for c in ("median", "p90")],
        *[F.avg((F.col("amount") < F.col(c)).cast("double")).alias(f"{c}_below") for c in ("median", "p90")],
    )
    error = 0.03
    return said.join(payers, "month").join(ranks, "month").select(
        "month",
        "n",
        "payers",
        (F.abs(F.col("distinct") - F.col("payers")) <= 0.03 * F.col("payers")).alias("distinct_in_bound"),
        ((F.col("median_below") <= 0.5 + error) & (F.col("median_rank") >= 0.5 - error)).alias("median_in_bound"),
        ((F.col("p90_below") <= 0.9 + error) & (F.col("p90_rank") >= 0.9 - error)).alias("p90_in_bound"),
    )


# Properties whose shape drifts: numbers, numbers as text, nested objects, text that is no number, broken JSON, none.
_DRIFT = """case event_id % 6 when 0 then props when 1 then '{"k": "' || user_id || '", "v": ' || event_id || '}'
  when 2 then '{"k": {"id": ' || user_id || '}, "tags": ["a", "' || event_type || '"]}' when 3 then '{"k": "n/a", "v": null}'
  when 4 then '{"k": ' || event_id end"""


@register(
    "variant_event_props",
    f"""with d as (select event_id, {_DRIFT} as raw from events),
j as (select event_id, raw, case when json_valid(raw) then raw::json end as doc from d)
select event_id, try_cast(doc->>'$.k' as bigint) k, try_cast(doc->>'$.v' as bigint) v, doc->>'$.tags[1]' tag, try_cast(doc->>'$.k.id' as bigint) nested,
  case when raw is not null and doc is null then raw
    when doc->>'$.k' is not null and try_cast(doc->>'$.k' as bigint) is null then raw end as rejected
from j""",
    "nested and semi-structured columns: variant parsing, typed extraction, rejects kept as text",
)
def q_variant_event_props(spark, sf_dir):
    events = read_table(spark, sf_dir, "events").select("event_id", F.expr(_DRIFT).alias("raw"))
    fields = {"k": ("$.k", "bigint"), "v": ("$.v", "bigint"), "tag": ("$.tags[1]", "string"), "nested": ("$.k.id", "bigint")}
    return typed_fields(events, "raw", fields, rejected="rejected").drop("raw")


@register(
    "colocated_user_activity",
    with_views(
        """, p as (select userId, count(*) payments, sum(cast(amount as decimal(18,2))) paid from v_payment where userId is not null group by 1),
b as (select userId, count(*) bookings from v_booking where userId is not null group by 1)
select userId, bookings, payments, cast(paid as double) paid from p join b using (userId)""",
        "v_payment",
        "v_booking",
    ),
    "co-located bucketed tables: joined and aggregated without an exchange",
)
def q_colocated_user_activity(spark, sf_dir):
    t = Tables(spark, sf_dir)
    payments = write_colocated(fx.v_payment(t).where("userId is not null").select("id", "userId", "amount"), "payment", ["userId"], 16, ["userId"])
    bookings = write_colocated(fx.v_booking(t).where("userId is not null").select("id", "userId"), "booking", ["userId"], 16, ["userId"])
    paid = payments.groupBy("userId").agg(F.count(F.lit(1)).alias("payments"), F.sum(_money()).cast("double").alias("paid"))
    booked = bookings.groupBy("userId").agg(F.count(F.lit(1)).alias("bookings"))
    return booked.hint("merge").join(paid, "userId").select("userId", "bookings", "payments", "paid")
