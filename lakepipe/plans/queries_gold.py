"""Gold KPI queries and the join / aggregate probes they are built from."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakepipe.operators.scalar import append_scalar_row
from lakepipe.plans import fixtures as fx
from lakepipe.plans import gold
from lakepipe.plans.catalog import CLOCK, SNAPSHOT_SQL, register, sround
from lakepipe.plans.fixtures import Tables, with_views

# --------------------------------------------------------------- gold tables


@register(
    "gold_booking_funnel",
    with_views(
        f"""select cast(createdAt as date) as date, count(*) as total_bookings,
  cast(sum(case when status = 'COMPLETED' then 1 else 0 end) as bigint) as completed,
  cast(sum(case when status = 'CANCELLED' then 1 else 0 end) as bigint) as cancelled,
  {SNAPSHOT_SQL}
from v_booking group by 1""",
        "v_booking",
    ),
    "AG-1 AG-3 AG-6 DT-2 PRJ-10",
)
def q_gold_booking_funnel(spark, sf_dir):
    return gold.booking_funnel(fx.v_booking(Tables(spark, sf_dir)), CLOCK)


@register(
    "gold_center_revenue",
    with_views(
        f"""select fitnessCenterId, cast(createdAt as date) as date,
  cast(sum(cast(amount as decimal(38,2))) as double) as daily_revenue, count(distinct userId) as paying_users,
  count(*) as transactions, {SNAPSHOT_SQL}
from v_payment where status = 'SUCCESS' and userId is not null group by 1, 2""",
        "v_payment",
    ),
    "FLT-4 AG-2 AG-5 AG-7",
)
def q_gold_center_revenue(spark, sf_dir):
    return gold.center_revenue(fx.v_payment(Tables(spark, sf_dir)), CLOCK)


_MRR_SQL = """mrr_parts as (
  select cast(sum(case when durationDays >= 365 then cast(price as decimal(38,2)) end) as double) y,
         cast(sum(case when durationDays >= 90 and durationDays < 365 then cast(price as decimal(38,2)) end) as double) q,
         cast(sum(case when durationDays is null or durationDays < 90 then cast(price as decimal(38,2)) end) as double) m,
         count(distinct s.fitnessCenterId) active_centers
  from v_sub s left join v_plan p on s.membershipPlanId = p.id
  where s.status = 'ACTIVE'),
mrr as (
  select case when y is null and q is null and m is null then null
              else coalesce(y / 12, 0.0) + coalesce(q / 3, 0.0) + coalesce(m, 0.0) end as MRR,
         active_centers
  from mrr_parts)"""


@register(
    "gold_subscription_metrics",
    with_views(
        f"""select d.date, d.daily_platform_revenue, mrr.MRR, mrr.active_centers,
  mrr.MRR * 12 as ARR,
  {sround("mrr.MRR / nullif(mrr.active_centers, 0)", 2)} as avg_revenue_per_center,
  {SNAPSHOT_SQL}
from (select cast(createdAt as date) as date, cast(sum(cast(amount as decimal(38,2))) as double) as daily_platform_revenue
      from v_payment where userId is null and status = 'SUCCESS' group by 1) d
cross join mrr""",
        "v_payment",
        "v_sub",
        "v_plan",
    ).replace("\nselect d.date", f",\n{_MRR_SQL}\nselect d.date", 1),
    "FLT-3 FLT-4 JN-4 JN-6 CD-2 AG-8 MA-1 MA-3",
)
def q_gold_subscription_metrics(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return gold.platform_subscription_metrics(fx.v_payment(t), fx.v_sub(t), fx.v_plan(t), CLOCK)


@register(
    "gold_session_utilization",
    with_views(
        f"""select s.id as session_id, s.fitnessCenterId, s.startTime, s.endTime, s.availableSlots,
  coalesce(b.booked_count, 0) as booked_count,
  case when s.availableSlots is null or s.availableSlots = 0 then 0.0
       else {sround("coalesce(b.booked_count, 0) / s.availableSlots * 100", 2)} end as utilization_percentage,
  {SNAPSHOT_SQL}
from v_session s left join (select sessionId, count(id) as booked_count from v_booking group by 1) b
  on s.id = b.sessionId""",
        "v_session",
        "v_booking",
    ),
    "JN-1 AG-4 CD-3 FLT-5 PRJ-3 MA-1",
)
def q_gold_session_utilization(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return gold.session_utilization(fx.v_session(t), fx.v_booking(t), CLOCK)


@register(
    "gold_user_ltv",
    with_views(
        f"""select u.*, coalesce(r.total_spend, 0.0) as total_spend, r.total_txn,
  coalesce(b.total_bookings, 0) as total_bookings, {SNAPSHOT_SQL}
from v_user u
left join (select userId, cast(sum(cast(amount as decimal(38,2))) as double) as total_spend, count(*) as total_txn
           from v_payment where status = 'SUCCESS' group by 1) r on u.id = r.userId
left join (select userId, count(*) as total_bookings from v_booking group by 1) b on u.id = b.userId""",
        "v_user",
        "v_payment",
        "v_booking",
    ),
    "JN-5 PRJ-8 CD-5",
)
def q_gold_user_ltv(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return gold.user_lifetime_value(fx.v_user(t), fx.v_payment(t), fx.v_booking(t), CLOCK)


_LIFECYCLE_SQL = f"""select f.id as fitnessCenterId, f.name, f.lastLoginAt,
  fs.first_subscription_date, r.total_revenue, uc.total_users, bc.total_bookings,
  case when f.lastLoginAt is null then 999
       else date_diff('day', cast(f.lastLoginAt as date), date '2001-10-01') end as days_since_login,
  case when fs.first_subscription_date is null then 'ONBOARDING'
       when (case when f.lastLoginAt is null then 999
                  else date_diff('day', cast(f.lastLoginAt as date), date '2001-10-01') end) > 60 then 'AT_RISK'
       else 'ACTIVE' end as lifecycle_stage,
  {SNAPSHOT_SQL}
from v_fc f
left join (select fitnessCenterId, min(createdAt) as first_subscription_date from v_sub group by 1) fs
  on f.id = fs.fitnessCenterId
left join (select fitnessCenterId, cast(sum(cast(amount as decimal(38,2))) as double) as total_revenue from v_payment
           where status = 'SUCCESS' group by 1) r on f.id = r.fitnessCenterId
left join (select fitnessCenterId, count(*) as total_users from v_user group by 1) uc
  on f.id = uc.fitnessCenterId
left join (select u.fitnessCenterId, count(*) as total_bookings
           from v_booking b left join v_user u on b.userId = u.id group by 1) bc
  on f.id = bc.fitnessCenterId"""


@register(
    "gold_center_lifecycle",
    with_views(_LIFECYCLE_SQL, "v_fc", "v_sub", "v_payment", "v_user", "v_booking"),
    "JN-2 JN-3 AG-9 PRJ-4 PRJ-5 DT-3 CD-2",
)
def q_gold_center_lifecycle(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return gold.fitnesscenter_lifecycle(
        fx.v_fc(t), fx.v_sub(t), fx.v_payment(t), fx.v_user(t), fx.v_booking(t), CLOCK
    )


# ------------------------------------------------------ join / agg probes


@register(
    "join_left_expr",
    with_views(
        """select s.id, s.availableSlots, b.sessionId, b.n
from v_session s left join (select sessionId, count(*) as n from v_booking group by 1) b
  on s.id = b.sessionId""",
        "v_session",
        "v_booking",
    ),
    "JN-1",
)
def q_join_left_expr(spark, sf_dir):
    t = Tables(spark, sf_dir)
    s = fx.v_session(t).select("id", "availableSlots")
    b = fx.v_booking(t).groupBy("sessionId").agg(F.count(F.lit(1)).alias("n"))
    return s.join(b, s.id == b.sessionId, "left")


@register(
    "join_left_using_chain",
    with_views(
        """select f.id as fitnessCenterId, f.name, a.n_subs, b.n_users, c.n_payments
from v_fc f
left join (select fitnessCenterId, count(*) n_subs from v_sub group by 1) a on f.id = a.fitnessCenterId
left join (select fitnessCenterId, count(*) n_users from v_user group by 1) b on f.id = b.fitnessCenterId
left join (select fitnessCenterId, count(*) n_payments from v_payment group by 1) c
  on f.id = c.fitnessCenterId""",
        "v_fc",
        "v_sub",
        "v_user",
        "v_payment",
    ),
    "JN-2 PRJ-5",
)
def q_join_left_using_chain(spark, sf_dir):
    t = Tables(spark, sf_dir)
    cnt = lambda df, name: df.groupBy("fitnessCenterId").agg(F.count(F.lit(1)).alias(name))
    return (
        fx.v_fc(t).select("id", "name").withColumnRenamed("id", "fitnessCenterId")
        .join(cnt(fx.v_sub(t), "n_subs"), "fitnessCenterId", "left")
        .join(cnt(fx.v_user(t), "n_users"), "fitnessCenterId", "left")
        .join(cnt(fx.v_payment(t), "n_payments"), "fitnessCenterId", "left")
    )


@register(
    "join_cross_scalar",
    with_views(
        """select d.date, d.n, m.total_n
from (select cast(createdAt as date) as date, count(*) as n from v_booking group by 1) d
cross join (select count(*) as total_n from v_booking) m""",
        "v_booking",
    ),
    "JN-6",
)
def q_join_cross_scalar(spark, sf_dir):
    b = fx.v_booking(Tables(spark, sf_dir))
    daily = b.groupBy(F.to_date("createdAt").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    one = b.agg(F.count(F.lit(1)).alias("total_n"))  # global aggregate: one row
    return append_scalar_row(daily, one)


@register(
    "booking_with_center",
    with_views(
        """select b.*, u.fitnessCenterId from v_booking b left join v_user u on b.userId = u.id""",
        "v_booking",
        "v_user",
    ),
    "JN-3 PRJ-4",
)
def q_booking_with_center(spark, sf_dir):
    t = Tables(spark, sf_dir)
    return gold.booking_with_center(fx.v_booking(t), fx.v_user(t))


@register(
    "agg_count_col",
    with_views(
        "select fitnessCenterId, count(availableSlots) as n_with_slots, count(*) as n from v_session group by 1",
        "v_session",
    ),
    "AG-4",
)
def q_agg_count_col(spark, sf_dir):
    return fx.v_session(Tables(spark, sf_dir)).groupBy("fitnessCenterId").agg(
        F.count("availableSlots").alias("n_with_slots"), F.count(F.lit(1)).alias("n")
    )


@register(
    "agg_conditional",
    with_views(
        """select sessionId, cast(sum(case when status = 'COMPLETED' then 1 else 0 end) as bigint) as completed,
  count(*) filter (where status = 'CANCELLED') as cancelled from v_booking group by 1""",
        "v_booking",
    ),
    "AG-6",
)
def q_agg_conditional(spark, sf_dir):
    return fx.v_booking(Tables(spark, sf_dir)).groupBy("sessionId").agg(
        F.sum(F.when(F.col("status") == "COMPLETED", 1).otherwise(0)).alias("completed"),
        F.count_if(F.col("status") == "CANCELLED").alias("cancelled"),
    )


@register(
    "agg_distinct_grouped",
    with_views(
        """select fitnessCenterId, status, count(distinct userId) as users, count(*) as n
from v_payment group by 1, 2""",
        "v_payment",
    ),
    "AG-7",
)
def q_agg_distinct_grouped(spark, sf_dir):
    return fx.v_payment(Tables(spark, sf_dir)).groupBy("fitnessCenterId", "status").agg(
        F.count_distinct("userId").alias("users"), F.count(F.lit(1)).alias("n")
    )


@register(
    "agg_distinct_global",
    with_views(
        """select count(distinct fitnessCenterId) as centers, count(distinct userId) as users,
  cast(sum(cast(amount as decimal(38,2))) as double) as total from v_payment where status = 'SUCCESS'""",
        "v_payment",
    ),
    "AG-8",
)
def q_agg_distinct_global(spark, sf_dir):
    return fx.v_payment(Tables(spark, sf_dir)).filter(F.col("status") == "SUCCESS").agg(
        F.count_distinct("fitnessCenterId").alias("centers"),
        F.count_distinct("userId").alias("users"),
        gold.money_sum("amount").alias("total"),
    )


@register(
    "agg_min_ts",
    with_views(
        """select fitnessCenterId, min(createdAt) as first_at, max(createdAt) as last_at
from v_payment group by 1""",
        "v_payment",
    ),
    "AG-9",
)
def q_agg_min_ts(spark, sf_dir):
    return fx.v_payment(Tables(spark, sf_dir)).groupBy("fitnessCenterId").agg(
        F.min("createdAt").alias("first_at"), F.max("createdAt").alias("last_at")
    )
