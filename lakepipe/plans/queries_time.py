"""Queries over time and order: as-of, interval and range joins, gaps, sessions, rolling sums, exact positions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from lakepipe.operators.asof import asof_join
from lakepipe.operators.interval_join import interval_join
from lakepipe.operators.ordering import exact_quantiles, global_rank, global_row_number
from lakepipe.operators.sessions import rolling_sum, sessionize, with_previous
from lakepipe.plans import fixtures as fx
from lakepipe.plans.catalog import register
from lakepipe.plans.fixtures import Tables, read_table, with_views

# ------------------------------------------------------------------- as-of


@register(
    "asof_event_order",
    """select event_id, user_id, ts, o_orderdate, o_orderkey, o_totalprice
from events e asof left join (
  select * from orders where o_custkey is not null and o_orderdate is not null
  qualify row_number() over (partition by o_custkey, o_orderdate order by o_orderkey desc) = 1) o
on e.user_id = o.o_custkey and e.ts >= o.o_orderdate""",
    "as-of join",
)
def q_asof_event_order(spark, sf_dir):
    t = Tables(spark, sf_dir)
    orders = t.orders.select(F.col("o_custkey").alias("user_id"), "o_orderdate", "o_orderkey", "o_totalprice")
    return asof_join(t.events.select("event_id", "user_id", "ts"), orders, "user_id", "ts", "o_orderdate")


@register(
    "asof_booking_payment",
    with_views(
        """, p as (
  select userId, createdAt paidAt, id paymentId, amount from v_payment where userId is not null and createdAt is not null
  qualify row_number() over (partition by userId, createdAt order by id desc) = 1),
m as (select b.id, b.userId, b.createdAt, p.paidAt, p.paymentId, p.amount
  from v_booking b asof left join p on b.userId = p.userId and b.createdAt >= p.paidAt)
select id, userId, createdAt,
  case when createdAt - paidAt <= interval 365 days then paidAt end paidAt,
  case when createdAt - paidAt <= interval 365 days then paymentId end paymentId,
  case when createdAt - paidAt <= interval 365 days then amount end amount from m""",
        "v_booking",
        "v_payment",
    ),
    "as-of join with a tolerance, NULL keys kept",
)
def q_asof_booking_payment(spark, sf_dir):
    t = Tables(spark, sf_dir)
    paid = fx.v_payment(t).select("userId", F.col("createdAt").alias("paidAt"), F.col("id").alias("paymentId"), "amount")
    bookings = fx.v_booking(t).select("id", "userId", "createdAt")
    return asof_join(bookings, paid, "userId", "createdAt", "paidAt", tolerance=dt.timedelta(days=365))


@register(
    "asof_payment_next_booking",
    with_views(
        """, b as (
  select userId, createdAt bookedAt, id bookingId from v_booking where userId is not null and createdAt is not null
  qualify row_number() over (partition by userId, createdAt order by id desc) = 1)
select p.id, p.userId, p.createdAt, b.bookedAt, b.bookingId
from v_payment p asof join b on p.userId = b.userId and p.createdAt < b.bookedAt""",
        "v_booking",
        "v_payment",
    ),
    "as-of join forward, strictly later, inner",
)
def q_asof_payment_next_booking(spark, sf_dir):
    t = Tables(spark, sf_dir)
    booked = fx.v_booking(t).select("userId", F.col("createdAt").alias("bookedAt"), F.col("id").alias("bookingId"))
    payments = fx.v_payment(t).select("id", "userId", "createdAt")
    return asof_join(payments, booked, "userId", "createdAt", "bookedAt", direction="forward", allow_equal=False, how="inner")


# ------------------------------------------------------- interval and range

_HOLDS = (
    "select l_orderkey*10+l_linenumber id, l_partkey sessionId, o_orderdate heldFrom, l_shipdate heldTo "
    "from lineitem join orders on l_orderkey = o_orderkey"
)


def _holds(t: Tables, side: str):
    li = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias(f"id{side}"),
        F.col("l_partkey").alias("sessionId"),
        F.col("o_orderdate").alias(f"from{side}"),
        F.col("l_shipdate").alias(f"to{side}"),
    )


@register(
    "interval_booking_overlap",
    f"""with h as ({_HOLDS})
select a.sessionId, count(*) n_pairs,
  cast(sum(date_diff('day', greatest(a.heldFrom, b.heldFrom), least(a.heldTo, b.heldTo))) as bigint) overlap_days
from h a join h b on a.sessionId = b.sessionId and a.id < b.id
where a.heldFrom <= a.heldTo and b.heldFrom <= b.heldTo
  and ((a.heldFrom < b.heldTo and b.heldFrom < a.heldTo) or a.heldFrom = b.heldFrom)
group by 1""",
    "interval join (bookings of a session held at the same time)",
)
def q_interval_booking_overlap(spark, sf_dir):
    t = Tables(spark, sf_dir)
    pairs = interval_join(_holds(t, "A"), _holds(t, "B"), "sessionId", ("fromA", "toA"), ("fromB", "toB"), F.col("idA") < F.col("idB"))
    days = F.datediff(F.least("toA", "toB"), F.greatest("fromA", "fromB"))
    return pairs.groupBy("sessionId").agg(F.count(F.lit(1)).alias("n_pairs"), F.sum(days).alias("overlap_days"))


@register(
    "range_payment_subscription",
    with_views(
        """select p.id paymentId, p.fitnessCenterId, p.createdAt, s.id subscriptionId
from v_payment p join v_sub s on p.fitnessCenterId = s.fitnessCenterId
join v_plan on v_plan.id = s.membershipPlanId
where p.createdAt >= s.createdAt and p.createdAt < s.createdAt + to_days(cast(durationDays as int))""",
        "v_payment",
        "v_sub",
        "v_plan",
    ),
    "range join (instant within interval)",
)
def q_range_payment_subscription(spark, sf_dir):
    t = Tables(spark, sf_dir)
    payments = fx.v_payment(t).select(F.col("id").alias("paymentId"), "fitnessCenterId", "createdAt")
    days = F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.col("durationDays").cast("int"))
    plans = fx.v_plan(t).select(F.col("id").alias("membershipPlanId"), "durationDays")
    subs = fx.v_sub(t).join(plans, "membershipPlanId").select(
        F.col("id").alias("subscriptionId"), "fitnessCenterId", F.col("createdAt").alias("validFrom"), (F.col("createdAt") + days).alias("validTo")
    )
    found = interval_join(payments, subs, "fitnessCenterId", ("createdAt", "createdAt"), ("validFrom", "validTo"))
    return found.select("paymentId", "fitnessCenterId", "createdAt", "subscriptionId")


# ------------------------------------------------- gaps, sessions, rolling


@register(
    "gap_between_bookings",
    with_views(
        """select id, userId, createdAt, lag(createdAt) over (partition by userId order by createdAt, id) previousAt
from v_booking where createdAt is not null""",
        "v_booking",
    ),
    "lag (hot users cut into slices of time)",
)
def q_gap_between_bookings(spark, sf_dir):
    bookings = fx.v_booking(Tables(spark, sf_dir)).select("id", "userId", "createdAt")
    return with_previous(bookings, "userId", "createdAt", ["id"], "previousAt")


@register(
    "sessionize_events",
    """with f as (
  select user_id, ts, case when ts - lag(ts) over w > interval 48 hours or lag(ts) over w is null then 1 else 0 end opens
  from events where ts is not null window w as (partition by user_id order by ts, event_id)),
s as (select *, sum(opens) over (partition by user_id order by ts rows unbounded preceding) no from f)
select user_id, min(ts) session_start, max(ts) session_end, count(*) n_rows from s group by user_id, no""",
    "sessionisation by gap",
)
def q_sessionize_events(spark, sf_dir):
    return sessionize(read_table(spark, sf_dir, "events"), "user_id", "ts", dt.timedelta(hours=48))


@register(
    "rolling_center_revenue",
    with_views(
        """, d as (select fitnessCenterId, cast(createdAt as date) as day, sum(cast(amount as decimal(18,2))) total from v_payment group by 1, 2)
select fitnessCenterId, day, cast(total as double) total, cast(sum(total) over (partition by fitnessCenterId order by day
  range between interval 6 days preceding and current row) as double) rolling from d""",
        "v_payment",
    ),
    "range frame: revenue of the last seven days",
)
def q_rolling_center_revenue(spark, sf_dir):
    amount = F.col("amount").cast("decimal(18,2)")
    out = rolling_sum(fx.v_payment(Tables(spark, sf_dir)), "fitnessCenterId", F.col("createdAt"), amount, 7)
    return out.withColumns({c: F.col(c).cast("double") for c in ("total", "rolling")})


# ------------------------------------------------------------ global order


@register(
    "global_order_position",
    "select o_orderkey, o_totalprice, row_number() over (order by o_totalprice, o_orderkey) as position from orders",
    "row number over a whole relation",
)
def q_global_order_position(spark, sf_dir):
    return global_row_number(read_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", "o_orderkey")


@register(
    "global_rank_quantity",
    """select l_orderkey, l_linenumber, l_quantity, l_discount, rank() over w as rank, dense_rank() over w as dense_rank
from lineitem window w as (order by l_quantity nulls first, l_discount nulls first)""",
    "rank and dense rank over a whole relation",
)
def q_global_rank_quantity(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    return global_rank(li, ["l_quantity", "l_discount"])


@register(
    "exact_price_quantiles",
    """with o as (select o_totalprice, row_number() over (order by o_totalprice) rn, count(*) over () n from orders where o_totalprice is not null),
p as (select unnest([0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]) share)
select cast(share as double) share, o_totalprice as value from p join o
on rn = greatest(1, cast(ceil(cast(share as decimal(18,6)) * n) as bigint))""",
    "exact quantiles of a whole relation",
)
def q_exact_price_quantiles(spark, sf_dir):
    return exact_quantiles(read_table(spark, sf_dir, "orders"), "o_totalprice", [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0])
