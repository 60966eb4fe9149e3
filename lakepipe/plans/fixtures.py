"""The driver's TPC-H-style tables re-viewed as the pipeline's silver entities.

Each ``v_*`` builder is a declarative DataFrame over the parquet scans, so
Catalyst prunes columns and pushes filters down into the reader.  The same
views exist as DuckDB CTEs in ``VIEW_SQL`` for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakepipe.operators.scalar import append_scalar_row

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one driver table.  Zone-less (``timestamp_ntz``) columns become
    ``timestamp`` in the session time zone, which keeps wall-clock values and
    lets epoch arithmetic work."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    casts = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema.fields
        if f.dataType.typeName() == "timestamp_ntz"
    }
    return df.withColumns(casts) if casts else df


class Tables:
    """Lazy accessor: ``t = Tables(spark, sf_dir); t.orders``.  Each table is
    opened (listed, footer read) once per accessor, however many views of
    one query use it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._opened: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        if name not in self._opened:
            self._opened[name] = read_table(self.spark, self.sf_dir, name)
        return self._opened[name]


def _days(n) -> F.Column:
    return F.make_interval(F.lit(0), F.lit(0), F.lit(0), n)


def v_user(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_nationkey").alias("fitnessCenterId"),
        "c_name",
        F.col("c_mktsegment").alias("role"),
    )


def v_fc(t: Tables) -> DataFrame:
    n = F.col("n_nationkey")
    base = F.lit("2001-09-30 00:00:00").cast("timestamp")
    return t.nation.select(
        n.alias("id"),
        F.col("n_name").alias("name"),
        F.when(n % 7 == 0, F.lit(None).cast("timestamp"))
        .otherwise(base - _days(n * 5))
        .alias("lastLoginAt"),
    )


def v_payment(t: Tables) -> DataFrame:
    o = t.orders
    cust = t.customer.select("c_custkey", "c_nationkey")
    return o.join(cust, o.o_custkey == cust.c_custkey, "inner").select(
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderkey") % 10 == 0, F.lit(None).cast("long"))
        .otherwise(F.col("o_custkey"))
        .alias("userId"),
        F.col("c_nationkey").alias("fitnessCenterId"),
        F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS")
        .when(F.col("o_orderstatus") == "O", "PENDING")
        .otherwise("FAILED")
        .alias("status"),
        F.col("o_orderdate").alias("createdAt"),
    )


def v_booking(t: Tables) -> DataFrame:
    # Every line item is a booking; some belong to no user or to a session that is not known, so both sides of the joins occur.
    li = t.lineitem
    o = t.orders.select("o_orderkey", "o_custkey")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("userId"),
        F.when(F.col("l_partkey") % 9 != 0, F.col("l_partkey")).otherwise(F.col("l_partkey") + 1_000_000_000).alias("sessionId"),
        F.when(F.col("l_returnflag") == "A", "COMPLETED")
        .when(F.col("l_returnflag") == "R", "CANCELLED")
        .otherwise("BOOKED")
        .alias("status"),
        F.col("l_shipdate").alias("createdAt"),
    )


def v_session(t: Tables) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")
    start = F.lit("2001-01-01 06:00:00").cast("timestamp") + F.make_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(0), k.cast("int"), F.lit(0), F.lit(0)
    )
    return t.part.select(
        k.alias("id"),
        (k % 25).alias("fitnessCenterId"),
        start.alias("startTime"),
        (start + F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), size * 3, (k % 60).cast("decimal(18,6)"))).alias("endTime"),
        F.when(size % 10 == 0, F.lit(0)).when(size % 11 == 0, F.lit(None).cast("int")).otherwise(size).alias("availableSlots"),
    )


def v_plan(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("id"),
        F.col("p_retailprice").alias("price"),
        (F.col("p_size") * 10).alias("durationDays"),
    )


def v_sub(t: Tables) -> DataFrame:
    # The plan id wraps around the number of parts: a global count, used as
    # a scalar subquery (computed once, no join).
    n_parts = t.part.agg(F.count(F.lit(1)).alias("n_parts"))
    s = t.supplier
    base = F.lit("2000-01-01 00:00:00").cast("timestamp")
    return append_scalar_row(s, n_parts).select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_nationkey") % 6 != 0, F.col("s_nationkey")).otherwise(F.col("s_nationkey") + 1000).alias("fitnessCenterId"),
        ((F.col("s_suppkey") * 7) % F.col("n_parts")).alias("membershipPlanId"),
        F.when(F.col("s_acctbal") > 0, "ACTIVE").otherwise("EXPIRED").alias("status"),
        (base + _days((F.col("s_suppkey") % 90).cast("int"))).alias("createdAt"),
    )


# DuckDB versions of the same views, used as CTEs by the oracle SQL.
VIEW_SQL = {
    "v_user": "select c_custkey id, c_nationkey fitnessCenterId, c_name, c_mktsegment role from customer",
    "v_fc": (
        "select n_nationkey id, n_name name, case when n_nationkey%7=0 then null "
        "else timestamp '2001-09-30' - to_days(n_nationkey*5) end lastLoginAt from nation"
    ),
    "v_payment": (
        "select o_orderkey id, case when o_orderkey%10=0 then null else o_custkey end userId, "
        "c_nationkey fitnessCenterId, o_totalprice amount, case o_orderstatus when 'F' then 'SUCCESS' "
        "when 'O' then 'PENDING' else 'FAILED' end status, o_orderdate createdAt "
        "from orders join customer on o_custkey=c_custkey"
    ),
    "v_booking": (
        "select l_orderkey*10+l_linenumber id, case when o_custkey%7<>0 then o_custkey end userId, "
        "case when l_partkey%9<>0 then l_partkey else l_partkey+1000000000 end sessionId, "
        "case l_returnflag when 'A' then 'COMPLETED' when 'R' then 'CANCELLED' else 'BOOKED' end status, "
        "l_shipdate createdAt from lineitem join orders on l_orderkey=o_orderkey"
    ),
    "v_session": (
        "select p_partkey id, p_partkey%25 fitnessCenterId, "
        "timestamp '2001-01-01 06:00:00' + to_hours(cast(p_partkey as int)) startTime, "
        "timestamp '2001-01-01 06:00:00' + to_hours(cast(p_partkey as int)) + to_minutes(p_size*3) "
        "+ to_seconds(cast(p_partkey%60 as int)) endTime, "
        "case when p_size%10=0 then 0 when p_size%11=0 then null else p_size end availableSlots from part"
    ),
    "v_plan": "select p_partkey id, p_retailprice price, p_size*10 durationDays from part",
    "v_sub": (
        "select s_suppkey id, case when s_nationkey%6<>0 then s_nationkey else s_nationkey+1000 end fitnessCenterId, (s_suppkey*7)%(select count(*) from part) "
        "membershipPlanId, case when s_acctbal>0 then 'ACTIVE' else 'EXPIRED' end status, "
        "timestamp '2000-01-01' + to_days(cast(s_suppkey%90 as int)) createdAt "
        "from supplier"
    ),
}


def with_views(sql: str, *views: str) -> str:
    """Prefix ``sql`` with the named views as CTEs."""
    if not views:
        return sql
    ctes = ",\n".join(f"{v} as ({VIEW_SQL[v]})" for v in views)
    return f"with {ctes}\n{sql}"
