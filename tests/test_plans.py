"""Physical-plan assertions: the plans we want, not just right answers."""

import datetime as dt

from pyspark.sql import functions as F

from lakepipe.operators.dedup import dedup_latest
from lakepipe.operators.merge import upsert_df
from lakepipe.plans import catalog

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_rows_before_the_shuffle(spark):
    p = plan(catalog.queries()["dedup_latest"](spark, SF))
    assert "WindowGroupLimit" in p and "Partial" in p and "Final" in p
    # the partial limit sits below the exchange
    assert p.index("Final") < p.index("Exchange") < p.index("Partial")


def test_scan_prunes_columns(spark):
    p = plan(catalog.queries()["gold_booking_funnel"](spark, SF))
    assert "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string,l_shipdate:timestamp_ntz>" in p


def test_one_row_aggregate_is_a_scalar_subquery_not_a_join(spark):
    p = plan(catalog.queries()["gold_subscription_metrics"](spark, SF))
    assert "Subquery" in p and "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_distinct_count_spreads_hot_groups(spark):
    p = plan(catalog.queries()["gold_center_revenue"](spark, SF))
    # first exchange is keyed on (center, date, userId), not on (center, date) alone
    assert "hashpartitioning(fitnessCenterId" in p and "userId" in p.split("Exchange hashpartitioning")[2]


def test_fact_side_aggregated_before_user_join(spark):
    p = plan(catalog.queries()["gold_center_lifecycle"](spark, SF))
    join_at = p.index("_uid")
    assert "HashAggregate(keys=[userId" in p[join_at:]


def test_upsert_broadcasts_small_batch_keys(spark):
    t = spark.range(1000).select(F.col("id"), F.lit("t").alias("v"))
    b = spark.range(990, 1010).select(F.col("id"), F.lit("b").alias("v"))
    p = plan(upsert_df(t, b, "id"))
    assert "BroadcastHashJoin" in p and "LeftAnti" in p


def test_incremental_predicate_reaches_the_scan(spark, tmp_root):
    path = tmp_root + "/src"
    spark.createDataFrame([(1, dt.datetime(2001, 1, 1))], "id long, updatedAt timestamp").write.parquet(path)
    df = spark.read.parquet(path).filter(F.col("updatedAt") > F.lit(dt.datetime(2000, 1, 1)))
    assert "GreaterThan(updatedAt" in plan(df)


def test_dedup_is_per_key_not_global(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").cast("timestamp").alias("u"))
    p = plan(dedup_latest(df, "k", "u"))
    assert "SinglePartition" not in p


def test_null_user_keys_are_salted_in_shuffle_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the shuffle's partitions visible
    try:
        df = catalog.queries()["booking_with_center"](spark, SF)
        p = plan(df)
        assert "hashpartitioning(_b_key" in p
        # NULL-user rows land in many partitions, not one
        from pyspark.sql import functions as F
        b = spark.range(2000).select(F.lit(None).cast("long").alias("userId"), F.col("id"))
        u = spark.range(10).select(F.col("id"), F.lit(1).alias("fitnessCenterId"))
        from lakepipe.plans.gold import booking_with_center
        out = booking_with_center(b, u)
        parts = out.select(F.spark_partition_id().alias("p")).distinct().count()
        assert out.count() == 2000 and parts > 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_money_sums_are_exact_under_any_partitioning(spark):
    from lakepipe.plans.gold import money_sum

    df = spark.range(200_000).select((F.pmod(F.xxhash64("id"), F.lit(10**11)) / 100).alias("amount"))
    exact = spark.range(200_000).agg(F.sum(F.pmod(F.xxhash64("id"), F.lit(10**11)))).first()[0] / 100
    totals = {df.repartition(n).agg(money_sum("amount")).first()[0] for n in (1, 3, 7)}
    assert totals == {exact}


def test_subscriptions_are_counted_before_the_plan_join(spark):
    from lakepipe.plans import fixtures as fx
    from lakepipe.plans.gold import subscription_mrr

    t = fx.Tables(spark, SF)
    p = subscription_mrr(fx.v_sub(t), fx.v_plan(t))._jdf.queryExecution().optimizedPlan().toString()
    lines = p.splitlines()
    join = next(i for i, line in enumerate(lines) if "Join LeftOuter" in line)
    assert any("Aggregate [membershipPlanId" in line for line in lines[join:])


def test_lifetime_value_joins_its_dimension_once(spark):
    from lakepipe.plans import fixtures as fx
    from lakepipe.plans.gold import user_lifetime_value

    t = fx.Tables(spark, SF)
    p = user_lifetime_value(fx.v_user(t), fx.v_payment(t), fx.v_booking(t), catalog.CLOCK)
    assert p._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 1


def test_guarded_upsert_reads_its_target_once(spark, tmp_root):
    schema = "id long, v string, at timestamp"
    target = [(k, "old", dt.datetime(2024, 1, 1 + k % 20)) for k in range(100)]
    spark.createDataFrame(target, schema).write.parquet(tmp_root + "/t")
    t = spark.read.parquet(tmp_root + "/t")
    b = spark.createDataFrame([(k, dt.datetime(2024, 1, 10), k) for k in range(90, 110)], "id long, at timestamp, extra long")
    out = upsert_df(t, b, "id", "at", guard_stale=True)
    assert out.columns == ["id", "v", "at", "extra"]
    assert plan(out).count("FileScan parquet") == 1
    got = {r.id: (r.v, r.extra) for r in out.collect()}
    assert len(got) == 110 and all(got[k] == ("old", None) for k in range(90))
    assert all(got[k] == (("old", None) if target[k][2] > dt.datetime(2024, 1, 10) else (None, k)) for k in range(90, 100))
    assert all(got[k] == (None, k) for k in range(100, 110))


def test_money_is_exact_and_keeps_what_is_no_number(spark):
    from lakepipe.plans.gold import money_sum

    def total(*values):
        return spark.createDataFrame([(v,) for v in values], "amount double").agg(money_sum("amount").alias("s")).first().s

    assert total(*[0.004] * 1000) == 4.0 and total(0.1, 0.2) == 0.3
    assert total(None, None) is None and total(None, 2.5) == 2.5
    assert str(total(float("nan"), 1.0)) == "nan" and total(float("inf"), 1.0) == float("inf")
    assert total(1e20, 1.0) == 1e20 + 1.0
