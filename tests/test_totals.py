"""Totals, sketches, drifting JSON and co-located tables: results and plans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakepipe.functions.semi import typed_fields
from lakepipe.operators.rollups import merge_sketches, pivoted, sketch_estimates, sketch_groups, totals
from lakepipe.plans import catalog
from lakepipe.sinks.colocated import upsert_colocated, write_colocated

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_totals_expand_group_rows_only(spark):
    p = plan(catalog.queries()["totals_rollup"](spark, SF))
    # From the bottom: aggregate to the finest groups, then Expand, then the totals.
    expand = p.index("Expand")
    assert p.count("HashAggregate", expand) >= 2 and p.count("HashAggregate", 0, expand) >= 2


def test_totals_tell_null_groups_from_totals(spark):
    d = spark.createDataFrame([("x", 1), (None, 2), ("x", 4)], "k string, v long")
    got = {(r.k, r.grouping_id): r.s for r in totals(d, {"k": F.col("k")}, {"s": F.col("v")}).collect()}
    assert got == {("x", 0): 5, (None, 0): 2, (None, 1): 7}
    got = totals(d, {"k": F.col("k"), "l": F.lit(1)}, {"s": F.col("v")}, [["k", "l"], []]).collect()
    assert sorted((r.grouping_id, r.s) for r in got) == [(0, 2), (0, 5), (3, 7)]


def test_pivot_has_the_stated_columns(spark):
    d = spark.createDataFrame([(1, "a", 2), (1, "a", 3), (1, "z", 9), (2, "b", 1)], "k long, s string, v long")
    got = pivoted(d, ["k"], "s", ["a", "b", "never"], F.col("v"))
    assert got.columns == ["k", "a", "b", "never"]
    assert sorted(map(tuple, got.collect())) == [(1, 5, None, None), (2, None, 1, None)]


@pytest.mark.parametrize("users", [50, 20_000])
def test_sketches_roll_up_within_their_bounds(spark, users):
    d = spark.range(60_000).select((F.col("id") % 30).alias("day"), F.pmod(F.xxhash64("id"), F.lit(users)).alias("u"), (F.col("id") * 7 % 60_000).cast("double").alias("v"))
    stored = sketch_groups(d, ["day"], F.col("u"), F.col("v"))
    assert stored.count() == 30
    r = sketch_estimates(merge_sketches(stored, [(F.col("day") >= 0).alias("all")]), ["all"], {"q10": 0.1, "q50": 0.5, "q99": 0.99}).first()
    exact = d.agg(F.countDistinct("u")).first()[0]
    assert r.n == 60_000 and abs(r.distinct - exact) <= 0.03 * exact
    assert all(abs(got / 60_000 - want) < 0.02 for got, want in ((r.q10, 0.1), (r.q50, 0.5), (r.q99, 0.99)))


def test_sketches_of_nulls(spark):
    d = spark.createDataFrame([(1, None, None), (1, 5, 2.0)], "g long, u long, v double")
    r = sketch_estimates(merge_sketches(sketch_groups(d, ["g"], F.col("u"), F.col("v")), ["g"]), ["g"], {"m": 0.5}).first()
    assert (r.n, r.distinct, r.m) == (2, 1, 2.0)


def test_typed_fields_keep_what_does_not_fit(spark):
    texts = ['{"a": 1, "b": "x"}', '{"a": "7"}', '{"a": "x"}', '{"a": [1]}', '{"a": null}', "{broken", None, "[]", '{"a": 99999999999999999999}']
    d = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, j string")
    got = {r.i: (r.a, r.b, r.rejected) for r in typed_fields(d, "j", {"a": ("$.a", "bigint"), "b": ("$.b", "string")}).collect()}
    fits = {0: (1, "x"), 1: (7, None), 4: (None, None), 6: (None, None), 7: (None, None)}
    assert got == {i: (*fits[i], None) if i in fits else (None, None, t) for i, t in enumerate(texts)}


def test_colocated_tables_join_without_an_exchange(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(catalog.queries()["colocated_user_activity"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "Exchange" not in p and "SelectedBucketsCount" in p


def test_colocated_upsert_moves_the_batch_only(spark):
    t = [(k, "old", dt.datetime(2024, 1, 1)) for k in range(50)]
    b = [(k, f"new{n}", dt.datetime(2024, 1, 2 + n)) for k in range(45, 55) for n in range(2)]
    schema = "id long, v string, at timestamp"
    target = write_colocated(spark.createDataFrame(t, schema), "t", ["id"], 4, ["id"])
    out = upsert_colocated(target, spark.createDataFrame(b, schema), ["id"], "at")
    assert {r.id: r.v for r in out.collect()} == {**{k: "old" for k in range(45)}, **{k: "new1" for k in range(45, 55)}}
    p = plan(out)
    assert "FileScan" in p and "Exchange" not in p[p.index("FileScan") - 400 : p.index("FileScan")]
