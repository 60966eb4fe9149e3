"""dedup_latest, upsert_df, scd2_df: examples and properties."""

import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakepipe.clock import Clock
from lakepipe.operators.dedup import dedup_latest, dedup_rows
from lakepipe.operators.merge import scd2_df, upsert_df
from lakepipe.operators.quality import assert_unique, require_not_null

T1, T2, T3 = (dt.datetime(2001, 1, d) for d in (1, 2, 3))
SCHEMA = "id long, v string, updatedAt timestamp"
PROP = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_dedup_latest_example(spark):
    df = spark.createDataFrame([(1, "a", T1), (1, "b", T2), (None, "c", T3), (2, "d", None), (2, "e", T1)], SCHEMA)
    assert rows(dedup_latest(df, "id", "updatedAt")) == [(1, "b", T2), (2, "e", T1)]


def test_dedup_ties_are_deterministic(spark):
    df = spark.createDataFrame([(1, "z", T1), (1, "a", T1)], SCHEMA)
    assert rows(dedup_latest(df, "id", "updatedAt")) == [(1, "a", T1)]


key_rows = st.lists(st.tuples(st.integers(0, 6), st.sampled_from("abc"), st.integers(1, 5)), max_size=25)


@PROP
@given(key_rows)
def test_dedup_one_row_per_key_and_order_free(spark, data):
    data = [(k, v, dt.datetime(2001, 1, d)) for k, v, d in data]
    a = dedup_latest(spark.createDataFrame(data, SCHEMA), "id", "updatedAt")
    shuffled = data[:]
    random.Random(7).shuffle(shuffled)
    b = dedup_latest(spark.createDataFrame(shuffled, SCHEMA).repartition(3), "id", "updatedAt")
    ra = rows(a)
    assert ra == rows(b)
    assert len({r[0] for r in ra}) == len(ra) == len({r[0] for r in data})
    for k, v, t in ra:
        assert t == max(d for kk, _, d in data if kk == k)


def test_dedup_rows(spark):
    df = spark.createDataFrame([(1, "a", T1), (1, "a", T1), (1, "b", T1)], SCHEMA)
    assert len(rows(dedup_rows(df))) == 2


def test_upsert_example(spark):
    tgt = spark.createDataFrame([(1, "a", T1), (2, "b", T1)], SCHEMA)
    bat = spark.createDataFrame([(2, "c", T2), (3, "d", T2)], SCHEMA)
    assert rows(upsert_df(tgt, bat, "id")) == [(1, "a", T1), (2, "c", T2), (3, "d", T2)]


def test_upsert_older_batch_wins_unless_guarded(spark):
    tgt = spark.createDataFrame([(1, "new", T3)], SCHEMA)
    bat = spark.createDataFrame([(1, "old", T1)], SCHEMA)
    assert rows(upsert_df(tgt, bat, "id")) == [(1, "old", T1)]
    assert rows(upsert_df(tgt, bat, "id", "updatedAt", guard_stale=True)) == [(1, "new", T3)]


def test_upsert_without_broadcast_same_result(spark):
    tgt = spark.createDataFrame([(i, "t", T1) for i in range(10)], SCHEMA)
    bat = spark.createDataFrame([(i, "b", T2) for i in range(5, 15)], SCHEMA)
    assert rows(upsert_df(tgt, bat, "id", max_broadcast_rows=1)) == rows(upsert_df(tgt, bat, "id"))


@PROP
@given(key_rows, key_rows)
def test_upsert_idempotent(spark, t_data, b_data):
    t = spark.createDataFrame([(k, v, dt.datetime(2001, 1, d)) for k, v, d in t_data], SCHEMA)
    t = dedup_latest(t, "id", "updatedAt")
    b = dedup_latest(spark.createDataFrame([(k, v, dt.datetime(2001, 2, d)) for k, v, d in b_data], SCHEMA),
                     "id", "updatedAt")
    once = upsert_df(t, b, "id")
    twice = upsert_df(once, b, "id")
    assert rows(once) == rows(twice)
    keys = [r[0] for r in rows(once)]
    assert len(keys) == len(set(keys))


def test_require_not_null(spark):
    from pyspark.sql import Observation
    df = spark.createDataFrame([(1, None, T1), (None, "x", T1), (2, "y", None)], SCHEMA)
    obs = Observation()
    out = require_not_null(df, "id", "updatedAt", observation=obs)
    assert rows(out) == [(1, None, T1)]
    assert obs.get == {"rows_in": 3, "rows_rejected": 2}


def test_assert_unique(spark):
    with pytest.raises(ValueError):
        assert_unique(spark.createDataFrame([(1, "a", T1), (1, "b", T1)], SCHEMA), "id")


D1, D2 = Clock("2001-09-01"), Clock("2001-10-01")


def test_scd2_reference_semantics(spark):
    cur = scd2_df(None, spark.createDataFrame([(1, "a", T1), (2, "b", T1)], SCHEMA), "id", D1)
    nxt = scd2_df(cur, spark.createDataFrame([(1, "a", T1)], SCHEMA), "id", D2)
    got = rows(nxt.select("id", "v", "is_current", "effective_date", "end_date"))
    d1, d2 = dt.date(2001, 9, 1), dt.date(2001, 10, 1)
    assert got == [(1, "a", False, d1, d2), (1, "a", True, d2, None), (2, "b", True, d1, None)]


def test_scd2_compare_and_expire_missing(spark):
    cur = scd2_df(None, spark.createDataFrame([(1, "a", T1), (2, "b", T1)], SCHEMA), "id", D1)
    upd = spark.createDataFrame([(1, "a", T1), (3, "c", T1)], SCHEMA)
    nxt = scd2_df(cur, upd, "id", D2, compare_cols=["v"], expire_missing=True)
    got = rows(nxt.select("id", "is_current"))
    assert got == [(1, True), (2, False), (3, True)]


def test_scd2_compare_is_exact_with_nulls(spark):
    """A value moving into a neighbouring NULL column is a change; equal
    rows with NULLs are not (hashes skip NULLs, so both need the values)."""
    schema = "id long, first string, last string"
    cur = scd2_df(None, spark.createDataFrame([(1, None, "Lee"), (2, "Ann", None)], schema), "id", D1)
    upd = spark.createDataFrame([(1, "Lee", None), (2, "Ann", None)], schema)
    nxt = scd2_df(cur, upd, "id", D2, compare_cols=["first", "last"])
    got = {tuple(r) for r in nxt.select("id", "first", "last", "is_current").collect()}
    assert got == {(1, None, "Lee", False), (1, "Lee", None, True), (2, "Ann", None, True)}


def test_scd2_rejects_duplicates_and_missing_key(spark):
    with pytest.raises(ValueError):
        scd2_df(None, spark.createDataFrame([(1, "a", T1), (1, "b", T1)], SCHEMA), "id", D1)
    with pytest.raises(ValueError):
        scd2_df(None, spark.createDataFrame([(1, "a", T1)], SCHEMA), None, D1)


@PROP
@given(st.lists(st.lists(st.integers(0, 5), max_size=6, unique=True), min_size=1, max_size=4))
def test_scd2_invariants(spark, loads):
    hist, n_before = None, 0
    for i, keys in enumerate(loads):
        upd = spark.createDataFrame([(k, f"v{i}", T1) for k in keys], SCHEMA)
        if not keys:
            continue
        hist = scd2_df(hist, upd, "id", Clock(f"2001-0{i + 1}-01"))
        got = hist.collect()
        assert len(got) >= n_before  # history never shrinks
        n_before = len(got)
        current = [r.id for r in got if r.is_current]
        assert len(current) == len(set(current))  # at most one current version per key
        for r in got:
            assert (r.end_date is None) == r.is_current


def test_upsert_schema_evolution(spark):
    tgt = spark.createDataFrame([(1, "a", T1)], SCHEMA)
    bat = spark.createDataFrame([(2, "b", T2, 7)], SCHEMA + ", extra int")
    got = sorted(tuple(r) for r in upsert_df(tgt, bat, "id").select("id", "v", "extra").collect())
    assert got == [(1, "a", None), (2, "b", 7)]


def test_composite_key_dedup_and_upsert(spark):
    s = "a long, b string, v string, updatedAt timestamp"
    df = spark.createDataFrame([(1, "x", "old", T1), (1, "x", "new", T2), (1, "y", "o", T1)], s)
    d = dedup_latest(df, ["a", "b"], "updatedAt")
    assert sorted((r.a, r.b, r.v) for r in d.collect()) == [(1, "x", "new"), (1, "y", "o")]
    up = upsert_df(d, spark.createDataFrame([(1, "y", "z", T3)], s), ["a", "b"])
    assert sorted((r.a, r.b, r.v) for r in up.collect()) == [(1, "x", "new"), (1, "y", "z")]


def test_broadcast_gate_bounds_rows_and_bytes(spark):
    from lakepipe.operators.sizing import has_at_most, measure

    df = spark.createDataFrame([(i, "x" * 10) for i in range(100)], "id long, k string")
    assert measure(df) == (100, 100 * (8 + 10))
    assert has_at_most(df, 100, 1800) and not has_at_most(df, 99) and not has_at_most(df, 100, 1799)
    assert measure(df.limit(0)) == (0, 0)


def test_append_scalar_row(spark):
    from pyspark.sql import functions as F

    from lakepipe.operators.scalar import append_scalar_row

    df = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    one = df.agg(F.sum("id").alias("total"), F.count(F.lit(1)).alias("n"))
    out = append_scalar_row(df, one)
    assert out.columns == ["id", "v", "total", "n"]
    assert rows(out) == [(1, "a", 3, 2), (2, "b", 3, 2)]
    # more than one row is an error, never a multiplication of rows
    with pytest.raises(Exception):
        append_scalar_row(df, df.select("id")).collect()


def test_upsert_byte_bound_falls_back_to_shuffle(spark):
    tgt = spark.createDataFrame([(i, "t", T1) for i in range(10)], SCHEMA)
    bat = spark.createDataFrame([(i, "b", T2) for i in range(5, 15)], SCHEMA)
    small = upsert_df(tgt, bat, "id")
    out = upsert_df(tgt, bat, "id", max_broadcast_bytes=8)  # 10 keys x 8 bytes > 8 bytes

    def hinted(df):
        return "strategy=broadcast" in df._jdf.queryExecution().optimizedPlan().toString()

    assert hinted(small) and not hinted(out)
    assert rows(out) == rows(small)
