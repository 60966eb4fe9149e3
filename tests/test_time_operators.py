"""As-of and interval joins, gaps, sessions and exact order against brute force, with hot keys cut and whole."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lakepipe.operators.asof import asof_join
from lakepipe.operators.interval_join import interval_join
from lakepipe.operators.ordering import exact_quantiles, global_rank, global_row_number, value_positions
from lakepipe.operators.sessions import rolling_sum, sessionize, with_previous
from lakepipe.plans import catalog

SF = "/root/testdata/sf0.001"
DAY0 = dt.datetime(2024, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def at(k):
    return None if k is None else DAY0 + dt.timedelta(hours=k)


def rows_of(seed, n, hot=0.5, span=60):
    """(id, key, hour): one key holds a good part of the rows, some share one instant, some lack a key or time."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        key = 0 if rng.random() < hot else rng.choice([1, 2, 3, None])
        hour = 30 if rng.random() < 0.25 else rng.choice([*range(span), None])
        out.append((i, key, hour))
    return out + out[:3]


# ------------------------------------------------------------------- as-of


def brute_asof(left, right, direction, equal, tolerance):
    out = []
    for i, k, t in left:
        best = None
        for j, rk, rt in right:
            if None in (k, t, rk, rt) or rk != k:
                continue
            gap = t - rt if direction == "backward" else rt - t
            if gap < 0 or (gap == 0 and not equal) or (tolerance is not None and gap > tolerance):
                continue
            if best is None or (-gap, at(rt), j) > best[0]:
                best = ((-gap, at(rt), j), rt, j)
        out.append((i, k, at(t), at(best[1]) if best else None, best[2] if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("max_rows", [7, 10_000])
@pytest.mark.parametrize("direction,equal,tolerance", [("backward", True, None), ("backward", False, 5), ("forward", True, 3), ("forward", False, None)])
def test_asof_join(spark, max_rows, direction, equal, tolerance):
    left, right = rows_of(1, 220), rows_of(2, 90, hot=0.7)
    one = spark.createDataFrame([(i, k, at(t)) for i, k, t in left], "id long, k long, t timestamp")
    two = spark.createDataFrame([(k, at(t), i) for i, k, t in right], "k long, rt timestamp, rid long")
    gap = None if tolerance is None else dt.timedelta(hours=tolerance)
    got = asof_join(one, two, "k", "t", "rt", direction=direction, allow_equal=equal, tolerance=gap, max_rows=max_rows)
    assert got.columns == ["id", "k", "t", "rt", "rid"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_asof(left, right, direction, equal, tolerance)


def test_asof_edges(spark):
    one = spark.createDataFrame([(1, 1, 5)], "id long, k long, t long")
    none = spark.createDataFrame([], "k long, rt long, v string")
    assert [tuple(r) for r in asof_join(one, none, "k", "t", "rt").collect()] == [(1, 1, 5, None, None)]
    assert asof_join(one, none, "k", "t", "rt", how="inner").count() == 0
    assert asof_join(one.where("id > 1"), none, "k", "t", "rt").count() == 0
    days = spark.createDataFrame([(1, dt.date(2024, 1, 9))], "k long, d date")
    paid = spark.createDataFrame([(1, dt.date(2024, 1, 2), "a"), (1, dt.date(2024, 1, 1), "b")], "k long, rd date, v string")
    assert [r.v for r in asof_join(days, paid, "k", "d", "rd", ["v"], tolerance=dt.timedelta(days=7)).collect()] == ["a"]
    assert [r.v for r in asof_join(days, paid, "k", "d", "rd", ["v"], tolerance=6).collect()] == [None]
    with pytest.raises(ValueError, match="both sides"):
        asof_join(one, one, "k", "t", "t")
    with pytest.raises(TypeError, match="no time"):
        asof_join(one.withColumn("t", F.lit("x")), none, "k", "t", "rt")


def test_asof_forms_no_pairs(spark):
    p = plan(catalog.queries()["asof_booking_payment"](spark, SF))
    assert "Window" in p and "NestedLoopJoin" not in p and "CartesianProduct" not in p


# ---------------------------------------------------------------- interval


def brute_overlaps(left, right):
    out = []
    for i, k, s, e in left:
        for j, rk, rs, re in right:
            if None in (k, s, e, rk, rs, re) or k != rk or e < s or re < rs:
                continue
            if (s < re and rs < e) or s == rs or (s == e and rs <= s < re) or (rs == re and s <= rs < e):
                out.append((k, i, j))
    return sorted(out)


def spans(seed, n, hot=0.6):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.randint(-40, 200)
        length = rng.choice([0, 0, 1, 2, 3, 7, 8, 9, 100, 5000, -3])
        out.append((i, 0 if rng.random() < hot else rng.choice([1, 2, None]), start if rng.random() > 0.03 else None, start + length))
    return out + out[:2]


@pytest.mark.parametrize("max_pairs", [4, 10**6])
def test_interval_join(spark, max_pairs):
    left, right = spans(3, 90), spans(4, 70)
    one = spark.createDataFrame(left, "i long, k long, s long, e long")
    two = spark.createDataFrame(right, "j long, k long, rs long, re long")
    got = interval_join(one, two, "k", ("s", "e"), ("rs", "re"), max_pairs=max_pairs)
    assert got.columns == ["k", "i", "s", "e", "j", "rs", "re"]
    assert sorted((r.k, r.i, r.j) for r in got.collect()) == brute_overlaps(left, right)


def test_range_join_and_condition(spark):
    left = [(i, 1, t, t) for i, t in enumerate([0, 4, 5, 9, 10, 15])]
    right = [(0, 1, 0, 5), (1, 1, 5, 10), (2, 1, 0, 100)]
    one = spark.createDataFrame(left, "i long, k long, s long, e long")
    two = spark.createDataFrame(right, "j long, k long, rs long, re long")
    got = sorted((r.i, r.j) for r in interval_join(one, two, "k", ("s", "s"), ("rs", "re")).collect())
    assert got == [(0, 0), (0, 2), (1, 0), (1, 2), (2, 1), (2, 2), (3, 1), (3, 2), (4, 2), (5, 2)]
    got = interval_join(one, two, "k", ("s", "s"), ("rs", "re"), F.col("i") > F.col("j") + 2)
    assert sorted((r.i, r.j) for r in got.collect()) == [(5, 2)]
    assert interval_join(one.where("i > 99"), two, "k", ("s", "e"), ("rs", "re")).count() == 0


@pytest.mark.parametrize("few_rows", [0, 5, 40])
def test_interval_join_of_busy_and_other_keys(spark, few_rows):
    """Keys above ``few_rows`` meet in bins, the others on the key: the same pairs, repeated rows as often as they occur."""
    left, right = spans(5, 60), spans(6, 60)
    one = spark.createDataFrame(left, "i long, k long, s long, e long")
    two = spark.createDataFrame(right, "j long, k long, rs long, re long")
    got = interval_join(one, two, "k", ("s", "e"), ("rs", "re"), few_rows=few_rows)
    assert sorted((r.k, r.i, r.j) for r in got.collect()) == brute_overlaps(left, right)


def test_interval_join_copies_no_row_of_small_keys(spark):
    """Rows of keys with few rows are shuffled once a side, not once a level and bin."""
    rows = spark.range(0, 4000).selectExpr("id i", "id % 400 k", "id s", "id + pow(2, id % 11) e").selectExpr("i", "k", "s", "cast(e as long) e")
    other = rows.selectExpr("i j", "k", "s rs", "e re")
    found = interval_join(rows, other, "k", ("s", "e"), ("rs", "re"))
    p = plan(found)
    assert "Generate" not in p and "explode" not in p and p.count("SortMergeJoin") + p.count("HashJoin") == 1
    assert found.count() == rows.crossJoin(other.withColumnRenamed("k", "k2")).where("k = k2 and ((s < re and rs < e) or s = rs)").count()


def test_interval_join_is_an_equi_join(spark):
    p = plan(catalog.queries()["interval_booking_overlap"](spark, SF))
    assert "_bin" in p and "NestedLoopJoin" not in p and "CartesianProduct" not in p


def test_long_intervals_are_not_copied_more(spark):
    """Copies follow the number of levels in use, not the length."""
    from lakepipe.operators.interval_join import _binned, _own

    one = spark.createDataFrame([(0, 1, 0, 1 << 40), (1, 1, 5, 6), (2, 1, 7, 7 + (1 << 20))], "i long, k long, s long, e long")
    assert _own(_binned(one, ["k"], ("s", "e"), "_l"), "_l").groupBy("i").count().agg(F.max("count")).first()[0] <= 2


@pytest.mark.parametrize("max_pairs", [4, 900, 10**8])
def test_range_join_over_slices_of_busy_keys(spark, max_pairs):
    """Instants on either side, many of them equal, keys of very different size, repeated rows, empty and endless intervals."""
    rng = random.Random(7)
    points = [(i, rng.choice([0, 0, 0, 0, 1, 1, 2, None]), rng.choice([50, 50, None, *range(100)])) for i in range(2500)]
    points = [(i, k, t, t) for i, k, t in points + points[:3]]
    other = [(i, k, s, e if i % 9 else (1 << 63) - 1) for i, k, s, e in spans(8, 60)]
    one = spark.createDataFrame(points, "i long, k long, s long, e long").drop("e")
    two = spark.createDataFrame(other, "j long, k long, rs long, re long")
    want = brute_overlaps(points, other)
    got = interval_join(one, two, "k", ("s", "s"), ("rs", "re"), max_pairs=max_pairs)
    assert got.columns == ["k", "i", "s", "j", "rs", "re"] and sorted((r.k, r.i, r.j) for r in got.collect()) == want
    got = interval_join(two, one, "k", ("rs", "re"), ("s", "s"), max_pairs=max_pairs)
    assert got.columns == ["k", "j", "rs", "re", "i", "s"] and sorted((r.k, r.i, r.j) for r in got.collect()) == want


def test_range_join_copies_no_instant(spark):
    """An instant is shuffled once, not once for each length of interval; an interval goes to the slices it touches."""
    points = spark.range(0, 20000).selectExpr("id i", "id % 2 k", "id s")
    other = spark.range(0, 400).selectExpr("id j", "id % 2 k", "id * 45 rs", "cast(id * 45 + pow(2, id % 14) as long) re")
    found = interval_join(points, other, "k", ("s", "s"), ("rs", "re"))
    p = plan(found)
    assert p.count("Generate") == 1 and p.count("SortMergeJoin") + p.count("HashJoin") == 1 + 3  # keys of both sides, the cuts of either
    assert found.count() == points.crossJoin(other.withColumnRenamed("k", "k2")).where("k = k2 and rs <= s and s < re").count()


# ------------------------------------------------- gaps, sessions, rolling


@pytest.mark.parametrize("max_rows", [5, 10_000])
def test_with_previous(spark, max_rows):
    rows = rows_of(5, 150)
    d = spark.createDataFrame([(i, k, at(t)) for i, k, t in rows], "id long, k long, t timestamp")
    got = sorted(((r.k, r.t, r.id, r.before) for r in with_previous(d, "k", "t", ["id"], "before", max_rows).collect()), key=str)
    want = []
    for key in {k for _, k, _ in rows}:
        mine = sorted((at(t), i) for i, k, t in rows if k == key and t is not None)
        want += [(key, t, i, mine[n - 1][0] if n else None) for n, (t, i) in enumerate(mine)]
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("max_rows", [5, 10_000])
@pytest.mark.parametrize("gap", [0, 2])
def test_sessionize(spark, max_rows, gap):
    rows = rows_of(6, 120, span=300)
    d = spark.createDataFrame([(i, k, at(t)) for i, k, t in rows], "id long, k long, t timestamp")
    got = sorted((tuple(r) for r in sessionize(d, "k", "t", dt.timedelta(hours=gap), max_rows).collect()), key=str)
    want = []
    for key in {k for _, k, _ in rows}:
        runs = []
        for t in sorted(t for _, k, t in rows if k == key and t is not None):
            if runs and t - runs[-1][1] <= gap:
                runs[-1] = (runs[-1][0], t, runs[-1][2] + 1)
            else:
                runs.append((t, t, 1))
        want += [(key, at(a), at(b), n) for a, b, n in runs]
    assert got == sorted(want, key=str)


def test_rolling_sum(spark):
    d = spark.createDataFrame([(1, dt.date(2024, 1, k), k) for k in (1, 2, 2, 7, 8, 20)] + [(2, None, 5)], "k long, d date, v long")
    got = {r.day.day: (r.total, r.rolling) for r in rolling_sum(d, "k", F.col("d"), F.col("v"), 7).collect()}
    assert got == {1: (1, 1), 2: (4, 5), 7: (7, 12), 8: (8, 19), 20: (20, 20)}
    p = plan(rolling_sum(d, "k", F.col("d"), F.col("v"), 7))
    assert p.index("Window") < p.index("HashAggregate")  # one row a day reaches the frame


# ------------------------------------------------------------ global order


@pytest.mark.parametrize("partitions", [1, 5])
def test_global_order(spark, partitions):
    rng = random.Random(7)
    rows = [(i, 5 if rng.random() < 0.4 else rng.choice([None, *range(20)])) for i in range(200)]
    d = spark.createDataFrame(rows, "id long, v long").repartition(4)
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    got = {r.id: r.position for r in global_row_number(d, "v", "id", partitions=partitions).collect()}
    assert got == {r[0]: n for n, r in enumerate(order, 1)}
    values = [r[1] for r in order]
    distinct = sorted(set(values), key=lambda v: (v is not None, v or 0))
    ranked = {(r.id, r.v): (r["rank"], r.dense_rank) for r in global_rank(d, ["v"], partitions).collect()}
    assert ranked == {(i, v): (values.index(v) + 1, distinct.index(v) + 1) for i, v in rows}
    known = sorted(v for v in values if v is not None)
    got = {r.share: r.value for r in exact_quantiles(d, "v", [0, 0.1, 0.5, "0.9", 1], partitions).collect()}
    n = len(known)
    assert got == {float(s): known[max(1, -(-n * p // 10)) - 1] for s, p in ((0, 0), (0.1, 1), (0.5, 5), (0.9, 9), (1, 10))}


def test_global_order_of_nothing(spark):
    none = spark.createDataFrame([], "v long")
    assert global_row_number(none, "v").columns == ["v", "position"] and global_row_number(none, "v").count() == 0
    assert value_positions(none, ["v"]).count() == 0 and global_rank(none, ["v"]).count() == 0
    assert exact_quantiles(none, "v", [0.5]).count() == 0


def test_global_order_has_no_single_partition_window(spark):
    p = plan(catalog.queries()["global_order_position"](spark, SF))
    assert "SinglePartition" not in p and "Window" not in p
