"""Hard negatives: intervals that never fail, the whole result against brute force and SQL, edge rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepipe.llm.hard_negatives import OneBitCodes, hard_negatives, integer_scores
from lakepipe.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.01"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, is_anchor, positives=5, negatives=3, share=(50, 95)):
    """Straight from the definition, in Python integers."""
    seen = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        c = [int(np.floor(256.0 * x)) for x in v]
        seen[i] = min(seen.get(i, (label, c)), (label, c))
    out = []
    for a in sorted(filter(is_anchor, seen)):
        label, q = seen[a]
        scored = sorted((-sum(x * y for x, y in zip(q, c)), i) for i, (_, c) in seen.items() if i != a)
        near = [(-s, i) for s, i in scored if seen[i][0] == label][:positives]
        for best, p in near:
            fits = [(-s, i) for s, i in scored if seen[i][0] != label and share[0] * best <= -100 * s <= share[1] * best]
            out += [(a, p, r, i, best, s) for r, (s, i) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("dim", [1, 3, 8, 64, 100])
@pytest.mark.parametrize("rotations", [1, 4])
def test_intervals_hold_every_score(dim, rotations):
    rng = np.random.default_rng(dim)
    c = np.floor(rng.normal(size=(300, dim)) * rng.lognormal(3, 2, (300, 1)))
    c[:3] = 0
    c[3:6] = c[6:9]
    q = c[:40]
    codes = OneBitCodes(dim, rotations)
    low, high = codes.intervals(q, codes.rows(c))
    exact = integer_scores(q, c)
    assert (low <= exact).all() and (exact <= high).all()
    assert np.isfinite(low).all() and np.isfinite(high).all()


def test_more_rotations_narrow_the_intervals():
    c = np.floor(np.random.default_rng(0).normal(size=(500, 64)) * 100)
    width = []
    for rotations in (1, 4, 16):
        codes = OneBitCodes(64, rotations)
        low, high = codes.intervals(c[:50], codes.rows(c))
        width.append((high - low).mean())
    assert width[0] > 1.4 * width[1] > 1.8 * width[2]


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    want = con.execute(ORACLES["op12_hard_negatives"]).fetchdf()
    assert found(QUERIES["op12_hard_negatives"](spark, SF)) == sorted(want[COLUMNS].itertuples(index=False, name=None))
    assert len(want) > 100


def test_clusters_copies_ties_and_lengths(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 16))
    rows = []
    for i in range(900):
        v = centres[i % 6] + 0.3 * rng.normal(size=16) if i % 3 else centres[0]  # a third are copies
        rows.append((i, [float(x) for x in v * rng.lognormal(0, 0.5 * (i % 3 > 0))], int(i % 4)))
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = found(hard_negatives(d, F.col("vec_id") % 50 == 0, F.col("label")))
    assert got == brute(rows, lambda i: i % 50 == 0) and got
    assert found(hard_negatives(d, F.col("vec_id") < 9, F.col("label"), 2, 7, (10, 100), rotations=1)) == brute(rows, lambda i: i < 9, 2, 7, (10, 100))


def test_large_integers_are_exact(spark):
    rng = np.random.default_rng(6)
    rows = [(i, [float(x) for x in rng.integers(-(10**6), 10**6, 8) + 0.25], i % 2) for i in range(60)]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert found(hard_negatives(d, F.col("vec_id") % 5 == 0, F.col("label"))) == brute(rows, lambda i: i % 5 == 0)


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (1, [0.9, 0.1], 1), (2, [0.7, 0.2], 2), (3, [0.7, 0.2], 3), (4, [0.7, 0.2], 3)]
    rows += [(5, [0.6, 0.0], 2), (6, None, 1), (7, [1.0, None], 1), (8, [nan, 1.0], 2), (9, [inf, 1.0], 2), (10, [0.8, 0.0], None)]
    rows += [(None, [0.8, 0.0], 2), (11, [], 1), (50, [0.0, 0.0], 2), (100, [-1.0, 0.5], 7)]
    d = spark.createDataFrame([(*r, 1, "x", 0.5) for r in rows], "vec_id long, embedding array<double>, label int, i int, c string, score double")
    got = found(hard_negatives(d, F.col("vec_id") % 50 == 0, F.col("label")))
    assert got == brute([r for r in rows if r[1] != []], lambda i: i % 50 == 0)
    assert [g[3] for g in got if g[0] == 0] == [2, 3, 4]
    other = spark.createDataFrame([*rows, (12, [1.0], 1)], "vec_id long, embedding array<double>, label int")
    assert found(hard_negatives(other, F.col("vec_id") % 50 == 0, F.col("label"))) == got
    empty = hard_negatives(d.where("vec_id > 1000"), F.col("vec_id") % 50 == 0, F.col("label"))
    assert empty.columns == COLUMNS and empty.count() == 0
    assert hard_negatives(d.where("vec_id in (1, 2)"), F.col("vec_id") % 50 == 0, F.col("label")).count() == 0
    with pytest.raises(Exception, match="32 bits|fit a long"):
        hard_negatives(spark.createDataFrame([(0, [1e300], 1)], "vec_id long, embedding array<double>, label int"), F.lit(True), F.col("label")).count()
