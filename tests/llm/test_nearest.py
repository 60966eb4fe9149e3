"""Cross-polytope search: small and long tables, lengths that differ, small dimensions, ties, edge rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakepipe.llm.cross_polytope import nearest

SCHEMA = "vec_id long, embedding array<double>"


def table(spark, x, ids=None):
    return spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids if ids is not None else range(len(x)), x)], SCHEMA)


def exact(x, queries, k):
    out = {}
    for q in queries:
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        out[q] = sorted(range(len(x)), key=lambda i: (-s[i], i))[: min(k, len(x) - 1)]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append(r.vec_id)
        assert len(out[r.query_id]) == r["rank"]
    return out


@pytest.mark.parametrize("n,dim", [(2, 3), (21, 64), (25, 8), (60, 1), (60, 5)])
def test_small_tables_give_all_there_is(spark, n, dim):
    x = np.random.default_rng(n).normal(size=(n, dim))
    got = found(nearest(table(spark, x), F.col("vec_id") % 7 == 0))
    assert {q: len(v) for q, v in got.items()} == {q: min(20, n - 1) for q in range(0, n, 7)}


def test_few_probes_are_made_up_for_by_an_exact_pass(spark):
    x = np.random.default_rng(1).normal(size=(300, 32))
    got = found(nearest(table(spark, x), F.col("vec_id") % 50 == 0, k=299, probes=1, tables=1))
    assert got == exact(x, range(0, 300, 50), 299)


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall_where_lengths_differ(spark, spread):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(4000, 48))
    x *= rng.lognormal(0, spread, (4000, 1)) / np.linalg.norm(x, axis=1, keepdims=True)
    got, want = found(nearest(table(spark, x), F.col("vec_id") % 20 == 0)), exact(x, range(0, 4000, 20), 20)
    assert all(len(v) == 20 for v in got.values()) and len(got) == 200
    assert np.mean([len(set(got[q]) & set(want[q])) / 20 for q in want]) >= 0.9


def test_clustered_rows_need_few_probes(spark):
    from lakepipe.llm.cross_polytope import Rotations, probes_for

    rng = np.random.default_rng(3)
    centres = rng.normal(size=(100, 64))
    close = centres[rng.integers(0, 100, 3000)] + 0.05 * rng.normal(size=(3000, 64))
    apart = rng.normal(size=(3000, 64))
    r = Rotations(64, 4, 0)
    close, apart = (v / np.linalg.norm(v, axis=1, keepdims=True) for v in (close, apart))
    assert probes_for(close, r, 1.0, 20, 0.96) < 12 < probes_for(apart, r, 1.0, 20, 0.96)


def test_ties_of_large_scores_and_copies(spark):
    x = np.zeros((80, 4))
    x[:, 0] = 1e6
    x[40:, 1] = 1.0
    got = found(nearest(table(spark, x), F.col("vec_id") == 79, k=5))
    assert got == {79: [40, 41, 42, 43, 44]}
    twice = table(spark, np.repeat(x[38:50], 3, 0), np.repeat(np.arange(38, 50), 3))
    assert found(nearest(twice, F.col("vec_id") == 41, k=20))[41] == [40, *range(42, 50), 38, 39]


def test_edge_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, None), (2, []), (3, [0.0, 0.0]), (4, [None, 1.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (None, [1.0, 1.0]), (7, [1.0]), (8, [0.5, 0.5]), (8, [0.5, 0.5])]
    d = spark.createDataFrame([(*r, 1, "x", 2.0) for r in rows], "vec_id long, embedding array<double>, i int, t string, score double")
    assert found(nearest(d, F.col("vec_id") % 4 == 0)) == {0: [8], 8: [0]}
    for none in (d.where("false"), d.where("vec_id = 3"), d.where("vec_id is null")):
        assert nearest(none, F.lit(True)).collect() == []
    assert nearest(d.where("vec_id = 0"), F.lit(True)).count() == 0
