"""Connected components against union-find, and the size of a round's plan."""

import random

from pyspark.sql.readwriter import DataFrameWriter

from lakepipe.llm.components import components


def _roots(edges):
    root = {v: v for e in edges for v in e}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for e in edges if e[0] != e[1] for v in e}


def test_rounds_have_small_plans(spark, tmp_root, monkeypatch):
    """A path, a star, a random graph, repeated and turned edges, a loop; links come united from two writes."""
    rng = random.Random(5)
    edges = [(v, v + 1) for v in range(12)] + [(120, v) for v in range(100, 120)] + [(b, a) for a, b in [(3, 4), (100, 120)]] + [(40, 41), (40, 41), (60, 60)]
    edges += [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    for k in range(2):
        spark.createDataFrame(edges[k::2], "a long, b long").distinct().write.parquet(f"{tmp_root}/links-{k}")
    links = spark.read.parquet(f"{tmp_root}/links-0").unionByName(spark.read.parquet(f"{tmp_root}/links-1"))
    plans, write = [], DataFrameWriter.parquet

    def spy(self, path, *args, **options):
        plans.append(self._df._jdf.queryExecution().executedPlan().toString().count("Exchange"))
        return write(self, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", spy)
    got = components(links, f"{tmp_root}/rounds").collect()
    assert len(got) == len({r.v for r in got}) and {r.v: r.root for r in got} == _roots(edges)
    assert len(plans) > 1 and max(plans) <= 10, plans
