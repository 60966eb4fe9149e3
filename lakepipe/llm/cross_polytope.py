"""Approximate nearest neighbours by cross-polytope hashing.

A pseudo-rotation (three rounds of random signs and a fast Hadamard transform)
turns a unit vector; its hash is the signed axis nearest to the result.  Each
table has its own rotation.  A query looks into the buckets of the ``probes``
axes nearest to it in every table, and the candidates are ranked by the exact
inner product of the original vectors.

Nearness is the inner product, hashing sees directions: where lengths differ,
a row gets one more component that brings all rows to the greatest length, so
the nearest direction is the largest inner product.  How many axes to probe
follows from the data, on a bounded sample.  A query that meets fewer than
``k`` rows is compared with all rows.

A bucket is cut into blocks of bounded size, queries of a bucket likewise; a
pair of blocks is one matrix product, of which only the best ``k`` of each
query leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakepipe.session import scratch_path

_BLOCK = 4096  # rows, or queries, of a bucket in one product


def vectors(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(matrix of the usable vectors in double precision, their positions).

    Null, zero and empty vectors and those with null or non-finite components
    are left out, and so are vectors of another length than the longest run of
    equal lengths in the batch would give: the caller passes one dimension.
    """
    rows = column.to_pylist()
    keep, out = [], []
    for i, v in enumerate(rows):
        if v is None or not len(v) or any(x is None for x in v):
            continue
        a = np.array(v, np.float64)
        if np.isfinite(a).all() and a.any():
            keep.append(i)
            out.append(a)
    return (np.array(out) if out else np.zeros((0, 0))), np.array(keep, np.int64)


class Rotations:
    """The seeded pseudo-rotations of all tables."""

    def __init__(self, dim: int, tables: int, seed: int):
        self.dim, self.width = dim, 1 << max(1, (dim - 1).bit_length())
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (tables, 3, self.width))

    def apply(self, x: np.ndarray, table: int) -> np.ndarray:
        y = np.zeros((len(x), self.width))
        y[:, : self.dim] = x
        for signs in self.signs[table]:
            y *= signs
            h = 1
            while h < self.width:
                y = y.reshape(len(x), -1, 2, h)
                y = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), self.width)
                h *= 2
        return y

    def axes(self, x: np.ndarray, table: int, probes: int) -> np.ndarray:
        """The ``probes`` nearest signed axes of each row, nearest first; axis a is +a, width + a is -a."""
        y = self.apply(x, table)
        both = np.concatenate([y, -y], 1)
        return np.argsort(-both, 1, kind="stable")[:, :probes]


def probes_for(x: np.ndarray, rotations: Rotations, greatest: float, k: int, recall: float) -> int:
    """Axes to probe so that a share ``recall`` of the nearest rows of a sample is met.

    In a sample neighbours lie farther away than among all rows, so the
    number errs upwards.
    """
    asked = x[: max(1, len(x) // 8)]
    k = min(k, len(x) - 1)
    if k < 1:
        return 2 * rotations.width
    scores = asked @ x.T
    scores[np.arange(len(asked)), np.arange(len(asked))] = -np.inf
    top = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    first = np.full(top.shape, 2 * rotations.width)
    for t in range(len(rotations.signs)):
        bucket = rotations.axes(raised(x, greatest, rotations.dim), t, 1)[:, 0]
        order = rotations.axes(asking(asked, rotations.dim), t, 2 * rotations.width)
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
        first = np.minimum(first, np.take_along_axis(place, bucket[top], 1))
    return int(np.quantile(first, recall, method="higher")) + 1


def raised(x: np.ndarray, greatest: float, dim: int) -> np.ndarray:
    """Unit vectors of rows; with a dimension more than ``x`` has, by what each lacks of the greatest length."""
    if dim == x.shape[1]:
        return x / np.linalg.norm(x, axis=1, keepdims=True)
    part = x / greatest
    return np.column_stack([part, np.sqrt(np.maximum(0.0, 1.0 - (part**2).sum(1)))])


def asking(x: np.ndarray, dim: int) -> np.ndarray:
    """Unit vectors of queries; a dimension more is zero."""
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    return unit if dim == x.shape[1] else np.column_stack([unit, np.zeros(len(x))])


def nearest(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    tables: int = 4,
    probes: int | None = None,
    seed: int = 0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    recall: float = 0.96,
    sample_bytes: int = 4 << 20,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best found rows for each query row, its own left out.

    ``is_query`` is a condition on the rows.  The score is the inner product
    of the original vectors in double precision, best first, ties to the
    smaller id.  ``probes`` axes are looked into in each of ``tables``; by
    default as many as bring the share ``recall`` of the nearest rows of a
    sample of ``sample_bytes``.  All candidates come, if there are fewer than
    ``k``.  Vectors that are null, empty, zero or hold a null or non-finite
    component take no part, nor do rows with a null id or vectors of another
    dimension than the most common one.  Repeated rows are repeated candidates
    of one id and give it once.  Other columns are ignored; an empty table
    gives an empty result.
    """
    spark = rows.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    single = str(rows.schema[vector_col].dataType.elementType) == "FloatType()"
    kind = np.float32 if single else np.float64
    usable = rows.select(F.col(id_col).cast("long").alias("i"), F.col(vector_col).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q"))
    usable = usable.where("i is not null and size(v) > 0")
    square = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    proper = F.when(square < float("inf"), square)
    dims = usable.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("count"), F.max(proper).alias("most"), F.min(F.when(proper > 0, proper)).alias("least")).orderBy(F.desc("count"), "d").first()
    if dims is None or not dims["most"]:
        return spark.createDataFrame([], schema)
    usable = usable.where(F.size("v") == dims["d"])
    greatest = dims["most"] ** 0.5
    # Rows of one length need no more than their direction.
    dim = dims["d"] + (dims["least"] < dims["most"] * (1 - 1e-6))
    rotations = Rotations(dim, tables, seed)
    if probes is None:
        few = usable.orderBy(F.xxhash64("i"), "i").limit(max(2 * k, sample_bytes // (8 * dims["d"])))
        x, _ = vectors(pa.array([r["v"] for r in few.select("v").collect()]))
        probes = probes_for(x, rotations, greatest, k, recall) if len(x) else 1
    probes = max(1, min(probes, 2 * rotations.width))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _BLOCK):
                part = batch.slice(at, _BLOCK)
                x, kept = vectors(part.column("v"))
                if not len(kept):
                    continue
                packed = pa.array([v.astype(kind).tobytes() for v in x], pa.binary())
                ids = part.column("i").take(pa.array(kept))
                asks = np.array(part.column("q").to_pylist(), bool)[kept]
                for t in range(tables):
                    yield _rows(t, rotations.axes(raised(x, greatest, dim), t, 1)[:, 0], ids, packed, False)
                    if asks.any():
                        who = pa.array(np.repeat(np.flatnonzero(asks), probes))
                        yield _rows(t, rotations.axes(asking(x[asks], dim), t, probes).ravel(), ids.take(who), packed.take(who), True)

    path = scratch_path(spark, "cross-polytope")
    usable.mapInArrow(hashed, _ENTRY).write.parquet(f"{path}/entries")
    entries = spark.read.parquet(f"{path}/entries")
    _best(_meet(entries, k, kind), k).write.parquet(f"{path}/found")
    found = spark.read.parquet(f"{path}/found")

    # A query with fewer rows than there are to find meets all rows, in blocks.
    all_rows = entries.where("t = 0 and not q")
    n_ids = all_rows.select("i").distinct().count()
    asked = entries.where("t = 0 and q").select("i", "v").dropDuplicates(["i", "v"])
    counts = found.groupBy(F.col("query_id").alias("i")).agg(F.count("*").alias("n"))
    short = asked.join(counts, "i", "left").where(F.coalesce("n", F.lit(0)) < min(k, n_ids - 1)).select(F.lit(0).alias("t"), F.lit(0).alias("b"), "i", "v", F.lit(True).alias("q"))
    short.write.parquet(f"{path}/short")
    short = spark.read.parquet(f"{path}/short")
    if short.isEmpty():
        return found.select("query_id", "rank", "vec_id", "score")
    whole = _best(_meet(all_rows.withColumn("b", F.lit(0)).unionByName(short), k, kind), k)
    rest = found.join(short.select(F.col("i").alias("query_id")).distinct(), "query_id", "left_anti")
    return rest.unionByName(whole).select("query_id", "rank", "vec_id", "score")


_ENTRY = "t int, b int, i long, v binary, q boolean"


def _best(found: DataFrame, k: int) -> DataFrame:
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k)


def _meet(entries: DataFrame, k: int, kind: type) -> DataFrame:
    """(query_id, vec_id, score): of each pair of blocks of a bucket the best ``k`` rows of each query."""
    # The number of blocks of a bucket follows from its rows; there are at most tables * 2 * width buckets.
    blocks = entries.groupBy("t", "b").agg(
        F.ceil(F.count(F.when(~F.col("q"), 1)) / _BLOCK).cast("int").alias("nr"), F.ceil(F.count(F.when(F.col("q"), 1)) / _BLOCK).cast("int").alias("nq")
    )
    dealt = entries.join(F.broadcast(blocks.where("nr > 0 and nq > 0")), ["t", "b"])
    mine, row_block = F.xxhash64("i"), F.col("nr")
    row_of = F.pmod(mine, row_block).cast("int")
    query_of = F.pmod(mine, F.col("nq")).cast("int")
    # A row block meets every query block of its bucket.
    placed = dealt.where("not q").select("t", "b", row_of.alias("rb"), F.explode(F.sequence(F.lit(0), F.col("nq") - 1)).alias("qb"), "i", "v", "q")
    asked = dealt.where("q").select("t", "b", F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("rb"), query_of.alias("qb"), "i", "v", "q")

    def product(table: pa.Table) -> pa.Table:
        ids = table.column("i").to_numpy()
        x = np.frombuffer(b"".join(table.column("v").to_pylist()), kind).reshape(len(ids), -1).astype(np.float64)
        asks = table.column("q").to_numpy(zero_copy_only=False).astype(bool)
        qs, rs = ids[asks], ids[~asks]
        out_q, out_i, out_s = [], [], []
        if len(qs) and len(rs):
            data, wanted = x[~asks], x[asks]
            longest = np.sqrt((data**2).sum(1).max())
            for a in range(0, len(qs), 256):
                sims = wanted[a : a + 256] @ data.T
                # The product only chooses, with room for its rounding; scores are summed the same way everywhere.
                near = 1e-12 * longest * np.sqrt((wanted[a : a + 256] ** 2).sum(1))
                sims[qs[a : a + 256, None] == rs[None, :]] = -np.inf
                take = min(len(rs), k + 8)
                top = np.argpartition(-sims, take - 1, axis=1)[:, :take]
                for j in range(len(top)):
                    cand = top[j][np.isfinite(sims[j, top[j]])]
                    if len(cand) == take < len(rs):
                        cand = np.union1d(cand, np.flatnonzero(sims[j] >= sims[j, cand].min() - near[j]))
                    score = (data[cand] * wanted[a + j]).sum(1)
                    order = np.lexsort((rs[cand], -score))
                    # One place an id: copies of a row do not take those of others.
                    _, once = np.unique(rs[cand][order], return_index=True)
                    order = order[np.sort(once)][:k]
                    out_q.append(np.full(len(order), qs[a + j]))
                    out_i.append(rs[cand][order])
                    out_s.append(score[order])
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        return pa.table({"query_id": pa.array(cat(out_q, np.int64)), "vec_id": pa.array(cat(out_i, np.int64)), "score": pa.array(cat(out_s, np.float64))})

    return placed.unionByName(asked).groupBy("t", "b", "rb", "qb").applyInArrow(product, "query_id long, vec_id long, score double")


def _rows(t: int, buckets: np.ndarray, ids: pa.Array, packed: pa.Array, query: bool) -> pa.RecordBatch:
    n = len(buckets)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(n, t, np.int32)), pa.array(buckets.astype(np.int32)), ids, packed, pa.array(np.full(n, query))], ["t", "b", "i", "v", "q"]
    )
