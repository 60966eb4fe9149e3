"""Hard negatives by rotated one-bit codes with exact intervals.

Vectors become integers.  A row is stored with the signs of several
pseudo-rotations of it (its code) and with how well the code vector aligns with
it.  For an anchor, bit planes of its rotated components meet the codes in
popcounts; with the stored alignment these give an estimate of the inner
product, and Cauchy-Schwarz on what the code leaves out gives an interval that
holds the true one without exception.  Rows whose interval cannot be among the
best of a block are left out, the others are scored in integers, so the result
is exact.

Anchors meet all rows in blocks: a pair of blocks is one task's work, of which
only the best few rows of each anchor leave the task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakepipe.session import scratch_path

_ROWS, _ANCHORS, _TILE = 8192, 16384, 64  # rows and anchors of a block, anchors worked on at once
_PLANES = 6  # bits of a rotated component of an anchor
_SLACK = 1e-9  # of the product of two lengths: more than rounding can be
_LIMIT = 2.0**62


class OneBitCodes:
    """Codes, alignments and intervals for vectors of one dimension."""

    def __init__(self, dim: int, rotations: int = 4, seed: int = 0):
        self.dim, self.width = dim, 1 << max(0, (dim - 1).bit_length())
        self.signs = np.random.default_rng(seed).choice([-1.0, 1.0], (rotations, 3, self.width))
        self.bits = rotations * self.width
        self.words = -(-self.bits // 64)

    def _hadamard(self, y: np.ndarray) -> np.ndarray:
        h = 1
        while h < self.width:
            z = y.reshape(len(y), -1, 2, h)
            y = np.stack([z[:, :, 0] + z[:, :, 1], z[:, :, 0] - z[:, :, 1]], 2).reshape(len(y), self.width)
            h *= 2
        return y / np.sqrt(self.width)

    def turn(self, x: np.ndarray) -> np.ndarray:
        """All rotations of each row side by side, of the same length as the row."""
        out = []
        for signs in self.signs:
            y = np.zeros((len(x), self.width))
            y[:, : self.dim] = x
            for s in signs:
                y = self._hadamard(y * s)
            out.append(y)
        return np.concatenate(out, 1) / np.sqrt(len(out))

    def turn_back(self, y: np.ndarray) -> np.ndarray:
        """The transpose of ``turn``."""
        total = 0
        for k, signs in enumerate(self.signs):
            z = y[:, k * self.width : (k + 1) * self.width]
            for s in signs[::-1]:
                z = self._hadamard(z) * s
            total = total + z[:, : self.dim]
        return total / np.sqrt(len(self.signs))

    def _pack(self, bits: np.ndarray) -> np.ndarray:
        room = np.zeros((len(bits), self.words * 8), np.uint8)
        packed = np.packbits(bits, axis=1)
        room[:, : packed.shape[1]] = packed
        return room.view(np.uint64)

    def rows(self, c: np.ndarray) -> Codes:
        positive = self.turn(c) >= 0
        unit = np.where(positive, 1.0, -1.0) / np.sqrt(self.bits)
        seen = self.turn_back(unit)  # the code vector as far as it lies among the vectors
        square = (seen**2).sum(1)
        align = (c * seen).sum(1)
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = np.where(square > 0, align / square, 0.0)
            part = np.where(square > 0, align**2 / square, 0.0)
        lengths = (c**2).sum(1)
        return Codes(self._pack(positive), gain, np.sqrt(np.maximum(0.0, lengths - part)), square, positive.sum(1) * 2.0 - self.bits, np.sqrt(lengths))

    def intervals(self, q: np.ndarray, codes: Codes) -> tuple[np.ndarray, np.ndarray]:
        """(low, high) bounds of the inner product of each anchor with each row."""
        y = self.turn(q)
        start = y.min(1, keepdims=True)
        step = (y.max(1, keepdims=True) - start) / ((1 << _PLANES) - 1)
        step[step == 0] = 1.0
        levels = np.rint((y - start) / step).astype(np.int64)
        missed = np.sqrt(((y - (start + step * levels)) ** 2).sum(1))[:, None]
        met = np.zeros((len(q), len(codes.bits)), np.int32)
        for k in range(_PLANES):
            plane = self._pack((levels >> k & 1).astype(bool))
            count = np.zeros(met.shape, np.uint16)
            for w in range(self.words):
                count += np.bitwise_count(plane[:, w, None] & codes.bits[None, :, w])
            met += count.astype(np.int32) << k
        with_signs = 2.0 * met - levels.sum(1)[:, None]
        t = (step * with_signs + start * codes.ones) / np.sqrt(self.bits)  # inner product with the code vector
        length = np.sqrt((q**2).sum(1))[:, None]
        least = np.maximum(0.0, np.abs(t) - missed)
        with np.errstate(divide="ignore", invalid="ignore"):
            across = np.where(codes.square > 0, least**2 / codes.square, 0.0)
        half = np.abs(codes.gain) * missed + codes.rest * np.sqrt(np.maximum(0.0, length**2 - across))
        half += _SLACK * (length * codes.length + 1.0)
        most = length * codes.length * (1 + _SLACK)
        middle = codes.gain * t
        return np.maximum(middle - half, -most), np.minimum(middle + half, most)


@dataclass
class Codes:
    bits: np.ndarray  # packed signs
    gain: np.ndarray  # alignment over the square of the code vector's length: times an inner product with it, the estimate
    rest: np.ndarray  # length of what the code vector leaves out
    square: np.ndarray
    ones: np.ndarray  # sum of the signs
    length: np.ndarray

    def columns(self) -> list[pa.Array]:
        return [pa.array([b.tobytes() for b in self.bits], pa.binary()), *(pa.array(getattr(self, f)) for f in _STORED[1:])]

    @staticmethod
    def of(table: pa.Table, at: np.ndarray) -> Codes:
        """Those stored in some rows of a table."""
        part = table.select(_STORED).take(pa.array(at))
        bits = np.frombuffer(b"".join(part.column("bits").to_pylist()), np.uint64).reshape(len(at), -1)
        return Codes(bits, *(part.column(f).to_numpy() for f in _STORED[1:]))


_STORED = ["bits", "gain", "rest", "square", "ones", "length"]


def integer_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows (held as doubles): no sum reaches 2^62, and below 2^53 doubles are exact."""
    if len(q) and len(c) and np.sqrt((q**2).sum(1).max() * (c**2).sum(1).max()) < 2.0**52:
        return (q @ c.T).astype(np.int64)
    return q.astype(np.int64) @ c.astype(np.int64).T


def _integers(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches of rows of ``dim`` finite components, with floor(256 x) of each as doubles."""
    for batch in batches:
        if not batch.num_rows:
            continue
        flat = batch.column("v").flatten().cast(pa.float64())
        x = flat.to_numpy(zero_copy_only=False).reshape(-1, dim)
        good = np.isfinite(x).all(1)
        c = np.floor(256.0 * x[good])
        if len(c) and not (c**2).sum(1).max() < _LIMIT:
            raise ValueError("a vector's integers are so large that scores would not fit a long")
        yield batch.filter(pa.array(good)), c


_SCORED = "anchor long, row long, score long"


def _stacked(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    parts = column.to_pylist()
    return np.frombuffer(b"".join(parts), np.int32).reshape(len(parts), -1).astype(np.float64)


def _best_positives(table: pa.Table, codes: OneBitCodes, k: int) -> pa.Table:
    """The ``k`` best rows of an anchor's label in a pair of blocks."""
    ids, label, asks = (table.column(c).to_numpy(zero_copy_only=False) for c in ("i", "label", "q"))
    c, asks = _stacked(table.column("c")), asks.astype(bool)
    out = []
    for kind in np.unique(label[asks]):
        rows = np.flatnonzero(~asks & (label == kind))
        anchors = np.flatnonzero(asks & (label == kind))
        if not len(rows):
            continue
        rows = rows[np.argsort(ids[rows])]
        stored = Codes.of(table, rows)
        for a in range(0, len(anchors), _TILE):
            mine = anchors[a : a + _TILE]
            low, high = codes.intervals(c[mine], stored)
            other = ids[mine][:, None] != ids[rows][None, :]
            low[~other] = -np.inf
            edge = np.partition(low, -k, axis=1)[:, -k, None] if len(rows) > k else -np.inf
            open_ = other & (high >= edge)
            used = np.flatnonzero(open_.any(0))
            scores = integer_scores(c[mine], c[rows[used]])
            for j, anchor in enumerate(ids[mine]):
                at = np.flatnonzero(open_[j, used])
                s = scores[j, at]
                top = np.argsort(-s, kind="stable")[:k]  # rows are in the order of their ids
                out.append((np.full(len(top), anchor), ids[rows[used[at[top]]]], s[top]))
    return _table(out, ("anchor", "row", "score"))


def _best_negatives(table: pa.Table, codes: OneBitCodes, k: int, share: tuple[int, int]) -> pa.Table:
    """For each anchor and positive the ``k`` best rows of other labels in its window of scores."""
    ids, label, asks = (table.column(c).to_numpy(zero_copy_only=False) for c in ("i", "label", "q"))
    c, asks = _stacked(table.column("c")), asks.astype(bool)
    known = table.column("positives").to_pylist()
    rows, anchors = np.flatnonzero(~asks), np.flatnonzero(asks)
    out = []
    if len(rows):
        rows = rows[np.argsort(ids[rows])]
        stored = Codes.of(table, rows)
    for a in range(0, len(anchors) if len(rows) else 0, _TILE):
        mine = anchors[a : a + _TILE]
        low, high = codes.intervals(c[mine], stored)
        other = label[mine][:, None] != label[rows][None, :]
        # Windows of scores: share[0] * s <= 100 * score <= share[1] * s, in integers.
        windows = [[(-(-share[0] * p["score"] // 100), share[1] * p["score"] // 100, p) for p in known[m]] for m in mine]
        open_ = np.zeros(other.shape, bool)
        for n in range(max(map(len, windows))):
            least = np.array([w[n][0] if n < len(w) else 1 for w in windows], np.float64)[:, None]
            most = np.array([w[n][1] if n < len(w) else 0 for w in windows], np.float64)[:, None]
            inside = other & (high >= least) & (low <= most) & (least <= most)
            if len(rows) > k:
                sure = np.where(inside & (low >= least) & (high <= most), low, -np.inf)
                inside &= high >= np.partition(sure, -k, axis=1)[:, -k, None]
            open_ |= inside
        used = np.flatnonzero(open_.any(0))
        scores = integer_scores(c[mine], c[rows[used]])
        for j, anchor in enumerate(ids[mine]):
            at = np.flatnonzero(open_[j, used])
            s = scores[j, at]
            order = np.argsort(-s, kind="stable")
            falling = -s[order]
            for least, most, p in windows[j]:
                to = slice(np.searchsorted(falling, -most, "left"), np.searchsorted(falling, -least, "right"))
                best = order[to][:k]
                if len(best):
                    size = len(best)
                    out.append((np.full(size, anchor), np.full(size, p["row"]), np.full(size, p["score"]), ids[rows[used[at[best]]]], s[best]))
    return _table(out, ("anchor", "row", "score", "negative", "negative_score"))


def _table(parts: list[tuple[np.ndarray, ...]], names: tuple[str, ...]) -> pa.Table:
    columns = [np.concatenate(x).astype(np.int64) for x in zip(*parts)] if parts else [np.zeros(0, np.int64)] * len(names)
    return pa.table(dict(zip(names, map(pa.array, columns))))


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: Column,
    positives: int = 5,
    negatives: int = 3,
    share: tuple[int, int] = (50, 95),
    rotations: int = 4,
    seed: int = 0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(256 x); a score is the integer inner product with
    the anchor, higher first, ties to the smaller id.  An anchor's positives
    are its best other rows of the same label; its negatives for a positive
    are the best rows of other labels whose score is between the two ``share``
    (in percent) of the positive's.

    ``is_anchor`` and ``label`` are expressions over the rows.  Rows with a
    null id, label, vector or component, with a non-finite component or with
    another dimension than the most common one take no part.  Rows that repeat
    an id count once, the one with the smallest label and vector.  Fewer
    positives or negatives than asked for give fewer rows.  Other columns are
    ignored; an empty table gives an empty result.  Integers of 2^31 or more,
    or so large that a score might not fit a long, raise an error.
    """
    spark = rows.sparkSession
    named = rows.select(F.col(id_col).cast("long").alias("i"), label.cast("long").alias("label"), F.coalesce(is_anchor, F.lit(False)).alias("q"), F.col(vector_col).alias("v"))
    named = named.where("i is not null and label is not null and size(v) > 0")
    common = named.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if common is None:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    dim = common["d"]
    codes = OneBitCodes(dim, rotations, seed)

    def integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, c in _integers(batches, dim):
            whole = c.astype(np.int32)
            if (whole != c).any():
                raise ValueError("a component times 256 does not fit 32 bits")
            packed = pa.array([r.tobytes() for r in whole], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("label"), batch.column("q"), packed], ["i", "label", "q", "c"])

    path = scratch_path(spark, "hard-negatives")
    usable = named.where(F.size("v") == dim).mapInArrow(integers, "i long, label long, q boolean, c binary")
    one = usable.groupBy("i").agg(F.min(F.struct("label", "c", "q")).alias("r")).select("i", "r.*")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                yield pa.RecordBatch.from_arrays([*part.columns, *codes.rows(_stacked(part.column("c"))).columns()], [*part.schema.names, *_STORED])

    kinds = "i long, label long, c binary, q boolean, bits binary, gain double, rest double, square double, ones double, length double"
    one.mapInArrow(encode, kinds).write.parquet(f"{path}/rows")
    table = spark.read.parquet(f"{path}/rows")
    total = table.agg(F.count("*").alias("n"), F.count(F.when(F.col("q"), 1)).alias("a")).first()
    least = min(2 * spark.sparkContext.defaultParallelism, -(-total["n"] // 512))
    blocks, asked = max(1, least, -(-total["n"] // _ROWS)), max(1, -(-total["a"] // _ANCHORS))

    def met(anchors: DataFrame) -> DataFrame:
        """Every block of rows beside every block of anchors."""
        row_block, anchor_block = F.pmod(F.xxhash64("i"), F.lit(blocks)).cast("int"), F.pmod(F.xxhash64("i"), F.lit(asked)).cast("int")
        extra = [c for c in anchors.columns if c not in table.columns]
        mine = anchors.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("rb"), anchor_block.alias("ab"), "i", "label", F.lit(True).alias("q"), "c", *extra)
        # A row goes with its stored code, once for each block of anchors.
        all_rows = table.select(row_block.alias("rb"), F.explode(F.sequence(F.lit(0), F.lit(asked - 1))).alias("ab"), "i", "label", F.lit(False).alias("q"), "c", *_STORED)
        return all_rows.unionByName(mine, allowMissingColumns=True).groupBy("rb", "ab")

    def best(scored: DataFrame, keys: list[str], score: str, row: str, k: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(score), row))
        return scored.withColumn("rank", rank).where(F.col("rank") <= k)

    near = met(table.where("q")).applyInArrow(lambda t: _best_positives(t, codes, positives), _SCORED)
    kept = best(near, ["anchor"], "score", "row", positives)
    lists = kept.groupBy("anchor").agg(F.collect_list(F.struct("row", "score")).alias("positives"))  # ``positives`` of them at most
    anchors = table.where("q").join(lists, F.col("i") == F.col("anchor")).drop("anchor")
    anchors.write.parquet(f"{path}/anchors")
    anchors = spark.read.parquet(f"{path}/anchors")
    found = met(anchors).applyInArrow(lambda t: _best_negatives(t, codes, negatives, share), _SCORED + ", negative long, negative_score long")
    final = best(found, ["anchor", "row"], "negative_score", "negative", negatives)
    return final.select(
        F.col("anchor").alias("anchor_id"),
        F.col("row").alias("positive_id"),
        "rank",
        F.col("negative").alias("negative_id"),
        F.col("score").alias("positive_score"),
        "negative_score",
    )
