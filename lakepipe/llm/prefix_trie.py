"""Prefix trie of conversations by union-find over sorted neighbours.

A conversation becomes a path: a 16-byte digest for each turn.  Paths are sorted
over range partitions; the common prefix of two neighbours is an edge between
them.  Each partition takes its edges from the deepest up: joining two
components makes a branching node, so its forest is built from the leaves.

Only nodes on the first and last path of a partition can reach into another
one, as deep as the common prefix with the neighbour there.  These are
contracted to one row each, with sums that add up (a node counts as new in the
leftmost partition that has it), and merged across boundaries by the digest of
their prefix.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakepipe.session import checkpoint_root, scratch_path

_TURN = 16  # bytes of a turn's digest
_PART_BYTES = 8 << 20  # of paths in a partition
_PART_ROWS = 50_000
_OUT = 1 << 16
NO_ENDS = hashlib.sha256(b"").hexdigest()


def conversation_paths(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, path, sizes) of every conversation: digests of its turns side by side, and their code points.

    Turns are in the order of their number, null first, equal numbers in the
    order of their digests; repeated rows are turns of their own.  A null role
    or text counts as empty; rows without a conversation id take no part.
    Texts stay where they are: a turn travels as 16 bytes and a number.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    rows = turns.select(F.col(conv_col).cast("long").alias("conv"), F.struct(F.col(turn_col).alias("at"), digest.alias("d"), F.length(text).cast("long").alias("n")).alias("t"))
    gathered = rows.where("conv is not null").groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return gathered.select("conv", F.unhex(F.array_join("t.d", "")).alias("path"), F.col("t.n").alias("sizes"))


def with_base(paths: DataFrame, base: Column, keep: Column, most: int) -> DataFrame:
    """Every path with its first ``keep`` turns replaced by those of the path ``base`` names (all if fewer, none if absent).

    ``keep`` is ``most`` at most.
    """
    heads = paths.select(F.col("conv").alias("b"), F.substring("path", 1, most * _TURN).alias("b_path"), F.slice("sizes", 1, most).alias("b_sizes"))
    cut = paths.select("*", base.alias("b"), keep.cast("int").alias("k")).join(heads, "b", "left")
    head = F.coalesce(F.substring(F.col("b_path"), F.lit(1), F.col("k") * _TURN), F.lit(b""))
    sizes = F.coalesce(F.slice(F.col("b_sizes"), F.lit(1), F.col("k")), F.array().cast("array<long>"))
    return cut.select(
        "conv",
        F.concat(head, F.substring(F.col("path"), F.col("k") * _TURN + 1, F.octet_length("path"))).alias("path"),
        F.concat(sizes, F.slice(F.col("sizes"), F.col("k") + 1, F.size("sizes"))).alias("sizes"),
    )


def common_turns(a: bytes, b: bytes) -> int:
    """How many turns two paths begin with in common."""
    n = min(len(a), len(b))
    if n > 64 * _TURN:
        differ = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
        return (int(differ.argmax()) if differ.any() else n) // _TURN
    for at in range(0, n, _TURN):
        if a[at : at + _TURN] != b[at : at + _TURN]:
            return at // _TURN
    return n // _TURN


class Forest:
    """The nodes of one partition's sorted paths.

    ``left`` and ``right`` are the common turns with the paths before and
    after the partition, -1 where there are none.  A node is known by its
    deepest point; the points between it and its parent have the same members.
    """

    def __init__(self, ids: list[int], paths: list[bytes], sizes: list[list[int]], left: int, right: int):
        self.ids, self.paths, self.left, self.right = ids, paths, left, right
        n = len(ids)
        self.length = [len(p) // _TURN for p in paths]
        self.sums = [list(accumulate(s, initial=0)) for s in sizes]
        shared = [common_turns(a, b) for a, b in zip(paths, paths[1:])]
        after = [*shared, right]
        # One node a conversation; the last copy of one that nothing continues is a leaf.
        self.depth, self.first, self.last = list(self.length), list(range(n)), list(range(n))
        self.members, self.least = [1] * n, list(ids)
        self.total = [s[-1] for s in self.sums]
        self.leaves = [int(shared < length) for shared, length in zip(after, self.length)]
        self.kids, self.below = [0] * n, [0] * n
        self.up, self.same = [-1] * n, [-1] * n
        self.set, self.node = list(range(n)), list(range(n))
        for i in np.argsort(-np.array(shared, np.int64), kind="stable").tolist():
            self._merge(i, i + 1, shared[i])
        self.root = self.node[self._find(0)]
        if self.depth[self.root]:
            self.root = self._raise(self.root, 0)

    def _find(self, i: int) -> int:
        while self.set[i] != i:
            self.set[i] = self.set[self.set[i]]
            i = self.set[i]
        return i

    def _merge(self, i: int, j: int, depth: int) -> None:
        a, b = self._find(i), self._find(j)
        x, y = (v if self.depth[v] == depth else self._raise(v, depth) for v in (self.node[a], self.node[b]))
        self.same[y] = x
        self.last[x] = self.last[y]
        self.least[x] = min(self.least[x], self.least[y])
        for sums in (self.members, self.total, self.leaves, self.kids, self.below):
            sums[x] += sums[y]
        self.set[b] = a
        self.node[a] = x

    def _raise(self, x: int, depth: int) -> int:
        """A new node at ``depth`` with ``x`` as its only child."""
        y = len(self.depth)
        for values in (self.first, self.last, self.members, self.least, self.total, self.leaves):
            values.append(values[x])
        self.depth.append(depth)
        self.kids.append(int(self.new(x, depth + 1)))
        self.below.append(self.below[x] + self._new_sizes(x, depth))
        self.up.append(-1)
        self.same.append(-1)
        self.up[x] = y
        return y

    def new(self, x: int, depth: int) -> bool:
        """Whether no partition before has the point of ``x`` at ``depth``."""
        return self.first[x] > 0 or depth > self.left

    def open(self, x: int, depth: int) -> bool:
        """Whether another partition may have that point too."""
        return (self.first[x] == 0 and depth <= self.left) or (self.last[x] == len(self.ids) - 1 and depth <= self.right)

    def _new_sizes(self, x: int, depth: int) -> int:
        """Code points of the new points of ``x`` below ``depth``."""
        sums = self.sums[self.first[x]]
        start = depth if self.first[x] else max(depth, self.left)
        return max(0, sums[self.depth[x]] - sums[min(start, self.depth[x])])

    def rows(self, part: int) -> Iterator[tuple]:
        """One row a point, of the schema ``_NODES``; an open one has partial sums, and its ends in a row of its own."""
        keys = [self._digests(self.paths[0], self.left), self._digests(self.paths[-1], self.right)]
        for x in range(len(self.depth)):
            if self.same[x] >= 0:
                continue
            parent, top = self.up[x], 0
            if parent >= 0:
                while self.same[parent] >= 0:
                    parent = self.same[parent]
                top = self.depth[parent] + 1
            sums, bottom = self.sums[self.first[x]], self.depth[x]
            for e in range(top, bottom + 1):
                above = parent if e == top else x
                side = int(self.first[x] > 0)
                kids = self.kids[x] if e == bottom else int(self.new(x, e + 1))
                spent = self.total[x] - self.members[x] * (sums[e - 1] if e else 0)
                saved = spent - self.below[x] - self._new_sizes(x, e - 1) if e else spent - self.below[x] - self._new_sizes(x, 0)
                ends = self._ends(x) if e == bottom else ""
                values = (self.least[x], self.members[x], kids, self.leaves[x], saved)
                if self.open(x, e):
                    prefixes = keys[0] if side == 0 and e <= self.left else keys[1]
                    key = prefixes[e]
                    yield (1, part, side, e, key, prefixes[e - 1] if e else None, None, None, *values, None)
                    if ends:
                        yield (2, part, side, e, key, None, None, None, self.ids[self.first[x]], 0, 0, 0, 0, ends)
                else:
                    waits = above >= 0 and self.open(above, e - 1)
                    known = self.least[above] if above >= 0 and not waits else None
                    of = int(self.first[above] > 0) if waits else None
                    yield (0, part, side, e, None, None, of, known, *values, hashlib.sha256(ends.encode()).hexdigest() if ends else NO_ENDS)

    def _ends(self, x: int) -> str:
        """The conversations that end at node ``x``; sorted, they come first in it."""
        end = self.first[x]
        while end <= self.last[x] and self.length[end] == self.depth[x]:
            end += 1
        return ",".join(map(str, self.ids[self.first[x] : end]))

    @staticmethod
    def _digests(path: bytes, depth: int) -> list[bytes]:
        """Of the prefix at every depth up to the given one."""
        state = hashlib.md5(usedforsecurity=False)
        out = [state.digest()]
        for e in range(depth):
            state.update(path[e * _TURN : (e + 1) * _TURN])
            out.append(state.copy().digest())
        return out


_NODES = (
    "kind int, part int, side int, depth long, key binary, parent_key binary, parent_side int, parent long, "
    "conv long, members long, kids long, leaves long, saved long, ends string"
)
_NODE_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), *[pa.int64()] * 6, pa.string()]


def _firsts_and_lasts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    first = last = part = None
    for batch in batches:
        if batch.num_rows:
            part = batch.column("part")[0]
            first = batch.column("path")[0] if first is None else first
            last = batch.column("path")[batch.num_rows - 1]
    if part is not None:
        yield pa.RecordBatch.from_arrays([pa.array([part.as_py()], pa.int32()), pa.array([first.as_py()]), pa.array([last.as_py()])], ["part", "first", "last"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n = [common_turns(a, b) for a, b in zip(batch.column("last").to_pylist(), batch.column("first").to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column("part"), batch.column("then"), pa.array(n, pa.int64())], ["part", "then", "shared"])


def _hash_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces, comma-joined, read in order one after the other."""
    key, state = None, None
    for batch in batches:
        keys, out = [], []
        for k, piece in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist()):
            if k != key:
                if key is not None:
                    keys.append(key)
                    out.append(state.hexdigest())
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(piece.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], ["key", "sha"])
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "sha"])


def trie_nodes(paths: DataFrame) -> DataFrame:
    """All nodes of the trie of ``paths`` (conv, path, sizes; one row a conversation), from the root at depth 0.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256): smallest member, turns, the parent's smallest
    member (null for the root), members, children, childless nodes of the
    subtree, the code points that members beyond the first repeat in the
    subtree, and the SHA-256 of the comma-joined ids of members that end here.
    Conversations without turns are members of the root.  Without any
    conversation there is no node.

    A path is one row and a partition holds whole paths, so the longest
    conversation must fit a task (24 bytes a turn).
    """
    spark = paths.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
    place = scratch_path(spark, "prefix-trie")
    paths.write.parquet(f"{place}/paths")
    paths = spark.read.parquet(f"{place}/paths")
    size = paths.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("path")), F.lit(0)).alias("b")).first()
    least = min(2 * spark.sparkContext.defaultParallelism, -(-size["n"] // 256))
    parts = max(1, least, -(-size["n"] // _PART_ROWS), -(-size["b"] // _PART_BYTES))
    # The checkpoint keeps partitions as they are, so both passes see the same ranges.
    ranged = paths.repartitionByRange(parts, "path", "conv").sortWithinPartitions("path", "conv").checkpoint().withColumn("part", F.spark_partition_id())
    ranged.select("part", "path").mapInArrow(_firsts_and_lasts, "part int, first binary, last binary").write.parquet(f"{place}/ends")
    ends = spark.read.parquet(f"{place}/ends")
    order = sorted(r["part"] for r in ends.select("part").collect())  # one number a partition
    pairs = spark.createDataFrame(list(zip(order, order[1:])), "part int, then int")
    met = ends.select("part", "last").join(pairs, "part").join(ends.select(F.col("part").alias("then"), "first"), "then")
    right, left = {}, {}
    for r in met.select("part", "then", "last", "first").mapInArrow(_shared, "part int, then int, shared long").collect():
        right[r["part"]] = left[r["then"]] = r["shared"]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, steps, sizes, part = [], [], [], None
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                ids += batch.column("conv").to_pylist()
                steps += batch.column("path").to_pylist()
                sizes += batch.column("sizes").to_pylist()
        if part is None:
            return
        rows = []
        for row in Forest(ids, steps, sizes, left.get(part, -1), right.get(part, -1)).rows(part):
            rows.append(row)
            if len(rows) == _OUT:
                yield _batch(rows)
                rows = []
        yield _batch(rows)

    ranged.select("part", "conv", "path", "sizes").mapInArrow(build, _NODES).write.parquet(f"{place}/nodes")
    nodes = spark.read.parquet(f"{place}/nodes")
    done, shared, pieces = (nodes.where(F.col("kind") == k) for k in range(3))
    merged = shared.groupBy("key", "depth").agg(
        F.min("parent_key").alias("parent_key"), F.min("conv").alias("conv"), *(F.sum(c).alias(c) for c in ("members", "kids", "leaves", "saved"))
    )
    hashed = pieces.select("key", "conv", "ends").repartition("key").sortWithinPartitions("key", "conv").mapInArrow(lambda b: _hash_ends(x.select(["key", "ends"]) for x in b), "key binary, sha string")
    parents = merged.select(F.col("key").alias("parent_key"), F.col("conv").alias("parent"))
    across = merged.join(parents, "parent_key", "left").join(hashed, "key", "left").withColumn("ends", F.coalesce("sha", F.lit(NO_ENDS)))
    # Children of an open node find its smallest member under their own partition, so no node's children meet in one task.
    spine = shared.select("key", "part", F.col("side").alias("parent_side"), (F.col("depth") + 1).alias("depth")).join(merged.select("key", F.col("conv").alias("parent")), "key")
    waiting = done.where("parent_side is not null").drop("parent").join(spine.drop("key"), ["part", "parent_side", "depth"])
    columns = ["conv", "depth", "parent", "members", "kids", "leaves", "saved", "ends"]
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    whole = done.where("parent_side is null").select(columns).unionByName(waiting.select(columns)).unionByName(across.select(columns))
    return whole.toDF(*names)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(_NODE_TYPES)
    names = [c.split()[0] for c in _NODES.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _NODE_TYPES)], names)
