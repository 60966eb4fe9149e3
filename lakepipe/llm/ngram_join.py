"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence.

A document is a row of the incidence matrix, its columns are hashed n-grams in
one global order: rare cells first (cell counts of all n-grams), then by hash.
Two sets with similarity of at least t share a column among their first
``|A| - ceil(t |A|) + 1``, so the product of that block of columns with itself
holds every pair; its entries are overlap counts, and a pair is discarded when
its sizes, or its count plus what may follow the last shared column, cannot
reach the threshold.  What is left is verified on the whole sets.

Copies of one set are one row.  A column's rows are first paired with one of
them only, so a group of near copies costs as many pairs as it has
members; the links found give components, and the product then runs over the
columns that still hold different components, for pairs of different ones.  No
link between components is missed, and no group is expanded into all its pairs.

``jaccard_links`` and ``link_counts`` give the links themselves: there the
product runs over all shared columns, inside components as well.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.llm import text as tx
from lakepipe.llm.cells import cell_counts, cell_of
from lakepipe.llm.components import components
from lakepipe.session import scratch_path

_CELLS = 20
_SALT = 512  # about so many comparisons with one document go to one group


def _fingerprint(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes."""
    a = int(np.add.reduce(tx.mix(s), dtype=np.uint64))
    b = int(np.bitwise_xor.reduce(tx.mix(s ^ np.uint64(0x5851F42D4C957F2D)))) if len(s) else 0
    return a - (1 << 64) if a >> 63 else a, b - (1 << 64) if b >> 63 else b


def _incidence(rows: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(i, n, fa, fb, prefix): each row's set size, fingerprint and first columns."""

    def grams(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for part in tx.chunks(batch, "t"):
            words, _ = tx.word_hashes(*tx.texts(part.column("t")))
            yield tx.gram_hashes(words, n)

    cells = cell_counts(rows.select("t"), grams, _CELLS)
    rank = np.minimum(np.floor(8 * np.log2(np.maximum(cells, 1))), 255).astype(np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                sizes, fps, prefixes = [], [], []
                words, first = tx.word_hashes(*tx.texts(part.column("t")))
                for s in tx.shingle_sets(words, first, n):
                    size = len(s)
                    sizes.append(size)
                    fps.append(_fingerprint(s))
                    length = size - (num * size + den - 1) // den + 1 if size else 0
                    column = (rank[cell_of(s, _CELLS)].astype(np.uint64) << np.uint64(55)) | (s >> np.uint64(9))
                    column = np.partition(column, length - 1)[:length] if length < size else column
                    column.sort()
                    prefixes.append(column.astype(np.int64))
                flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
                cuts = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("i"),
                        pa.array(sizes, pa.int64()),
                        pa.array([f[0] for f in fps], pa.int64()),
                        pa.array([f[1] for f in fps], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts), pa.array(flat)),
                    ],
                    ["i", "n", "fa", "fb", "prefix"],
                )

    ids = rows.schema["i"].dataType.simpleString()
    return rows.select("i", "t").mapInArrow(run, f"i {ids}, n long, fa long, fb long, prefix array<long>")


def _marked(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bit map of hashed values, of fixed size: what it lets through beside them is sorted out by a join."""

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        yield tx.mix(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))

    return np.packbits(cell_counts(values.select(F.xxhash64(column)), hashes, bits) > 0)


def _texts_of(rows: DataFrame, wanted: DataFrame, n: int, path: str) -> DataFrame:
    """(v, t): the texts of the sets in ``wanted`` (v, low, fa, fb)."""
    bits = 20
    marks = _marked(wanted, "low", bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = cell_of(tx.mix(batch.column("h").to_numpy(zero_copy_only=False).view(np.uint64)), bits)
            hit = (marks[place >> 3] >> (7 - (place & 7))) & 1 == 1
            for part in tx.chunks(batch.filter(pa.array(hit)), "t"):
                words, first = tx.word_hashes(*tx.texts(part.column("t")))
                fps = [_fingerprint(s) for s in tx.shingle_sets(words, first, n)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("i"), pa.array([f[0] for f in fps], pa.int64()), pa.array([f[1] for f in fps], pa.int64()), part.column("t")],
                    ["low", "fa", "fb", "t"],
                )

    ids = rows.schema["i"].dataType.simpleString()
    found = rows.select("i", "t", F.xxhash64("i").alias("h")).mapInArrow(run, f"low {ids}, fa long, fb long, t string")
    return found.join(wanted, ["low", "fa", "fb"]).select("v", "t")


def _verified(pairs: DataFrame, sets: DataFrame, rows: DataFrame, n: int, num: int, den: int, path: str) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole sets reach the threshold.

    The texts compared with one document are dealt to groups of about
    ``_SALT``; a group is read as a stream with that document first, so
    neither its number nor the length of the texts adds up in memory.
    """
    spark = pairs.sparkSession
    many = pairs.groupBy("a").agg(F.ceil(F.count("*") / _SALT).alias("salts"))
    dealt = pairs.join(many, "a").select("a", F.pmod(F.xxhash64("b"), "salts").alias("salt"), F.col("b").alias("v"))
    heads = dealt.select("a", "salt").distinct().withColumn("v", F.col("a"))
    dealt.unionByName(heads).write.parquet(f"{path}/dealt")
    dealt = spark.read.parquet(f"{path}/dealt")
    wanted = sets.select("v", "low", "fa", "fb").join(dealt.select("v").distinct(), "v", "left_semi")
    wanted.write.parquet(f"{path}/wanted")
    texts = _texts_of(rows, spark.read.parquet(f"{path}/wanted"), n, path)
    streams = (
        dealt.join(texts, "v")
        .withColumn("spoke", F.col("v") != F.col("a"))
        .repartition("a", "salt")
        .sortWithinPartitions("a", "salt", "spoke")
        .select("a", "salt", "spoke", "v", "t")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, head = None, None
        for batch in batches:
            for part in tx.chunks(batch, "t"):
                words, first = tx.word_hashes(*tx.texts(part.column("t")))
                out = []
                cols = (part.column(c).to_pylist() for c in ("a", "salt", "spoke", "v"))
                for a, salt, spoke, v, s in zip(*cols, tx.shingle_sets(words, first, n)):
                    if not spoke:
                        key, head = (a, salt), s
                    elif key == (a, salt):
                        place = np.searchsorted(head, s)
                        place[place == len(head)] = 0
                        both = int(np.count_nonzero(head[place] == s))
                        if den * both >= num * (len(head) + len(s) - both):
                            out.append((a, v))
                if out:
                    a, b = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    streams.mapInArrow(run, "a long, b long").distinct().write.parquet(f"{path}/links")
    return spark.read.parquet(f"{path}/links")


def _bounded(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose whole first blocks leave room for the threshold.

    Up to the smaller of the two blocks' ends both sets are known in full: the
    overlap is at most what they share there plus the smaller rest.
    """
    one = sets.select(F.col("v").alias("a"), F.col("n").alias("an"), F.col("prefix").alias("ap"))
    two = sets.select(F.col("v").alias("b"), F.col("n").alias("bn"), F.col("prefix").alias("bp"))
    end = F.least(F.element_at("ap", -1), F.element_at("bp", -1))
    known = lambda p: F.size(F.filter(p, lambda x: x <= F.col("end")))
    rest = F.least(F.col("an") - known("ap"), F.col("bn") - known("bp"))
    both = F.size(F.array_intersect("ap", "bp"))
    return (
        pairs.join(one, "a").join(two, "b").withColumn("end", end)
        .where((both + rest) * (num + den) >= (F.col("an") + F.col("bn")) * num)
        .select("a", "b")
    )


def _matrix(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str, path: str) -> tuple[DataFrame, ...]:
    """(rows, incidence, sets, block): the texts, their incidence, its distinct rows, and their columns that two or more share."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    _incidence(rows, n, num, den).write.parquet(f"{path}/incidence")
    incidence = spark.read.parquet(f"{path}/incidence")
    linkable = incidence.where("n > 0 and i is not null")
    linkable.groupBy("fa", "fb").agg(
        F.min("i").alias("low"), F.any_value("n").alias("n"), F.any_value("prefix").alias("prefix"), F.count("*").alias("copies")
    ).withColumn("v", F.monotonically_increasing_id()).write.parquet(f"{path}/sets")
    sets = spark.read.parquet(f"{path}/sets")

    columns = sets.select("v", "n", F.posexplode("prefix").alias("pos", "k"))
    shared = columns.groupBy("k").agg(F.min(F.struct("pos", "v")).alias("head"), F.count("*").alias("c"))
    shared = shared.where("c > 1").select("k", F.col("head.pos").alias("head_pos"), F.col("head.v").alias("head"), "c")
    columns.join(shared, "k").write.parquet(f"{path}/block")
    return rows, incidence, sets, spark.read.parquet(f"{path}/block")


def _reaches(num: int, den: int):
    def reaches(most, n: str, m: str):
        """Can an overlap of ``most`` make sets of these sizes similar enough?  (It holds the bound on the sizes as well.)"""
        return most * (num + den) >= (F.col(n) + F.col(m)) * num

    return reaches


def _set_links(docs: DataFrame, n: int, num: int, den: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(incidence, sets, links): every link (a, b) of two different sets, inside components as well.

    A column's rows are dealt to blocks of about ``_SALT``; each pair of its
    blocks is a group of its own, so no task gets all pairs of a hot column.
    """
    path = scratch_path(docs.sparkSession, "ngram-links")
    rows, incidence, sets, block = _matrix(docs, n, num, den, id_col, text_col, path)
    reaches = _reaches(num, den)
    blocks = F.ceil(F.col("c") / _SALT).cast("int")
    dealt = block.select("k", "v", "n", "pos", blocks.alias("blocks"), F.pmod(F.xxhash64("v"), blocks).cast("int").alias("own"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    left = dealt.select("k", F.col("own").alias("x"), every.alias("y"), "v", "n", "pos")
    right = dealt.select("k", every.alias("x"), F.col("own").alias("y"), F.col("v").alias("w"), F.col("n").alias("m"), F.col("pos").alias("at"))
    after = F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("at"))
    product = (
        left.join(right, ["k", "x", "y"])
        .where((F.col("v") < F.col("w")) & reaches(after, "n", "m"))
        .groupBy("v", "w")
        .agg(F.count("*").alias("overlap"), F.max("pos").alias("pos"), F.max("at").alias("at"), F.min("n").alias("n"), F.min("m").alias("m"))
    )
    pairs = product.where(reaches(F.col("overlap") + after - 1, "n", "m")).select(F.col("v").alias("a"), F.col("w").alias("b"))
    _bounded(pairs, sets, num, den).write.parquet(f"{path}/pairs")
    pairs = docs.sparkSession.read.parquet(f"{path}/pairs")
    return incidence, sets, _verified(pairs, sets, rows, n, num, den, path)


def jaccard_links(
    docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id_a, rows_a, id_b, rows_b): one row per link of two different shingle sets, as ``jaccard_components`` defines it.

    A set stands for all rows that have it: its smallest id and their number
    are given, so a link is ``rows_a * rows_b`` links of rows, and a set's own
    rows all link with each other.
    """
    _, sets, links = _set_links(docs, n, *threshold, id_col, text_col)
    for s in ("a", "b"):
        links = links.join(sets.select(F.col("v").alias(s), F.col("low").alias(f"id_{s}"), F.col("copies").alias(f"rows_{s}")), s)
    return links.select("id_a", "rows_a", "id_b", "rows_b")


def link_counts(
    docs: DataFrame, n: int = 5, threshold: tuple[int, int] = (4, 5), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: id, n_shingles, n_links, the number of other rows it links with (copies each count)."""
    incidence, sets, links = _set_links(docs, n, *threshold, id_col, text_col)
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ends.join(sets.select(F.col("v").alias("b"), "copies"), "b").groupBy(F.col("a").alias("v")).agg(F.sum("copies").alias("others"))
    member = sets.join(others, "v", "left").select("fa", "fb", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    own = F.when(F.col("i").isNotNull() & (F.col("n") > 0), F.col("fa")).alias("fa")
    out = incidence.select("i", "n", own, "fb").join(member, ["fa", "fb"], "left")
    return out.select(F.col("i").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_components(
    docs: DataFrame,
    n: int = 5,
    threshold: tuple[int, int] = (4, 5),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: id, n_shingles, component_id.

    Two texts link when ``den * |A and B| >= num * |A or B|`` for their sets
    of n-word shingles, ``threshold`` being (num, den).  ``component_id`` is
    the smallest id reachable over links, the row's own included.  A text of
    fewer than n words has one shingle, its whole sequence; null and empty
    texts have none and link with nothing.  Rows with a null id link with
    nothing and have no component.  Repeated rows are kept; equal ids with
    different texts are different rows.  Other columns are ignored; an empty
    table gives an empty result.
    """
    num, den = threshold
    spark = docs.sparkSession
    path = scratch_path(spark, "ngram-join")
    rows, incidence, sets, block = _matrix(docs, n, num, den, id_col, text_col, path)

    reaches = _reaches(num, den)
    # Each column's rows with its head, the row with the fewest rarer columns: in a group of near copies, the one least changed.
    size = sets.select(F.col("v").alias("head"), F.col("n").alias("head_n"))
    stars = (
        block.where("v <> head")
        .groupBy("head", "v")
        .agg(F.min("n").alias("n"), F.min("pos").alias("pos"), F.min("head_pos").alias("head_pos"))
        .join(size, "head")
        .where(reaches(F.least(F.col("n") - F.col("pos"), F.col("head_n") - F.col("head_pos")), "n", "head_n"))
        .select(F.col("head").alias("a"), F.col("v").alias("b"))
    )
    _bounded(stars, sets, num, den).write.parquet(f"{path}/stars")
    stars = spark.read.parquet(f"{path}/stars")
    links = _verified(stars, sets, rows, n, num, den, f"{path}/first")
    comps = components(links, f"{path}/components-first")

    # The product over columns that still hold different components.
    labelled = block.join(comps, "v", "left").withColumn("root", F.coalesce("root", "v")).select("k", "v", "n", "pos", "root")
    mixed = labelled.groupBy("k").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("k")
    labelled.join(mixed, "k", "left_semi").write.parquet(f"{path}/mixed")
    left = spark.read.parquet(f"{path}/mixed")
    right = left.select("k", F.col("v").alias("w"), F.col("n").alias("m"), F.col("pos").alias("at"), F.col("root").alias("other"))
    # A pair's first common column leaves at most this overlap; later ones that leave too little add nothing to the count below.
    after = F.least(F.col("n") - F.col("pos"), F.col("m") - F.col("at"))
    product = (
        left.join(right, "k")
        .where((F.col("v") < F.col("w")) & (F.col("root") != F.col("other")) & reaches(after, "n", "m"))
        .groupBy("v", "w")
        .agg(F.count("*").alias("overlap"), F.max("pos").alias("pos"), F.max("at").alias("at"), F.min("n").alias("n"), F.min("m").alias("m"))
    )
    pairs = product.where(reaches(F.col("overlap") + after - 1, "n", "m")).select(F.col("v").alias("a"), F.col("w").alias("b"))
    pairs = pairs.join(stars, ["a", "b"], "left_anti")
    _bounded(pairs, sets, num, den).write.parquet(f"{path}/pairs")
    pairs = spark.read.parquet(f"{path}/pairs")
    if pairs.head(1):
        links = links.unionByName(_verified(pairs, sets, rows, n, num, den, f"{path}/second"))
        comps = components(links, f"{path}/components-second")

    lows = comps.join(sets.select("v", "low"), "v")
    least = lows.groupBy("root").agg(F.min("low").alias("component"))
    member = sets.join(comps, "v", "left").join(least, "root", "left").select("fa", "fb", F.coalesce("component", "low").alias("component"))
    out = incidence.select("i", "n", F.when(F.col("n") > 0, F.col("fa")).alias("fa"), "fb").join(member, ["fa", "fb"], "left")
    component = F.when(F.col("i").isNull(), F.lit(None)).otherwise(F.coalesce("component", "i"))
    return out.select(F.col("i").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row of each group of near duplicates, all columns kept.

    A group keeps the row with the smallest id; rows of one id with the same
    text are one row.  Rows with a null id are kept.
    """
    found = jaccard_components(docs, id_col=id_col, text_col=text_col, **options)
    keep = found.where(F.col(id_col) == F.col("component_id")).select(id_col).distinct()
    first = docs.where(F.col(id_col).isNotNull()).join(keep, id_col, "left_semi").dropDuplicates([id_col, text_col])
    return first.unionByName(docs.where(F.col(id_col).isNull())).select(docs.columns)
