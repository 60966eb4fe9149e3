"""Exact order, rank and quantiles of a whole relation, without a window over one partition.

Rows are dealt into ranges of the sort order (sampled bounds), sorted and
numbered inside each range; the number of rows in the ranges before is added.
The ranges are stored, as counts and numbers must come from the same ones: in
a checkpoint, or packed in Parquet, which takes a fraction of that.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.operators.sizing import broadcast_if_small
from lakepipe.session import checkpoint_root, scratch_path, shuffles_removed

# What Parquet gives back as it was; times of long ago it may refuse.
_PLAIN = (T.StringType, T.BinaryType, T.BooleanType, T.IntegralType, T.FractionalType)


def _ranges(df: DataFrame, order: Sequence[str | Column], partitions: int | None, distinct: bool = False, packed: bool = False) -> DataFrame:
    """``df`` over range partitions, with ``_part`` and, in the sort order, ``_id``; partition k comes before partition k + 1.

    With ``distinct`` rows that are equal in all columns stay once: they are in
    the same range, so this takes no other shuffle.  With ``packed`` the ranges
    are kept in Parquet, where the kinds of columns allow it.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(parts, *order)
    ranged = (dealt.dropDuplicates() if distinct else dealt).sortWithinPartitions(*order)
    # The id holds the partition above its low 33 bits and counts the partition's rows in them.
    with shuffles_removed(spark):
        if packed and all(isinstance(f.dataType, _PLAIN) for f in df.schema.fields):
            path = scratch_path(spark, "ranges")
            ranged = ranged.withColumn("_id", F.monotonically_increasing_id())
            ranged.write.option("compression", "zstd").parquet(path)
            # Files are read in any order.
            stored = spark.read.schema(ranged.schema).parquet(path).repartitionById(parts, F.shiftright("_id", 33).cast("int")).sortWithinPartitions("_id")
        else:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(checkpoint_root(spark))
            stored = ranged.checkpoint().withColumn("_id", F.monotonically_increasing_id())
    return stored.withColumn("_part", F.shiftright("_id", 33).cast("int"))


def _offsets(ranged: DataFrame, **sums: Column) -> DataFrame:
    """(_part, one column for each sum): what the partitions before add up to."""
    totals = ranged.groupBy("_part").agg(*[c.alias(name) for name, c in sums.items()]).orderBy("_part").collect()  # one row a partition
    before, out = [0] * len(sums), []
    for row in totals:
        out.append((row["_part"], *before))
        before = [b + row[name] for b, name in zip(before, sums)]
    return F.broadcast(ranged.sparkSession.createDataFrame(out, "_part int, " + ", ".join(f"{n} long" for n in sums)))


def global_row_number(
    df: DataFrame, *order: str | Column, partitions: int | None = None, name: str = "position", distinct: bool = False, packed: bool = False
) -> DataFrame:
    """``df`` with each row's position (from 1) in the whole relation.

    Rows equal in ``order`` are numbered in any sequence and fall into one
    range; add a unique column for a repeatable number and even ranges.  With
    ``distinct`` rows equal in all columns are one.  ``packed`` is for wide
    rows: they take less of the scratch folder and one more shuffle.
    """
    ranged = _ranges(df, order, partitions, distinct, packed)
    # The id counts the rows of a partition in its low 33 bits, so no window is needed.
    within = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    placed = ranged.join(_offsets(ranged, _before=F.count(F.lit(1))), "_part")
    return placed.withColumn(name, F.col("_before") + within + 1).select(*df.columns, name)


def value_positions(df: DataFrame, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """(``by``, n, first, place): each distinct value, its rows, the position of its first row, and its own place.

    Values are counted map-side before they are ordered, so a value that a
    third of the rows hold is one row here.  NULLs come first.
    """
    ranged = _ranges(df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), by, partitions)
    along = Window.partitionBy("_part").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = ranged.withColumn("_rows", F.sum("n").over(along) - F.col("n")).withColumn("_place", F.count(F.lit(1)).over(along))
    placed = inside.join(_offsets(ranged, _before=F.sum("n"), _values=F.count(F.lit(1))), "_part")
    return placed.select(*by, "n", (F.col("_before") + F.col("_rows") + 1).alias("first"), (F.col("_values") + F.col("_place")).alias("place"))


def global_rank(df: DataFrame, by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """``df`` with ``rank`` and ``dense_rank`` over the whole relation by the ``by`` columns ascending, NULLs first."""
    values = value_positions(df, by, partitions).select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("first").alias("rank"), F.col("place").alias("dense_rank"))
    on = [df[c].eqNullSafe(values[f"_by_{c}"]) for c in by]
    return df.join(broadcast_if_small(values), on).select(*[df[c] for c in df.columns], "rank", "dense_rank")


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float | str], partitions: int | None = None) -> DataFrame:
    """(share, value): for each share the smallest value with at least that part of the rows at or below it.

    NULLs take no part; without other rows the result is empty.
    """
    known = df.where(F.col(f"`{column}`").isNotNull()).select(F.col(f"`{column}`").alias("value"))
    placed = value_positions(known, ["value"], partitions)
    total = known.count()
    hits = []
    for share in shares:
        at = max(1, -int(-Decimal(str(share)) * total // 1))
        held = (F.col("first") <= at) & (at < F.col("first") + F.col("n"))
        hits.append(F.when(held, F.lit(float(share))))
    return placed.select(F.explode(F.array_compact(F.array(*hits))).alias("share"), "value")
