"""Mixing sources to target weights by capped water-filling.

Every source wants the share of the budget that its weight gives it.  A source
may be repeated at most ``max_epochs`` times; what it cannot take is shared
anew among the others in proportion to their weights, until no target is above
its cap.  A source's target is then taken from its documents as whole
repetitions, a seeded sample of documents taken once more, and a fraction of
the documents at the sample's edge.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakepipe.llm import text as tx
from lakepipe.session import scratch_path

HEX = 3  # a document's seeded place is one of 16 ** HEX cells


def word_counts(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(id, source, size): the number of words of each text, 0 for null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = []
            for part in tx.chunks(batch, "t"):
                _, _, first = tx.word_bounds(*tx.texts(part.column("t")))
                sizes.append(np.diff(first))
            size = np.concatenate(sizes) if sizes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("i"), batch.column("s"), pa.array(size, pa.int64())], ["i", "s", "n"])

    ids = docs.schema[id_col].dataType.simpleString()
    cols = docs.select(F.col(id_col).alias("i"), F.col(source_col).cast("string").alias("s"), F.col(text_col).alias("t"))
    return cols.mapInArrow(run, f"i {ids}, s string, n long")


def weigh(sources: DataFrame, weights: Sequence[int], path: str) -> DataFrame:
    """Adds w: the sources by code point, null last, weigh as ``weights`` repeats.

    The rank is made from a count per range partition, not in one task.
    """
    part = sources.repartitionByRange(F.col("s").asc_nulls_last()).withColumn("p", F.spark_partition_id())
    part.write.parquet(path)  # the ranges and their counts come from the same split
    part = sources.sparkSession.read.parquet(path)
    ranked = part.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy(F.col("s").asc_nulls_last())))
    before = part.groupBy("p").count().withColumn(
        "before", F.coalesce(F.sum("count").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    )
    table = F.array(*[F.lit(w) for w in weights])
    return ranked.join(before, "p").withColumn(
        "w", F.element_at(table, ((F.col("r") + F.col("before") - 1) % len(weights) + 1).cast("int"))
    )


def water_fill(sources: DataFrame, share: tuple[int, int], max_epochs: int) -> DataFrame:
    """Adds target to (s, source_size, w).

    Each round is one aggregate over the table of sources: the sources whose
    share is above their cap are clamped, the level (budget left / weight left)
    is set anew, until no further source is clamped.
    """
    cap = F.col("source_size") * max_epochs
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    budget = total * share[0] / share[1]
    level = None
    clamped = -1
    while True:
        # The first level is that of all sources; a level never falls, so a clamped source stays clamped.
        over = F.lit(False) if level is None else F.col("w") * F.lit(float(level[0])) > cap * F.lit(float(level[1]))
        caps, weight, n = sources.agg(
            F.sum(F.when(over, cap)), F.sum(F.when(~over, F.col("w"))), F.count(F.when(over, 1))
        ).first()
        if n == clamped or not weight:
            break
        clamped, level = n, (budget - (caps or 0), weight)
    if level is None:
        return sources.withColumn("target", F.lit(0.0))
    fair = F.col("w") * F.lit(float(level[0])) / F.lit(float(level[1]))
    return sources.withColumn("target", F.least(fair, cap.cast("double")))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[int] = (5, 2, 1),
    share: tuple[int, int] = (3, 2),
    max_epochs: int = 2,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: id, source, size, source_size, target, taken, whole, fraction.

    ``taken`` is the number of its words in the mix, repeats counted:
    ``whole`` repetitions plus ``fraction`` of one more.  The budget is
    ``share`` of all words; no document is taken more than ``max_epochs``
    times.  A document's seeded place depends on seed, id and source only, so
    reruns agree, and rows that repeat (id, source) share a place.  Null texts
    have size 0 and take nothing; null sources form one source, the last; an
    empty table gives an empty result.  Other columns are ignored.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "mixing")
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("i").cast("string"), "s"))
    word_counts(docs, id_col, text_col, source_col).withColumn(
        "c", F.conv(F.substring(place, 1, HEX), 16, 10).cast("int")
    ).write.parquet(f"{path}/sizes")
    sizes = spark.read.parquet(f"{path}/sizes")
    cells = sizes.groupBy("s", "c").agg(F.sum("n").alias("cell"))
    cells.write.parquet(f"{path}/cells")
    cells = spark.read.parquet(f"{path}/cells")
    by_source = cells.groupBy("s").agg(F.sum("cell").alias("source_size"))
    weigh(by_source, weights, f"{path}/ranges").select("s", "source_size", "w").write.parquet(f"{path}/sources")
    filled = water_fill(spark.read.parquet(f"{path}/sources"), share, max_epochs)
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    filled = filled.withColumn("whole", F.floor(epochs)).withColumn(
        "rest", F.col("target") - F.col("whole") * F.col("source_size")
    )
    # Cells in order are taken once more while they fit in the rest; the cell at the edge by the fraction that fits.
    upto = F.sum("cell").over(Window.partitionBy("s").orderBy("c").rowsBetween(Window.unboundedPreceding, -1))
    edge = (
        cells.withColumn("before", F.coalesce(upto, F.lit(0)))
        .withColumnRenamed("s", "ks")
        .join(filled, F.col("ks").eqNullSafe(F.col("s")))
        .select(
            "ks",
            F.col("c").alias("kc"),
            "source_size",
            "target",
            "whole",
            F.when(F.col("cell") > 0, F.greatest(F.lit(0.0), F.least(F.lit(1.0), (F.col("rest") - F.col("before")) / F.col("cell"))))
            .otherwise(0.0)
            .alias("fraction"),
        )
    )
    taken = F.col("whole") * F.col("n") + F.round(F.col("fraction") * F.col("n")).cast("long")
    return (
        sizes.join(edge, F.col("s").eqNullSafe(F.col("ks")) & (F.col("c") == F.col("kc")))
        .select(
            F.col("i").alias(id_col),
            F.col("s").alias(source_col),
            F.col("n").alias("size"),
            "source_size",
            "target",
            taken.alias("taken"),
            "whole",
            "fraction",
        )
    )
