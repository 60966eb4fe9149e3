"""Connected components of an edge table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from itertools import count

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def components(edges: DataFrame, path: str) -> DataFrame:
    """(v, root) for every vertex of the undirected ``edges`` (a, b); root is the smallest vertex reachable.

    Each round rewrites the edge table under ``path`` (lineage is cut there).
    The minimum of a vertex's neighbours is a partial aggregate; a vertex's
    neighbours are never gathered in one row.  Both ends of an edge come from
    one scan and nothing is united, so a round's plan stays small: the driver
    describes it anew after each of its stages.  Rounds go on until one changes
    nothing: every edge moves towards a smaller vertex, so one comes.
    """
    spark = edges.sparkSession
    cur = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("m"))
    state = None
    for k in count():
        both = cur.select(F.inline(F.array(F.struct("u", "m"), F.struct(F.col("m").alias("u"), F.col("u").alias("m")))))
        low = both.groupBy("u").agg(F.min("m").alias("low"))
        # Large star: every larger neighbour is moved to the smallest one; vertices that have a smaller one keep that edge.
        moved = F.when(F.col("m") > F.col("u"), F.struct(F.col("m").alias("u"), F.least("u", "low").alias("m")))
        kept = F.when(F.col("low") < F.col("u"), F.struct("u", F.col("low").alias("m")))
        large = both.join(low, "u").select(F.inline(F.array_compact(F.array(moved, kept)))).distinct()
        # Small star: every smaller neighbour is moved to the smallest one.
        small_low = large.groupBy("u").agg(F.min("m").alias("low"))
        moved = F.when(F.col("m") != F.col("low"), F.struct(F.col("m").alias("u"), F.col("low").alias("m")))
        kept = F.struct("u", F.col("low").alias("m"))
        small = large.join(small_low, "u").select(F.inline(F.array_compact(F.array(moved, kept)))).distinct()
        small.write.parquet(f"{path}/round-{k}")
        cur = spark.read.parquet(f"{path}/round-{k}")
        now = cur.agg(F.count("*"), F.sum(F.xxhash64("u", "m").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    ends = F.array(F.struct(F.col("u").alias("v"), F.col("m").alias("root")), F.struct(F.col("m").alias("v"), F.col("m").alias("root")))
    return cur.select(F.inline(ends)).distinct()
