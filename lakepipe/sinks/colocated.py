"""Catalog tables bucketed on a key: joins and aggregates on it need no exchange.

Tables that share key columns (by position and type) and bucket count are
co-located: bucket k of one holds the same keys as bucket k of the other.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.operators.dedup import dedup_latest
from lakepipe.session import scratch_path


def write_colocated(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, sort: Sequence[str] = (), table: str | None = None, path: str | None = None
) -> DataFrame:
    """Store ``df`` as a Parquet catalog table in ``buckets`` buckets of ``keys``, and read it back.

    One exchange on the keys comes first, so a bucket is one file, not one a
    task.  ``table`` names the catalog table (default: ``name`` with a unique
    ending), ``path`` its folder (default: one under the shared scratch
    folder).
    """
    spark = df.sparkSession
    table = table or f"{name}_{uuid.uuid4().hex[:12]}"
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path or scratch_path(spark, f"colocated-{name}")).bucketBy(buckets, *keys)
    if sort:
        writer = writer.sortBy(*sort)
    writer.saveAsTable(table)
    return spark.table(table)


def upsert_colocated(target: DataFrame, batch: DataFrame, keys: Sequence[str], updated_col: str) -> DataFrame:
    """The next content of a co-located table: the newest row of each key of ``target`` and ``batch``.

    The target side is read bucket by bucket without an exchange; only the
    batch moves.
    """
    latest = dedup_latest(batch, keys, updated_col)
    mine = F.struct(*[F.col(f"`{c}`") for c in target.columns])
    theirs = F.struct(*[F.col(f"`{c}`") for c in target.columns])
    both = target.select(*keys, mine.alias("_old")).join(latest.select(*keys, theirs.alias("_new")).hint("merge"), list(keys), "full")
    return both.select(F.coalesce("_new", "_old").alias("r")).select("r.*")
