"""Keyed upsert and SCD Type 2 as pure DataFrame transformations.

Both take the current table and a batch and return the table's next
content; the sinks in ``lakepipe.sinks`` decide how that content is stored.
The batch side of every join is broadcast only when one bounded job shows
it is small in rows and bytes (the usual micro-batch); otherwise the join
shuffles on the key.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.clock import SYSTEM_CLOCK, Clock
from lakepipe.operators.quality import assert_unique
from lakepipe.operators.sizing import DEFAULT_MAX_BROADCAST_BYTES, DEFAULT_MAX_BROADCAST_ROWS, broadcast_if_small

SCD2_COLUMNS = ("is_current", "effective_date", "end_date")


def _keys(pk: str | Sequence[str]) -> list[str]:
    return [pk] if isinstance(pk, str) else list(pk)


def upsert_df(
    target: DataFrame,
    batch: DataFrame,
    pk: str | Sequence[str],
    updated_col: str | None = None,
    guard_stale: bool = False,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *.

    ``batch`` must hold one row per key (see ``dedup_latest``).  By default
    the batch row always replaces the target row.  With ``guard_stale`` a
    target row whose ``updated_col`` is strictly newer than the batch row is
    kept instead (late, out-of-order data cannot roll a row back).
    Columns missing on either side are filled with NULL."""
    keys = _keys(pk)
    if guard_stale:
        if not updated_col:
            raise ValueError("guard_stale needs updated_col")
        return _newer_of(target, batch, keys, updated_col)
    batch_keys = broadcast_if_small(batch.select(*keys), max_broadcast_rows, max_broadcast_bytes)
    kept = target.join(batch_keys, keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def _newer_of(target: DataFrame, batch: DataFrame, keys: Sequence[str], updated_col: str) -> DataFrame:
    """The target with the batch's rows, but for keys whose target row is strictly newer.

    One full join reads either side once; its hash side is the batch, so the
    target needs no sort.  (Without the guard an anti-join does: the batch
    need not be compared.)"""
    # The types a union of both would have.
    columns = {f.name: f.dataType for f in target.limit(0).unionByName(batch.limit(0), allowMissingColumns=True).schema.fields}

    def whole(df):
        have = set(df.columns)
        return F.struct(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(columns[c]).alias(c) for c in columns])

    both = target.select(*keys, whole(target).alias("_t")).join(batch.select(*keys, whole(batch).alias("_s")).hint("shuffle_hash"), list(keys), "full")
    newer = F.col("_t").getField(updated_col) > F.col("_s").getField(updated_col)
    keep_target = F.col("_s").isNull() | (F.col("_t").isNotNull() & F.coalesce(newer, F.lit(False)))
    return both.select(F.when(keep_target, F.col("_t")).otherwise(F.col("_s")).alias("r")).select("r.*")


def scd2_bootstrap(updates: DataFrame, clock: Clock = SYSTEM_CLOCK) -> DataFrame:
    return updates.withColumns(
        {
            "is_current": F.lit(True),
            "effective_date": clock.date(),
            "end_date": F.lit(None).cast("date"),
        }
    )


def scd2_df(
    target: DataFrame | None,
    updates: DataFrame,
    pk: str | Sequence[str],
    clock: Clock = SYSTEM_CLOCK,
    compare_cols: Sequence[str] | None = None,
    expire_missing: bool = False,
    check_unique: bool = True,
    max_broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
    max_broadcast_bytes: int = DEFAULT_MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Next content of an SCD-2 history table.

    Default (reference behaviour): every key in ``updates`` expires its
    current version (``is_current=false, end_date=today``) and every update
    row is inserted as a new current version -- unchanged rows included.
    Opt-ins: ``compare_cols`` skips keys whose compared values did not
    change; ``expire_missing`` also expires current keys absent from
    ``updates``.  Duplicate keys in ``updates`` are rejected."""
    if not pk:
        raise ValueError("a primary key is required for SCD-2 history")
    keys = _keys(pk)
    if check_unique:
        assert_unique(updates, *keys)
    if target is None:
        return scd2_bootstrap(updates, clock)

    today = clock.date()
    # One row per update key: _chg = the key gets a new version.
    flags = updates.select(*keys).withColumn("_chg", F.lit(True))
    if compare_cols:
        # Exact, NULL-safe comparison of the values themselves.  (A hash
        # signature is not enough: Spark's hashes skip NULLs, so moving a
        # value to a neighbouring NULL column would look unchanged.)
        cols = [c for c in compare_cols if c not in keys]
        cur = target.filter(F.col("is_current")).select(
            *keys, *[F.col(c).alias(f"_t{i}") for i, c in enumerate(cols)]
        )
        same = reduce(
            lambda a, b: a & b,
            [F.col(c).eqNullSafe(F.col(f"_t{i}")) for i, c in enumerate(cols)],
            F.lit(True),
        )
        unchanged = updates.select(*keys, *cols).join(cur, keys, "inner").filter(same).select(*keys)
        updates = updates.join(unchanged, keys, "left_anti")
        flags = flags.join(unchanged.withColumn("_same", F.lit(True)), keys, "left").select(
            *keys, F.col("_same").isNull().alias("_chg")
        )

    marked = target.join(broadcast_if_small(flags, max_broadcast_rows, max_broadcast_bytes), keys, "left")
    present = F.col("_chg").isNotNull()
    expire = F.col("is_current") & (
        F.coalesce(F.col("_chg"), F.lit(False)) | (F.lit(expire_missing) & ~present)
    )
    expired = marked.withColumns(
        {
            "is_current": F.when(expire, F.lit(False)).otherwise(F.col("is_current")),
            "end_date": F.when(expire, today).otherwise(F.col("end_date")),
        }
    ).drop("_chg")
    return expired.unionByName(scd2_bootstrap(updates, clock), allowMissingColumns=True)
