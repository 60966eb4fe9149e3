"""Table storage without a table format: plain Parquet directories.

``VersionedTable`` serves tables that are rewritten from their own content
(keyed upserts, SCD-2 history).  Spark cannot overwrite a path its own plan
reads, so each commit writes a complete new snapshot ``<root>/v=<n>``; the
current snapshot is the highest ``n`` whose job committed (``_SUCCESS``).
A crashed write leaves an uncommitted directory that readers skip.

``BucketedTable`` serves large keyed tables: rows live in
``_bucket = pmod(xxhash64(key), buckets)`` partitions and an upsert rewrites
only the buckets its batch touches (staged, then renamed into place).  For an
entity whose integral key grows with time (bookings, payments), the range
layout ``_bucket = key div range_width`` keeps a batch of new rows in the
newest range or two, where hash buckets would send it to every bucket and
rewrite the whole table on each micro-batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.sources.layout import hadoop_fs, list_dirs
from lakepipe.sources.schemas import widen_schema

BUCKET_COL = "_bucket"


class VersionedTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        partition_cols: Sequence[str] | None = None,
        keep: int | None = None,
    ):
        """``keep``: after each commit, delete all but the newest ``keep``
        committed snapshots (None keeps every snapshot).  A stream commits
        once per micro-batch, so a long-running one needs a bound; a reader
        must not outlive ``keep - 1`` later commits."""
        self.spark, self.root = spark, root.rstrip("/")
        self.partition_cols = list(partition_cols or [])
        if keep is not None and keep < 1:
            raise ValueError("keep must be at least 1")
        self.keep = keep

    def _committed(self) -> list[int]:
        out = []
        for name in list_dirs(self.spark, self.root):
            if name.startswith("v=") and name[2:].isdigit():
                fs, p = hadoop_fs(self.spark, f"{self.root}/{name}/_SUCCESS")
                if fs.exists(p):
                    out.append(int(name[2:]))
        return sorted(out)

    def current_version(self) -> int | None:
        v = self._committed()
        return v[-1] if v else None

    def exists(self) -> bool:
        return self.current_version() is not None

    def path(self, version: int) -> str:
        return f"{self.root}/v={version:08d}"

    def read(self, version: int | None = None) -> DataFrame:
        v = self.current_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no committed version under {self.root}")
        return self.spark.read.parquet(self.path(v))

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` committed snapshots (and any
        uncommitted directory older than them).  Call only when no reader
        still uses an old snapshot."""
        committed = self._committed()
        if len(committed) <= keep:
            return []
        oldest_kept = committed[-keep]
        dropped = []
        for name in list_dirs(self.spark, self.root):
            if name.startswith("v=") and name[2:].isdigit() and int(name[2:]) < oldest_kept:
                fs, p = hadoop_fs(self.spark, f"{self.root}/{name}")
                fs.delete(p, True)
                dropped.append(int(name[2:]))
        return sorted(dropped)

    def commit(self, df: DataFrame) -> int:
        """Write ``df`` as the next snapshot; returns its version number."""
        # Every directory name counts, committed or not, so a retried commit
        # never lands in a half-written directory.
        taken = [int(n[2:]) for n in list_dirs(self.spark, self.root) if n.startswith("v=") and n[2:].isdigit()]
        v = max(taken, default=0) + 1
        w = df.write.mode("errorifexists")
        if self.partition_cols:
            w = w.partitionBy(*self.partition_cols)
        w.parquet(self.path(v))
        if self.keep is not None:
            self.vacuum(self.keep)
        return v


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(buckets)).cast("int")


def range_of(key: str, width: int) -> Column:
    """Consecutive runs of ``width`` key values share a partition."""
    return F.expr(f"`{key}` div {int(width)}")


BUCKETS_FILE = "_lakepipe_buckets"
# Names the staged content of a bucket swap that has not finished yet.
PENDING_FILE = "_lakepipe_pending_swap"
# The table's columns, widened by every commit that brings new ones.
SCHEMA_FILE = "_lakepipe_schema"
# Staged buckets live inside the table's folder, so that they are renamed
# into place on one file system; the underscore hides them from readers.
STAGE_PREFIX = "_lakepipe_stage-"
RANGE_PREFIX = "range="


class BucketedTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        buckets: int = 256,
        range_width: int | None = None,
    ):
        """Hash layout over ``buckets`` partitions, or, with ``range_width``,
        one partition per run of ``range_width`` values of a single
        integral key."""
        self.spark, self.root = spark, root.rstrip("/")
        self.keys, self.buckets, self.range_width = list(keys), buckets, range_width
        if range_width is not None and (len(self.keys) != 1 or range_width < 1):
            raise ValueError("the range layout needs one integral key and a positive width")

    def _layout(self) -> str:
        kind = f"{RANGE_PREFIX}{self.range_width}" if self.range_width else str(self.buckets)
        return f"{kind}:{','.join(self.keys)}"

    @staticmethod
    def _clustered(df: DataFrame) -> DataFrame:
        """Cluster rows by bucket before the partitioned write (few files
        per bucket) with a REBALANCE, which AQE may split: a bucket larger
        than the advisory partition size is written by several tasks
        instead of one (at 100 TB / 4096 buckets a bucket is ~25 GB)."""
        return df.hint("rebalance", BUCKET_COL)

    def exists(self) -> bool:
        """Whether the table has been created.  A writer calls this first,
        so it also completes a bucket swap an earlier writer left half done
        (see ``replace_buckets``)."""
        fs, p = hadoop_fs(self.spark, f"{self.root}/_SUCCESS")
        if not fs.exists(p):
            return False
        self._check_layout()
        self.recover()
        return True

    def _check_layout(self) -> None:
        """Rows were placed with the bucket count recorded at creation; a
        different count would send keys to the wrong bucket."""
        recorded = self._read_marker()
        if recorded is None:
            raise ValueError(f"{self.root} holds data but no layout marker: not a table made by BucketedTable")
        if recorded != self._layout():
            raise ValueError(f"{self.root} was created with layout {recorded}, not {self._layout()}")

    def _read_file(self, name: str) -> str | None:
        fs, p = hadoop_fs(self.spark, f"{self.root}/{name}")
        if not fs.exists(p):
            return None
        jvm = self.spark.sparkContext._jvm
        stream = fs.open(p)
        try:
            return str(jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")).strip()
        finally:
            stream.close()

    def _write_file(self, name: str, text: str) -> None:
        fs, p = hadoop_fs(self.spark, f"{self.root}/{name}")
        out = fs.create(p, True)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()

    def _read_marker(self) -> str | None:
        return self._read_file(BUCKETS_FILE)

    def schema(self) -> T.StructType:
        """The recorded columns, without the bucket column (merged from the
        files of a table that has no record yet)."""
        text = self._read_file(SCHEMA_FILE)
        if text is not None:
            return T.StructType.fromJson(json.loads(text))
        found = self.spark.read.option("mergeSchema", "true").parquet(self.root).schema
        return T.StructType([f for f in found.fields if f.name != BUCKET_COL])

    def check_columns(self, df: DataFrame) -> None:
        """Refuse a batch whose column types cannot join the table's (a union
        would cast them, or fail in the middle of the write)."""
        widen_schema(self.schema(), df.schema)

    def _record_schema(self, schema: T.StructType) -> None:
        self._write_file(SCHEMA_FILE, schema.json())

    def _staged(self, stage: str) -> list[str]:
        """Bucket directories of a stage that are not in place yet."""
        return [d for d in list_dirs(self.spark, stage) if d.startswith(f"{BUCKET_COL}=")]

    def read(self, with_bucket: bool = False) -> DataFrame:
        """The whole table with every recorded column (NULL where a file was
        written before the column came).  While a bucket swap is pending --
        in progress, or left by a lost driver -- the buckets not in place
        yet are read from its stage, so no rows are missing."""
        schema = self.schema()
        df = self.spark.read.schema(schema).parquet(self.root)
        stage = self._read_file(PENDING_FILE)
        staged = self._staged(stage) if stage else []
        if staged:
            new = self.spark.read.schema(schema).parquet(stage)
            ids = [int(d.split("=", 1)[1]) for d in staged]
            df = df.filter(~F.col(BUCKET_COL).isin(ids)).unionByName(new)
        return df if with_bucket else df.drop(BUCKET_COL)

    def with_bucket(self, df: DataFrame) -> DataFrame:
        if self.range_width:
            kind = df.schema[self.keys[0]].dataType
            if not isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
                raise ValueError(f"range layout needs an integral key, {self.keys[0]} is {kind.simpleString()}")
            return df.withColumn(BUCKET_COL, range_of(self.keys[0], self.range_width))
        return df.withColumn(BUCKET_COL, bucket_of(self.keys, self.buckets))

    def touched(self, batch: DataFrame) -> tuple[list[int], int]:
        """The buckets the table has that rows of ``batch`` (with its bucket
        column) fall into, and how many buckets the batch falls into in all.

        Buckets the table lacks yet have no rows to read, so at most the
        table's own list of partitions reaches the driver, which holds it as
        the file index anyway."""
        stage = self._read_file(PENDING_FILE)
        names = list_dirs(self.spark, self.root) + (self._staged(stage) if stage else [])
        have = sorted({int(d.split("=", 1)[1]) for d in names if d.startswith(f"{BUCKET_COL}=") and d.split("=", 1)[1].lstrip("-").isdigit()})
        kind = batch.schema[BUCKET_COL].dataType.simpleString()
        mine = self.spark.createDataFrame([(b, b) for b in have], f"{BUCKET_COL} {kind}, _have {kind}")
        met = batch.select(BUCKET_COL).distinct().join(mine, BUCKET_COL, "left")
        row = met.agg(F.count(F.lit(1)).alias("n"), F.collect_list("_have").alias("have")).first()
        return row["have"], row["n"]

    def create(self, df: DataFrame) -> None:
        """First write.  Layout and columns are recorded before the data;
        the table exists once its ``_SUCCESS`` does, so what a crashed
        creation left behind is cleared by the next one."""
        fs, p = hadoop_fs(self.spark, f"{self.root}/_SUCCESS")
        if fs.exists(p):
            raise ValueError(f"{self.root} already exists")
        fs, p = hadoop_fs(self.spark, self.root)
        if fs.exists(p) and len(fs.listStatus(p)) and self._read_marker() is None:
            raise ValueError(f"{self.root} holds files of something else (no layout marker)")
        fs.delete(p, True)
        b = self.with_bucket(df)
        self._write_file(BUCKETS_FILE, self._layout())
        self._record_schema(df.schema)
        self._clustered(b).write.mode("append").partitionBy(BUCKET_COL).parquet(self.root)

    def replace_buckets(self, df: DataFrame) -> None:
        """Rewrite exactly the buckets present in ``df`` (which must carry
        the bucket column).

        The new content is staged in a hidden folder of the table first (it
        was computed from the table, which Spark cannot overwrite while
        reading), and its bucket directories are then renamed into place, so
        each batch is written once.  A bucket is swapped as
        delete-then-rename; the stage is recorded in the table before the
        first one, readers take a bucket that is not in place yet from the
        stage, and the next writer (``exists``) completes a swap that a lost
        driver left.  One writer at a time."""
        if self._read_file(PENDING_FILE):
            # ``df`` was computed from a table with an unfinished swap.
            raise RuntimeError(f"{self.root}: a bucket swap is pending; call exists() or recover() first")
        schema = widen_schema(self.schema(), T.StructType([f for f in df.schema.fields if f.name != BUCKET_COL]))
        stage = f"{self.root}/{STAGE_PREFIX}{uuid.uuid4().hex}"
        self._clustered(df).write.mode("errorifexists").partitionBy(BUCKET_COL).parquet(stage)
        self._record_schema(schema)
        self._write_file(PENDING_FILE, stage)
        self._swap_in(stage)

    def _swap_in(self, stage: str) -> None:
        """Rename the staged buckets into place (metadata calls only, as many
        as buckets were touched).  A bucket leaves the stage when it is in
        place, so doing this again continues where it stopped."""
        for name in self._staged(stage):
            fs, dst = hadoop_fs(self.spark, f"{self.root}/{name}")
            _, src = hadoop_fs(self.spark, f"{stage}/{name}")
            fs.delete(dst, True)
            if not fs.rename(src, dst):
                raise OSError(f"cannot move {stage}/{name} into {self.root}")
        fs, p = hadoop_fs(self.spark, f"{self.root}/{PENDING_FILE}")
        fs.delete(p, False)
        fs, p = hadoop_fs(self.spark, stage)
        fs.delete(p, True)
        # Cached file listings of this session still name the old files.
        self.spark.catalog.refreshByPath(self.root)

    def recover(self) -> bool:
        """Finish a bucket swap that an earlier writer began but did not
        complete (the buckets still staged are renamed into place).  Returns
        whether there was one."""
        stage = self._read_file(PENDING_FILE)
        if not stage:
            return False
        self._swap_in(stage)
        return True


def open_table(spark: SparkSession, root: str) -> VersionedTable | BucketedTable:
    """The table stored at ``root``, whichever layout wrote it."""
    fs, p = hadoop_fs(spark, f"{root.rstrip('/')}/{BUCKETS_FILE}")
    if fs.exists(p):
        probe = BucketedTable(spark, root, [], 1)
        kind, keys = probe._read_marker().split(":", 1)
        if kind.startswith(RANGE_PREFIX):
            return BucketedTable(spark, root, keys.split(","), range_width=int(kind[len(RANGE_PREFIX):]))
        return BucketedTable(spark, root, keys.split(","), int(kind))
    return VersionedTable(spark, root)
