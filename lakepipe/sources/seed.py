"""Seed files (CSV or zipped CSV), their typed tables and their normalisation.

A zip archive is not splittable.  Its members are copied, one buffer at a time
and still compressed, into the shared scratch folder through the file system
classes that Spark itself reads with (any archive size, any store): a deflated
member is what a gzip file holds.  They are then CSV files for Spark's own
reader, which inflates them in its tasks, each with its own header.

CSV follows RFC 4180 as the seed files do: quoted fields may hold commas,
newlines and doubled quotes."""

from __future__ import annotations

import io
import struct
import zipfile
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakepipe.functions.numeric import std_cast
from lakepipe.operators.ordering import global_row_number
from lakepipe.session import checkpoint_root, remove_paths, scratch_listed, scratch_path, shuffles_removed
from lakepipe.sources.layout import hadoop_fs, path_exists

# RFC 4180: a quote inside a quoted field is written twice.
CSV_OPTIONS = {"escape": '"'}

# Seed file -> table and table -> primary key of the source DB.
SEED_TABLES = {
    "olist_customers_dataset.csv": "customers",
    "olist_orders_dataset.csv": "orders",
    "olist_order_items_dataset.csv": "order_items",
    "olist_order_payments_dataset.csv": "order_payments",
    "olist_order_reviews_dataset.csv": "order_reviews",
    "olist_products_dataset.csv": "products",
    "olist_sellers_dataset.csv": "sellers",
    "olist_geolocation_dataset.csv": "geolocation",
}
# The category translation is loaded on its own; its key is generated by
# the database (auto-increment), so no synthetic key is added here.
TRANSLATION_SEED = {"product_category_name_translation.csv": "product_category_name_translation"}
SEED_PRIMARY_KEYS = {
    "customers": "customer_id",
    "orders": "order_id",
    "order_items": "id",
    "order_payments": "id",
    "order_reviews": "review_id",
    "products": "product_id",
    "sellers": "seller_id",
    "geolocation": "id",
}


# Columns and types of the tables of the source database.
_SEED_COLUMNS = {
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix int, customer_city string, customer_state string",
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp, order_approved_at timestamp, "
    "order_delivered_carrier_date timestamp, order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp",
    "order_items": "id bigint, order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp, "
    "price float, freight_value float",
    "order_payments": "id bigint, order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value float",
    "order_reviews": "review_id string, order_id string, review_score int, review_comment_title string, review_comment_message string, "
    "review_creation_date timestamp, review_answer_timestamp timestamp",
    "products": "product_id string, product_category_name string, product_name_lenght int, product_description_lenght int, "
    "product_photos_qty int, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int",
    "sellers": "seller_id string, seller_zip_code_prefix int, seller_city string, seller_state string",
    "geolocation": "id bigint, geolocation_zip_code_prefix int, geolocation_lat float, geolocation_lng float, geolocation_city string, "
    "geolocation_state string",
    "product_category_name_translation": "id bigint, product_category_name string, product_category_name_english string",
}
_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(), "float": T.FloatType(), "timestamp": T.TimestampType()}
SEED_SCHEMAS: dict[str, T.StructType] = {
    table: T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in map(str.split, columns.split(", "))]) for table, columns in _SEED_COLUMNS.items()
}


GZIP_HEADER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff"
# Spark's readers unpack files by these endings.
_PACKED = (".gz", ".bz2", ".deflate", ".snappy", ".lz4", ".zst", ".zstd", ".xz")


class _HadoopFile(io.RawIOBase):
    """A file of any store as a seekable stream; used for an archive's directory only."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        fs, source = hadoop_fs(spark, path)
        self.stream, self.size, self.at = fs.open(source), fs.getFileStatus(source).getLen(), 0

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, offset: int, whence: int = io.SEEK_SET) -> int:
        self.at = max(0, offset + {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.size}[whence])
        return self.at

    def readinto(self, buffer) -> int:
        n = max(0, min(len(buffer), self.size - self.at))
        if n:
            self.stream.seek(self.at)
            buffer[:n] = bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(self.stream, n))
            self.at += n
        return n

    def close(self) -> None:
        if not self.closed:
            self.stream.close()
        super().close()


def unzip_to(spark: SparkSession, archive: str, folder: str, threads: int = 8) -> list[str]:
    """Write every file of a zip archive below ``folder``; returns their paths in the archive's order.

    Deflated members become gzip files (``.gz`` after their name) without being
    inflated; bytes go from one stream to the other through a small buffer,
    several members at a time.  Members are numbered, so names that repeat or
    climb out of the folder do no harm.
    """
    with zipfile.ZipFile(io.BufferedReader(_HadoopFile(spark, archive), 65536)) as z:
        members = [m for m in z.infolist() if not m.is_dir()]
    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(lambda m: _copy_member(spark, archive, m[1], f"{folder}/{m[0]:06d}"), enumerate(members)))


def _copy_member(spark: SparkSession, archive: str, member: zipfile.ZipInfo, folder: str) -> str:
    if member.flag_bits & 1 or member.compress_type not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"{member.filename} in {archive}: encrypted, or neither stored nor deflated")
    jvm = spark.sparkContext._jvm
    copy = jvm.org.apache.commons.io.IOUtils.copyLarge
    name = member.filename.rsplit("/", 1)[-1] or "member"
    deflated = member.compress_type == zipfile.ZIP_DEFLATED and member.file_size > 0
    as_gzip = deflated and not name.lower().endswith(_PACKED)
    to = f"{folder}/{name}.gz" if as_gzip else f"{folder}/{name}"
    with _HadoopFile(spark, archive) as source:
        # The local header may name other lengths of name and extra field than the directory.
        source.seek(member.header_offset + 26)
        source.stream.seek(member.header_offset + 30 + sum(struct.unpack("<HH", source.read(4))))
        fs, path = hadoop_fs(spark, to)
        target = fs.create(path, True)
        try:
            if as_gzip:
                target.write(GZIP_HEADER)
                copy(source.stream, target, 0, member.compress_size)
                target.write(struct.pack("<LL", member.CRC, member.file_size & 0xFFFFFFFF))
            elif deflated:
                copy(jvm.java.util.zip.InflaterInputStream(source.stream, jvm.java.util.zip.Inflater(True)), target, 0, member.file_size)
            else:
                copy(source.stream, target, 0, member.file_size)
        finally:
            target.close()
    return to


def _read_csv(spark: SparkSession, path: str | list[str], multi_line: bool) -> DataFrame:
    reader = spark.read.option("header", "true").option("inferSchema", "false").options(**CSV_OPTIONS)
    return (reader.option("multiLine", "true") if multi_line else reader).csv(path)


def read_zipped_csv(spark: SparkSession, zip_path: str, schema: T.StructType | None = None, multi_line: bool = True, threads: int = 8) -> DataFrame:
    """All rows of all members of the zip archives at ``zip_path`` (a file or a glob).

    Every member is read with its own header; members are put together by
    column name (lower case, stripped) whatever the order of their columns.  A
    member with other columns than the first one, or than ``schema``, raises.
    Empty members (no header) have no rows.
    """
    fs, pattern = hadoop_fs(spark, zip_path)
    archives = sorted(str(f.getPath()) for f in fs.globStatus(pattern) or [])
    folder = scratch_path(spark, "unzipped")
    with ThreadPoolExecutor(threads) as pool:
        unpacked = list(pool.map(lambda a: unzip_to(spark, a[1], f"{folder}/{a[0]:06d}"), enumerate(archives)))
    paths = [path for some in unpacked for path in some]
    with ThreadPoolExecutor(threads) as pool:
        headers = list(pool.map(lambda p: tuple(_read_csv(spark, p, multi_line).columns), paths))
    # Members of the same header are one read.
    alike: dict[tuple[str, ...], list[str]] = {}
    for path, header in zip(paths, headers):
        if header:
            alike.setdefault(header, []).append(path)
    members = [normalise_headers(_read_csv(spark, some, multi_line)) for some in alike.values()]
    if not members:
        return spark.createDataFrame([], schema or T.StructType([]))
    first = members[0].columns
    for m in members:
        if sorted(m.columns) != sorted(first):
            raise ValueError(f"members of {zip_path} have other columns: {sorted(first)} and {sorted(m.columns)}")
    rows = reduce(DataFrame.unionByName, members)
    return rows if schema is None else conform_to(rows, schema)


def conform_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to a contract, by name; a value that does not cast becomes NULL, other columns raise."""
    wanted = {f.name.lower() for f in schema.fields}
    if wanted != set(df.columns):
        raise ValueError(f"columns {sorted(df.columns)}, the contract has {sorted(wanted)}")
    return df.select(*[_cast(f).alias(f.name) for f in schema.fields])


def _cast(field: T.StructField):
    c = F.col(f"`{field.name.lower()}`")
    if isinstance(field.dataType, T.TimestampType):
        return F.try_to_timestamp(c.cast("string"))
    return std_cast(c, field.dataType.simpleString())


def read_csv_seed(
    spark: SparkSession, path: str, schema: T.StructType | None = None, multi_line: bool = True
) -> DataFrame | None:
    """CSV at ``path`` (a file or folder); else the archive ``path + '.zip'``; else None.  Columns are text
    (lower-case names), or with ``schema`` cast to it.

    ``multi_line`` (default) keeps quoted newlines inside their field; a
    file is then parsed by one task (streamed, not held), so a large seed is
    best delivered as many files.  Files known to have no quoted newlines can
    pass ``False`` to split each file over many tasks."""
    if path_exists(spark, path):
        rows = normalise_headers(_read_csv(spark, path, multi_line))
        return rows if schema is None else conform_to(rows, schema)
    if path_exists(spark, path + ".zip"):
        return read_zipped_csv(spark, path + ".zip", schema, multi_line)
    return None


def normalise_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def dense_key(df: DataFrame, name: str, offset: int = 0, order: Sequence[str] | None = None, distinct: bool = False) -> DataFrame:
    """Add ``name`` = 1..n (+ ``offset``), unique and gap-free, in the order of
    the ``order`` columns (a range shuffle) or, without them, in any order.
    With ``distinct`` rows equal in all columns are one.

    Per-partition row counts (one small row per partition) give each
    partition its starting offset; the row's position inside its partition
    comes from ``monotonically_increasing_id``.  The input is checkpointed
    first so both passes see identical partitions."""
    if order:
        keyed = global_row_number(df, *order, name=name, distinct=distinct, packed=True).withColumn(name, F.col(name) + offset)
        return keyed.select(name, *df.columns)
    checkpoint_root(df.sparkSession)
    df = (df.dropDuplicates() if distinct else df).checkpoint(eager=True)
    pos = df.withColumns({"_pid": F.spark_partition_id(), "_mid": F.monotonically_increasing_id()})
    counts = pos.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    starts = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow))
         - F.col("_n")).alias("_start"),
    )
    idx = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    keyed = pos.join(F.broadcast(starts), "_pid").withColumn(name, F.col("_start") + idx + F.lit(1 + offset))
    return keyed.select(name, *df.columns)


def seed_normalise(
    df: DataFrame,
    pk: str | None = None,
    key_offset: int = 0,
    datetime_cols: Sequence[str] | None = None,
    schema: T.StructType | None = None,
    key_order: Sequence[str] | None = None,
) -> DataFrame:
    """Lower/strip headers, drop full-row duplicates, add a dense key when
    ``pk`` is missing (starting after ``key_offset``; in the order of the
    ``key_order`` columns, which makes reruns agree), parse date/time columns
    (by name, plus ``datetime_cols``) with bad values -> NULL.

    With ``schema`` (see ``SEED_SCHEMAS``) the columns take its types and
    order instead: its timestamps are the date/time columns whatever their
    names, and columns missing in the file are NULL.  Columns beyond it
    raise."""
    df = normalise_headers(df)
    if pk and pk not in df.columns:
        df = dense_key(df, pk, key_offset, key_order, distinct=True)
    else:
        df = df.dropDuplicates()
    if schema is not None:
        if beyond := set(df.columns) - {f.name for f in schema.fields}:
            raise ValueError(f"columns {sorted(beyond)} are not in the table's contract")
        missing = {f.name: F.lit(None).cast("string") for f in schema.fields if f.name not in df.columns}
        return conform_to(df.withColumns(missing) if missing else df, schema)
    wanted = set(datetime_cols or [])
    casts = {
        c: F.try_to_timestamp(F.col(c).cast("string"))
        for c in df.columns
        if ("date" in c or "timestamp" in c or c in wanted) and c != pk
    }
    return df.withColumns(casts) if casts else df


def next_offset(stored: DataFrame | None, pk: str) -> int:
    """The greatest synthetic key a stored table holds (0 without one): new keys go on after it."""
    if stored is None or pk not in stored.columns:
        return 0
    return stored.agg(F.max(F.col(pk).try_cast("bigint"))).first()[0] or 0


@dataclass
class SeedLoadResult:
    table: str
    file: str
    status: str  # loaded | missing | failed
    rows: int | None = None
    error: str | None = None


SeedSink = Callable[[str, DataFrame], None]


def jdbc_sink(opts) -> SeedSink:
    """Append each seed table into the source database over JDBC."""
    from lakepipe.sources.jdbc import write_jdbc

    return lambda table, df: write_jdbc(df, opts, table, "append")


def jdbc_stored(spark: SparkSession, opts) -> Callable[[str], DataFrame]:
    """What a table of the source database holds, for keys that go on after its greatest one."""
    from lakepipe.sources.jdbc import read_jdbc_full

    return lambda table: read_jdbc_full(spark, opts, table)


def load_seeds(
    spark: SparkSession,
    data_dir: str,
    sink: SeedSink,
    tables: dict[str, str] | None = None,
    primary_keys: dict[str, str] | None = None,
    key_offsets: dict[str, int] | None = None,
    on_error: str = "raise",
    schemas: Mapping[str, T.StructType] | None = None,
    stored: Callable[[str], DataFrame | None] | None = None,
    key_order: Mapping[str, Sequence[str]] | None = None,
) -> list[SeedLoadResult]:
    """Load every seed file into its table: read the CSV (or its ``.zip``),
    normalise it (``seed_normalise``: headers, duplicate rows, synthetic key
    when the primary key is missing, column types) and append it with
    ``sink(table, df)``.  ``schemas`` types the tables it names (pass
    ``SEED_SCHEMAS``); ``stored(table)`` gives what a table already holds, so
    that synthetic keys go on after its greatest one.  A missing file is reported and skipped.  A failed
    table raises, or with ``on_error="skip"`` is reported and the loop goes
    on.  Row counts are observed on the write itself, so ``sink`` must
    write (run) the frame it is given.  What a table's load has put into the
    scratch folder (unzipped members, sorted ranges) goes when it is stored."""
    tables = SEED_TABLES if tables is None else tables
    primary_keys = SEED_PRIMARY_KEYS if primary_keys is None else primary_keys
    out = []
    for file, table in tables.items():
        made: list[str] = []
        try:
            with scratch_listed(made):
                raw = read_csv_seed(spark, f"{data_dir.rstrip('/')}/{file}")
            if raw is None:
                out.append(SeedLoadResult(table, file, "missing"))
                continue
            obs = Observation()
            pk = primary_keys.get(table)
            offset = (key_offsets or {}).get(table, 0)
            if stored is not None and pk and pk not in raw.columns:
                offset = max(offset, next_offset(stored(table), pk))
            with shuffles_removed(spark):
                with scratch_listed(made):
                    df = seed_normalise(raw, pk=pk, key_offset=offset, schema=(schemas or {}).get(table), key_order=(key_order or {}).get(table))
                try:
                    sink(table, df.observe(obs, F.count(F.lit(1)).alias("rows")))
                except Exception as e:  # noqa: BLE001 - reported per table when skipping
                    if on_error != "skip":
                        raise
                    out.append(SeedLoadResult(table, file, "failed", error=str(e)))
                    continue
            out.append(SeedLoadResult(table, file, "loaded", rows=obs.get.get("rows")))
        finally:
            remove_paths(spark, made)
    return out
