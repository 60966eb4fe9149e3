"""Seed queries: the nine seed files, plain and zipped, loaded into typed tables.

The driver's tables are written as the seed files would arrive (text, every row
twice, headers in any case and order, some files zipped in several members),
loaded, and read back as whole rows.
"""

from __future__ import annotations

import struct
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakepipe.plans.catalog import register
from lakepipe.plans.fixtures import TABLES, read_table
from lakepipe.session import remove_paths, scratch_listed, scratch_path
from lakepipe.sources.catalog import Layer, check_primary_key
from lakepipe.sources.layout import hadoop_fs
from lakepipe.sources.seed import GZIP_HEADER, SEED_PRIMARY_KEYS, SEED_SCHEMAS, SEED_TABLES, TRANSLATION_SEED, load_seeds, read_csv_seed

_DAY = "date_trunc('day', o_orderdate)"
# What each seed table holds, in SQL that both engines run; synthetic keys are not part of the files.
_SOURCES = {
    "customers": "select cast(c_custkey as string) customer_id, c_name customer_unique_id, cast(c_nationkey * 100 as int) customer_zip_code_prefix, "
    "c_mktsegment customer_city, concat('S', cast(c_nationkey as string)) customer_state from customer",
    "orders": "select cast(o_orderkey as string) order_id, cast(o_custkey as string) customer_id, o_orderstatus order_status, "
    "cast(o_orderdate as timestamp) order_purchase_timestamp, case when o_orderkey % 5 > 0 then cast(o_orderdate + interval '1' hour as timestamp) end order_approved_at, "
    "cast(o_orderdate + interval '2' day as timestamp) order_delivered_carrier_date, case when o_orderkey % 7 > 0 then cast(o_orderdate + interval '9' day as timestamp) end "
    "order_delivered_customer_date, cast(o_orderdate + interval '20' day as timestamp) order_estimated_delivery_date from orders",
    "order_items": "select cast(l_orderkey as string) order_id, cast(l_linenumber as int) order_item_id, cast(l_partkey as string) product_id, "
    "cast(l_suppkey as string) seller_id, cast(l_shipdate as timestamp) shipping_limit_date, cast(l_extendedprice as float) price, "
    "cast(l_quantity as float) freight_value from lineitem",
    "order_payments": "select cast(o_orderkey as string) order_id, cast(o_orderkey % 3 + 1 as int) payment_sequential, o_orderpriority payment_type, "
    "cast(o_orderkey % 12 as int) payment_installments, cast(o_totalprice as float) payment_value from orders",
    "order_reviews": "select concat('r', cast(o_orderkey as string)) review_id, cast(o_orderkey as string) order_id, cast(o_orderkey % 5 + 1 as int) review_score, "
    "case when o_orderkey % 3 > 0 then 'a 5\" screen' end review_comment_title, concat('ok, \"', o_orderpriority, '\"', chr(10), 'said twice') review_comment_message, "
    "cast(o_orderdate as timestamp) review_creation_date, cast(o_orderdate + interval '3' day as timestamp) review_answer_timestamp from orders",
    "products": "select cast(p_partkey as string) product_id, p_name product_category_name, cast(length(p_name) as int) product_name_lenght, "
    "cast(p_size * 3 as int) product_description_lenght, cast(p_size % 4 as int) product_photos_qty, cast(p_size * 10 as int) product_weight_g, "
    "cast(p_size as int) product_length_cm, case when p_size % 2 > 0 then cast(p_size + 1 as int) end product_height_cm, cast(p_size + 2 as int) product_width_cm from part",
    "sellers": "select cast(s_suppkey as string) seller_id, cast(s_nationkey * 10 as int) seller_zip_code_prefix, s_name seller_city, "
    "cast(s_nationkey as string) seller_state from supplier",
    "geolocation": "select cast(c_custkey as int) geolocation_zip_code_prefix, cast(c_acctbal as float) geolocation_lat, cast(c_nationkey as float) geolocation_lng, "
    "c_name geolocation_city, c_mktsegment geolocation_state from customer",
    "product_category_name_translation": "select concat('cat ', n_name) product_category_name, lower(n_name) product_category_name_english from nation",
}
_FILES = {table: file for file, table in {**SEED_TABLES, **TRANSLATION_SEED}.items()}
_KEYS = {**SEED_PRIMARY_KEYS, "product_category_name_translation": "id"}
_ZIPPED = ("order_items", "order_reviews", "sellers", "geolocation")


def _source(spark, sf_dir, table):
    for name in TABLES:
        if f"from {name}" in _SOURCES[table]:
            return spark.sql(_SOURCES[table].replace(f"from {name}", "from {src}"), src=read_table(spark, sf_dir, name))
    raise KeyError(table)


def _write_csv(rows, folder, shuffled=False, times=2, **options):
    """The rows as text, each twice (or ``times``), headers with spaces and capitals; ``shuffled`` turns the order of the columns round."""
    text = rows.select(*[F.col(c).cast("string").alias(f" {c.title()} ") for c in rows.columns])
    if shuffled:
        text = text.select(*reversed(text.columns))
    reduce(DataFrame.unionAll, [text] * times).write.option("header", "true").option("escape", '"').options(**options).csv(folder)


def _zip(spark, folders, archive):
    """Pack the gzip files of some folders into one archive, as a seed delivery has them.

    A gzip file holds a deflated member between a header of 10 bytes and its checksum and length; the tasks
    that wrote the files have done the work, here bytes are copied.
    """
    jvm = spark.sparkContext._jvm
    copy = jvm.org.apache.commons.io.IOUtils.copyLarge
    fs, to = hadoop_fs(spark, archive)
    out, directory, at = fs.create(to, True), [], 0
    for k, folder in enumerate(folders):
        for f in sorted(fs.listStatus(hadoop_fs(spark, folder)[1]), key=lambda f: f.getPath().getName()):
            name, size = f.getPath().getName(), f.getLen() - 18
            if not name.endswith(".csv.gz"):
                continue
            stream = fs.open(f.getPath())
            head = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, 10))
            assert head[:4] == GZIP_HEADER[:4] and size < 2**32 - 1, (name, head, size)
            stream.seek(10 + size)
            crc, length = struct.unpack("<LL", bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(stream, 8)))
            entry = f"{k}/{name.removesuffix('.gz')}".encode()
            shape = (0, 8, 0, 0x21, crc, size, length, len(entry))  # flags, deflated, time, date 1980-01-01
            local = struct.pack("<LH4H3L2H", 0x04034B50, 45, *shape, 0) + entry
            # An offset beyond 4 GB goes into an extra field.
            extra = struct.pack("<HHQ", 1, 8, at) if at >= 2**32 - 1 else b""
            directory.append(struct.pack("<L2H4H3L5H2L", 0x02014B50, 45, 45, *shape, len(extra), 0, 0, 0, 0, min(at, 2**32 - 1)) + entry + extra)
            out.write(local)
            stream.seek(10)
            copy(stream, out, 0, size)
            stream.close()
            at += len(local) + size
    for entry in directory:
        out.write(entry)
    n, size = len(directory), sum(map(len, directory))
    out.write(struct.pack("<LQ2H2L4Q", 0x06064B50, 44, 45, 45, 0, 0, n, n, size, at) + struct.pack("<LLQL", 0x07064B50, 0, at + size, 1))
    out.write(struct.pack("<L4H2LH", 0x06054B50, 0, 0, min(n, 2**16 - 1), min(n, 2**16 - 1), min(size, 2**32 - 1), min(at, 2**32 - 1), 0))
    out.close()


def _deliver(spark, sf_dir, table, data, where=None):
    rows = _source(spark, sf_dir, table)
    rows = rows if where is None else rows.where(where)
    if table not in _ZIPPED:
        _write_csv(rows, f"{data}/{_FILES[table]}")
        return
    parts = scratch_path(spark, "seed-parts")
    # Two columns tell most rows apart, and are all that the scan for the other half computes of a row.
    half = F.pmod(F.xxhash64(*rows.columns[:2]), F.lit(2))
    # A gzip file keeps its length modulo 4 GB, so files are bounded; the fast kind of deflating takes less of a task.
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 4_000_000}
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda k: _write_csv(rows.where(half == k), f"{parts}/{'ab'[k]}", shuffled=k == 1, times=1, **packed), range(2)))
    # Every row comes twice, as members of its own each time: text is made and deflated once, and packed twice.
    _zip(spark, [f"{parts}/a", f"{parts}/b"] * 2, f"{data}/{_FILES[table]}.zip")


def _place(spark, sf_dir, table, data, where=None):
    """``_deliver``, which leaves no more than the delivered file: the parts of an archive go once it is packed."""
    parts = []
    with scratch_listed(parts):
        _deliver(spark, sf_dir, table, data, where)
    remove_paths(spark, parts)


def _load(spark, layer, data, tables):
    """Load seed files into catalog tables of their contracts, which are created when missing."""
    for table in tables:
        layer.ensure_table(spark, table, SEED_SCHEMAS[table], location=scratch_path(spark, f"seed-{table}"))

    def append(table, df):
        df.write.insertInto(layer.qualified(table).replace("`", ""))
        # A delivered file is of no use once its rows are stored.
        remove_paths(spark, [f"{data}/{_FILES[table]}", f"{data}/{_FILES[table]}.zip"])

    # Keys follow the rows' own order, so the stored result can be compared as a whole.
    order = {t: [f.name for f in SEED_SCHEMAS[t].fields if f.name != _KEYS[t]] for t in tables}
    return load_seeds(
        spark, data, append, {_FILES[t]: t for t in tables}, {t: _KEYS[t] for t in tables}, schemas=SEED_SCHEMAS, stored=lambda t: layer.read(spark, t), key_order=order
    )


def _layer():
    return Layer(f"seed_{uuid.uuid4().hex[:12]}")


def _oracle(table):
    rows = f"select distinct * from ({_SOURCES[table]})"
    if _KEYS[table] != "id":
        return rows
    columns = [f.name for f in SEED_SCHEMAS[table].fields if f.name != "id"]
    # Files are text, so text is what their rows are ordered by.
    by = ", ".join(f"cast({c} as varchar) nulls first" for c in columns)
    return f"select row_number() over (order by {by}) as id, * from ({rows})"


def _register_table(table):
    @register(f"seed_{table}", _oracle(table), "SRC-7 SRC-8 SRC-9 SRC-13" + (" (zipped, two members of different column order)" if table in _ZIPPED else ""))
    def build(spark, sf_dir):
        data, layer = scratch_path(spark, "seed-data"), _layer()
        _place(spark, sf_dir, table, data)
        results = _load(spark, layer, data, [table])
        assert [r.status for r in results] == ["loaded"], results
        return layer.read(spark, table)


for _table in _SOURCES:
    _register_table(_table)


@register("seed_zip", f"select cast(columns(*) as varchar) from ({_SOURCES['order_reviews']}) union all select cast(columns(*) as varchar) from ({_SOURCES['order_reviews']})", "SRC-7 (every member, own header each, quoted line breaks)")
def q_seed_zip(spark, sf_dir):
    data = scratch_path(spark, "seed-data")
    _place(spark, sf_dir, "order_reviews", data)
    return read_csv_seed(spark, f"{data}/{_FILES['order_reviews']}")


@register(
    "seed_synthetic_key",
    f"""with a as (select distinct * from ({_SOURCES['order_payments']}) where payment_sequential < 3),
b as (select distinct * from ({_SOURCES['order_payments']}) where payment_sequential = 3),
k as (select 0 as part, * from a union all select 1 as part, * from b)
select row_number() over (order by part, order_id, cast(payment_sequential as varchar), payment_type, cast(payment_installments as varchar),
  cast(payment_value as varchar)) as id, * exclude (part) from k""",
    "SRC-8 D28 (a second load goes on after the stored keys)",
)
def q_seed_synthetic_key(spark, sf_dir):
    layer = _layer()
    for where in ("payment_sequential < 3", "payment_sequential = 3"):
        data = scratch_path(spark, "seed-data")
        _place(spark, sf_dir, "order_payments", data, where)
        _load(spark, layer, data, ["order_payments"])
    return layer.read(spark, "order_payments")


@register(
    "seed_load_tables",
    f"""select o.order_id, o.order_purchase_timestamp, o.order_approved_at, c.customer_unique_id, c.customer_zip_code_prefix, s.seller_city, i.order_item_id, i.price
from ({_SOURCES['orders']}) o join ({_SOURCES['customers']}) c using (customer_id) join (select distinct * from ({_SOURCES['order_items']})) i using (order_id)
join ({_SOURCES['sellers']}) s using (seller_id)""",
    "SRC-7 SRC-8 SRC-9 SNK-15 (seed load loop into catalog tables, read back together)",
)
def q_seed_load_tables(spark, sf_dir):
    tables = ["customers", "orders", "order_items", "sellers"]
    data, layer = scratch_path(spark, "seed-data"), _layer()
    # Archives are packed by the driver while tasks write the other files.
    with ThreadPoolExecutor(len(tables)) as pool:
        list(pool.map(lambda t: _place(spark, sf_dir, t, data), sorted(tables, key=lambda t: t not in _ZIPPED)))
    _load(spark, layer, data, tables)
    c, o, i, s = (layer.read(spark, t) for t in tables)
    return o.join(c, "customer_id").join(i, "order_id").join(s, "seller_id").select(
        "order_id", "order_purchase_timestamp", "order_approved_at", "customer_unique_id", "customer_zip_code_prefix", "seller_city", "order_item_id", "price"
    )


@register(
    "seed_check_keys",
    "select cast(o_custkey as string) customer_id from orders group by 1 having count(*) > 1",
    "SRC-13 (keys that occur more than once)",
)
def q_seed_check_keys(spark, sf_dir):
    return check_primary_key(_source(spark, sf_dir, "orders"), "customer_id")
