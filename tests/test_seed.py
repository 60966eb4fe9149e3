"""CSV / zipped CSV seeds and their normalisation."""

import glob
import gzip
import os
import zipfile
from collections import Counter

import pytest
from pyspark.sql import types as T

from lakepipe.plans import queries_seed
from lakepipe.plans.queries_seed import _deliver, _write_csv, _zip
from lakepipe.session import checkpoint_root
from lakepipe.sources.seed import (
    SEED_PRIMARY_KEYS,
    SEED_SCHEMAS,
    SEED_TABLES,
    TRANSLATION_SEED,
    dense_key,
    load_seeds,
    read_csv_seed,
    read_zipped_csv,
    seed_normalise,
    unzip_to,
)


def test_zip_and_plain_csv(spark, tmp_root):
    text = " Order_ID ,Order_Purchase_Timestamp,Order_Approved_At\nA,2001-01-02 03:04:05,x\nA,2001-01-02 03:04:05,x\n" \
           "B,bad,2001-01-01 00:00:00\n"
    with zipfile.ZipFile(tmp_root + "/orders.csv.zip", "w") as z:
        z.writestr("orders.csv", text)
    df = read_csv_seed(spark, tmp_root + "/orders.csv")
    assert df is not None and df.count() == 3
    out = seed_normalise(df, pk="order_id", datetime_cols=["order_approved_at"])
    got = sorted((r.order_id, str(r.order_purchase_timestamp), str(r.order_approved_at)) for r in out.collect())
    assert got == [("A", "2001-01-02 03:04:05", "None"), ("B", "None", "2001-01-01 00:00:00")]
    with open(tmp_root + "/plain.csv", "w") as f:
        f.write(text)
    assert read_csv_seed(spark, tmp_root + "/plain.csv").count() == 3
    assert read_csv_seed(spark, tmp_root + "/missing.csv") is None


def test_dense_key_unique_and_gap_free(spark):
    df = spark.range(0, 1000, numPartitions=7).selectExpr("id * 3 as v")
    keys = sorted(r.k for r in dense_key(df, "k", offset=100).collect())
    assert keys == list(range(101, 1101))


def test_synthetic_key_only_when_missing(spark):
    df = spark.createDataFrame([("x", 1)], "Customer_ID string, n int")
    out = seed_normalise(df, pk=SEED_PRIMARY_KEYS["customers"])
    assert out.columns == ["customer_id", "n"]


def test_quoted_newlines_and_doubled_quotes(spark, tmp_root):
    """RFC 4180 fields: commas, line breaks and doubled quotes inside quotes
    stay in their field, zipped or plain."""
    text = ('review_id,comment,score\nr1,"good, fast\nwould buy ""again""",5\nr2,plain,3\n'
            'r3,a 5" screen,4\nr4,"x",2\n')
    with zipfile.ZipFile(tmp_root + "/reviews.csv.zip", "w") as z:
        z.writestr("reviews.csv", text)
    with open(tmp_root + "/plain_reviews.csv", "w", newline="") as f:
        f.write(text)
    want = [("r1", 'good, fast\nwould buy "again"', "5"), ("r2", "plain", "3"), ("r3", 'a 5" screen', "4"),
            ("r4", "x", "2")]
    for p in ("/reviews.csv", "/plain_reviews.csv"):
        df = read_csv_seed(spark, tmp_root + p)
        assert sorted(tuple(r) for r in df.collect()) == want, p


def test_zip_members_are_joined_by_name(spark, tmp_root):
    """Every member of every archive, each with its own header; other columns raise, an empty member adds nothing."""
    with zipfile.ZipFile(tmp_root + "/a.zip", "w") as z:
        z.writestr("x/part.csv", "A,b\n1,one\n")
        z.writestr("y/part.csv", " B ,a\ntwo,2\nthree,3\n")
        z.writestr("empty.csv", "")
    with zipfile.ZipFile(tmp_root + "/b.zip", "w") as z:
        z.writestr("../up.csv", "b,a\nfour,4.0\nbad,n/a\n")
    df = read_zipped_csv(spark, tmp_root + "/*.zip", T.StructType.fromDDL("a int, b string"))
    assert df.dtypes == [("a", "int"), ("b", "string")]
    assert sorted(map(tuple, df.collect()), key=str) == sorted([(1, "one"), (2, "two"), (3, "three"), (4, "four"), (None, "bad")], key=str)
    with pytest.raises(ValueError, match="contract"):
        read_zipped_csv(spark, tmp_root + "/b.zip", T.StructType.fromDDL("a int"))
    with zipfile.ZipFile(tmp_root + "/c.zip", "w") as z:
        z.writestr("c.csv", "a,b,c\n1,2,3\n")
    with pytest.raises(ValueError, match="other columns"):
        read_zipped_csv(spark, tmp_root + "/*.zip")


def test_zip_members_stay_compressed_and_alike_ones_are_one_read(spark, tmp_root):
    """The driver copies deflated bytes; tasks inflate them.  Stored, packed and empty members keep their rows."""
    with zipfile.ZipFile(tmp_root + "/a.zip", "w") as z:
        for n in range(30):
            z.writestr(f"p{n}.csv", f"A,b\n{n},x{n}\n", zipfile.ZIP_DEFLATED)
        z.writestr("stored.csv", "b,a\nx30,30\n", zipfile.ZIP_STORED)
        z.writestr("inner.csv.gz", gzip.compress(b"a,b\n31,x31\n"), zipfile.ZIP_DEFLATED)
        z.writestr("empty.csv", "", zipfile.ZIP_DEFLATED)
    files = unzip_to(spark, tmp_root + "/a.zip", tmp_root + "/out")
    assert [f.rsplit("/", 1)[-1] for f in files] == [f"p{n}.csv.gz" for n in range(30)] + ["stored.csv", "inner.csv.gz", "empty.csv"]
    assert gzip.decompress(open(files[7], "rb").read()) == b"A,b\n7,x7\n"
    df = read_zipped_csv(spark, tmp_root + "/a.zip")
    assert sorted(map(tuple, df.collect()), key=lambda r: int(r[0])) == [(str(n), f"x{n}") for n in range(32)]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") <= 3


def test_delivered_archive_is_a_zip(spark, tmp_root):
    rows = spark.range(0, 50, numPartitions=3).selectExpr("id", "concat('a \"', id, '\"') v")
    for folder in ("a", "b"):
        _write_csv(rows, f"{tmp_root}/{folder}", compression="gzip")
    _zip(spark, [f"{tmp_root}/a", f"{tmp_root}/b"], f"{tmp_root}/d.zip")
    with zipfile.ZipFile(f"{tmp_root}/d.zip") as z:
        assert z.testzip() is None and {m.compress_type for m in z.infolist()} == {zipfile.ZIP_DEFLATED}
    got = read_zipped_csv(spark, f"{tmp_root}/d.zip")
    assert sorted((int(r.id), r.v) for r in got.collect()) == sorted([(n, f'a "{n}"') for n in range(50)] * 4)


def test_delivered_text_is_made_once_and_packed_twice(spark, tmp_root, monkeypatch):
    """Every row arrives twice, half of them with the columns turned round; each member is deflated once."""
    rows = spark.range(0, 40, numPartitions=2).selectExpr("id s_suppkey", "concat('s \"', id, '\"') s_name", "cast(id % 25 as int) s_nationkey")
    rows.write.parquet(f"{tmp_root}/supplier.parquet")
    made = []

    def pack(spark, folders, archive):
        made.extend(sorted(set(folders)))
        _zip(spark, folders, archive)

    monkeypatch.setattr(queries_seed, "_zip", pack)
    _deliver(spark, tmp_root, "sellers", tmp_root)
    assert sum(spark.read.option("header", "true").csv(folder).count() for folder in made) == 40
    with zipfile.ZipFile(f"{tmp_root}/olist_sellers_dataset.csv.zip") as z:
        members = z.infolist()
        assert z.testzip() is None and len({m.filename for m in members}) == len(members)
        assert {z.open(m).readline().strip() for m in members} == {
            b"Seller_Id,Seller_Zip_Code_Prefix,Seller_City,Seller_State",
            b"Seller_State,Seller_City,Seller_Zip_Code_Prefix,Seller_Id",
        }
    assert sorted(Counter(m.CRC for m in members).values()) == [2] * (len(members) // 2)
    got = read_csv_seed(spark, f"{tmp_root}/olist_sellers_dataset.csv").collect()
    assert Counter((r.seller_id, r.seller_city, r.seller_state) for r in got) == {(str(n), f's "{n}"', str(n % 25)): 2 for n in range(40)}


def test_keys_go_on_after_the_stored_ones(spark, tmp_root):
    with open(tmp_root + "/pay.csv", "w") as f:
        f.write("Order_ID,Payment_Value\nb,2.5\na,1\na,1\n")
    stored = []

    def sink(table, df):
        stored.extend(df.collect())

    def held(table):
        return spark.createDataFrame(stored, SEED_SCHEMAS["order_payments"]) if stored else None

    for _ in range(2):
        load_seeds(spark, tmp_root, sink, {"pay.csv": "order_payments"}, schemas=SEED_SCHEMAS, stored=held, key_order={"order_payments": ["order_id"]})
    assert [(r.id, r.order_id, r.payment_value, r.payment_type) for r in stored] == [(1, "a", 1.0, None), (2, "b", 2.5, None), (3, "a", 1.0, None), (4, "b", 2.5, None)]


def test_distinct_rows_are_numbered_in_one_shuffle(spark):
    """Equal rows fall in one range, so rows are told apart where they are put in order; NULL and empty text differ."""
    rows = [("b", "2", None), ("a", "10", "x"), ("a", "9", "x"), ("a", "9", ""), ("a", "9", None), (None, "1", "x")] * 3
    df = spark.createDataFrame(rows, "k string, n string, v string").repartition(5)
    out = dense_key(df, "id", 7, ["k", "n"], distinct=True)
    got = out.orderBy("id").collect()
    assert [r.id for r in got] == list(range(8, 14)) and {(r.k, r.n, r.v) for r in got} == set(rows)
    assert [(r.k, r.n) for r in got] == [(None, "1"), ("a", "10"), ("a", "9"), ("a", "9"), ("a", "9"), ("b", "2")]
    ranged = df.repartitionByRange(3, "k", "n").dropDuplicates().sortWithinPartitions("k", "n")
    assert ranged._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 2  # repartition(5) and the ranges


def test_ranges_of_other_kinds_keep_their_values(spark):
    """Times of long ago, arrays and maps are numbered too."""
    df = spark.sql("select id, timestamp'0900-01-01 00:00:00' + make_interval(cast(id as int)) t, array(id) a, map(id, 'x') m from range(5)")
    got = dense_key(df, "n", 0, ["t"]).selectExpr("*", "year(t) y").drop("t").orderBy("n").collect()
    assert [(r.n, r.id, r.a, r.m, r.y) for r in got] == [(i + 1, i, [i], {i: "x"}, 900 + i) for i in range(5)]


def test_a_load_leaves_only_its_table(spark, tmp_root):
    """Unzipped members, sorted ranges, shuffle files and what the query delivered go when the rows are stored."""
    left = lambda: {p for name in ("unzipped", "ranges", "seed-parts") for p in glob.glob(f"{checkpoint_root(spark).removeprefix('file:')}/lakepipe/{name}-*")}
    before, setting = left(), spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    spark.range(0, 30).selectExpr("id s_suppkey", "concat('s', id) s_name", "cast(id as int) s_nationkey").write.parquet(f"{tmp_root}/supplier.parquet")
    spark.range(0, 30).selectExpr("id c_custkey", "id * 0.5D c_acctbal", "concat('c', id) c_name", "cast(id as int) c_nationkey", "'m' c_mktsegment").write.parquet(f"{tmp_root}/customer.parquet")
    layer, data = queries_seed._layer(), f"{tmp_root}/data"
    for table in ("sellers", "customers", "geolocation"):
        queries_seed._place(spark, tmp_root, table, data)
    results = queries_seed._load(spark, layer, data, ["sellers", "customers", "geolocation"])
    assert [(r.status, r.rows) for r in results] == [("loaded", 30)] * 3
    assert [layer.read(spark, r.table).count() for r in results] == [30] * 3
    assert left() == before and not [f for f in os.listdir(data) if not f.startswith(".")]
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting


def test_contracts_of_all_tables(spark):
    assert set(SEED_SCHEMAS) == {*SEED_TABLES.values(), *TRANSLATION_SEED.values()}
    assert all(SEED_PRIMARY_KEYS.get(t, "id") in s.fieldNames() for t, s in SEED_SCHEMAS.items())
    with pytest.raises(ValueError, match="not in the table's contract"):
        seed_normalise(spark.createDataFrame([("x", 1)], "seller_id string, other int"), schema=SEED_SCHEMAS["sellers"])


def test_load_seeds_loop(spark, tmp_root):
    """Every mapped file -> normalised table through the sink; a missing file
    is reported; a failing table raises, or is reported with on_error=skip."""
    with zipfile.ZipFile(tmp_root + "/sellers.csv.zip", "w") as z:
        z.writestr("sellers.csv", " Seller_ID ,Seller_City\ns1,a\ns1,a\ns2,b\n")
    with open(tmp_root + "/orders.csv", "w") as f:
        f.write("Order_Status,Order_Purchase_Timestamp\nok,2001-01-02 03:04:05\nok,2001-01-02 03:04:05\nx,bad\n")
    tables = {"sellers.csv": "sellers", "orders.csv": "orders", "absent.csv": "products"}
    got = {}
    res = load_seeds(spark, tmp_root, lambda t, df: got.__setitem__(t, df.collect()), tables=tables)
    assert [(r.table, r.status, r.rows) for r in res] == [
        ("sellers", "loaded", 2), ("orders", "loaded", 2), ("products", "missing", None)]
    assert sorted(r.seller_id for r in got["sellers"]) == ["s1", "s2"]
    assert sorted(r.order_id for r in got["orders"]) == [1, 2]  # synthetic key

    def broken(table, df):
        raise RuntimeError("db down")

    with pytest.raises(RuntimeError):
        load_seeds(spark, tmp_root, broken, tables=tables)
    res = load_seeds(spark, tmp_root, broken, tables=tables, on_error="skip")
    assert [r.status for r in res] == ["failed", "failed", "missing"] and res[0].error == "db down"


def test_translation_seed_has_no_synthetic_key(spark, tmp_root):
    with open(tmp_root + "/product_category_name_translation.csv", "w") as f:
        f.write("Product_Category_Name,Product_Category_Name_English\nbeleza,beauty\nbeleza,beauty\n")
    got = {}
    res = load_seeds(spark, tmp_root, lambda t, df: got.__setitem__(t, (df.columns, df.collect())),
                     tables=TRANSLATION_SEED)
    assert res[0].status == "loaded" and res[0].rows == 1
    cols, rows_ = got["product_category_name_translation"]
    assert cols == ["product_category_name", "product_category_name_english"] and len(rows_) == 1
