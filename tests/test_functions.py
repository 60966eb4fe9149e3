"""Column functions against hand-written dirty values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakepipe import functions as lf
from lakepipe.clock import Clock


def one(spark, col, values, schema="x string"):
    rows = [(v,) if not isinstance(v, tuple) else v for v in values]
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col.alias("y")).collect()]


def test_title_case(spark):
    assert one(spark, lf.title_case("x"), ["  JOHN o'neil smith-LEE ", "\tann", None]) == [
        "John O'neil Smith-lee", "\tann", None]


def test_code_and_email_norm(spark):
    assert one(spark, lf.code_norm("x"), [" active "]) == ["ACTIVE"]
    assert one(spark, lf.email_norm("x"), [" A@B.C "]) == ["a@b.c"]


def test_blank_to_null_variants(spark):
    assert one(spark, lf.blank_to_null("x", "keep"), ["   ", " hi ", None]) == [None, " hi ", None]
    assert one(spark, lf.blank_to_null("x", "trim"), [" hi "]) == ["hi"]
    assert one(spark, lf.blank_to_null("x", "title"), [" near PARK "]) == ["Near Park"]


def test_clean_email(spark):
    assert one(spark, lf.clean_email("x"), [" A.B@X.Co ", "a@b", "a b@c.de", None]) == [
        "a.b@x.co", None, None, None]


def test_clean_phone(spark):
    vals = ["+91 98765-43210", "98765 43210", "123456789", "12345678901", "12345678", "123456789012"]
    assert one(spark, lf.clean_phone("x"), vals) == [
        None, "9876543210", "123456789", "12345678901", None, None]


def test_digits_pincode_quotes(spark):
    assert one(spark, lf.digits_only("x"), ["abc"]) == [""]
    assert one(spark, lf.clean_pincode("x"), ["PIN 560 001", "n/a"]) == ["560001", None]
    assert one(spark, lf.strip_quotes("x"), ['""ab"c"']) == ['ab"c']


def test_arrays(spark):
    assert one(spark, lf.pg_array_to_array("x"), ["{a, b ,c}", "{}", None]) == [["a", "b", "c"], [""], None]
    assert one(spark, lf.csv_to_array("x"), [" squat ,  press"]) == [["squat", "press"]]


def test_full_name(spark):
    df = spark.createDataFrame([("Ann", None), (None, None)], "a string, b string")
    assert [r[0] for r in df.select(lf.full_name("a", "b")).collect()] == ["Ann", ""]


def test_bmi(spark):
    df = spark.createDataFrame([(175.0, 70.0), (0.0, 70.0), (175.0, -1.0), (None, 70.0)], "h double, w double")
    assert [r[0] for r in df.select(lf.bmi("h", "w")).collect()] == [22.86, None, None, None]


def test_duration_minutes(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2001, 1, 1, 10, 0, 0), dt.datetime(2001, 1, 1, 11, 30, 30)),
         (dt.datetime(2001, 1, 1, 10, 0, 0), None)], "s timestamp, e timestamp")
    assert [r[0] for r in df.select(lf.duration_minutes("s", "e")).collect()] == [91.0, None]


def test_std_ts_never_raises(spark):
    out = one(spark, lf.std_ts("x"), ["bad", "", "2001-02-03 04:05:06", None])
    assert out[:2] == [None, None] and out[2] == dt.datetime(2001, 2, 3, 4, 5, 6) and out[3] is None


def test_std_cast(spark):
    assert one(spark, lf.std_cast("x", "int"), ["12", "12.7", "abc"]) == [12, 12, None]
    assert one(spark, lf.std_cast("x", "boolean"), ["true", "maybe"]) == [True, None]


@pytest.mark.parametrize("days,price,expected", [(365, 1200.0, 100.0), (364, 300.0, 100.0), (90, 300.0, 100.0),
                                                 (89, 50.0, 50.0), (None, 50.0, 50.0)])
def test_monthly_price(spark, days, price, expected):
    df = spark.createDataFrame([(days, price)], "d int, p double")
    assert df.select(lf.monthly_price("d", "p")).first()[0] == expected


def test_days_since(spark):
    df = spark.createDataFrame([(dt.datetime(2001, 8, 1),), (None,)], "x timestamp")
    out = [r[0] for r in df.select(lf.days_since("x", Clock("2001-10-01").date())).collect()]
    assert out == [61, 999]


def test_default_if_null(spark):
    assert one(spark, lf.default_if_null(F.lower("x"), "unknown"), ["A@B.C", None]) == ["a@b.c", "unknown"]
