from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from retailgold import functions as fn


def apply(spark, column, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    return [r.v for r in df.select("i", column(F.col("s")).alias("v")).orderBy("i").collect()]


def test_lenient_int(spark):
    cases = {
        "7": 7, " 007 ": 7, "12.9": 12, "-4.7": -4, "+3": 3, "5.": 5, ".5": 0, "x": None, "": None, "1e3": None,
        "99999999999": None, "99999999999.5": None, "2147483647.9": 2147483647, "1 2": None, "1d": None, None: None,
    }
    assert dict(zip(cases, apply(spark, fn.lenient_int, list(cases)))) == cases


def test_lenient_double(spark):
    cases = {"10.5": 10.5, "10.50": 10.5, " 1 ": 1.0, "x": None, "": None, None: None}
    assert dict(zip(cases, apply(spark, fn.lenient_double, list(cases)))) == cases


def test_lenient_date(spark):
    day = dt.date(2020, 1, 2)
    cases = {"2020-01-02": day, "2020-01-02 10:00:00": day, "01/02/2020": None, "2020-13-01": None, "": None, None: None}
    assert dict(zip(cases, apply(spark, fn.lenient_date, list(cases)))) == cases


def test_settlement_date(spark):
    cases = {
        "09/10/2020 12:01:02": dt.date(2020, 9, 10), "9/10/2020 12:01": dt.date(2020, 9, 10),
        "9/1/2020 12:01": dt.date(2020, 9, 1), "12/1/2020 10:00": dt.date(2020, 12, 1), "garbage": None,
        "13/45/2020 10:00": None, "2020-09-10": None, "": None, None: None,
    }
    assert dict(zip(cases, apply(spark, fn.settlement_date, list(cases)))) == cases


def test_card_digits(spark):
    assert apply(spark, fn.card_suffix, ["411111xxxxxx1234", "123", "", None]) == ["1234", "123", "", None]
    assert apply(spark, fn.card_prefix, ["411111xxxxxx1234", "123", "", None]) == ["411111", "123", "", None]


@pytest.mark.parametrize("parts, plain, filled", [
    (("1", "2", "3"), "1~2~3", "1~2~3"), ((None, "2", "3"), None, "~2~3"), (("1", None, "3"), None, "1~~3"),
    (("1", "2", None), None, "1~2~"), ((None, None, None), None, "~~"),
])
def test_check_id(spark, parts, plain, filled):
    df = spark.createDataFrame([parts], "a string, b string, c string")
    columns = [F.col(c) for c in "abc"]
    assert df.select(fn.check_id(*columns)).first()[0] == plain
    assert df.select(fn.check_id(*[fn.key_part(c) for c in columns])).first()[0] == filled


def test_names(spark):
    key = "brand_a/daily/Transaction_Item/feed_transaction_item_20200102.psv.gz.pgp"
    assert apply(spark, fn.date_from_name, [key]) == ["20200102"]
    assert apply(spark, fn.feed_from_name, [key]) == ["transaction_item"]
    assert apply(spark, fn.file_name, [key]) == ["feed_transaction_item_20200102.psv.gz.pgp"]
    assert apply(spark, fn.feed_folder, ["transaction_item", "product"]) == ["Transaction_Item", "Product"]
    assert apply(spark, fn.partition_value, ["a/partition_col=20200102/part-0.gz", "a/b"]) == ["20200102", ""]


def test_shift_day(spark):
    days = ["20200301", "20200101", "20201231", "x"]
    assert apply(spark, lambda c: fn.shift_day(c, -1), days) == ["20200229", "20191231", "20201230", None]
    assert apply(spark, lambda c: fn.shift_day(c, 1), days) == ["20200302", "20200102", "20210101", None]
