from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from retailgold.operators import arrivals, selection
from retailgold.schemas import DIMENSIONS, POS_FEEDS


def record(key, time="2020-01-02T00:00:00"):
    return {"eventTime": time, "s3": {"bucket": {"name": "b"}, "object": {"key": key, "size": 3, "eTag": "e"}}}


def notice(*keys):
    return json.dumps({"Records": [record(k) for k in keys]})


def envelope(*messages):
    return json.dumps({"Records": [{"Sns": {"Message": m}} for m in messages]})


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def key(brand, schedule, feed, dt, suffix=".psv.gz.pgp"):
    if schedule == "weekly" and feed in DIMENSIONS:
        return f"{brand}/weekly_staging/{feed}/dt={dt}/feed_{feed}_{dt}{suffix}"
    return f"{brand}/{schedule}/{feed.title()}/feed_{feed}_{dt}{suffix}"


def test_parse(spark):
    out = arrivals.parse(frame(
        spark, notice("a", "b"), envelope(notice("c", "d"), notice("e")), "not json", "{}", None, notice(),
        json.dumps({"Records": [{"Sns": {"Message": {"Records": [record("f")]}}}]}),
    ))
    assert [r[0] for r in rows(out, "key")] == list("abcdef")
    assert rows(out, "event_time", "bucket", "size")[0] == ("2020-01-02T00:00:00", "b", 3)


def test_irrelevant_key_between_relevant_ones(spark):
    good = [key("brand_a", "daily", "tenders", 20200102), key("brand_b", "weekly", "product", 20200102)]
    out = arrivals.route(frame(spark, notice(good[0], "other/logs/x", "brand_a/weekly_staging/tenders/t_20200102", good[1])))
    assert [r[0] for r in rows(out, "key")] == sorted(good)


def test_classify(spark):
    keys = [
        key("brand_a", "daily", "transaction_item", 20200102), key("brand_b", "weekly", "tenders", 20200103),
        "brand_b/Weekly_daily/feed_product_20200104.psv", "brand_a/monthly/feed_product_x.psv",
    ]
    out = arrivals.classify(spark.createDataFrame([(k,) for k in keys], "key string"))
    assert rows(out, "brand", "schedule", "place", "feed", "dt") == [
        ("brand_a", None, "remote", "product", None), ("brand_a", "daily", "remote", "transaction_item", 20200102),
        ("brand_b", "weekly", "remote", "product", 20200104), ("brand_b", "weekly", "remote", "tenders", 20200103),
    ]


def settled(spark, *dates):
    return spark.createDataFrame([(d,) for d in dates], "dt int")


def test_completeness(spark):
    def files(brand, schedule, dt, without=()):
        return [key(brand, schedule, f, dt) for f in POS_FEEDS if f not in without]

    keys = (
        files("brand_a", "daily", 20200101) + files("brand_a", "daily", 20200101)[:3]
        + files("brand_a", "daily", 20200102, ("tenders", "product"))
        + files("brand_a", "daily", 20200103) + files("brand_b", "weekly", 20200101)
        # a weekly dimension that did not come through the staging folder does not count
        + files("brand_a", "weekly", 20200101, ("product",)) + ["brand_a/weekly/Product/feed_product_20200101.psv.gz"]
    )
    routed = arrivals.route(frame(spark, notice(*keys)))
    dates = settled(spark, 20200101, 20200101, 20200102)
    assert rows(arrivals.ready(routed, dates)) == [("brand_a", "daily", 20200101), ("brand_b", "weekly", 20200101)]
    assert rows(arrivals.missing(routed, dates)) == [
        ("brand_a", "daily", 20200102, "tenders,product", True), ("brand_a", "daily", 20200103, "", False),
        ("brand_a", "weekly", 20200101, "product", True),
    ]


def test_pending(spark):
    arrived = spark.createDataFrame([("settlement", 1, "a"), ("settlement", 2, "b")], "feed string, dt int, key string")
    staged = spark.createDataFrame([("settlement", 1), ("settlement", 1)], "feed string, dt int")
    assert rows(arrivals.pending(arrived, staged), "key") == [("b",)]


@pytest.mark.parametrize("spec, days", [
    ("20200101", [20200101]), ("20200101,20200105", [20200101, 20200105]),
    ("20200130:20200202", [20200130, 20200131, 20200201, 20200202]),
    ("20191231:20200101", [20191231, 20200101]), ("20200102:20200101", []),
])
def test_select_dates(spark, spec, days):
    every = spark.sql("select cast(date_format(d, 'yyyyMMdd') as int) dt from "
                      "(select explode(sequence(date'2019-12-25', date'2020-02-10')) d)")
    assert [r[0] for r in rows(selection.select_dates(every, spec))] == days


def test_start_date_is_strict(spark):
    df = spark.createDataFrame([(20200909,), (20200910,), (20200911,)], "dt int")
    assert rows(selection.after_start(df, selection.SETTLEMENT_START)) == [(20200911,)]
    assert rows(selection.after_start(df, selection.NEVER)) == []


def test_files_of_a_feed(spark):
    names = ["p_product_20200101.gz", "p_product_category_20200101.gz", "p_product_20200102.gz"]
    files = spark.createDataFrame([(n,) for n in names], "name string")
    assert rows(selection.files_of(files, "p", "product", "20200101")) == [(names[0],)]
    assert rows(selection.files_of(files, "p", F.lit("product_category"), "2020")) == [(names[1],)]


def test_malformed(spark):
    keyless = json.dumps({"Records": [record("a"), {"eventTime": "t", "s3": {"bucket": {"name": "b"}, "object": {"size": 1}}}]})
    out = arrivals.malformed(frame(spark, notice("a"), notice(), envelope(notice("c"), keyless), keyless, "not json", "{}", None, notice("x")[:-4]))
    assert rows(out.groupBy("reason").agg(F.count("*").alias("n"), F.sum("lost").alias("lost"))) == [
        ("no records", 3, None), ("no text", 1, None), ("records without a key", 2, 2)
    ]
