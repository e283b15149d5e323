from __future__ import annotations

import glob
import gzip

import pytest
from conftest import rows
from pyspark.sql import functions as F
from shop import D1, D2, transaction

from retailgold.operators import gold
from retailgold.operators.typed import type_feeds
from retailgold.schemas import AUDIT_LAYOUT, DIMENSIONS
from retailgold.sinks import (
    archive_feed, carry_over_dimensions, gold_manifest, publish, published_files, read_audit, store, write_audit,
    write_gold,
)
from retailgold.sinks.gold_files import date_sizes, in_parts
from retailgold.sources import read_gold


@pytest.fixture(scope="module")
def built(feed, tmp_path_factory):
    rows_ = [transaction(str(i), dt=D1, Total='a"b|c' if i == 0 else None) for i in range(20)]
    rows_ += [transaction(str(i), dt=D2) for i in range(5)]
    table = gold.transactions(type_feeds({"transactions": feed("transactions", rows_, partitions=4)}))
    return store(table, str(tmp_path_factory.mktemp("built")))


def files(path, dt):
    return sorted(glob.glob(f"{path}/transactions/partition_col={dt}/*.csv.gz"))


def test_one_file_per_date_and_format(spark, built, tmp_path):
    write_gold(built, str(tmp_path), "transactions")
    assert len(files(tmp_path, D1)) == len(files(tmp_path, D2)) == 1
    with gzip.open(files(tmp_path, D1)[0], "rt") as f:
        head, *lines = f.read().splitlines()
    # dt stays inside the file too
    assert head == (
        "sourcetransactionnumber|SourceOrganizationNumber|Total|Currency|Discount|Tax|Type|TransactionTimeStamp|"
        "SourceCustomerNumber|DateCreated|CustomAttributes|PromoAmt|CouponAmt|POSDiscAmt|ManufacturerCouponAmt|"
        "registernumber|AccountNumberMasked|postransactionnumber|dt|check_id"
    )
    assert len(lines) == 20
    first = next(line for line in lines if line.startswith("0|"))
    assert '|"a""b|c"|USD||' in first and first.endswith("|07||55|20200102|0~55~07")


def test_readback_gives_the_same_rows(spark, built, tmp_path):
    write_gold(built, str(tmp_path), "transactions")
    back = read_gold(spark, str(tmp_path), "transactions")
    assert rows(back, *built.columns) == rows(built)


def test_large_date_is_split_and_whole(spark, built, tmp_path):
    # every row of the large date a copy of one row: still spread, nothing lost
    one = built.filter("dt = 20200102 and sourcetransactionnumber = '1'")
    copies = one.select("*", F.explode(F.array_repeat(F.lit(1), 200)).alias("n")).drop("n").unionByName(built)
    stored = store(copies.repartition(5), str(tmp_path / "built"))
    write_gold(stored, str(tmp_path), "transactions", rows_per_file=25)
    back = read_gold(spark, str(tmp_path), "transactions")
    assert rows(back, *stored.columns) == rows(stored)
    sizes = back.filter(F.col("dt") == D1).groupBy(F.col("_metadata.file_name").alias("f")).count()
    assert sorted(r[0] for r in rows(sizes, "count")) == [20, *[25] * 8]
    listed = published_files(spark, str(tmp_path), "transactions", schedule="daily", as_of="20200110")
    names = {dt: [r[0] for r in rows(listed.filter(F.col("dt") == dt), "file_name")] for dt in (D1, D2)}
    # one scheme of names, whatever a date's size
    assert names[D2] == ["transactions_20200102_20200103_daily_p0001.psv.gz"]
    assert names[D1] == [f"transactions_20200101_20200102_daily_p{i:04d}.psv.gz" for i in range(1, 10)]


def test_small_files_share_a_task(spark, built, tmp_path):
    """As many tasks as the rows need, however many files they become, also when these are read."""
    copies = built.select("*", F.explode(F.array_repeat(F.lit(1), 40)).alias("n")).drop("n")
    stored = store(copies, str(tmp_path / "built"))
    sizes = date_sizes(stored)
    assert in_parts(stored, 10, sizes, 1_000).rdd.getNumPartitions() == len(sizes) == 2
    write_gold(stored, str(tmp_path), "transactions", rows_per_file=10)
    names = [f.rsplit("/", 1)[-1] for f in files(tmp_path, D1)]
    assert len(names) == sizes[D1] // 10 and len({n.split("-")[2] for n in names}) == 1
    assert rows(read_gold(spark, str(tmp_path), "transactions"), *stored.columns) == rows(stored)


def test_emptied_dates_go(spark, built, tmp_path):
    publish(built, str(tmp_path), "transactions")
    only = store(built.filter(F.col("dt") == D1), str(tmp_path / "again"))
    publish(only, str(tmp_path), "transactions", emptied=lambda dt: dt == D2)
    assert not files(tmp_path, D2) and len(files(tmp_path, D1)) == 1


def test_rerun_replaces_its_dates_only(spark, built, tmp_path):
    path = str(tmp_path)
    publish(built, path, "transactions")
    kept = files(tmp_path, D2)
    again = store(built.filter(F.col("dt") == D1).withColumn("Currency", F.lit("EUR")), str(tmp_path / "again"))
    for _ in range(2):
        publish(again, path, "transactions")
    assert files(tmp_path, D2) == kept and len(files(tmp_path, D1)) == 1
    counted = read_gold(spark, path, "transactions").groupBy("dt", "Currency").count()
    assert rows(counted) == [(D1, "EUR", 20), (D2, "USD", 5)]


@pytest.mark.parametrize("table, schedule, dt, name", [
    ("transactions", "daily", 20200301, "transactions_20200229_20200301_daily.psv.gz"),
    ("transaction_item", "daily", 20200101, "line_item_20191231_20200101_daily.psv.gz"),
    ("transaction_item", "weekly", 20200101, "line_item_20210101_20200101_weekly.psv.gz"),
])
def test_published_names(spark, table, schedule, dt, name):
    df = spark.createDataFrame([(dt,), (dt,)], "partition_col int")
    out = gold_manifest(df, table, schedule=schedule, as_of="20201231")
    assert rows(out) == [(table, dt, name)]
    assert gold_manifest(df, table, schedule=schedule, as_of="20201231", prefix="x_").first().file_name == "x_" + name


def test_audit_log_appends(spark, tmp_path):
    one = spark.createDataFrame([("b", "gold_run", "pos", "2020-01-02", "t", 1, 2, "s", "d", None, None, "SUCCESS", "{}")],
                                AUDIT_LAYOUT)
    for _ in range(2):
        write_audit(one, str(tmp_path / "log"))
    assert read_audit(spark, str(tmp_path / "log")).count() == 2
    with open(glob.glob(f"{tmp_path}/log/part-*")[0]) as f:
        assert f.read().startswith("b\u0001gold_run\u0001pos\u0001")


def test_archive_replaces_dates(spark, feed, tmp_path):
    path = str(tmp_path)
    archive_feed(feed("transactions", [transaction("1"), transaction("2", dt=D2)]), path, "transactions")
    out = archive_feed(feed("transactions", [transaction("9")]), path, "transactions")
    assert rows(out, "SourceTransactionNumber", "dt") == [("2", D2), ("9", D1)]


def test_settlement_archive_keeps_other_files_of_a_day(spark, feed, tmp_path):
    from shop import paid

    def landed(file_dt, *stamps):
        return feed("settlement", [paid(when=s) for s in stamps]).withColumn("file_dt", F.lit(file_dt))

    path = str(tmp_path)
    archive_feed(landed(D1, "01/02/2020 10:00"), path, "settlement")
    # the next file brings a late row of the day before
    archive_feed(landed(D2, "01/02/2020 11:00", "1/3/2020 10:00"), path, "settlement")
    out = archive_feed(landed(D2, "01/02/2020 11:00", "1/3/2020 10:00"), path, "settlement")
    out = out.select(F.col("settlement_day").cast("string").alias("d"), "file_dt")
    assert rows(out) == [("2020-01-02", D1), ("2020-01-02", D2), ("2020-01-03", D2)]


def test_carry_over(spark, feed, tmp_path):
    feeds = {
        "product": feed("product", [dict(SourceProductNumber="1", dt=D1)]),
        "product_category": feed("product_category", [dict(SourceCategoryNumber="1", dt=D1)]),
        "organization": feed("organization", [dict(SourceOrganizationNumberkey="1", dt=D1)]),
        "transactions": feed("transactions", [transaction()]),
    }
    staged = carry_over_dimensions(feeds, str(tmp_path))
    assert sorted(p.rsplit("/", 1)[1] for p in glob.glob(f"{tmp_path}/*")) == sorted(DIMENSIONS)
    assert rows(staged["product"], "SourceProductNumber", "dt") == [("1", D1)]


def test_emptied_date_goes_from_the_archive(spark, feed, tmp_path):
    path = str(tmp_path)
    archive_feed(feed("transactions", [transaction("1"), transaction("2", dt=D2)]), path, "transactions")
    out = archive_feed(feed("transactions", [transaction("9")]), path, "transactions", lambda dt: dt == D2)
    assert rows(out, "SourceTransactionNumber", "dt") == [("9", D1)]
