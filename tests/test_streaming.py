from __future__ import annotations

import pytest
from conftest import rows
from pyspark.sql import functions as F
from shop import D1, D2, good_feeds
from test_arrivals import key, notice

from retailgold.operators import arrivals
from retailgold.plans import GateFailure
from retailgold.schemas import POS_FEEDS
from retailgold.sources import read_gold
from retailgold.streaming import (
    read_notifications, read_ready, read_rejected, stream_arrivals, stream_completeness, stream_gold,
)
from retailgold.streaming.arrivals import update_ledger
from retailgold.streaming.gold import _rejected


@pytest.fixture
def landing(tmp_path):
    (tmp_path / "in").mkdir()

    def land(name, *keys):
        (tmp_path / "in" / name).write_text("".join(notice(k) + "\n" for k in keys))

    return land


def settlement(*dates):
    return [f"settlement/SETTLE_1_{d}.csv" for d in dates]


def files(dt, feeds=POS_FEEDS, brand="brand_a"):
    return [key(brand, "daily", f, dt) for f in feeds]


def test_stream_equals_batch_and_restarts(spark, landing, tmp_path):
    source = f"{tmp_path}/in"
    landing("1", *files(D1, POS_FEEDS[:5]), *settlement(D1, D2), "other/x")
    landing("2", *files(D1, POS_FEEDS[3:]), *files(D2, POS_FEEDS[:7]))

    def go():
        notes = read_notifications(spark, source, 1)
        stream_arrivals(notes, f"{tmp_path}/arrived", f"{tmp_path}/c1").awaitTermination()
        stream_completeness(
            notes, f"{tmp_path}/ledger", f"{tmp_path}/ready", f"{tmp_path}/c2"
        ).awaitTermination()
        return rows(read_ready(spark, f"{tmp_path}/ready"), "brand", "schedule", "dt", "batch_id")

    assert go() == [("brand_a", "daily", D1, 1)]
    # a restart takes up after the second batch
    landing("3", *files(D2, POS_FEEDS[7:]))
    assert go() == [("brand_a", "daily", D1, 1), ("brand_a", "daily", D2, 2)]
    batch = arrivals.route(spark.read.text(source))
    assert rows(spark.read.parquet(f"{tmp_path}/arrived"), *batch.columns) == rows(batch)
    assert len(rows(arrivals.ready(batch))) == 2


def test_replayed_batch_replaces_itself(spark, tmp_path):
    ledger = f"{tmp_path}/ledger"

    def batch(number, *keys):
        df = spark.createDataFrame([(notice(*keys),)], "value string")
        return rows(update_ledger(df, number, ledger, arrivals.Routes()))

    first, last = files(D1, POS_FEEDS[:5]) + settlement(D1), files(D1, POS_FEEDS[5:])
    assert batch(0, *first) == []
    assert batch(1, *last) == [("brand_a", "daily", D1)]
    # replaying batch 0 must not see batch 1; replaying batch 1 finds the date again
    assert batch(0, *first) == []
    assert batch(1, *last) == [("brand_a", "daily", D1)]
    assert spark.read.parquet(ledger).count() == len(POS_FEEDS) + 1
    assert batch(2, "other/x") == []


def test_incremental_gold(spark, feed, landing, tmp_path):
    raw = good_feeds(feed)
    landing("1", *files(D1, POS_FEEDS[:5]), *settlement(D1, D2))
    landing("2", *files(D1, POS_FEEDS[5:]), *files(D2, POS_FEEDS[:5]))

    def go():
        stream_gold(
            read_notifications(spark, f"{tmp_path}/in", 1), lambda brand, schedule: raw,
            ledger=f"{tmp_path}/ledger", out=f"{tmp_path}/gold", rejected=f"{tmp_path}/rejected", audit_path=f"{tmp_path}/audit",
            checkpoint=f"{tmp_path}/c", tables=("transactions", "transaction_item"),
        ).awaitTermination()
        items = read_gold(spark, f"{tmp_path}/gold/brand_a/daily", "transaction_item")
        return rows(items, "sourcetransactionitemnumber", "check_id")

    assert go() == [("1-1", "1~55~07"), ("2-1", "2~55~07")]
    landing("3", *files(D2, POS_FEEDS[5:]))
    assert go() == [("1-1", "1~55~07"), ("2-1", "2~55~07"), ("3-1", "3~55~07")]


def test_settlement_that_comes_last_makes_its_date_ready(spark, landing, tmp_path):
    def go():
        stream_completeness(
            read_notifications(spark, f"{tmp_path}/in", 1), f"{tmp_path}/ledger", f"{tmp_path}/ready", f"{tmp_path}/c"
        ).awaitTermination()
        return rows(read_ready(spark, f"{tmp_path}/ready"), "dt")

    landing("1", *files(D1), *files(99999999), *files(20200230))
    assert go() == []
    landing("2", *settlement(D1, 99999999))
    assert go() == [(D1,)]


def test_a_bad_date_is_rejected_and_the_stream_goes_on(spark, feed, landing, tmp_path):
    raw = good_feeds(feed)
    bad = dict(raw, transaction_item=raw["transaction_item"].filter(f"dt = {D1}").unionByName(
        raw["transaction_item"].filter(f"dt = {D2}").withColumn("sourcetransactionnumber", F.lit("lost"))
    ))

    def go(feeds):
        stream_gold(
            read_notifications(spark, f"{tmp_path}/in", 1), lambda brand, schedule: feeds, ledger=f"{tmp_path}/ledger",
            out=f"{tmp_path}/gold", rejected=f"{tmp_path}/rejected", audit_path=f"{tmp_path}/audit", checkpoint=f"{tmp_path}/c",
            tables=("transactions", "transaction_item"),
        ).awaitTermination()
        return (
            rows(read_gold(spark, f"{tmp_path}/gold/brand_a/daily", "transaction_item"), "sourcetransactionitemnumber"),
            rows(read_rejected(spark, f"{tmp_path}/rejected"), "dt", "entity_type", "batch_id"),
        )

    landing("1", *files(D1), *files(D2), *settlement(D1, D2))
    assert go(bad) == ([("1-1",), ("2-1",)], [(D2, "transaction_item", 0)])
    # the next batch and a restart go on; a file that comes again has its date run again
    landing("2", key("brand_a", "daily", "transaction_item", D2))
    assert go(raw) == ([("1-1",), ("2-1",), ("3-1",)], [(D2, "transaction_item", 0)])


def test_one_build_for_many_dates_with_a_bad_one(spark, feed, landing, tmp_path, monkeypatch):
    """The bad date is left out of all tables by the run that finds it; it keeps the gold it has."""
    from retailgold.streaming import gold as streaming_gold

    raw, runs = good_feeds(feed), []
    real = streaming_gold.run
    monkeypatch.setattr(streaming_gold, "run", lambda *a, **o: (runs.append(o["dates"]), real(*a, **o))[1])
    landing("1", *files(D1), *files(D2), *settlement(D1, D2))

    def go(feeds):
        stream_gold(
            read_notifications(spark, f"{tmp_path}/in", 1), lambda brand, schedule: feeds, ledger=f"{tmp_path}/ledger",
            out=f"{tmp_path}/gold", rejected=f"{tmp_path}/rejected", audit_path=f"{tmp_path}/audit", checkpoint=f"{tmp_path}/c",
            tables=("transactions", "transaction_item", "tenders"),
        ).awaitTermination()
        base = f"{tmp_path}/gold/brand_a/daily"
        return [rows(read_gold(spark, base, t).groupBy("dt", *more).count()) for t, *more in (("transactions", "Currency"), ("transaction_item",), ("tenders",))]

    assert go(raw) == [[(D1, "USD", 2), (D2, "USD", 1)], [(D1, 2), (D2, 1)], [(D1, 2), (D2, 1)]]
    bad = dict(raw, transactions=raw["transactions"].withColumn("Currency", F.lit("EUR")), transaction_item=raw["transaction_item"].withColumn(
        "sourcetransactionnumber", F.when(F.col("dt") == D1, F.col("sourcetransactionnumber"))))
    landing("2", key("brand_a", "daily", "transaction_item", D1), key("brand_a", "daily", "transaction_item", D2))
    assert go(bad) == [[(D1, "EUR", 2), (D2, "USD", 1)], [(D1, 2), (D2, 1)], [(D1, 2), (D2, 1)]]
    assert runs == [f"{D1},{D2}"] * 2
    assert rows(read_rejected(spark, f"{tmp_path}/rejected"), "dt", "entity_type") == [(D2, "transaction_item")]


def test_dates_whose_rows_cannot_be_computed_are_halved():
    tried = []

    def publish(dates):
        tried.append(dates)
        if 5 in dates:
            raise GateFailure("tenders", "boom", [])
        return []

    assert [(r.dt, r.table, r.reason) for r in _rejected(publish, list(range(8)))] == [(5, "tenders", "boom")]
    assert len(tried) == 7
