from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from conftest import rows
from shop import D1, D2
from test_arrivals import key, record

from retailgold.operators import arrivals
from retailgold.schemas import POS_FEEDS
from retailgold.streaming import read_date_states, read_notifications, stream_date_states

DAY = timedelta(days=1)


@pytest.fixture
def watch(spark, tmp_path):
    """Lands files of (key, time) and lets the stream go on from where it stopped."""
    (tmp_path / "in").mkdir()

    def go(name, *notices):
        text = "".join(json.dumps({"Records": [record(k, t)]}) + "\n" for k, t in notices)
        (tmp_path / "in" / name).write_text(text)
        source = read_notifications(spark, f"{tmp_path}/in", 1)
        stream_date_states(source, f"{tmp_path}/out", f"{tmp_path}/check", DAY, "1 hour").awaitTermination()
        return rows(read_date_states(spark, f"{tmp_path}/out"), "brand", "schedule", "dt", "state", "missing", "has_settlement", "due")

    return go


def files(dt, time, feeds=POS_FEEDS, brand="brand_a", schedule="daily"):
    return [(key(brand, schedule, f, dt), time) for f in feeds]


def settled(dt, time):
    return (f"settlement/SETTLE_1_{dt}.csv", time)


def test_dates_become_ready_or_overdue(watch):
    first, second = POS_FEEDS[:5], POS_FEEDS[5:]
    assert watch("1", *files(D1, "2020-01-02T10:00:00", first), *files(D2, "2020-01-02T12:00:00", first), settled(D2, "2020-01-02T12:00:00")) == []
    ready = ("brand_a", "daily", D2, "ready", "", True, datetime(2020, 1, 3, 12))
    assert watch("2", *files(D2, "2020-01-02T18:00:00", second)) == [ready]
    # eleven hours after the first file's day, less the hour that event time runs behind
    late = ("brand_a", "daily", D1, "overdue", ",".join(second), False, datetime(2020, 1, 3, 10))
    assert watch("3", ("brand_a/other", "2020-01-03T22:00:00"), settled(20200109, "2020-01-03T22:00:00")) == sorted([ready, late])
    # an overdue date may still become ready, and is not reported as overdue again
    after = watch("4", *files(D1, "2020-01-03T23:00:00", second), settled(D1, "2020-01-03T23:00:00"))
    assert after == sorted([ready, late, (*late[:3], "ready", "", True, late[6])])
    assert watch("5", settled(20200110, "2020-02-01T00:00:00")) == after


def test_brands_and_schedules_are_apart_and_settlement_is_for_all(watch):
    t = "2020-01-02T10:00:00"
    both = files(D1, t) + files(D1, t, brand="brand_b") + files(D1, t, POS_FEEDS[:1], schedule="weekly")
    assert watch("1", *both) == []
    got = watch("2", settled(D1, t))
    assert [r[:4] for r in got] == [("brand_a", "daily", D1, "ready"), ("brand_b", "daily", D1, "ready")]
    got = watch("3", settled(D2, "2020-03-01T00:00:00"))
    assert [r[:3] for r in got if r[3] == "overdue"] == [("brand_a", "weekly", D1)]
    # a date that is complete and gets another file is listed again
    assert [r[:4] for r in watch("4", *files(D2, "2020-03-01T00:00:00"), *files(D2, "2020-03-01T00:00:00"))].count(("brand_a", "daily", D2, "ready")) == 1


def test_the_earliest_file_counts_and_unreadable_times_are_left_out(watch):
    one, two = POS_FEEDS[:1], POS_FEEDS[1:2]
    watch("1", *files(D1, "2020-01-02T10:30:00", one), *files(D1, "2020-01-02T10:00:00", two), *files(D2, "no time", one), *files(D2, None, two))
    got = watch("2", settled(D2, "2020-01-05T00:00:00"))
    assert [(r[2], r[3], r[6]) for r in got] == [(D1, "overdue", datetime(2020, 1, 3, 10))]
    assert got[0][4] == ",".join(POS_FEEDS[2:])


def test_overdue_at_the_end_is_what_a_batch_calls_missing(watch, spark, tmp_path):
    t = "2020-01-02T10:00:00"
    watch("1", *files(D1, t), *files(D2, t, POS_FEEDS[2:]), *files(D2, t, brand="brand_b"), settled(D2, t), ("other/x", t))
    got = watch("2", settled(20200109, "2020-03-01T00:00:00"))
    batch = arrivals.missing(arrivals.route(spark.read.text(f"{tmp_path}/in")))
    assert [(*r[:3], *r[4:6]) for r in got if r[3] == "overdue"] == rows(batch, "brand", "schedule", "dt", "missing", "has_settlement")
