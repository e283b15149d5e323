from __future__ import annotations

import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F
from shop import D1, D2, good_feeds, transaction

from retailgold.operators import gold
from retailgold.operators.selection import in_date_spec
from retailgold.operators.typed import type_feeds
from retailgold.sinks import attach_bucketed, stage_bucketed


@pytest.fixture
def name():
    return "b" + uuid.uuid4().hex[:8]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_joins_without_a_shuffle(spark, feed, name, tmp_path):
    typed = type_feeds(good_feeds(feed))
    staged = stage_bucketed(typed, str(tmp_path), name, 3)
    for build in (gold.line_item, gold.tender_transactions):
        assert "Exchange" in plan(build(typed)) and "Exchange" not in plan(build(staged))
        assert rows(build(staged)) == rows(build(typed))
    # dates are still pruned, and what follows is shuffled by its own keys only
    days = {n: df.filter(in_date_spec(str(D1))) for n, df in staged.items() if "dt" in df.columns}
    text = plan(gold.line_item(days))
    assert "Exchange" not in text and "SelectedBucketsCount: 3 out of 3" in text and "20200102" in text
    before, after = (plan(gold.discounts(f)).count("Exchange hashpartitioning(") for f in (typed, staged))
    assert after == before - 2 and rows(gold.discounts(staged)) == rows(gold.discounts(typed))


def test_dates_replace_themselves_and_columns_are_added(spark, feed, name, tmp_path):
    def staged(*rows_, **more):
        df = type_feeds({"transactions": feed("transactions", list(rows_))})["transactions"].withColumns(more)
        return stage_bucketed({"transactions": df}, str(tmp_path), name, 2)["transactions"]

    staged(transaction("1"), transaction("2", dt=D2))
    out = staged(transaction("9"), brand_new=F.lit("n"))
    assert rows(out, "sourcetransactionnumber", "brand_new", "dt") == [("2", None, D2), ("9", "n", D1)]
    # a column that does not come again, and a session that has not seen the table
    staged(transaction("7"))
    spark.sql(f"DROP TABLE {name}_transactions")
    again = attach_bucketed(spark, str(tmp_path), f"{name}x", "transactions")
    assert rows(again, "sourcetransactionnumber", "brand_new", "dt") == [("2", None, D2), ("7", None, D1)]
