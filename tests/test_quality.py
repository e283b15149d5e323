from __future__ import annotations

import json

import pytest
from conftest import rows
from pyspark.sql import functions as F
from shop import D1, D2

from retailgold.operators import quality
from retailgold.schemas import AUDIT_LAYOUT


def verdict(spark, table, gold_rows, staging, columns="check_id string, transactiontimestamp string, customer_name string"):
    gold = spark.createDataFrame(gold_rows, columns).withColumn("dt", F.lit(D1))
    measured = quality.table_metrics(table, gold, spark.range(staging).withColumn("dt", F.lit(D1)))
    row = quality.evaluate(measured).first()
    return row.event_result, row.reason


FULL = ("1~2~3", "t", "Ann")


@pytest.mark.parametrize("table, gold_rows, staging, result, reason", [
    ("transactions", [FULL], 1, "SUCCESS", ""),
    ("transactions", [FULL], 2, "FAILURE", "row count 1 differs from staging row count 2"),
    ("transactions", [FULL, FULL], 1, "FAILURE", "row count 2 differs from staging row count 1"),
    ("transactions", [("", "t", None)], 1, "FAILURE", "1 rows without check_id"),
    ("transaction_item", [(None, "t", None)], 1, "FAILURE", "1 rows without check_id"),
    ("transaction_item", [("1", "", None)], 1, "FAILURE", "1 rows without transactiontimestamp"),
    ("transactions", [("1", None, None)], 1, "SUCCESS", ""),
    ("discounts", [(None, None, None)], 1, "FAILURE", "1 rows without check_id"),
    ("product", [(None, None, None)], 1, "SUCCESS", ""),
    ("product", [], 0, "FAILURE", "zero rows"),
    ("tenders", [], 0, "FAILURE", "zero rows"),
    ("tenders", [FULL], 1, "SUCCESS", ""),
    ("tenders", [FULL], 2, "WARNING", "row count 1 differs from staging row count 2"),
    ("tenders", [(None, "t", "Ann")], 1, "WARNING", "1 rows without check_id"),
    # NULL is a name too: 2 of 10 is exactly the limit, which is not enough; 3 of 10 is
    ("tenders", [FULL] * 5 + [("1", "t", None)] * 5, 10, "WARNING", "too few customer names"),
    ("tenders", [FULL] * 5 + [("1", "t", None)] * 4 + [("1", "t", "Bob")], 10, "SUCCESS", ""),
])
def test_verdicts(spark, table, gold_rows, staging, result, reason):
    assert verdict(spark, table, gold_rows, staging) == (result, reason)


def test_all_tables_in_one_job(spark):
    gold = spark.createDataFrame([(*FULL, D1)], "check_id string, transactiontimestamp string, customer_name string, dt int")
    sides = [s for t in ("transactions", "tenders") for s in (quality.gold_side(t, gold), quality.staging_side(t, gold))]
    measured = quality.metrics(sides)
    assert rows(measured, "entity_type", "source_count", "destination_count", "distinct_names") == [
        ("tenders", 1, 1, 1), ("transactions", 1, 1, 0)
    ]
    assert "Cartesian" not in measured._jdf.queryExecution().executedPlan().toString()


def test_counts_by_date(spark):
    gold = spark.createDataFrame([(D1,), (D1,)], "dt int")
    staging = spark.createDataFrame([(D1,), (D2,)], "dt int")
    assert rows(quality.counts_by_date(gold, staging)) == [(D1, 2, 1, 1), (D2, 0, 1, -1)]


def test_distinct_with_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), (None,), ("",)], "c string")
    assert df.agg(quality.distinct_with_null("c")).first()[0] == df.distinct().count() == 3
    assert df.limit(0).agg(quality.distinct_with_null("c")).first()[0] == 0


def test_audit_row(spark):
    gold = spark.createDataFrame([(*FULL, D1)], "check_id string, transactiontimestamp string, customer_name string, dt int")
    evaluated = quality.evaluate(quality.table_metrics("transactions", gold, spark.range(2).withColumn("dt", F.lit(D1))))
    out = quality.audit_rows(
        evaluated, brand="brand_a", ingestion_date="2020-01-02", source="in", destination="out",
        start=F.lit("2020-01-02 00:00:00"), end=F.lit("2020-01-02 00:01:00"), notes={"SCHEDULE": "daily"},
    )
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in AUDIT_LAYOUT]
    row = out.first()
    assert row[:9] == ("brand_a", "gold_run", "pos", "2020-01-02", "transactions", 2, 1, "in", "out")
    assert json.loads(row.EVENT_NOTES) == {
        "SOURCE_TYPE": "table", "DESTINATION_TYPE": "file", "SCHEDULE": "daily",
        "FAILURE_REASON": "row count 1 differs from staging row count 2",
    }


def test_dates_are_compared_one_by_one(spark):
    gold = spark.createDataFrame([("1", D1), ("2", D1)], "check_id string, dt int")
    staging = spark.createDataFrame([(D1,), (D2,)], "dt int")
    row = quality.evaluate(quality.table_metrics("transactions", gold, staging)).first()
    assert (row.source_count, row.destination_count, row.dates_differing, row.event_result) == (2, 2, 2, "FAILURE")
    assert row.reason == "row counts of 2 dates differ from staging"


def test_a_long_reason_is_kept(spark):
    evaluated = spark.createDataFrame(
        [("t", 1, None, None, None, None, None, None, "x" * 150_000, "FAILURE")], quality.CHECKED_LAYOUT
    )
    out = quality.audit_rows(
        evaluated, brand="b", ingestion_date="d", source="s", destination="d", start=F.lit("2020-01-02 00:00:00"),
        end=F.lit("2020-01-02 00:00:00"), event_type="other",
    ).first()
    assert len(json.loads(out.EVENT_NOTES)["FAILURE_REASON"]) == 150_000 and out.EVENT_TYPE == "other"


def test_contents_by_date(spark):
    """One date has a row lost and another doubled, one has a changed value, one has its rows in another order."""
    layout = "dt int, id string, v string, extra string"
    staging = [(1, "a", "x", None), (1, "b", None, None), (1, "c", "z", None), (2, "a", "x", None), (3, "a", "x", None), (3, "b", "", None)]
    made = [(1, "a", "x", "g"), (1, "a", "x", "g"), (1, "b", None, "g"), (2, "a", "y", "g"), (3, "b", "", "h"), (3, "a", "x", "g"), (4, "n", "n", "g")]
    staging, made = spark.createDataFrame(staging, layout).drop("extra"), spark.createDataFrame(made, layout)
    assert rows(quality.contents_by_date(made, staging)) == [(1, 3, 3, False), (2, 1, 1, False), (3, 2, 2, True), (4, 1, 0, False)]
    assert rows(quality.counts_by_date(made, staging), "dt", "difference") == [(1, 0), (2, 0), (3, 0), (4, 1)]
    assert rows(quality.differing_rows(made, staging, ["id"])) == [(1, "a", 2, 1), (1, "c", 0, 1), (2, "a", 0, 1), (2, "a", 1, 0), (4, "n", 1, 0)]
    # NULL and empty are different rows
    other = staging.withColumn("v", F.nullif("v", F.lit("")))
    assert rows(quality.contents_by_date(other, staging), "dt", "same") == [(1, True), (2, True), (3, False)]


def test_differing_rows_shuffles_few_rows(spark):
    """Of a date that differs only the groups of rows that do are compared, NULL dates and repeated rows too."""
    staging = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, 1).alias("dt"), (F.col("id") % 5_000).alias("id"), F.lit("x").alias("v"))
    made = staging.where("id <> 77").unionByName(staging.where("id = 8"))
    found = quality.differing_rows(made, staging, ["id"])
    assert rows(found) == [(None, 77, 0, 4), (1, 8, 8, 4)]
    groups = quality._differing_groups(made, staging, ["dt", "id", "v"]).collect()
    assert sorted(len(r["_groups"]) for r in groups) == [1, 1]
    assert "array_contains" in found._jdf.queryExecution().executedPlan().toString()


def test_failing_dates(spark):
    measured = spark.createDataFrame([
        ("transactions", 1, 3, 3, 0, 0, 0), ("transactions", 2, 3, 2, 0, 0, 0), ("transactions", 3, 2, 2, 1, 0, 0), ("tenders", 1, 3, 4, 0, 0, 0),
        ("tenders", 2, 3, 0, 0, 0, 0), ("tenders", None, 0, 0, 0, 0, 9),
    ], quality.DATED_LAYOUT)
    assert rows(quality.failing_dates(measured), "entity_type", "dt") == [("tenders", 2), ("transactions", 2), ("transactions", 3)]
