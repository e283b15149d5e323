"""Plans that have to hold at any size: pruning, no cross joins, no single-task shuffles, whole-stage code."""

from __future__ import annotations

import os
import re

import pytest
from pyspark.sql import functions as F
from shop import D1, good_feeds, paid

from retailgold.bind import queries, star
from retailgold.operators import arrivals, gold, quality
from retailgold.operators.typed import type_feeds
from retailgold.plans import stage_feeds
from retailgold.plans.gold_run import _prune_settlement
from retailgold.schemas import GOLD_TABLES
from retailgold.sinks import store
from retailgold.sinks.gold_files import date_sizes, in_parts

SF = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def explain(df):
    """The plan with full lists of columns and filters."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def staged(feed, tmp_path_factory):
    raw = good_feeds(feed)
    raw["settlement"] = raw["settlement"].withColumn("file_dt", F.lit(D1))
    return type_feeds(stage_feeds(raw, str(tmp_path_factory.mktemp("archive"))))


def test_no_cross_join_no_python_no_single_partition(spark, staged):
    for table in GOLD_TABLES:
        text = plan(gold.BUILDERS[table](staged))
        for bad in ("Cartesian", "NestedLoop", "SinglePartition", "BatchEvalPython", "ArrowEvalPython", "Window"):
            assert bad not in text, (table, bad)


def test_growing_feeds_join_by_sort_merge_and_dimensions_by_broadcast(spark, staged):
    assert "SortMergeJoin" in plan(gold.line_item(staged)) and "Broadcast" not in plan(gold.line_item(staged))
    text = plan(gold.tenders(staged))
    assert text.count("SortMergeJoin") == 2 and "Broadcast" not in text
    assert "BroadcastHashJoin" in plan(gold.product(staged))
    text = plan(gold.discounts(staged))
    assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 2


def test_stored_line_items_save_a_join(spark, staged, tmp_path):
    gold.line_item(staged).write.parquet(f"{tmp_path}/built")
    built = spark.read.parquet(f"{tmp_path}/built")
    assert plan(gold.discounts(staged, line_items=built)).count("SortMergeJoin") == 1


def test_only_needed_columns_are_read(spark, staged):
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", explain(gold.line_item(staged)))
    transactions = next(s for s in schemas if "TransactionTimeStamp" in s)
    assert transactions.count(":") == 6  # of 18, and dt comes from the folder
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", explain(quality.gold_side("product", staged["product"])))
    assert all(s == "" for s in schemas)


def test_dates_prune_partitions_through_the_joins(spark, staged):
    dated = {n: df if n == "settlement" else df.filter(F.col("dt") == D1) for n, df in staged.items()}
    for table in ("transaction_item", "discounts", "tenders"):
        text = explain(gold.BUILDERS[table](dated))
        scans = text.count("PartitionFilters: [isnotnull(dt")
        assert scans == {"transaction_item": 2, "discounts": 4, "tenders": 2}[table]


def test_settlement_days_pick_partitions(spark, staged):
    text = explain(gold.settlement_summary(_prune_settlement(staged)["settlement"]))
    found = re.search(r"PartitionFilters: \[(.*)\]", text)[1]
    assert "settlement_month" in found and "dynamicpruning" in found
    assert re.search(r"DataFilters: .*settlement_day#\d+ >= .*[Ss]ubquery", plan(_prune_settlement(staged)["settlement"]))


def test_settlement_is_combined_before_its_shuffle(spark, staged):
    text = plan(gold.settlement_summary(staged["settlement"]))
    assert "partial_min(customer_name" in text


def test_a_part_is_a_task(spark, staged, tmp_path):
    stored = store(gold.organization(staged), str(tmp_path))
    parts = in_parts(stored, 10, date_sizes(stored))
    assert "NestedLoop" not in plan(parts) and "Cartesian" not in plan(parts)
    assert parts.rdd.getNumPartitions() == sum(-(-n // 10) for n in date_sizes(stored).values())


def test_checks_are_one_row_per_side(spark, staged):
    sides = [quality.gold_side(t, staged[t]) for t in ("organization", "product")]
    text = plan(quality.metrics(sides + [quality.staging_side(t, staged[t]) for t in ("organization", "product")]))
    assert "Join" not in text


@needs_tables
def test_arrivals_are_flags_in_generated_code(spark):
    text = plan(arrivals.ready(arrivals.route(star.notifications(spark, SF)), star.settlement_dates(spark, SF)))
    assert "HashAggregate" in text and "ObjectHashAggregate" not in text and "SortAggregate" not in text


@needs_tables
def test_binding_reads_its_tables_whole(spark):
    text = plan(gold.line_item(star.feeds(spark, SF, "transactions", "transaction_item")))
    assert "GlobalLimit" not in text and "LocalLimit" not in text


@needs_tables
def test_lines_are_shuffled_once(spark, conf):
    """The window that numbers copies and the join to the orders share the lines' shuffle; the orders have the other one."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    assert plan(star.transaction_item(spark, SF)).count("Exchange hashpartitioning") == 2


@needs_tables
def test_feeds_of_lines_share_stored_lines(spark, conf):
    """Feeds that are made of the order lines, or read again, deal, number and join these once."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    made = star.raw_feeds(spark, SF, "transaction_item", "trans_disc_xref")
    assert all("Exchange" not in plan(df) and "Window" not in plan(df) for df in made.values())
    again = star.raw_feeds(spark, SF, "transaction_item", again=True)["transaction_item"]
    assert "Exchange" not in plan(again)
    assert again.exceptAll(star.transaction_item(spark, SF)).isEmpty() and star.transaction_item(spark, SF).exceptAll(again).isEmpty()


@needs_tables
def test_joins_sort_by_the_key_that_tells_rows_apart(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    feeds = star.feeds(spark, SF, "transactions", "transaction_item")
    assert re.search(r"SortMergeJoin \[sourcetransactionnumber", plan(gold.line_item(feeds)))
    feeds = star.feeds(spark, SF, "transaction_item", "trans_disc_xref")
    assert re.search(r"SortMergeJoin \[SourceTransactionItemNumber", plan(gold.xref_items(feeds)))


@needs_tables
def test_metrics_build_tenders_once(spark):
    """Rows and names of the tenders are counted from stored rows; neither reads the settlement again."""
    text = explain(queries._all_metrics(spark, SF))
    assert "c_name" not in text and "customer_name" in text


def test_settlement_of_other_days_is_not_read(spark, feed, tmp_path):
    """The days of the tenders are found while the query runs: no job before it, other months' files and other days' row groups stay unread."""
    raw = good_feeds(feed)
    other = [("06/03/2021 11:00:00", 20210603), ("01/20/2020 11:00:00", 20200120)]
    raw["settlement"] = raw["settlement"].withColumn("file_dt", F.lit(D1))
    for when, file_dt in other:
        raw["settlement"] = raw["settlement"].unionByName(feed("settlement", [paid(when=when)]).withColumn("file_dt", F.lit(file_dt)))
    staged = type_feeds(stage_feeds(raw, f"{tmp_path}/archive"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pruning", "")
    try:
        kept = _prune_settlement(staged)["settlement"]
        assert not tracker.getJobIdsForGroup("pruning")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "dynamicpruning" in explain(kept)
    # what came out of the scan of the archive, by its metrics
    run = kept._jdf.queryExecution()
    assert len(run.executedPlan().executeCollect()) == 2
    scans = [leaf for leaf in _leaves(run.executedPlan()) if "settlement_day" in leaf.toString() and "FileScan" in leaf.toString()]
    assert [scan.metrics().apply("numOutputRows").value() for scan in scans] == [2]
    assert [scan.metrics().apply("numPartitions").value() for scan in scans] == [2]
    text = plan(gold.tenders({**staged, "settlement": kept}))
    for bad in ("Cartesian", "NestedLoop", "SinglePartition"):
        assert bad not in text


def _leaves(node):
    """The leaves of a plan that has run, those of its adaptive stages too."""
    if hasattr(node, "executedPlan") and "AdaptiveSparkPlan" in node.nodeName():
        return _leaves(node.executedPlan())
    if "QueryStage" in node.nodeName():
        return _leaves(node.plan())
    children = node.children()
    return [x for i in range(children.size()) for x in _leaves(children.apply(i))] or [node]
