from __future__ import annotations

import uuid

import pytest
from conftest import rows
from pyspark.sql import functions as F
from shop import D1, D2, transaction

from retailgold.operators import gold
from retailgold.operators.typed import type_feeds
from retailgold.schemas import GOLD_COLUMNS, conform, from_history, history_columns
from retailgold.sinks import publish, store
from retailgold.sources import create_external_table, sync_partitions


@pytest.fixture
def name():
    return "t" + uuid.uuid4().hex[:8]


@pytest.fixture(scope="module")
def built(feed, tmp_path_factory):
    rows_ = [transaction(str(i), dt=D1) for i in range(4)] + [transaction(str(i), dt=D2) for i in range(2)]
    return store(gold.transactions(type_feeds({"transactions": feed("transactions", rows_)})), str(tmp_path_factory.mktemp("built")))


def test_partitions_follow_the_log(spark, built, name, tmp_path):
    path = str(tmp_path)
    publish(built.filter(F.col("dt") == D1), path, "transactions")
    assert create_external_table(spark, name, f"{path}/transactions", "transactions").count() == 4
    publish(built.filter(F.col("dt") == D2), path, "transactions", emptied=lambda dt: dt == D1)
    assert sync_partitions(spark, name, f"{path}/_manifest", "transactions") == (1, 1)
    assert sync_partitions(spark, name, f"{path}/_manifest", "transactions") == (0, 0)
    spark.catalog.refreshTable(name)
    assert rows(spark.table(name).groupBy("partition_col").count()) == [(D2, 2)]


def test_older_layout(spark, built, name, tmp_path):
    old = built.select(*[F.col(new).alias(was) for new, was in history_columns("transactions").items()])
    assert "dt" not in old.columns and "checkid" in old.columns and "SourceTransactionNumer" in old.columns
    old.write.option("sep", "|").option("header", True).option("emptyValue", "").csv(f"{tmp_path}/old")
    table = create_external_table(spark, name, f"{tmp_path}/old", "transactions", kind="history")
    assert rows(from_history(table, "transactions")) == rows(conform(built, "transactions"))
    fixed = from_history(table, "transactions", F.lit(20200101))
    assert {r["dt"] for r in fixed.collect()} == {r["partition_col"] for r in fixed.collect()} == {20200101}


@pytest.mark.parametrize("table", list(GOLD_COLUMNS))
def test_every_table_has_an_older_layout(spark, table):
    names = list(history_columns(table).values())
    df = spark.createDataFrame([tuple("2020-01-02" if "date" in n.lower() else None for n in names)], ", ".join(f"`{n}` string" for n in names))
    assert len({n.lower() for n in names}) == len(names)
    out = from_history(df, table).first()
    assert out["partition_col"] == (20200102 if "dt" not in history_columns(table) else None)
