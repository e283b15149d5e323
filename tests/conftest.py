from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from retailgold.schemas import feed_layout  # noqa: E402
from retailgold.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]").appName("retailgold-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def conf(spark):
    """Set session values for one test."""
    before = {}

    def put(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield put
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture(scope="session")
def feed(spark):
    """A raw feed from a few rows given as dicts with any letter case; other columns are NULL."""

    def make(name: str, rows: list[dict], partitions: int = 2):
        layout = feed_layout(name)
        lowered = [{k.lower(): v for k, v in r.items()} for r in rows]
        unknown = {k for r in lowered for k in r} - {n.lower() for n in layout.names}
        assert not unknown, unknown
        data = [tuple(r.get(n.lower()) for n in layout.names) for r in lowered]
        return spark.createDataFrame(data, layout).repartition(partitions)

    return make


def rows(df, *columns):
    """Rows as a sorted list of tuples, NULLs first."""
    got = [tuple(r) for r in (df.select(*columns) if columns else df).collect()]
    return sorted(got, key=lambda r: tuple((v is not None, str(v)) for v in r))
