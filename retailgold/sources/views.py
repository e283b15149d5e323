"""SQL surface: feeds as named relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register_feeds(spark: SparkSession, feeds: dict[str, DataFrame], prefix: str = "pos_") -> list[str]:
    """One temporary view per feed, named ``prefix + feed``."""
    names = [prefix + feed for feed in feeds]
    for name, df in zip(names, feeds.values()):
        df.createOrReplaceTempView(name)
    return names


def run_sql(spark: SparkSession, feeds: dict[str, DataFrame], text: str, prefix: str = "pos_") -> DataFrame:
    """A user's own SQL text over the feeds."""
    register_feeds(spark, feeds, prefix)
    return spark.sql(text)
