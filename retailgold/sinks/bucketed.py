"""Typed staging, bucketed by transaction number within its dates: items and tenders then meet their transactions without a shuffle.

A feed that is joined to the transactions by several tables, or by several runs, is shuffled once here and not in each join.  Every
join key is equal only where the transaction number is, so rows that can match lie in buckets of the same number; the session
has to accept that as a common partitioning (``session.SETTINGS``).

A bucket is read by one task, and no skew handling splits it: all rows of one transaction number lie in it.  Where one number may
hold a large part of a feed, the plain archive with its split joins is the better staging.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailgold.session import file_system

KEY = "sourcetransactionnumber"
BUCKETED_FEEDS = ("transactions", "transaction_item", "tenders")


def attach_bucketed(spark: SparkSession, path: str, prefix: str, feed: str, like: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """The bucketed table of a feed below ``path``, known to this session's catalog as ``<prefix>_<feed>``.

    A new one takes its columns from ``like`` (typed, with ``dt``) and its number of buckets from ``buckets``; both are kept in
    its folder, so that other sessions attach it without them.
    """
    name, location = f"{prefix}_{feed}", f"{path}/{feed}"
    if not spark.catalog.tableExists(name):
        notes = f"{path}/_layout/{feed}"
        fs, folder = file_system(spark, notes)
        if fs.exists(folder):
            columns, buckets = spark.read.json(notes).select("columns", "buckets").first()
        else:
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
            spark.createDataFrame([(columns, buckets)], "columns string, buckets int").coalesce(1).write.json(notes)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (dt) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {buckets} BUCKETS "
            f"LOCATION '{location}'"
        )
        if fs.exists(file_system(spark, location)[1]):
            spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def stage_bucketed(feeds: dict[str, DataFrame], path: str, prefix: str, buckets: int) -> dict[str, DataFrame]:
    """Stage the typed feeds that are joined by transaction number, and give all feeds back, those from the staging.

    One shuffle per feed, into the buckets.  Dates that come again replace themselves.  A column that the staging does not have yet
    is added to it and is NULL on earlier dates.
    """
    out = dict(feeds)
    for feed in BUCKETED_FEEDS:
        if feed not in feeds:
            continue
        df = feeds[feed]
        spark = df.sparkSession
        table = attach_bucketed(spark, path, prefix, feed, df, buckets)
        known, given = {c.lower() for c in table.columns}, {c.lower() for c in df.columns}
        if new := [f for f in df.schema if f.name.lower() not in known]:
            spark.sql(f"ALTER TABLE {prefix}_{feed} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in new)})")
            table = spark.table(f"{prefix}_{feed}")
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in table.schema)
            spark.createDataFrame([(columns, _buckets(spark, f"{prefix}_{feed}"))], "columns string, buckets int").coalesce(1).write.mode("overwrite").json(f"{path}/_layout/{feed}")
        rows = df.select(*[F.col(f.name) if f.name.lower() in given else F.lit(None).cast(f.dataType).alias(f.name) for f in table.schema])
        # the same hash as the buckets', so a task writes one bucket of each date
        mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")  # a table takes it from nowhere else
        try:
            rows.repartition(_buckets(spark, f"{prefix}_{feed}"), KEY).write.insertInto(f"{prefix}_{feed}", overwrite=True)
        finally:
            spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
        out[feed] = spark.table(f"{prefix}_{feed}")
    return out


def _buckets(spark: SparkSession, name: str) -> int:
    """The number of buckets of a table."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Num Buckets'").select("data_type")
    return int(rows.first()[0])
