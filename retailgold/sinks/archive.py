"""Columnar archive of the raw feeds."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailgold import snapshots
from retailgold.folders import value_of
from retailgold.functions import settlement_date
from retailgold.operators import gold
from retailgold.operators.typed import type_settlement
from retailgold.schemas import DIMENSIONS
from retailgold.session import file_system
from retailgold.sources.files import REJECTED


SUMMARY = "settlement_summary"


_MARK = "_has_rejects"


def _has_rejects(spark: SparkSession, path: str, feed: str) -> bool:
    """Whether lines that were set aside may lie in the archive; others are read without that column."""
    fs, mark = file_system(spark, f"{path}/{feed}/{_MARK}")
    return fs.exists(mark)


def _log(path: str, feed: str) -> str:
    """Each feed has a log of its own, so that feeds are landed side by side."""
    return f"{path}/{feed}/{snapshots.LOG}"


def archive_feed(df: DataFrame, path: str, feed: str, emptied: Callable[[int], bool] = lambda dt: False) -> DataFrame:
    """Land a raw feed as Parquet by date and give back the feed's whole archive.

    Dates that come again replace themselves, dates that ``emptied`` names and that have no rows any more go, others stay.  No
    shuffle: a staged file holds one date, so a scan task writes few dates.  A settlement file is known by the date in its
    name (``file_dt``) and may hold several transaction days, so it is archived by month and file with the day as a column: a
    run reads the months of its days, within them the row groups that hold one, and landing a file again replaces that
    file's rows of all days.  (A folder per day would be thousands of small files where a file holds a month.)  Rows that were
    read with a ``_rejected`` line are landed with it and are not part of what is given back; ``read_rejects`` lists them.
    """
    by = ["dt"]
    if feed == "settlement":
        by = ["settlement_month", "file_dt"]
        df = df.withColumn("settlement_day", settlement_date(F.col("store_transaction_date_time")))
        df = df.withColumn("settlement_month", F.date_format("settlement_day", "yyyyMM").cast("int"))

    def gone(partition: str, again: set[str | None]) -> bool:
        if feed == "settlement":
            return value_of(partition, "file_dt") in again
        value = value_of(partition, "dt")
        return value.isdigit() and emptied(int(value))

    if REJECTED in df.columns:
        fs, mark = file_system(df.sparkSession, f"{path}/{feed}/{_MARK}")
        fs.mkdirs(mark)
    _land(df, path, feed, by, gone)
    return read_archive(df.sparkSession, path, feed, df.schema)


def _land(df: DataFrame, path: str, feed: str, by: list[str], gone: Callable[[str, set[str | None]], bool]) -> None:
    """Make rows the archive's; ``gone(partition, file dates that come again)`` names partitions that go."""
    spark, run = df.sparkSession, snapshots.new_run()
    snapshots.add_files(df, path, feed, by, run, compression="zstd")
    files = snapshots.files_of(spark, path, [feed], run, len(by))
    # every day of a file that comes again is replaced, also days that it no longer has
    again = {value_of(r["partition"], "file_dt") for r in files.select("partition").distinct().collect()} if "file_dt" in by else set()
    done = snapshots.commit(spark, path, files, lambda _, partition: gone(partition, again), [feed], _log(path, feed))
    snapshots.remove(spark, path, done.replaced)


def archive_summary(settlement: DataFrame, path: str) -> DataFrame:
    """Summarise new settlement files (raw, with ``file_dt``) for themselves, and give back the parts of all files.

    A file that comes again replaces its own part, so no other file is read again; a run merges the parts of its days
    (``gold.merged_summary``).
    """
    parts = gold.settlement_parts(type_settlement(settlement))
    parts = parts.withColumn("settlement_month", F.date_format("settlement_day", "yyyyMM").cast("int"))
    _land(parts, path, SUMMARY, ["settlement_month", "file_dt"], lambda partition, again: value_of(partition, "file_dt") in again)
    return read_archive(settlement.sparkSession, path, SUMMARY, parts.schema)


def read_archive(spark: SparkSession, path: str, feed: str, layout: T.StructType) -> DataFrame:
    """A feed's archive with the columns of ``layout``."""
    files = snapshots.current_files(spark, path, feed, _log(path, feed))
    good = T.StructType([f for f in layout if f.name != REJECTED])
    if not files:
        return spark.createDataFrame([], good)
    if not _has_rejects(spark, path, feed):
        return spark.read.schema(good).option("basePath", f"{path}/{feed}").parquet(*files)
    known = T.StructType([*good, T.StructField(REJECTED, T.StringType())])  # NULL where a file was landed without it
    rows = spark.read.schema(known).option("basePath", f"{path}/{feed}").parquet(*files)
    return rows.where(F.col(REJECTED).isNull()).drop(REJECTED)


def read_rejects(spark: SparkSession, path: str, feeds: Iterable[str], keep: Callable[[str, str], bool] = lambda feed, partition: True) -> DataFrame:
    """(feed, dt, line): the lines that were set aside; ``dt`` is the file's date for settlement.  ``keep`` picks partitions."""
    parts = []
    for feed in feeds:
        date = "file_dt" if feed == "settlement" else "dt"
        files = snapshots.current_files(spark, path, feed, _log(path, feed), lambda p, f=feed: keep(f, p))
        if files and _has_rejects(spark, path, feed):
            rows = spark.read.schema(f"{REJECTED} string, {date} int").option("basePath", f"{path}/{feed}").parquet(*files)
            parts.append(rows.where(F.col(REJECTED).isNotNull()).select(F.lit(feed).alias("feed"), F.col(date).alias("dt"), F.col(REJECTED).alias("line")))
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "feed string, dt int, line string")


def archived_settlement_files(spark: SparkSession, path: str, feed: str = "settlement") -> set[str]:
    """File dates that are archived."""
    rows = snapshots.state(spark, _log(path, feed)).select("partition").distinct().collect()
    return {value_of(r["partition"], "file_dt") for r in rows}


def carry_over_dimensions(
    feeds: dict[str, DataFrame], path: str, emptied: Callable[[int], bool] = lambda dt: False,
) -> dict[str, DataFrame]:
    """Stage a daily run's dimensions, with their dates, for the weekly run."""
    return {feed: archive_feed(feeds[feed], path, feed, emptied) for feed in DIMENSIONS}
