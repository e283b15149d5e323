"""What file names and paths say about their data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(key: Column) -> Column:
    return F.element_at(F.split(key, "/"), -1)


def date_from_name(key: Column) -> Column:
    """First eight characters after the last underscore."""
    return F.substring(F.element_at(F.split(key, "_"), -1), 1, 8)


def feed_from_name(key: Column) -> Column:
    """What stands between the first and the last underscore of the file name."""
    return F.lower(F.regexp_extract(file_name(key), r"^[^_]+_(.+)_[^_]+$", 1))


def feed_folder(feed: Column) -> Column:
    """``transaction_item`` -> ``Transaction_Item``."""
    return F.array_join(F.transform(F.split(feed, "_"), F.initcap), "_")


def partition_value(path: Column, column: str = "partition_col") -> Column:
    """Value of a partition directory in a path, as text."""
    return F.regexp_extract(path, f"/{column}=([^/]+)/", 1)


def shift_day(dt: Column, days: int) -> Column:
    """A ``yyyyMMdd`` day moved by some days; NULL where it is no day."""
    return F.date_format(F.date_add(F.try_to_date(dt.cast("string"), "yyyyMMdd"), days), "yyyyMMdd")
