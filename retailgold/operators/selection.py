"""Which dates and files a run takes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values ----------------------------------------------------------------------------------------------------
SETTLEMENT_START = "20200910"
NEVER = "99990101"
# a daily run takes settlement files after the start day, a weekly one takes none
SETTLEMENT_AFTER = {"daily": SETTLEMENT_START, "weekly": NEVER}
# --- end of fixed values ---------------------------------------------------------------------------------------------


def in_date_spec(spec: str, dt: Column | None = None) -> Column:
    """Predicate for ``d``, ``d1,d2,...`` or ``d1:d2`` (both ends included).

    The spec is known when the query is planned and ``dt`` orders like the calendar, so this is a plain comparison that
    prunes partitions without listing the days in between.
    """
    dt = F.col("dt") if dt is None else dt
    if "," in spec:
        return dt.isin([int(d) for d in spec.split(",")])
    if ":" in spec:
        first, last = spec.split(":")
        return dt.between(int(first), int(last))
    return dt == int(spec)


def spec_holds(spec: str | None, dt: int) -> bool:
    """``in_date_spec`` for one known date; without a spec nothing is asked for."""
    if spec is None:
        return False
    if "," in spec:
        return dt in {int(d) for d in spec.split(",")}
    first, _, last = spec.partition(":")
    return int(first) <= dt <= int(last or first)


def real_day(text: Column) -> Column:
    """``yyyyMMdd`` text as a number where it is a day of the calendar, else NULL."""
    return F.when(F.try_to_date(text, "yyyyMMdd").isNotNull(), text.try_cast("int"))


def select_dates(df: DataFrame, spec: str) -> DataFrame:
    return df.filter(in_date_spec(spec))


def after_start(df: DataFrame, start: str, dt: str = "dt") -> DataFrame:
    """Rows strictly after a start day, compared as text; ``NEVER`` lets nothing pass."""
    return df.filter(F.col(dt).cast("string") > start)


def files_of(files: DataFrame, prefix: str, feed: Column | str, date: Column | str) -> DataFrame:
    """Files whose name starts with ``prefix_feed_date``."""
    feed = F.lit(feed) if isinstance(feed, str) else feed
    date = F.lit(date) if isinstance(date, str) else date
    wanted = F.concat_ws("_", F.lit(prefix), feed, date) if prefix else F.concat_ws("_", feed, date)
    return files.filter(F.col("name").startswith(wanted))
