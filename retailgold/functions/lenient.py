"""Casts that give NULL for bad text, also while ANSI mode is on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_DECIMAL_TEXT = r"^\s*([+-]?(?:[0-9]+[.]?|[.])[0-9]*)\s*$"
_MONTH_DAY_YEAR = r"^\s*([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})"


def lenient_int(c: Column) -> Column:
    """Text to int: blanks trimmed, a fraction cut off, NULL for bad text and overflow.

    The plain cast answers for whole numbers; only what it rejects goes through the pattern.
    """
    return F.coalesce(c.try_cast("int"), F.regexp_extract(c, _DECIMAL_TEXT, 1).try_cast("double").try_cast("int"))


def lenient_double(c: Column) -> Column:
    return c.try_cast("double")


def lenient_date(c: Column) -> Column:
    """ISO text to date; a time after the day is ignored."""
    return c.try_cast("date")


def settlement_date(c: Column) -> Column:
    """Day of a ``month/day/year time`` text; one- and two-digit months and days."""
    return F.try_to_date(F.nullif(F.regexp_extract(c, _MONTH_DAY_YEAR, 1), F.lit("")), "M/d/yyyy")
