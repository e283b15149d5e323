"""Business keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def check_id(number: Column, pos_number: Column, register: Column) -> Column:
    """``number~pos_number~register``; NULL as soon as one part is NULL."""
    return F.concat(number, F.lit("~"), pos_number, F.lit("~"), register)


def key_part(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def card_suffix(c: Column) -> Column:
    """Last four characters; a shorter text as a whole."""
    return F.substring(c, -4, 4)


def card_prefix(c: Column) -> Column:
    return F.substring(c, 1, 6)


def is_missing(c: Column) -> Column:
    return c.isNull() | (c == "")
