"""Typing of raw feeds.  Only the named columns change; every other column, known or new, passes through as it is."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailgold.functions import key_part, lenient_date, lenient_double, lenient_int


def type_settlement(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "store_id": lenient_int(F.col("store_id")),
        "approved_amount": lenient_double(F.col("approved_amount")),
    })


def type_transactions(df: DataFrame) -> DataFrame:
    """Typed store and day; the three parts of the check id are never NULL."""
    return df.withColumns({
        "SourceOrganizationNumber": lenient_int(F.col("SourceOrganizationNumber")),
        "DateCreated": lenient_date(F.col("DateCreated")),
        "sourcetransactionnumber": key_part(F.col("sourcetransactionnumber")),
        "postransactionnumber": key_part(F.col("postransactionnumber")),
        "registernumber": key_part(F.col("registernumber")),
    })


def type_line_items(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "SourceOrganizationNumber": lenient_int(F.col("SourceOrganizationNumber")),
        "datecreated": lenient_date(F.col("datecreated")),
    })


def type_tenders(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "sourceorganizationnumber": lenient_int(F.col("sourceorganizationnumber")),
        "transactiondate": lenient_date(F.col("transactiondate")),
        "tenderamt": lenient_double(F.col("tenderamt")),
    })


_TYPERS = {
    "settlement": type_settlement,
    "transactions": type_transactions,
    "transaction_item": type_line_items,
    "tenders": type_tenders,
}


def type_feeds(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All feeds typed; those without typed columns stay as they are."""
    return {name: _TYPERS[name](df) if name in _TYPERS else df for name, df in feeds.items()}
