"""The seven gold tables: typed feeds in, one DataFrame out.

Dimension joins are left to Spark, which broadcasts a side only below its own size limit.  Joins between two growing feeds ask
for sort-merge: a size estimate from compressed files would broadcast a side many times its estimate (measured slower
already at 150,000 rows), and AQE can split a hot key's partition of a sort-merge join (``session.SETTINGS``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailgold.functions import card_prefix, card_suffix, check_id, lenient_int, settlement_date
from retailgold.schemas import columns_of

Feeds = dict[str, DataFrame]


def _dated(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("dt").alias("partition_col"))


def organization(feeds: Feeds) -> DataFrame:
    return _dated(feeds["organization"])


def product_category(feeds: Feeds) -> DataFrame:
    return _dated(feeds["product_category"])


def transactions(feeds: Feeds) -> DataFrame:
    return _dated(feeds["transactions"].withColumn(
        "check_id", check_id(F.col("sourcetransactionnumber"), F.col("postransactionnumber"), F.col("registernumber"))
    ))


def product(feeds: Feeds) -> DataFrame:
    """Products with the name of their category of the same date; products without one are left out."""
    items = feeds["product"]
    category = feeds["product_category"].select(
        F.col("dt").alias("c_dt"), F.col("SourceCategoryNumber").alias("c_number"),
        F.col("DateCreated").alias("c_created"), F.col("Name").alias("Sourceproductcategoryname"),
    )
    return (
        items.alias("p").join(
            category.alias("c"),
            (F.col("p.dt") == F.col("c_dt"))
            & (F.col("p.SourceProductCategoryNumber") == F.col("c_number"))
            & (F.col("p.DateCreated") == F.col("c_created")),
        )
        .select(*columns_of(items, "p"), "Sourceproductcategoryname", F.col("p.dt").alias("partition_col"))
    )


# --- what a transaction gives to its tenders and line items ------------------------------------------------------------

def _transaction_side(feeds: Feeds, *extra: str) -> DataFrame:
    """Join keys and carried columns of the transactions, under names no feed uses."""
    carried = ("postransactionnumber", "registernumber", "transactiontimestamp", *extra)
    return feeds["transactions"].select(
        F.col("dt").alias("tx_dt"), F.col("sourcetransactionnumber").alias("tx_number"),
        F.col("SourceOrganizationNumber").alias("tx_store"), F.col("DateCreated").alias("tx_day"),
        *[F.col(c).alias(f"tx_{c}") for c in carried],
    ).hint("merge")


def _same_transaction(alias: str, day: str) -> Column:
    # the number first: rows are sorted by the keys in this order, and the first decides nearly all comparisons by itself
    return (
        (F.col(f"{alias}.sourcetransactionnumber") == F.col("tx_number"))
        & (F.col(f"{alias}.dt") == F.col("tx_dt"))
        & (F.col(f"{alias}.sourceorganizationnumber") == F.col("tx_store"))
        & (F.col(f"{alias}.{day}") == F.col("tx_day"))
    )


def _check_id_of(alias: str) -> Column:
    return check_id(
        F.col(f"{alias}.sourcetransactionnumber"), F.col("tx_postransactionnumber"), F.col("tx_registernumber")
    )


def line_item(feeds: Feeds) -> DataFrame:
    """Line items with check id and time of their transaction."""
    items = feeds["transaction_item"]
    return items.alias("i").join(_transaction_side(feeds), _same_transaction("i", "datecreated")).select(
        *columns_of(items, "i"), _check_id_of("i").alias("check_id"),
        F.col("tx_transactiontimestamp").alias("transactiontimestamp"), F.col("i.dt").alias("partition_col"),
    )


def tender_transactions(feeds: Feeds) -> DataFrame:
    """Tenders joined to their transactions, before the settlement lookup."""
    tenders_ = feeds["tenders"]
    return (
        tenders_.alias("d")
        .join(
            _transaction_side(feeds, "sourcecustomernumber", "currency"),
            _same_transaction("d", "transactiondate"),
        )
        .select(
            F.col("tx_sourcecustomernumber").alias("sourcecustomernumber"),
            F.col("tx_registernumber").alias("registernumber"),
            F.col("tx_transactiontimestamp").alias("transactiontimestamp"),
            F.col("tx_currency").alias("currency"),
            _check_id_of("d").alias("check_id"),
            *[F.col(f"d.{c}").alias(c) for c in (
                "sourcetransactionnumber", "sourceorganizationnumber", "transactiondate", "tendercode", "tendername",
                "tenderamt", "accountnumbermasked", "cardusagetype", "dt",
            )],
        )
    )


def settlement_summary(settlement: DataFrame) -> DataFrame:
    """One row per store, day, masked card, amount and register, with the smallest customer name."""
    day = settlement_date(F.col("store_transaction_date_time"))
    return _smallest_names(settlement.withColumn("settlement_day", day))


_SUMMARY = ("store_id", "settlement_day", "masked_card_number", "approved_amount", "pos_register_number")
# rows are sorted by the keys in this order, and the first decide nearly all comparisons
_SORTED = ("masked_card_number", "approved_amount", "settlement_day", "store_id", "pos_register_number")


def _smallest_names(rows: DataFrame, *more: str) -> DataFrame:
    return rows.groupBy(*_SORTED, *more).agg(F.min("customer_name").alias("customer_name")).select(*more, *_SUMMARY, "customer_name")


def settlement_parts(settlement: DataFrame) -> DataFrame:
    """The summary of each settlement file (``file_dt``) for itself; a smallest name of parts is that of the whole."""
    day = settlement_date(F.col("store_transaction_date_time"))
    return _smallest_names(settlement.withColumn("settlement_day", day), "file_dt")


def merged_summary(parts: DataFrame) -> DataFrame:
    """``settlement_summary`` of all files from their parts."""
    return _smallest_names(parts)


# Longer than any card suffix, so it equals none.
_NO_MATCH = "no-match~"


def tenders(feeds: Feeds) -> DataFrame:
    """Tenders with their transaction and, where the card settlement has it, the customer name.

    A tender matches every settlement group with the same store, register, day, amount and the same visible card digits, so
    groups that differ in hidden digits only give one row each.

    Cash and other tenders with an empty key part can match nothing but still have to pass the outer join's shuffle.  Their
    card suffix is replaced by a text made of their own transaction key, which spreads them over all partitions.

    With a feed ``settlement_summary`` (``settlement_parts`` by file) the settlement itself is not read.
    """
    sold = tender_transactions(feeds)
    register, suffix = lenient_int(F.col("registernumber")), card_suffix(F.col("accountnumbermasked"))
    # the store and the day are join keys of the transaction join, hence never NULL here
    matchable = register.isNotNull() & suffix.isNotNull() & F.col("tenderamt").isNotNull()
    spread = F.concat(
        F.lit(_NO_MATCH), F.xxhash64("dt", "sourcetransactionnumber", "tendercode", "tenderamt").cast("string")
    )
    left = sold.select(
        "*", register.alias("k_register"), card_prefix(F.col("accountnumbermasked")).alias("k_prefix"),
        F.when(matchable, suffix).otherwise(spread).alias("k_suffix"),
    )
    summary = merged_summary(feeds["settlement_summary"]) if "settlement_summary" in feeds else settlement_summary(feeds["settlement"])
    right = summary.select(
        "customer_name", F.col("store_id").alias("s_store"), F.col("settlement_day").alias("s_day"),
        F.col("approved_amount").alias("s_amount"), lenient_int(F.col("pos_register_number")).alias("s_register"),
        card_prefix(F.col("masked_card_number")).alias("s_prefix"),
        card_suffix(F.col("masked_card_number")).alias("s_suffix"),
    ).hint("merge")
    joined = left.join(
        right,
        (F.col("k_suffix") == F.col("s_suffix"))
        & (F.col("tenderamt") == F.col("s_amount"))
        & (F.col("sourceorganizationnumber") == F.col("s_store"))
        & (F.col("k_register") == F.col("s_register"))
        & (F.col("transactiondate") == F.col("s_day"))
        & (F.col("k_prefix") == F.col("s_prefix")),
        "left",
    )
    return joined.select(
        "sourcecustomernumber", "registernumber", "transactiontimestamp", "currency", "customer_name", "check_id",
        "sourcetransactionnumber", "sourceorganizationnumber", "transactiondate", "tendercode", "tendername",
        "tenderamt", "accountnumbermasked", "cardusagetype", "dt", F.col("dt").alias("partition_col"),
    )


def discount_dimension(feeds: Feeds) -> DataFrame:
    """Distinct codes per date; a code with two descriptions keeps both."""
    return feeds["discounts"].select("discountcode", "DiscountDescription", "DiscountType", "dt").distinct()


def xref_items(feeds: Feeds, items: DataFrame | None = None) -> DataFrame:
    """Discount references with the line item they belong to."""
    items = feeds["transaction_item"] if items is None else items
    carried = [c for c in items.columns if c.lower() not in ("dt", "partition_col")]
    item_side = items.select(F.col("dt").alias("i_dt"), *[F.col(c).alias(f"i_{c.lower()}") for c in carried])
    item_side = item_side.hint("merge")
    return feeds["trans_disc_xref"].alias("x").join(
        item_side,
        (F.col("x.SourceTransactionItemNumber") == F.col("i_sourcetransactionitemnumber"))
        & (F.col("x.dt") == F.col("i_dt")),
    )


def discounts(feeds: Feeds, line_items: DataFrame | None = None) -> DataFrame:
    """Discounts with item, check id and description.

    An item's transaction is the one the line-item gold table already found, so a run that has written that table passes it as
    ``line_items`` and saves the second join of items to transactions.
    """
    items = line_item(feeds) if line_items is None else line_items
    items = items.select(
        "DateCreated", "SourceTransactionNumber", "SourceTransactionItemNumber", "SourceOrganizationNumber",
        "InvoiceDate", "ShipDate", "SourceProductNumber", "check_id", "dt",
    )
    codes = discount_dimension(feeds).select(
        F.col("dt").alias("k_dt"), F.col("discountcode").alias("k_code"), "DiscountType", "DiscountDescription"
    )
    # the dimension first: it is small and drops references without a known code before the item shuffle
    known = feeds["trans_disc_xref"].alias("r").join(
        codes, (F.col("r.dt") == F.col("k_dt")) & (F.col("r.DiscountCode") == F.col("k_code"))
    ).drop("k_dt", "k_code")
    return xref_items({**feeds, "trans_disc_xref": known}, items).select(
        F.col("i_datecreated").alias("DateCreated"),
        F.col("i_sourcetransactionnumber").alias("SourceTransactionNumber"),
        F.col("i_sourcetransactionitemnumber").alias("SourceTransactionItemNumber"),
        F.col("i_sourceorganizationnumber").alias("SourceOrganizationNumber"),
        F.col("i_invoicedate").alias("InvoiceDate"),
        F.col("i_shipdate").alias("ShipDate"),
        F.col("i_sourceproductnumber").alias("SourceProductNumber"),
        F.col("x.DiscountCode").alias("DiscountCode"),
        F.col("x.DiscountAmt").alias("DiscountAmt"),
        "DiscountType", "DiscountDescription",
        F.col("i_check_id").alias("check_id"),
        F.col("x.dt").alias("dt"), F.col("i_dt").alias("partition_col"),
    )


BUILDERS = {
    "transactions": transactions,
    "product_category": product_category,
    "product": product,
    "organization": organization,
    "tenders": tenders,
    "transaction_item": line_item,
    "discounts": discounts,
}
