"""Feed layouts and ordered gold contracts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _layout(names: str, **typed: T.DataType) -> T.StructType:
    types = {n.lower(): t for n, t in typed.items()}
    return T.StructType([T.StructField(n, types.get(n.lower(), T.StringType()), True) for n in names.split()])


# --- fixed values: feed columns, in file order -----------------------------------------------------------------------
FEED_COLUMNS = {
    "transactions": (
        "SourceTransactionNumber SourceOrganizationNumber Total Currency Discount Tax Type TransactionTimeStamp "
        "SourceCustomerNumber DateCreated CustomAttributes PromoAmt CouponAmt POSDiscAmt ManufacturerCouponAmt "
        "RegisterNumber AccountNumberMasked postransactionnumber"
    ),
    "tenders": (
        "sourcetransactionnumber sourceorganizationnumber transactiondate tendercode tendername tenderamt "
        "accountnumbermasked cardusagetype"
    ),
    "transaction_item": (
        "sourcetransactionitemnumber sourcetransactionnumber sourceorganizationnumber type subtype invoicedate shipdate "
        "sourceproductnumber quantity weight volume listprice currency salesrevenue discount costbasis tax "
        "shippingrevenue shippingcost shippingdiscount otherrevenue othercosts datecreated"
    ),
    "trans_disc_xref": "SourceTransactionItemNumber DiscountCode DiscountAmt",
    "discounts": "discountcode discountdescription discounttype",
    "product": (
        "SourceProductNumber Name Description ProductURL ImageURL ParentProductNumber BrandName MSRP ListPrice SalePrice "
        "SaleCondition Availability AvailableQty RecoStatus Size Color SourceProductCategoryNumber DateCreated "
        "CustomAttributes"
    ),
    "product_category": "SourceCategoryNumber Name SourceParentCategoryNumber DateCreated CustomAttributes",
    "organization": (
        "SourceOrganizationNumberkey Name Status Type Subtype ParentSourceOrganizationNumber Country State City "
        "Addr_line_1 Addr_line_2 Zip ExcludeAsClosestStore DateCreated CustomAttributes"
    ),
    "settlement": (
        "store_id transaction_id store_transaction_date_time host_transaction_date_time customer_name "
        "masked_card_number approval_code pos_transaction_number approved_amount pos_register_number"
    ),
}

# --- fixed values: gold columns, in the contract's order and spelling ------------------------------------------------
GOLD_COLUMNS = {
    "transactions": (
        "sourcetransactionnumber SourceOrganizationNumber Total Currency Discount Tax Type Transactiontimestamp "
        "Sourcecustomernumber DateCreated CustomAttributes Promoamt Couponamt Posdiscamt Manufacturercouponamt "
        "registernumber AccountNumberMasked postransactionnumber dt check_id"
    ),
    "product_category": (
        "Sourcecategorynumber Name Sourceparentcategorynumber Datecreated Customattributes dt"
    ),
    "product": (
        "Sourceproductnumber Name Description Producturl Imageurl Parentproductnumber BrandName Msrp Listprice Saleprice "
        "Salecondition Availability Availableqty Recostatus Size Color Sourceproductcategorynumber Datecreated "
        "Customattributes dt Sourceproductcategoryname"
    ),
    "organization": (
        "Sourceorganizationnumberkey Name Status Type Subtype Parentsourceorganizationnumber Country State City "
        "Addr_line_1 Addr_line_2 Zip Excludeascloseststore Datecreated Customattributes dt"
    ),
    "tenders": (
        "sourcecustomernumber registernumber transactiontimestamp currency customer_name check_id "
        "sourcetransactionnumber sourceorganizationnumber transactiondate tendercode tendername tenderamt "
        "accountnumbermasked cardusagetype dt"
    ),
    "transaction_item": (
        "Sourcetransactionitemnumber Sourcetransactionnumber SourceOrganizationNumber Type Subtype Invoicedate Shipdate "
        "Sourceproductnumber Quantity Weight Volume Listprice Currency Salesrevenue Discount Costbasis Tax "
        "Shippingrevenue Shippingcost Shippingdiscount Otherrevenue Othercosts datecreated dt check_id transactiontimestamp"
    ),
    "discounts": (
        "DateCreated SourceTransactionNumber SourceTransactionItemNumber SourceOrganizationNumber InvoiceDate ShipDate "
        "SourceProductNumber DiscountCode DiscountAmt DiscountType DiscountDescription check_id dt"
    ),
}

# --- fixed values: what the older gold files call the contract's columns, and which of them have no dt --------------------
HISTORY_NAMES = {
    "transactions": {
        "sourcetransactionnumber": "SourceTransactionNumer", "CustomAttributes": "Custom_Attributes",
        "AccountNumberMasked": "Account_Number_Masked", "check_id": "checkid",
    },
    "transaction_item": {"Type": "transactionitemtype", "check_id": "checkid"},
    "organization": {
        "Sourceorganizationnumberkey": "SourceOrganizationNumber", "Name": "OrgName", "Type": "OrgType", "State": "OrgState",
        "Addr_line_1": "Address1", "Addr_line_2": "Address2",
    },
    "product": {"Name": "ProductName", "Size": "ProductSize"},
    "product_category": {"Name": "ProductCategoryName"},
}
HISTORY_WITHOUT_DT = ("transactions", "tenders", "organization", "product", "product_category")

# what a file's header must name: all documented columns of a feed, of settlement files those that are used
NEEDED_COLUMNS = {
    **FEED_COLUMNS,
    "settlement": (
        "store_id store_transaction_date_time customer_name masked_card_number approved_amount pos_register_number"
    ),
}

POS_FEEDS = (
    "transactions", "tenders", "transaction_item", "trans_disc_xref",
    "product", "product_category", "organization", "discounts",
)
DIMENSIONS = ("product", "product_category", "organization")
# build order of the gold tables
GOLD_TABLES = (
    "transactions", "product_category", "product", "organization", "tenders", "transaction_item", "discounts",
)
# gold table -> feed whose rows it must account for
STAGING_OF = {t: t for t in GOLD_TABLES} | {"discounts": "trans_disc_xref"}
# --- end of fixed values ---------------------------------------------------------------------------------------------

DT = T.StructField("dt", T.IntegerType(), True)
PARTITION = T.StructField("partition_col", T.IntegerType(), True)

_TYPED = {
    "transactions": {"SourceOrganizationNumber": T.IntegerType(), "DateCreated": T.DateType()},
    "transaction_item": {"sourceorganizationnumber": T.IntegerType(), "datecreated": T.DateType()},
    "tenders": {
        "sourceorganizationnumber": T.IntegerType(), "transactiondate": T.DateType(), "tenderamt": T.DoubleType(),
    },
    "settlement": {"store_id": T.IntegerType(), "approved_amount": T.DoubleType()},
    "discounts": {"SourceOrganizationNumber": T.IntegerType(), "DateCreated": T.DateType()},
}


def feed_layout(feed: str, dt: bool = True) -> T.StructType:
    """A feed as it lies on disk: text columns, and the date partition for all feeds but settlement."""
    layout = _layout(FEED_COLUMNS[feed])
    return T.StructType(layout.fields + [DT]) if dt and feed != "settlement" else layout


def gold_layout(table: str, partition: bool = True) -> T.StructType:
    """A gold table by its contract, typed."""
    layout = _layout(GOLD_COLUMNS[table], dt=T.IntegerType(), **_TYPED.get(table, {}))
    return T.StructType(layout.fields + [PARTITION]) if partition else layout


def history_columns(table: str) -> dict[str, str]:
    """Contract column -> its name in the older files, in their order."""
    names = HISTORY_NAMES.get(table, {})
    return {c: names.get(c, c) for c in GOLD_COLUMNS[table].split() if not (c == "dt" and table in HISTORY_WITHOUT_DT)}


def from_history(df: DataFrame, table: str, dt: Column | None = None) -> DataFrame:
    """Rows of the older layout by the contract, with ``partition_col``.

    Where the layout has no ``dt`` it is the day of the row's own date, or what ``dt`` says.
    """
    columns, types = history_columns(table), {f.name: f.dataType for f in gold_layout(table)}
    rows = df.select(*[F.col(f"`{old}`").cast("string").try_cast(types[new]).alias(new) for new, old in columns.items()])
    if "dt" not in columns:
        day = F.col("transactiondate" if table == "tenders" else "DateCreated").cast("string").try_cast("date")
        rows = rows.withColumn("dt", F.date_format(day, "yyyyMMdd").cast("int") if dt is None else dt.cast("int"))
    return conform(rows.withColumn("partition_col", F.col("dt")), table)


AUDIT_LAYOUT = T.StructType([
    T.StructField("BRAND_SID", T.StringType()),
    T.StructField("EVENT_TYPE", T.StringType()),
    T.StructField("DATA_CATEGORY", T.StringType()),
    T.StructField("INGESTION_DATE", T.StringType()),
    T.StructField("ENTITY_TYPE", T.StringType()),
    # a gold table of this size holds more rows than an int can count
    T.StructField("SOURCE_COUNT", T.LongType()),
    T.StructField("DESTINATION_COUNT", T.LongType()),
    T.StructField("SOURCE", T.StringType()),
    T.StructField("DESTINATION", T.StringType()),
    T.StructField("EVENT_START_TIME", T.TimestampType()),
    T.StructField("EVENT_END_TIME", T.TimestampType()),
    T.StructField("EVENT_RESULT", T.StringType()),
    T.StructField("EVENT_NOTES", T.StringType()),
])


def conform(df: DataFrame, table: str, *, unknown: bool = False) -> DataFrame:
    """The contract's columns, in its order and spelling, plus the partition key; fails if one is missing.

    With ``unknown`` other columns follow them as they are.
    """
    wanted = gold_layout(table).names
    have = {c.lower() for c in df.columns}
    missing = [c for c in wanted if c.lower() not in have]
    if missing:
        raise ValueError(f"{table}: columns missing from the contract: {missing}")
    known = {c.lower() for c in wanted}
    more = [F.col(f"`{c}`") for c in df.columns if unknown and c.lower() not in known]
    # the partition key stays last
    return df.select(*[F.col(c).alias(c) for c in wanted[:-1]], *more, F.col(wanted[-1]).alias(wanted[-1]))


def columns_of(df: DataFrame, alias: str) -> list[Column]:
    """All columns of an aliased side of a join, whatever the feed carries."""
    return [F.col(f"{alias}.`{c}`") for c in df.columns]
