"""POS feeds as Spark derives them from orders, lineitem, customer, part, supplier, nation, region and events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailgold.operators.typed import type_feeds
from retailgold.schemas import POS_FEEDS, feed_layout
from retailgold.session import scratch_dir

DIMENSION_DT = 19950101
DIMENSION_DAY = "1995-01-01"


_layouts: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver table; its footer is read for the layout only once."""
    path = f"{sf}/{name}.parquet"
    if path not in _layouts:
        _layouts[path] = spark.read.parquet(path).schema
    return spark.read.schema(_layouts[path]).parquet(path)


def _text(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _feed(df: DataFrame, feed: str, dt: Column | None, **columns: Column) -> DataFrame:
    """A feed with all its columns in file order; those not given are NULL."""
    given = {k.lower(): v for k, v in columns.items()}
    names = [n for n in feed_layout(feed, dt=False).names]
    unknown = set(given) - {n.lower() for n in names}
    if unknown:
        raise ValueError(f"{feed}: {unknown}")
    cols = [given.get(n.lower(), F.lit(None)).cast("string").alias(n) for n in names]
    return df.select(*cols, *([] if dt is None else [dt.cast("int").alias("dt")]))


def _day() -> Column:
    return F.date_format("o_orderdate", "yyyy-MM-dd")


def _dt() -> Column:
    return F.year("o_orderdate") * 10000 + F.month("o_orderdate") * 100 + 1


def _store() -> Column:
    return _text(F.col("o_custkey") % 100)


def _register() -> Column:
    return F.lpad(_text(F.col("o_orderkey") % 12), 2, "0")


def _prefix() -> Column:
    return F.concat(F.lit("4"), F.lpad(_text(F.col("o_custkey") % 100000), 5, "0"))


def _suffix() -> Column:
    return F.lpad(_text(F.col("o_orderkey") % 10000), 4, "0")


def _card(mask: str) -> Column:
    return F.concat(_prefix(), F.lit(mask), _suffix())


def _null_every(n: int, key: str, c: Column) -> Column:
    return F.when(F.col(key) % n != 0, c)


def _order_lines(spark: SparkSession, sf: str, numbered: bool = True) -> DataFrame:
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_discount")
    if numbered:
        # the tables hold lines with equal keys; the copy's number makes item numbers unique.  Dealt by order, so that the window
        # and the join to the orders share one shuffle, and one sort
        lines = lines.repartition("l_orderkey")
        copies = Window.partitionBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").orderBy("l_discount")
        lines = lines.withColumn("copy", F.row_number().over(copies))
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))


def _stored_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The numbered lines with their orders, written once for all feeds that are made of them and for all that read these."""
    lines, path = _order_lines(spark, sf).drop("o_orderkey"), scratch_dir(spark, "lines")
    lines.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(lines.schema).parquet(path)


def _item_number() -> Column:
    return F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "copy")


def _code() -> Column:
    return F.concat(F.lit("D"), _text(F.round(F.col("l_discount") * 100).cast("int")))


def transactions(spark: SparkSession, sf: str) -> DataFrame:
    return _feed(
        table(spark, sf, "orders"), "transactions", _dt(),
        SourceTransactionNumber=_text("o_orderkey"), SourceOrganizationNumber=_store(), Currency=F.lit("USD"),
        SourceCustomerNumber=_text("o_custkey"), TransactionTimeStamp=F.concat(_day(), F.lit(" 10:00:00")),
        DateCreated=_day(), RegisterNumber=_null_every(101, "o_orderkey", _register()),
        postransactionnumber=_null_every(97, "o_orderkey", _text("o_custkey")),
    )


def transaction_item(spark: SparkSession, sf: str, complete: bool = False, lines: DataFrame | None = None) -> DataFrame:
    """``complete`` gives every item its transaction number; else some lack it and are lost in the join."""
    number = _text("l_orderkey")
    return _feed(
        _order_lines(spark, sf) if lines is None else lines, "transaction_item", _dt(),
        sourcetransactionitemnumber=_item_number(),
        sourcetransactionnumber=number if complete else _null_every(89, "l_orderkey", number),
        sourceorganizationnumber=_store(), sourceproductnumber=_text("l_partkey"), datecreated=_day(),
    )


def tenders(spark: SparkSession, sf: str) -> DataFrame:
    cash = F.col("o_orderkey") % 4 == 0
    return _feed(
        table(spark, sf, "orders"), "tenders", _dt(),
        sourcetransactionnumber=_text("o_orderkey"), sourceorganizationnumber=_store(), transactiondate=_day(),
        tendername=F.when(cash, "CASH").otherwise("CARD"), tenderamt=_text("o_totalprice"),
        accountnumbermasked=F.when(~cash, _card("xxxxxx")),
    )


def settlement(spark: SparkSession, sf: str) -> DataFrame:
    """Card settlements, some announced under a second name and some under a second mask."""
    orders = table(spark, sf, "orders").filter((F.col("o_orderkey") % 4 != 0) & (F.col("o_orderkey") % 7 != 0))
    cards = orders.join(
        table(spark, sf, "customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")
    )

    def rows(df: DataFrame, name: Column, mask: str) -> DataFrame:
        return _feed(
            df, "settlement", None, store_id=_store(),
            store_transaction_date_time=F.concat(F.date_format("o_orderdate", "MM/dd/yyyy"), F.lit(" 10:00:00")),
            customer_name=name, masked_card_number=_card(mask), approved_amount=_text("o_totalprice"),
            pos_register_number=_text(F.col("o_orderkey") % 12),
        )

    second_name = rows(cards.filter("o_orderkey % 11 = 0"), F.concat(F.lit("ZZ "), F.col("c_name")), "xxxxxx")
    second_mask = rows(cards.filter("o_orderkey % 13 = 0"), F.col("c_name"), "******")
    return rows(cards, F.col("c_name"), "xxxxxx").unionAll(second_name).unionAll(second_mask)


def settlement_files(spark: SparkSession, sf: str) -> DataFrame:
    """The settlement feed as read from one file per month."""
    month = F.date_format(F.to_date(F.substring("store_transaction_date_time", 1, 10), "MM/dd/yyyy"), "yyyyMM01")
    return settlement(spark, sf).withColumn("file_dt", month.cast("int"))


def trans_disc_xref(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    lines = _order_lines(spark, sf) if lines is None else lines
    return _feed(
        lines.filter("l_discount > 0"), "trans_disc_xref", _dt(),
        SourceTransactionItemNumber=_item_number(), DiscountCode=_code(), DiscountAmt=_text("l_discount"),
    )


def discounts(spark: SparkSession, sf: str, lines: DataFrame | None = None) -> DataFrame:
    """Every code of every date, one of them listed twice."""
    lines = _order_lines(spark, sf, numbered=False) if lines is None else lines
    codes = lines.filter("l_discount > 0").select(_code().alias("code"), _dt().alias("d")).distinct()
    rows = _feed(
        codes, "discounts", F.col("d"), discountcode=F.col("code"),
        discountdescription=F.concat(F.col("code"), F.lit(" percent")), discounttype=F.lit("PCT"),
    )
    return rows.unionAll(rows.filter(F.col("discountcode") == "D5"))


def product(spark: SparkSession, sf: str) -> DataFrame:
    return _feed(
        table(spark, sf, "part"), "product", F.lit(DIMENSION_DT),
        SourceProductNumber=_text("p_partkey"), Name=F.col("p_name"), BrandName=F.col("p_brand"),
        Size=_text("p_size"), SourceProductCategoryNumber=F.col("p_type"), DateCreated=F.lit(DIMENSION_DAY),
    )


def product_category(spark: SparkSession, sf: str) -> DataFrame:
    return _feed(
        table(spark, sf, "part").select("p_type").distinct(), "product_category", F.lit(DIMENSION_DT),
        SourceCategoryNumber=F.col("p_type"), Name=F.concat(F.lit("Category "), F.col("p_type")),
        DateCreated=F.lit(DIMENSION_DAY),
    )


def organization(spark: SparkSession, sf: str) -> DataFrame:
    stores = (
        table(spark, sf, "supplier")
        .join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return _feed(
        stores, "organization", F.lit(DIMENSION_DT), SourceOrganizationNumberkey=_text("s_suppkey"),
        Name=F.col("s_name"), State=F.col("n_name"), Country=F.col("r_name"),
    )


_MAKERS = {
    "transactions": transactions, "tenders": tenders, "transaction_item": transaction_item,
    "trans_disc_xref": trans_disc_xref, "product": product, "product_category": product_category,
    "organization": organization, "discounts": discounts, "settlement": settlement,
}


_OF_LINES = ("transaction_item", "trans_disc_xref", "discounts")


def raw_feeds(spark: SparkSession, sf: str, *names: str, complete: bool = False, again: bool = False) -> dict[str, DataFrame]:
    """The named feeds (all if none is named) as they would lie on disk: text, plus ``dt``.

    The order lines are dealt, numbered and joined to their orders once where several feeds are made of them, or one is read
    ``again``.
    """
    names = names or tuple(_MAKERS)
    of_lines = [n for n in names if n in _OF_LINES]
    shared = {"lines": _stored_lines(spark, sf)} if of_lines and (again or len(of_lines) > 1) else {}
    feeds = {n: _MAKERS[n](spark, sf, **(shared if n in _OF_LINES else {})) for n in names}
    if complete and "transaction_item" in feeds:
        feeds["transaction_item"] = transaction_item(spark, sf, complete=True, **shared)
    return feeds


def feeds(spark: SparkSession, sf: str, *names: str, complete: bool = False, again: bool = False) -> dict[str, DataFrame]:
    return type_feeds(raw_feeds(spark, sf, *names, complete=complete, again=again))


# --- notifications -----------------------------------------------------------------------------------------------------

_EVENT_FOLDER = {
    "click": "brand_a/daily/", "view": "brand_b/daily/", "purchase": "brand_a/weekly/", "signup": "brand_b/weekly/",
    "error": "other/logs/",
}
_STAGING_FOLDER = {"purchase": "brand_a/weekly_staging/", "signup": "brand_b/weekly_staging/"}
_DIMENSION_FEEDS = ("product", "product_category", "organization")


def _lookup(mapping: dict[str, str], c: Column) -> Column:
    out = F.lit(None).cast("string")
    for key, value in mapping.items():
        out = F.when(c == key, value).otherwise(out)
    return out


def _as_json(df: DataFrame) -> DataFrame:
    """(event_time, key, size) -> the notification text an object store sends."""
    return as_notifications(df)


def as_notifications(df: DataFrame, *kept: str) -> DataFrame:
    """The same with the columns ``kept``."""
    return df.select(*kept, F.to_json(F.struct(F.array(F.struct(
        F.col("event_time").alias("eventTime"),
        F.struct(
            F.struct(F.lit("landing").alias("name")).alias("bucket"),
            F.struct("key", "size").alias("object"),
        ).alias("s3"),
    )).alias("Records"))).alias("value"))


def arrival_keys(spark: SparkSession, sf: str) -> DataFrame:
    """One announced file per event; weekly dimensions lie in the weekly staging folder."""
    events = table(spark, sf, "events")
    feed = F.element_at(F.array(*[F.lit(f) for f in POS_FEEDS]), (F.col("user_id") % 8 + 1).cast("int"))
    day = F.date_format("ts", "yyyyMMdd")
    staged = feed.isin(*_DIMENSION_FEEDS) & F.col("event_type").isin(*_STAGING_FOLDER)
    folder = F.when(staged, _lookup(_STAGING_FOLDER, F.col("event_type"))).otherwise(
        _lookup(_EVENT_FOLDER, F.col("event_type"))
    )
    name = F.concat(F.lit("feed_"), feed, F.lit("_"), day, F.lit(".psv.gz"))
    return events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        F.concat(folder, feed, F.when(staged, F.concat(F.lit("/dt="), day)).otherwise(""), F.lit("/"), name).alias("key"),
        F.col("event_id").alias("size"),
    )


def notifications(spark: SparkSession, sf: str) -> DataFrame:
    return _as_json(arrival_keys(spark, sf))


def settlement_dates(spark: SparkSession, sf: str) -> DataFrame:
    """Days whose settlement file has come; each seventh day's has not."""
    day = table(spark, sf, "events").filter(F.dayofmonth("ts") % 7 != 0)
    return day.select(F.date_format("ts", "yyyyMMdd").cast("int").alias("dt")).distinct()


def settlement_notifications(dates: DataFrame, time: str = "2024-01-01 00:00:00") -> DataFrame:
    """One announced settlement file per day."""
    return _as_json(dates.select(
        F.lit(time).alias("event_time"), F.concat(F.lit("settlement/SETTLE_"), "dt", F.lit(".csv")).alias("key"),
        F.lit(1).cast("long").alias("size"),
    ))


def order_months(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(_dt().cast("int").alias("dt")).distinct()


def order_notifications(spark: SparkSession, sf: str) -> DataFrame:
    """Daily arrivals of the order months, one per feed; the tenders of each July have not come."""
    arrived = order_months(spark, sf).select("dt", F.explode(F.array(*[F.lit(f) for f in POS_FEEDS])).alias("feed")).filter(
        ~((F.col("feed") == "tenders") & (F.floor(F.col("dt") / 100) % 100 == 7))
    )
    return _as_json(arrived.select(
        F.lit("2024-01-01 00:00:00").alias("event_time"),
        F.concat(F.lit("brand_a/daily/"), "feed", F.lit("/feed_"), "feed", F.lit("_"), "dt", F.lit(".psv.gz")).alias("key"),
        F.length("feed").cast("long").alias("size"),
    ))
