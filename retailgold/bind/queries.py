"""One query per operator over the star-schema binding."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailgold.bind import star
from retailgold.functions import (
    card_prefix, card_suffix, check_id, date_from_name, feed_folder, key_part, lenient_date, lenient_double, lenient_int,
    settlement_date,
)
from retailgold.operators import arrivals, gold, quality, selection
from retailgold.operators.typed import type_feeds, type_line_items, type_settlement, type_tenders, type_transactions
from retailgold.plans import GateFailure, run, run_paths, stage_feeds, stage_settlement
from retailgold.schemas import DIMENSIONS, GOLD_TABLES, POS_FEEDS, STAGING_OF, conform, from_history, history_columns
from retailgold.session import configure, file_system, scratch_dir
from retailgold.sinks import (
    archive_feed, archive_summary, carry_over_dimensions, commit_gold, gold_manifest, publish, published_files, read_audit, read_manifest,
    read_rejects, stage_bucketed, stage_gold, store, write_audit, write_gold,
)
from retailgold.snapshots import current_parts, new_run
from retailgold.sources import create_external_table, list_files, read_feed, read_gold, read_settlement, run_sql, sync_partitions
from retailgold.streaming import (
    read_date_states, read_notifications, read_ready, read_rejected, stream_arrivals, stream_completeness, stream_date_states, stream_gold,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
AS_OF = "20240131"
# build order of the tables, as the registered run queries report it
RUN_ORDER = {t: i for i, t in enumerate(GOLD_TABLES)}


def query(fn: Query) -> Query:
    """Register under the function's name; a trailing underscore only keeps it apart from the operator's."""
    def configured(spark: SparkSession, sf: str) -> DataFrame:
        return _plain(fn(configure(spark), sf))

    _QUERIES[fn.__name__.rstrip("_")] = configured
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _plain(df: DataFrame) -> DataFrame:
    """Lower-case names and ISO text for days, so that two engines can be compared."""
    return df.select(*[
        (F.col(f"`{f.name}`").cast("string") if isinstance(f.dataType, T.DateType) else F.col(f"`{f.name}`"))
        .alias(f.name.lower()) for f in df.schema
    ])


def _tagged(parts: dict[str, DataFrame], name: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [df.withColumn(name, F.lit(tag)) for tag, df in parts.items()])


def _bucketed(spark: SparkSession, sf: str, *names: str) -> dict[str, DataFrame]:
    path = scratch_dir(spark, "bucketed")
    return stage_bucketed(star.feeds(spark, sf, *names), path, "b" + path.rsplit("-", 1)[-1], spark.sparkContext.defaultParallelism)


# --- files for the scans ---------------------------------------------------------------------------------------------

def write_feed_files(df: DataFrame, path: str, feed: str) -> None:
    """A raw feed as it arrives: gzip, pipes, ``\\N`` for NULL, one folder per date (several files for a large one)."""
    (
        df.hint("rebalance", "dt").write.partitionBy("dt").option("sep", "|").option("header", True)
        .option("nullValue", "\\N").option("compression", "gzip").csv(f"{path}/{feed}")
    )


def _feed_files(spark: SparkSession, sf: str, feed: str) -> str:
    path = scratch_dir(spark, "feeds")
    write_feed_files(star.raw_feeds(spark, sf, feed)[feed], path, feed)
    return path


@query
def scan_feed_psv(spark, sf):
    return read_feed(spark, _feed_files(spark, sf, "transaction_item"), "transaction_item")


@query
def scan_settlement_glob(spark, sf):
    path = scratch_dir(spark, "settlement")
    raw = star.settlement(spark, sf)
    raw.write.option("header", True).option("nullValue", "\\N").csv(path)
    return read_settlement(spark, f"{path}/part-*").select(*raw.columns)


@query
def scan_feed_header_drift(spark, sf):
    """Dates whose files have the documented columns, a new one in front, or the documented ones in another order."""
    path = scratch_dir(spark, "drift")
    raw = star.transactions(spark, sf)
    names = [c for c in raw.columns if c != "dt"]
    kind = F.floor(F.col("dt") / 10000) % 3
    for k, columns in enumerate((names, None, names[::-1])):
        part = raw.filter(kind == k)
        part = part.select(*columns, "dt") if columns else part.select(F.lit("new").alias("newcol"), *names, "dt")
        part.hint("rebalance", "dt").write.mode("append").partitionBy("dt").option("sep", "|").option("header", True).option(
            "nullValue", "\\N").option("compression", "gzip").csv(f"{path}/transactions")
    drifted = read_feed(spark, path, "transactions")
    return drifted.select(
        "SourceTransactionNumber", F.coalesce("RegisterNumber", F.lit("")).alias("registernumber"), "newcol", "DateCreated", "dt"
    )


def _settlement_files(spark: SparkSession, df: DataFrame, path: str, name: str = "SETTLE") -> None:
    """One file per ``file_dt`` with the date in its name."""
    sorted_days = [r["file_dt"] for r in df.select("file_dt").distinct().orderBy("file_dt").collect()]
    staged = f"{path}/_by_day"
    (
        df.repartition("file_dt").withColumn("day", F.col("file_dt")).drop("file_dt").write.mode("overwrite").partitionBy("day")
        .option("header", True).option("nullValue", "\\N").csv(staged)
    )
    fs, _ = file_system(spark, path)
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for day in sorted_days:
        for i, found in enumerate(fs.globStatus(of(f"{staged}/day={day}/part-*"))):
            fs.rename(found.getPath(), of(f"{path}/{name}_{i}_{day}.csv"))
    fs.delete(of(staged), True)


@query
def scan_settlement_header_drift(spark, sf):
    """Every second month's file has a new column in front."""
    path = scratch_dir(spark, "drift")
    raw = star.settlement_files(spark, sf)
    new = F.floor(F.col("file_dt") / 100) % 100 % 2 == 0
    _settlement_files(spark, raw.filter(~new), path, "SETTLE_A")
    _settlement_files(spark, raw.filter(new).select(F.lit("new").alias("newcol"), *raw.columns), path, "SETTLE_B")
    return read_settlement(spark, f"{path}/SETTLE_*").select("store_id", "customer_name", "masked_card_number", "newcol", "file_dt")


@query
def scan_partitioned_dt(spark, sf):
    feed = read_feed(spark, _feed_files(spark, sf, "transactions"), "transactions", declared=False)
    return quality.counts_per_date(feed)


@query
def scan_gold_readback(spark, sf):
    path = scratch_dir(spark, "readback")
    built = _stored(spark, gold.line_item(star.feeds(spark, sf, "transactions", "transaction_item")))
    write_gold(built, path, "transaction_item")
    return read_gold(spark, path, "transaction_item")


@query
def scan_feed_two_headers(spark, sf):
    """Every date has two files, one with a new column in front and the documented ones in reverse."""
    path = scratch_dir(spark, "headers")
    raw = star.transactions(spark, sf)
    names = [c for c in raw.columns if c != "dt"]
    first = F.col("SourceTransactionNumber").try_cast("bigint") % 2 == 0
    for part in (raw.filter(first), raw.filter(~first).select(F.lit("new").alias("newcol"), *names[::-1], "dt")):
        part.hint("rebalance", "dt").write.mode("append").partitionBy("dt").option("sep", "|").option("header", True).option(
            "nullValue", "\\N").option("compression", "gzip").csv(f"{path}/transactions")
    return read_feed(spark, path, "transactions").select(
        "SourceTransactionNumber", F.coalesce("RegisterNumber", F.lit("")).alias("registernumber"), "newcol", "DateCreated", "dt"
    )


@query
def scan_feed_rejects(spark, sf):
    """Every 50th line has a field too many and every 50th one too few: rows per date, and those set aside when they land."""
    path = scratch_dir(spark, "rejects")
    raw = star.transactions(spark, sf)
    names = [c for c in raw.columns if c != "dt"]
    text = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("\\N")) for c in names])
    lot = F.col("SourceTransactionNumber").try_cast("bigint") % 50
    line = F.when(lot == 0, F.concat(text, F.lit("|more"))).when(lot == 1, F.regexp_replace(text, r"\|[^|]*$", "")).otherwise(text)
    raw.select(line.alias("|".join(names)), "dt").hint("rebalance", "dt").write.partitionBy("dt").option("sep", "\u0001").option(
        "quote", "").option("header", True).option("compression", "gzip").csv(f"{path}/in/transactions")
    landed = archive_feed(read_feed(spark, f"{path}/in", "transactions", rejects=True), f"{path}/archive", "transactions")
    aside = read_rejects(spark, f"{path}/archive", ["transactions"])
    zero = F.lit(0).cast("bigint")
    both = landed.select("dt", F.lit(1).alias("good")).unionByName(aside.select("dt", F.lit(0).alias("good")))
    longer = aside.groupBy("dt").agg(F.count_if(F.col("line").endswith("|more")).alias("longer"))
    return both.groupBy("dt").agg(F.count_if(F.col("good") == 1).alias("rows"), F.count_if(F.col("good") == 0).alias("rejected")).join(
        longer, "dt", "left").withColumn("longer", F.coalesce("longer", zero))


@query
def scan_gold_readback_drift(spark, sf):
    """Two runs whose dates have different unknown columns after the contract's."""
    path = scratch_dir(spark, "drift")
    built = gold.transactions(star.feeds(spark, sf, "transactions"))
    early = F.col("dt") < 19960101
    publish(_stored(spark, built.filter(early).withColumn("colour", F.lit("red"))), path, "transactions")
    publish(_stored(spark, built.filter(~early).withColumn("promo", F.lit("P"))), path, "transactions")
    return read_gold(spark, path, "transactions").select("sourcetransactionnumber", "check_id", "colour", "promo", "partition_col")


@query
def sql_surface_view(spark, sf):
    feeds = star.feeds(spark, sf, "transactions", "tenders")
    return run_sql(spark, feeds, """
        select t.dt, d.tendername, count(*) as tenders, max(d.tenderamt) as largest
        from pos_tenders d join pos_transactions t
          on t.dt = d.dt and t.SourceTransactionNumber = d.sourcetransactionnumber
        group by t.dt, d.tendername""")


@query
def catalog_external_table(spark, sf):
    path = _feed_files(spark, sf, "trans_disc_xref")
    name = "xref_" + path.rsplit("-", 1)[-1]
    return create_external_table(spark, name, f"{path}/trans_disc_xref", "trans_disc_xref", kind="staging")


@query
def catalog_gold(spark, sf):
    path = scratch_dir(spark, "catalog")
    write_gold(_stored(spark, gold.transactions(star.feeds(spark, sf, "transactions"))), path, "transactions")
    name = "gold_" + path.rsplit("-", 1)[-1]
    rows = create_external_table(spark, name, f"{path}/transactions", "transactions")
    return rows.groupBy("partition_col").agg(F.count(F.lit(1)).alias("rows"), F.min("check_id").alias("first_check_id"))


@query
def catalog_history(spark, sf):
    """Gold before 1996 in files of the older layout, later gold as it is published: rows and check ids per table and date."""
    path = scratch_dir(spark, "history")
    feeds = star.feeds(spark, sf, "transactions", "transaction_item")
    month = F.date_format(F.trunc("DateCreated", "month"), "yyyyMMdd")
    parts = {}
    for table, built in (("transactions", gold.transactions(feeds)), ("transaction_item", gold.line_item(feeds))):
        stored, old = _stored(spark, conform(built, table)), F.col("dt") < 19960101
        older = stored.filter(old).select(*[F.col(new).alias(name) for new, name in history_columns(table).items()])
        older.write.option("sep", "|").option("header", True).option("compression", "gzip").option("emptyValue", "").csv(f"{path}/history/{table}")
        publish(stored.filter(~old), f"{path}/gold", table)
        history = create_external_table(spark, f"history_{table}_" + path.rsplit("-", 1)[-1], f"{path}/history/{table}", table, kind="history")
        parts[table] = from_history(history, table, month).unionByName(read_gold(spark, f"{path}/gold", table)).select("dt", "check_id")
    return _tagged(parts, "entity_type").groupBy("entity_type", "dt").agg(
        F.count(F.lit(1)).alias("rows"), F.min("check_id").alias("first_check_id"), F.max("check_id").alias("last_check_id"))


@query
def catalog_sync_partitions(spark, sf):
    """An external table follows two runs, the second of which brings a date again and empties one: rows per date, and what was altered."""
    path = scratch_dir(spark, "sync")
    built = _stored(spark, gold.transactions(star.feeds(spark, sf, "transactions")))
    publish(built.filter("dt >= 19950301"), path, "transactions")
    name = "synced_" + path.rsplit("-", 1)[-1]
    create_external_table(spark, name, f"{path}/transactions", "transactions")
    publish(built.filter("dt in (19950201, 19960101)"), path, "transactions", emptied=lambda dt: dt == 19960201)
    added, dropped = sync_partitions(spark, name, f"{path}/_manifest", "transactions")
    spark.catalog.refreshTable(name)
    counted = spark.table(name).groupBy("partition_col").agg(F.count(F.lit(1)).alias("rows"))
    return counted.withColumns({"added": F.lit(added), "dropped": F.lit(dropped)})


@query
def catalog_archive(spark, sf):
    path = scratch_dir(spark, "catalog")
    archive_feed(star.tenders(spark, sf).hint("rebalance", "dt"), path, "tenders")
    rows = create_external_table(spark, "archive_" + path.rsplit("-", 1)[-1], f"{path}/tenders", "tenders", kind="archive")
    return rows.groupBy("dt").agg(F.count(F.lit(1)).alias("rows"), F.max("tenderamt").alias("largest"))


@query
def catalog_settlement(spark, sf):
    path = scratch_dir(spark, "catalog")
    archive_feed(star.settlement_files(spark, sf).hint("rebalance", "file_dt"), path, "settlement")
    rows = create_external_table(spark, "settled_" + path.rsplit("-", 1)[-1], f"{path}/settlement", "settlement", kind="archive")
    return rows.groupBy("file_dt").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("settlement_day").alias("days"))


# --- typing, projections, filters --------------------------------------------------------------------------------------

@query
def type_settlement_(spark, sf):
    return type_settlement(star.settlement(spark, sf)).select(
        "store_id", "customer_name", "masked_card_number", "approved_amount", "pos_register_number"
    )


@query
def type_transactions_(spark, sf):
    return type_transactions(star.transactions(spark, sf))


@query
def type_line_items_(spark, sf):
    return type_line_items(star.transaction_item(spark, sf))


@query
def type_tenders_(spark, sf):
    return type_tenders(star.tenders(spark, sf))


@query
def gold_organization(spark, sf):
    return gold.organization(star.feeds(spark, sf, "organization"))


@query
def gold_product_category(spark, sf):
    return gold.product_category(star.feeds(spark, sf, "product_category"))


@query
def conform_contract(spark, sf):
    extra = gold.organization(star.feeds(spark, sf, "organization")).withColumn("unknown", F.lit("x"))
    return conform(extra, "organization")


@query
def gold_transactions(spark, sf):
    return gold.transactions(star.feeds(spark, sf, "transactions"))


@query
def filter_missing_key(spark, sf):
    return quality.missing_rows(star.transaction_item(spark, sf), "sourcetransactionnumber")


@query
def filter_start_date(spark, sf):
    return selection.after_start(star.transactions(spark, sf), "19960101")


# --- joins -----------------------------------------------------------------------------------------------------------

@query
def join_tender_transaction(spark, sf):
    return gold.tender_transactions(star.feeds(spark, sf, "tenders", "transactions"))


@query
def gold_tenders(spark, sf):
    return gold.tenders(star.feeds(spark, sf, "tenders", "transactions", "settlement"))


@query
def gold_line_item(spark, sf):
    return gold.line_item(star.feeds(spark, sf, "transactions", "transaction_item"))


@query
def join_xref_item(spark, sf):
    return gold.xref_items(star.feeds(spark, sf, "trans_disc_xref", "transaction_item")).select(
        "x.SourceTransactionItemNumber", "x.DiscountCode", "x.DiscountAmt", "x.dt",
        F.col("i_sourcetransactionnumber").alias("sourcetransactionnumber"),
        F.col("i_sourceproductnumber").alias("sourceproductnumber"),
    )


_DISCOUNT_FEEDS = ("trans_disc_xref", "transaction_item", "transactions", "discounts")


@query
def gold_discounts(spark, sf):
    return gold.discounts(star.feeds(spark, sf, *_DISCOUNT_FEEDS))


@query
def gold_product(spark, sf):
    return gold.product(star.feeds(spark, sf, "product", "product_category"))


@query
def gold_tenders_two_brands(spark, sf):
    """Even stores are one brand, odd ones the other; both look up the same settlement feed."""
    feeds = star.feeds(spark, sf, "tenders", "transactions", "settlement")

    def brand(rest: int) -> DataFrame:
        own = {
            n: df if n == "settlement" else df.filter(F.col("sourceorganizationnumber") % 2 == rest)
            for n, df in feeds.items()
        }
        return gold.tenders(own)

    return _tagged({"brand_a": brand(0), "brand_b": brand(1)}, "brand")


# --- aggregations ------------------------------------------------------------------------------------------------------

@query
def agg_settlement_summary(spark, sf):
    return gold.settlement_summary(star.feeds(spark, sf, "settlement")["settlement"])


@query
def distinct_discount_dim(spark, sf):
    return gold.discount_dimension(star.feeds(spark, sf, "discounts"))


@query
def count_rows(spark, sf):
    return _tagged({n: quality.row_count(df) for n, df in star.raw_feeds(spark, sf).items()}, "feed")


@query
def count_distinct_nullable(spark, sf):
    named = gold.tenders(star.feeds(spark, sf, "tenders", "transactions", "settlement"))
    cards = star.tenders(spark, sf)
    return _tagged({
        "customer_name": named.agg(quality.distinct_with_null("customer_name").alias("distinct_values")),
        "accountnumbermasked": cards.agg(quality.distinct_with_null("accountnumbermasked").alias("distinct_values")),
        "tendername": cards.agg(quality.distinct_with_null("tendername").alias("distinct_values")),
    }, "column_name")


@query
def count_per_dt(spark, sf):
    return quality.counts_per_date(star.transaction_item(spark, sf))


# --- scalar functions --------------------------------------------------------------------------------------------------

def _variants(key: Column, *options: Column) -> Column:
    """One of several texts, by key."""
    chosen = options[-1]
    for i, option in enumerate(options[:-1]):
        chosen = F.when(key % len(options) == i, option).otherwise(chosen)
    return chosen


@query
def fn_check_id(spark, sf):
    raw = star.transactions(spark, sf)
    return raw.select(
        "SourceTransactionNumber",
        check_id(F.col("SourceTransactionNumber"), F.col("postransactionnumber"), F.col("RegisterNumber")).alias("plain"),
        check_id(*[key_part(F.col(c)) for c in ("SourceTransactionNumber", "postransactionnumber", "RegisterNumber")])
        .alias("filled"),
    )


@query
def fn_coalesce_key(spark, sf):
    return star.transactions(spark, sf).select(
        "SourceTransactionNumber", key_part(F.col("RegisterNumber")).alias("register"),
        key_part(F.col("postransactionnumber")).alias("pos_number"),
    )


@query
def fn_settlement_date(spark, sf):
    o = star.table(spark, sf, "orders")
    day = F.col("o_orderdate")
    text = _variants(
        F.col("o_orderkey"),
        F.date_format(day, "MM/dd/yyyy HH:mm:ss"), F.date_format(day, "M/d/yyyy HH:mm"), F.date_format(day, "M/dd/yyyy"),
        F.date_format(day, "yyyy-MM-dd"), F.lit("garbage"), F.lit("13/45/2020 10:00"), F.lit(None).cast("string"),
    )
    return o.select("o_orderkey", settlement_date(text).alias("day"))


def _cards(spark: SparkSession, sf: str) -> DataFrame:
    short = _variants(
        F.col("number").cast("bigint"), F.col("card"), F.substring("card", 1, 5), F.substring("card", 1, 3), F.lit("")
    )
    tenders = star.tenders(spark, sf).select(
        F.col("sourcetransactionnumber").alias("number"), F.col("accountnumbermasked").alias("card")
    )
    return tenders.select("number", short.alias("card"))


@query
def fn_card_suffix(spark, sf):
    return _cards(spark, sf).select("number", card_suffix(F.col("card")).alias("suffix"))


@query
def fn_card_prefix(spark, sf):
    return _cards(spark, sf).select("number", card_prefix(F.col("card")).alias("prefix"))


def _numbers(spark: SparkSession, sf: str) -> DataFrame:
    whole, price = F.col("l_partkey").cast("string"), F.col("l_extendedprice").cast("string")
    return star.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        _variants(
            F.col("l_suppkey"), whole, F.concat(F.lit(" 00"), whole, F.lit(" ")), price, F.concat(F.lit("-"), whole),
            F.concat(F.lit("x"), whole), F.concat(whole, F.lit("00000000000")), F.lit(""),
            F.lit(None).cast("string"), F.concat(F.lit("+"), whole, F.lit(".")),
        ).alias("text"),
    )


@query
def fn_lenient_int(spark, sf):
    return _numbers(spark, sf).withColumn("value", lenient_int(F.col("text")).cast("string"))


@query
def fn_lenient_double(spark, sf):
    return _numbers(spark, sf).withColumn("value", lenient_double(F.col("text")))


@query
def fn_lenient_date(spark, sf):
    day = F.col("l_shipdate")
    text = _variants(
        F.col("l_suppkey"), F.date_format(day, "yyyy-MM-dd"), F.date_format(day, "yyyy-MM-dd HH:mm:ss"),
        F.date_format(day, "MM/dd/yyyy"), F.lit(""), F.lit("2020-13-01"), F.lit(None).cast("string"),
    )
    return star.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", lenient_date(text).alias("day")
    )


@query
def fn_date_from_name(spark, sf):
    return star.arrival_keys(spark, sf).select("event_id", date_from_name(F.col("key")).alias("day"))


@query
def fn_feed_folder(spark, sf):
    routed = arrivals.classify(star.arrival_keys(spark, sf))
    return routed.select("event_id", "feed", feed_folder(F.col("feed")).alias("folder"))


@query
def gold_line_item_bucketed(spark, sf):
    """From staging in which items and transactions lie in buckets of the same number."""
    return gold.line_item(_bucketed(spark, sf, "transactions", "transaction_item"))


@query
def join_tender_transaction_bucketed(spark, sf):
    return gold.tender_transactions(_bucketed(spark, sf, "transactions", "tenders"))


@query
def gold_discounts_bucketed(spark, sf):
    return gold.discounts(_bucketed(spark, sf, "transactions", "transaction_item", "trans_disc_xref", "discounts"))


# --- sinks -----------------------------------------------------------------------------------------------------------

@query
def sink_gold_psv(spark, sf):
    path = scratch_dir(spark, "sink")
    write_gold(_stored(spark, gold.transactions(star.feeds(spark, sf, "transactions"))), path, "transactions")
    return read_gold(spark, path, "transactions")


@query
def sink_one_file_per_dt(spark, sf):
    path = scratch_dir(spark, "sink")
    write_gold(_stored(spark, gold.transactions(star.feeds(spark, sf, "transactions"))), path, "transactions")
    files = published_files(spark, path, "transactions", schedule="daily", as_of=AS_OF)
    return files.groupBy("dt").agg(F.count(F.lit(1)).alias("files"))


@query
def publish_large_date(spark, sf):
    """Files per date at 100 rows a file, their rows, and the sizes of all but the last."""
    path = scratch_dir(spark, "large")
    write_gold(_stored(spark, gold.transactions(star.feeds(spark, sf, "transactions"))), path, "transactions", rows_per_file=100)
    counted = scratch_dir(spark, "counted")
    for files in current_parts(spark, path, "transactions"):  # the files are too many for the driver at once
        part = read_gold(spark, path, "transactions", files).groupBy("dt", F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("n"))
        part.write.mode("append").parquet(counted)
    rows = spark.read.schema(part.schema).parquet(counted)
    small = F.row_number().over(Window.partitionBy("dt").orderBy("n"))
    # a date's smallest file is its last part, or its only one
    return rows.withColumn("k", small).withColumn("files", F.count(F.lit(1)).over(Window.partitionBy("dt"))).groupBy("dt", "files").agg(
        F.sum("n").alias("rows"), F.max("n").alias("largest"),
        F.min(F.when((F.col("k") > 1) | (F.col("files") == 1), F.col("n"))).alias("smallest_but_last"),
    )


@query
def gold_file_names(spark, sf):
    feeds = star.feeds(spark, sf, "transactions", "transaction_item", "organization")
    tables = {
        "transactions": gold.transactions(feeds), "transaction_item": gold.line_item(feeds),
        "organization": gold.organization(feeds),
    }
    return reduce(DataFrame.unionByName, [
        gold_manifest(df, t, schedule=schedule, as_of=AS_OF).withColumn("schedule", F.lit(schedule))
        for t, df in tables.items() for schedule in ("daily", "weekly")
    ])


def _stored(spark: SparkSession, df: DataFrame) -> DataFrame:
    """A table written to the scratch folder, as a run has it when it publishes."""
    return store(df, scratch_dir(spark, "built"))


@query
def publish_gold(spark, sf):
    path = scratch_dir(spark, "publish")
    built = _stored(spark, gold.line_item(star.feeds(spark, sf, "transactions", "transaction_item")))
    publish(built, path, "transaction_item")
    names = published_files(spark, path, "transaction_item", schedule="daily", as_of=AS_OF).select("dt", "file_name")
    return read_gold(spark, path, "transaction_item").groupBy("dt").agg(
        F.count(F.lit(1)).alias("rows"), F.min("check_id").alias("first_check_id"),
        F.max("check_id").alias("last_check_id"),
    ).join(names, "dt")


@query
def publish_crash_between_tables(spark, sf):
    """A second run of two tables dies when the files of one are written; then it comes again and ends.

    Rows per table, date and currency after each.
    """
    path = scratch_dir(spark, "crash")
    feeds = star.feeds(spark, sf, "transactions", "transaction_item")
    items = _stored(spark, gold.line_item(feeds))
    first = {"transactions": _stored(spark, gold.transactions(feeds)), "transaction_item": items}
    second = {"transactions": _stored(spark, first["transactions"].withColumn("Currency", F.lit("EUR"))), "transaction_item": items}

    def seen(state: str) -> DataFrame:
        transactions = read_gold(spark, path, "transactions").select("dt", F.col("Currency").alias("currency"))
        all_rows = _tagged({"transactions": transactions, "transaction_item": read_gold(spark, path, "transaction_item").select(
            "dt", F.lit(None).cast("string").alias("currency"))}, "entity_type")
        counted = all_rows.groupBy("entity_type", "dt", "currency").agg(F.count(F.lit(1)).alias("rows"))
        out = scratch_dir(spark, "seen")
        counted.withColumn("state", F.lit(state)).write.parquet(out)  # the next run removes the files it replaces
        return spark.read.parquet(out)

    def finished(tables: dict[str, DataFrame]) -> None:
        name = new_run()
        for table, df in tables.items():
            stage_gold(df, path, table, 5_000_000, run=name)
        commit_gold(spark, path, list(tables), name)

    finished(first)
    stage_gold(second["transactions"], path, "transactions", 5_000_000)
    crashed = seen("crashed")
    finished(second)
    return crashed.unionByName(seen("finished"))


@query
def rerun_date_idempotent(spark, sf):
    path = scratch_dir(spark, "rerun")
    built = _stored(spark, gold.transactions(star.feeds(spark, sf, "transactions")))
    publish(built, path, "transactions")
    again = _stored(spark, selection.select_dates(built, "19960101:19961231").withColumn("Currency", F.lit("EUR")))
    publish(again, path, "transactions")
    publish(again, path, "transactions")
    return read_gold(spark, path, "transactions").select("sourcetransactionnumber", "Currency", "check_id", "dt")


@query
def rerun_date_emptied(spark, sf):
    """A second run of one month that has no transactions any more."""
    path = scratch_dir(spark, "emptied")
    built = _stored(spark, gold.transactions(star.feeds(spark, sf, "transactions")))
    publish(built, path, "transactions")
    month = "19960301:19960401"
    again = _stored(spark, selection.select_dates(built, month).filter("dt <> 19960301"))
    publish(again, path, "transactions", emptied=lambda dt: selection.spec_holds(month, dt))
    return quality.counts_per_date(read_gold(spark, path, "transactions"))


@query
def sink_audit_log(spark, sf):
    path = scratch_dir(spark, "audit")
    write_audit(_audit(spark, sf), path)
    return _audit_columns(read_audit(spark, path))


@query
def archive_feed_(spark, sf):
    path = scratch_dir(spark, "archive")
    raw = star.raw_feeds(spark, sf, "tenders")
    raw["settlement"] = star.settlement_files(spark, sf)
    stored = {
        feed: archive_feed(df.hint("rebalance", "file_dt" if feed == "settlement" else "dt"), path, feed)
        for feed, df in raw.items()
    }
    return stored["tenders"].select(
        F.lit("tenders").alias("feed"), F.col("dt").cast("string").alias("part"),
        F.col("accountnumbermasked").alias("card"), F.col("tenderamt").alias("amount"),
    ).unionByName(stored["settlement"].select(
        F.lit("settlement").alias("feed"), F.col("file_dt").cast("string").alias("part"),
        F.col("masked_card_number").alias("card"), F.col("approved_amount").alias("amount"),
    ))


@query
def stage_incremental(spark, sf):
    """Settlement files in two deliveries; the second staging lands new files only: rows per file, and whether it came second."""
    base = scratch_dir(spark, "incremental")
    raw = star.settlement_files(spark, sf)
    _settlement_files(spark, raw.filter("file_dt < 19970101"), f"{base}/in")
    stage_settlement(spark, f"{base}/in/SETTLE_*", f"{base}/archive", "19900101")
    first = {r["path"] for r in list_files(spark, f"{base}/archive/settlement").select("path").collect()}
    _settlement_files(spark, raw.filter("file_dt >= 19970101"), f"{base}/in")
    archive = stage_settlement(spark, f"{base}/in/SETTLE_*", f"{base}/archive", "19900101")
    # files of the first delivery that were written again would have other names
    kept = spark.createDataFrame([(p,) for p in first], "path string")
    rows = archive.groupBy("file_dt", F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("n"))
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    known = rows.join(kept.select(plain(F.col("path")).alias("p"), F.lit(False).alias("new")), plain(F.col("path")) == F.col("p"), "left")
    return known.groupBy(F.col("file_dt").cast("string").alias("file")).agg(
        F.sum("n").alias("rows"), F.bool_and(F.coalesce("new", F.lit(True))).alias("second")
    )


@query
def agg_settlement_incremental(spark, sf):
    """Files summarised one delivery after the other; the first is delivered wrong, comes again, and replaces only itself."""
    path = scratch_dir(spark, "summary")
    raw = star.settlement_files(spark, sf).hint("rebalance", "file_dt")
    early = F.col("file_dt") < 19970101
    archive_summary(raw.filter(early).withColumn("customer_name", F.lit("A wrong name")), path)
    archive_summary(raw.filter(~early), path)
    parts = archive_summary(raw.filter(early), path)
    return gold.merged_summary(parts)


@query
def carry_over_dimensions_(spark, sf):
    path = scratch_dir(spark, "weekly")
    staged = carry_over_dimensions(star.raw_feeds(spark, sf, *DIMENSIONS), path)
    return _tagged({f: df.select("Name", "dt") for f, df in staged.items()}, "feed")


# --- data quality ------------------------------------------------------------------------------------------------------

# of the line items, what the checks and the discounts read
_CHECKED_ITEM_COLUMNS = (
    "DateCreated", "SourceTransactionNumber", "SourceTransactionItemNumber", "SourceOrganizationNumber", "InvoiceDate", "ShipDate",
    "SourceProductNumber", "check_id", "transactiontimestamp", "dt", "partition_col",
)


def _all_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Line items are built once, for their own check and for the discounts, and tenders, whose rows and names are counted apart."""
    feeds = star.feeds(spark, sf)
    items = _stored(spark, gold.line_item(feeds).select(*_CHECKED_ITEM_COLUMNS))
    tenders = _stored(spark, gold.tenders(feeds).select("check_id", "customer_name", "dt", "partition_col"))
    built = {t: gold.BUILDERS[t](feeds) for t in GOLD_TABLES if t not in ("transaction_item", "tenders", "discounts")}
    built |= {"transaction_item": items, "tenders": tenders, "discounts": gold.discounts(feeds, line_items=items)}
    sides = [quality.gold_side(t, built[t]) for t in GOLD_TABLES]
    return quality.metrics(sides + [quality.staging_side(t, feeds[STAGING_OF[t]]) for t in GOLD_TABLES], GOLD_TABLES)


@query
def dq_reconcile(spark, sf):
    return quality.evaluate(_all_metrics(spark, sf)).select(
        "entity_type", "source_count", "destination_count", "event_result"
    )


@query
def dq_reconcile_by_date(spark, sf):
    """One row moved from one date to another: totals agree, two dates do not."""
    feeds = star.feeds(spark, sf, "transactions")
    built = gold.transactions(feeds)
    row = built.agg(F.min("SourceTransactionNumber").alias("n"), F.min("dt").alias("d"), F.max("dt").alias("e")).first()
    other = F.when(F.col("dt") == row["e"], row["d"]).otherwise(row["e"])
    wrong = built.withColumn("dt", F.when(F.col("SourceTransactionNumber") == row["n"], other).otherwise(F.col("dt")))
    return quality.evaluate(quality.table_metrics("transactions", wrong, feeds["transactions"])).select(
        "entity_type", "source_count", "destination_count", "dates_differing", "reason", "event_result"
    )


@query
def dq_name_gate_success(spark, sf):
    """Every tender under a name of its own."""
    feeds = star.feeds(spark, sf, "tenders", "transactions")
    named = gold.tender_transactions(feeds).withColumn("customer_name", F.col("sourcetransactionnumber"))
    measured = quality.table_metrics("tenders", named, feeds["tenders"])
    return quality.evaluate(measured).select("source_count", "destination_count", "distinct_names", "event_result")


@query
def dq_mandatory_fields(spark, sf):
    """Transactions that kept the NULLs of their key parts: each table then has rows without a check id."""
    raw = star.raw_feeds(spark, sf, "settlement", *_DISCOUNT_FEEDS, "tenders")
    feeds = type_feeds(raw)
    feeds["transactions"] = raw["transactions"].withColumns({
        "SourceOrganizationNumber": lenient_int(F.col("SourceOrganizationNumber")),
        "DateCreated": lenient_date(F.col("DateCreated")),
    })
    return quality.metrics(
        [quality.gold_side(t, gold.BUILDERS[t](feeds)) for t in quality.CHECK_ID_TABLES]
    ).select("entity_type", "destination_count", "missing_check_id", "missing_timestamp")


@query
def dq_tender_match_rate(spark, sf):
    feeds = star.feeds(spark, sf, "tenders", "transactions", "settlement")
    measured = quality.table_metrics("tenders", gold.tenders(feeds), feeds["tenders"])
    return quality.evaluate(measured).select(
        "source_count", "destination_count", "distinct_names", "name_ratio", "event_result"
    )


@query
def dq_counts_by_date(spark, sf):
    feeds = star.feeds(spark, sf, "transactions", "transaction_item")
    return quality.counts_by_date(gold.line_item(feeds), feeds["transaction_item"])


def _lost_and_doubled(spark, sf):
    """Line items of which each date's first is doubled and its last is lost: counts agree on every date."""
    feeds = star.feeds(spark, sf, "transactions", "transaction_item", complete=True, again=True)
    built = _stored(spark, gold.line_item(feeds))
    ends = built.groupBy("dt").agg(F.min("sourcetransactionitemnumber").alias("low"), F.max("sourcetransactionitemnumber").alias("high"))
    key = F.col("sourcetransactionitemnumber")
    marked = built.join(F.broadcast(ends), "dt").where((key != F.col("high")) | (F.col("low") == F.col("high")))
    again = marked.where((key == F.col("low")) & (F.col("low") != F.col("high")))
    wrong = marked.unionByName(again).drop("low", "high")
    return wrong, feeds


@query
def dq_fingerprint_by_date(spark, sf):
    """In odd months a row is lost and another is doubled."""
    wrong, feeds = _lost_and_doubled(spark, sf)
    odd = F.floor(F.col("dt") / 100) % 2 == 1
    right = gold.line_item(feeds).filter(~odd)
    return quality.contents_by_date(wrong.filter(odd).unionByName(right), feeds["transaction_item"])


@query
def dq_differing_rows(spark, sf):
    """The rows behind it, by their number."""
    wrong, feeds = _lost_and_doubled(spark, sf)
    return quality.differing_rows(wrong, feeds["transaction_item"], ["sourcetransactionitemnumber"])


@query
def dq_zero_rows(spark, sf):
    """A category list of another day leaves no product."""
    feeds = star.feeds(spark, sf, "product", "product_category")
    feeds["product_category"] = feeds["product_category"].withColumn("dt", F.col("dt") + 1)
    measured = quality.table_metrics("product", gold.product(feeds), feeds["product"])
    return quality.evaluate(measured).select("entity_type", "source_count", "destination_count", "reason", "event_result")


_EPOCH = "2024-01-31 00:00:00"


def _audit(spark: SparkSession, sf: str) -> DataFrame:
    return quality.audit_rows(
        quality.evaluate(_all_metrics(spark, sf)), brand="brand_a", ingestion_date="2024-01-31", source="staging",
        destination="gold", start=F.lit(_EPOCH), end=F.lit(_EPOCH), notes={"SCHEDULE": "daily"},
    )


def _audit_columns(rows: DataFrame) -> DataFrame:
    return rows.select(
        "BRAND_SID", "EVENT_TYPE", "DATA_CATEGORY", "INGESTION_DATE", "ENTITY_TYPE", "SOURCE_COUNT", "DESTINATION_COUNT",
        "EVENT_RESULT", F.get_json_object("EVENT_NOTES", "$.SCHEDULE").alias("note_schedule"),
    )


@query
def audit_rows(spark, sf):
    return _audit_columns(_audit(spark, sf))


@query
def dq_gate(spark, sf):
    """A run over feeds whose items partly lack their transaction: it stops there and publishes nothing."""
    base = scratch_dir(spark, "gate")
    try:
        run(
            spark, star.raw_feeds(spark, sf), f"{base}/gold", audit_path=f"{base}/audit", brand="brand_a",
            schedule="daily", as_of=AS_OF,
        )
    except GateFailure:
        pass
    return read_audit(spark, f"{base}/audit").select("ENTITY_TYPE", "SOURCE_COUNT", "DESTINATION_COUNT", "EVENT_RESULT")


@query
def run_daily(spark, sf):
    """A whole run from feed files to published gold: rows per table and date, read back from the published files."""
    base = scratch_dir(spark, "run")
    arrived = {}
    for feed, df in star.raw_feeds(spark, sf, *POS_FEEDS, complete=True).items():
        write_feed_files(df, f"{base}/landing", feed)
        arrived[feed] = read_feed(spark, f"{base}/landing", feed)
    arrived["settlement"] = star.settlement_files(spark, sf).hint("rebalance", "file_dt")
    raw = stage_feeds(arrived, f"{base}/archive")
    run(spark, raw, f"{base}/gold", audit_path=f"{base}/audit", brand="brand_a", schedule="daily", as_of=AS_OF)
    return _tagged({t: quality.counts_per_date(read_gold(spark, f"{base}/gold", t)) for t in GOLD_TABLES}, "entity_type")


@query
def run_weekly(spark, sf):
    """Two days of daily runs leave their dimensions; the weekly run takes five feeds, those, and no settlement files."""
    base = scratch_dir(spark, "weekly")
    days, raw = "19950101,19960201", star.raw_feeds(spark, sf, *POS_FEEDS, complete=True)
    carry_over_dimensions({f: raw[f] for f in DIMENSIONS}, f"{base}/weekly_staging")
    for feed in raw:
        if feed not in DIMENSIONS:
            write_feed_files(raw[feed], f"{base}/landing", feed)
    archive_feed(star.settlement_files(spark, sf).hint("rebalance", "file_dt"), f"{base}/archive", "settlement")
    run_paths(
        spark, f"{base}/landing", f"{base}/none/SETTLE_*", f"{base}/archive", f"{base}/gold", dates=days, schedule="weekly",
        dimensions=f"{base}/weekly_staging", audit_path=f"{base}/audit", brand="brand_a", as_of=AS_OF,
    )
    return _tagged({t: quality.counts_per_date(read_gold(spark, f"{base}/gold", t)) for t in GOLD_TABLES}, "entity_type")


@query
def run_manifest(spark, sf):
    base = scratch_dir(spark, "manifest")
    run(
        spark, star.raw_feeds(spark, sf, "transactions", "transaction_item", complete=True), f"{base}/gold", audit_path=f"{base}/audit",
        brand="brand_a", schedule="daily", as_of=AS_OF, tables=("transactions", "transaction_item"),
    )
    return read_manifest(spark, f"{base}/gold").select("entity_type", "dt", "part", "file_name")


@query
def run_manifest_two_runs(spark, sf):
    """Two weekly runs, the second of a later day with fewer tables and dates: names that were published stay."""
    base = scratch_dir(spark, "manifest")
    feeds = star.raw_feeds(spark, sf, "transactions", "transaction_item", complete=True)
    for as_of, dates, tables in (("20240131", "19950101:19951201", ("transactions", "transaction_item")), ("20240207", "19951201:19960201", ("transactions",))):
        run(
            spark, feeds, f"{base}/gold", audit_path=f"{base}/audit", brand="brand_a", schedule="weekly", as_of=as_of, dates=dates, tables=tables,
        )
    return read_manifest(spark, f"{base}/gold").select("entity_type", "dt", "part", "file_name")


# --- arrivals and selection ------------------------------------------------------------------------------------------

@query
def arrivals_parse(spark, sf):
    return arrivals.parse(star.notifications(spark, sf))


@query
def arrivals_malformed(spark, sf):
    """Of ten notifications one is cut off, one has a record without a key and one has no text: how many there are of each."""
    lot = F.col("size") % 10
    cut = star.as_notifications(star.arrival_keys(spark, sf).withColumn("key", F.when(lot != 4, F.col("key"))), "size")
    text = F.when(lot == 3, F.expr("left(value, length(value) - 5)")).when(lot != 5, F.col("value"))
    bad = arrivals.malformed(cut.select(text.alias("value")))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("notifications"), F.sum("lost").alias("records"))


@query
def arrivals_relevant(spark, sf):
    return arrivals.relevant(star.arrival_keys(spark, sf)).select("event_id", "key")


@query
def arrivals_classify(spark, sf):
    return arrivals.classify(star.arrival_keys(spark, sf)).select("event_id", "key", "brand", "schedule", "place")


@query
def arrivals_feed_date(spark, sf):
    return arrivals.classify(star.arrival_keys(spark, sf)).select("event_id", "file_name", "feed", "dt")


@query
def arrivals_ready(spark, sf):
    return arrivals.ready(arrivals.route(star.notifications(spark, sf)), star.settlement_dates(spark, sf))


@query
def arrivals_missing(spark, sf):
    return arrivals.missing(arrivals.route(star.notifications(spark, sf)), star.settlement_dates(spark, sf))


@query
def arrivals_pending(spark, sf):
    """Files of the first brand that the second brand's arrivals of settled days do not cover yet."""
    routed = arrivals.route(star.notifications(spark, sf))
    staged = routed.filter(F.col("brand") == "brand_b").join(star.settlement_dates(spark, sf), "dt", "left_semi")
    return arrivals.pending(routed.filter(F.col("brand") == "brand_a"), staged).select("key", "feed", "dt", "size")


@query
def select_dates(spark, sf):
    feed = star.transactions(spark, sf).select("SourceTransactionNumber", "dt")
    specs = ("19950301", "19950101,19960201,19990101", "19951101:19960201")
    return _tagged({s: selection.select_dates(feed, s) for s in specs}, "spec")


@query
def select_files_by_date(spark, sf):
    files = arrivals.classify(star.arrival_keys(spark, sf)).withColumnRenamed("file_name", "name")
    return _tagged({
        feed: selection.files_of(files, "feed", feed, "20240115").select("event_id", "name") for feed in POS_FEEDS
    }, "feed")


# --- streams -----------------------------------------------------------------------------------------------------------

def _notification_stream(spark: SparkSession, df: DataFrame, path: str) -> DataFrame:
    """Notifications as files, read back as a stream of three batches, each with a file for every task slot."""
    slots = spark.sparkContext.defaultParallelism
    df.repartition(3 * slots).write.text(path)
    return read_notifications(spark, path, slots)


@query
def stream_arrivals_(spark, sf):
    base = scratch_dir(spark, "stream")
    source = _notification_stream(spark, star.notifications(spark, sf), f"{base}/in")
    stream_arrivals(source, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("key", "size", "brand", "schedule", "place", "feed", "dt")


def _settled(spark: SparkSession, dates: DataFrame) -> DataFrame:
    return star.settlement_notifications(dates)


@query
def stream_ready_dates(spark, sf):
    base = scratch_dir(spark, "stream")
    notices = star.notifications(spark, sf).union(_settled(spark, star.settlement_dates(spark, sf)))
    source = _notification_stream(spark, notices, f"{base}/in")
    stream_completeness(source, f"{base}/ledger", f"{base}/ready", f"{base}/checkpoint").awaitTermination()
    return read_ready(spark, f"{base}/ready").select("brand", "schedule", "dt").distinct()


@query
def stream_ready_late_settlement(spark, sf):
    """All feeds first and their settlement files last, in a second start of the stream."""
    base = scratch_dir(spark, "stream")
    for notices in (star.notifications(spark, sf), _settled(spark, star.settlement_dates(spark, sf))):
        notices.write.mode("append").text(f"{base}/in")
        source = read_notifications(spark, f"{base}/in")
        stream_completeness(source, f"{base}/ledger", f"{base}/ready", f"{base}/checkpoint").awaitTermination()
    return read_ready(spark, f"{base}/ready").select("brand", "schedule", "dt").distinct()


@query
def stream_overdue_dates(spark, sf):
    """Dates that stayed incomplete, from keyed state and timers: a notification of a later time ends their patience."""
    base = scratch_dir(spark, "stream")
    every = star.notifications(spark, sf).union(_settled(spark, star.settlement_dates(spark, sf)))
    later = star.settlement_notifications(spark.range(1).select(F.lit(21000101).alias("dt")), "2100-01-01 00:00:00")
    for notices in (every, later):
        notices.write.mode("append").text(f"{base}/in")
        # the notifications' times are in no order, so event time has to run far behind
        source = read_notifications(spark, f"{base}/in")
        stream_date_states(source, f"{base}/out", f"{base}/checkpoint", delay="3650 days").awaitTermination()
    found = read_date_states(spark, f"{base}/out")
    return found.filter(F.col("state") == "overdue").select("brand", "schedule", "dt", "missing", "has_settlement")


def _stream_months(
    spark: SparkSession, sf: str, base: str, feeds: dict[str, DataFrame], tables: tuple[str, ...] = ("transaction_item",),
) -> None:
    notices = star.order_notifications(spark, sf).union(_settled(spark, star.order_months(spark, sf)))
    source = _notification_stream(spark, notices, f"{base}/in")
    stream_gold(
        source, lambda brand, schedule: feeds, ledger=f"{base}/ledger", out=f"{base}/gold", rejected=f"{base}/rejected",
        audit_path=f"{base}/audit", checkpoint=f"{base}/checkpoint", tables=tables,
    ).awaitTermination()


@query
def stream_gold_line_item(spark, sf):
    base = scratch_dir(spark, "stream")
    _stream_months(spark, sf, base, star.raw_feeds(spark, sf, "transactions", "transaction_item", complete=True, again=True))
    return read_gold(spark, f"{base}/gold/brand_a/daily", "transaction_item")


@query
def stream_gold_rejects_date(spark, sf):
    """One month lost the transaction of its items: rows per published month, and the month that was rejected."""
    base = scratch_dir(spark, "stream")
    feeds = star.raw_feeds(spark, sf, "transactions", "transaction_item", complete=True, again=True)
    number = F.when(F.col("dt") != 19960301, F.col("sourcetransactionnumber"))
    feeds["transaction_item"] = feeds["transaction_item"].withColumn("sourcetransactionnumber", number)
    _stream_months(spark, sf, base, feeds)
    good = quality.counts_per_date(read_gold(spark, f"{base}/gold/brand_a/daily", "transaction_item"))
    bad = read_rejected(spark, f"{base}/rejected")
    return good.select("dt", "rows", F.lit(False).alias("rejected")).unionByName(
        bad.select("dt", F.lit(0).cast("bigint").alias("rows"), F.lit(True).alias("rejected"))
    )


@query
def stream_gold_all_tables(spark, sf):
    """All seven tables; one month's items lost their transaction: rows per table and published month, and the month that was rejected."""
    base = scratch_dir(spark, "stream")
    feeds = star.raw_feeds(spark, sf, complete=True)
    number = F.when(F.col("dt") != 19960301, F.col("sourcetransactionnumber"))
    feeds["transaction_item"] = feeds["transaction_item"].withColumn("sourcetransactionnumber", number)
    months = [r["dt"] for r in star.order_months(spark, sf).orderBy("dt").collect()]
    every = F.array(*[F.lit(m) for m in months])
    for name in ("product_category", "organization"):  # every month has them, a product comes in one month
        feeds[name] = feeds[name].drop("dt").withColumn("dt", F.explode(every))
    number = F.col("SourceProductNumber").try_cast("int")
    feeds["product"] = feeds["product"].withColumn("dt", F.get(every, number % len(months)))
    # stored once, as a landed archive is
    feeds = {name: _landed(spark, df) for name, df in feeds.items()}
    _stream_months(spark, sf, base, feeds, GOLD_TABLES)
    good = _tagged({t: quality.counts_per_date(read_gold(spark, f"{base}/gold/brand_a/daily", t)) for t in GOLD_TABLES}, "entity_type")
    bad = read_rejected(spark, f"{base}/rejected")
    return good.unionByName(bad.select("dt", F.lit(None).cast("bigint").alias("rows"), "entity_type"))


def _landed(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch_dir(spark, "landed")
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
