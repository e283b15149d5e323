"""Reconciliation, mandatory fields, name match rate and the audit row.

Each side of a check is one aggregate by date; the sides meet by ``union`` and second, tiny aggregates.  Everything stays lazy, so the
checks of all tables can run as one job.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailgold.functions import is_missing
from retailgold.schemas import AUDIT_LAYOUT

# --- fixed values ----------------------------------------------------------------------------------------------------
CHECK_ID_TABLES = ("transactions", "transaction_item", "tenders", "discounts")
TIMESTAMP_TABLES = ("transaction_item",)
NAME_TABLE = "tenders"
MIN_NAME_RATIO = 0.2
DATA_CATEGORY = "pos"
SUCCESS, WARNING, FAILURE = "SUCCESS", "WARNING", "FAILURE"
# --- end of fixed values ---------------------------------------------------------------------------------------------

EVENT_TYPE = "gold_run"

# row layout of ``evaluate``
CHECKED_LAYOUT = (
    "entity_type string, source_count bigint, destination_count bigint, missing_check_id bigint, missing_timestamp bigint, "
    "distinct_names bigint, dates_differing bigint, name_ratio double, reason string, event_result string"
)
_METRICS = ("source_count", "destination_count", "missing_check_id", "missing_timestamp", "distinct_names")
DATED_LAYOUT = "entity_type string, dt int, " + ", ".join(f"{m} bigint" for m in _METRICS)


def missing_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose mandatory column is NULL or empty."""
    return df.filter(is_missing(F.col(column)))


def distinct_with_null(column: str) -> Column:
    """Distinct values, where NULL is one value too."""
    return F.count_distinct(F.col(column)) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


def counts_per_date(df: DataFrame, date: str = "dt") -> DataFrame:
    return df.groupBy(date).agg(F.count(F.lit(1)).alias("rows"))


def _side(table: str, df: DataFrame, by: list[Column], **metrics: Column) -> DataFrame:
    zero = F.lit(0).cast("long")
    rows = df.groupBy(*by).agg(*[metrics.get(m, zero).cast("long").alias(m) for m in _METRICS])
    dt = F.col("dt").cast("int") if by else F.lit(None).cast("int").alias("dt")
    return rows.select(F.lit(table).alias("entity_type"), dt, *_METRICS)


def gold_side(table: str, gold: DataFrame) -> DataFrame:
    """All checks on one gold table by date, in one pass over the columns they need; distinct names go over all dates."""
    metrics = {"destination_count": F.count(F.lit(1))}
    if table in CHECK_ID_TABLES:
        metrics["missing_check_id"] = F.count_if(is_missing(F.col("check_id")))
    if table in TIMESTAMP_TABLES:
        metrics["missing_timestamp"] = F.count_if(is_missing(F.col("transactiontimestamp")))
    dated = _side(table, gold, [F.col("dt")], **metrics)
    if table != NAME_TABLE:
        return dated
    return dated.unionByName(_side(table, gold, [], distinct_names=distinct_with_null("customer_name")))


def staging_side(table: str, staging: DataFrame) -> DataFrame:
    return _side(table, staging, [F.col("dt")], source_count=F.count(F.lit(1)))


def dated_metrics(sides: list[DataFrame]) -> DataFrame:
    """One row per table and date from any number of gold and staging sides."""
    rows = reduce(DataFrame.unionByName, sides)
    return rows.groupBy("entity_type", "dt").agg(*[F.sum(m).alias(m) for m in _METRICS])


def summed(dated: DataFrame, tables: tuple[str, ...] = ()) -> DataFrame:
    """One row per table; ``dates_differing`` counts the dates on which the two sides differ.

    A table without any row on either side is only known if it is among ``tables``.
    """
    if tables:
        dated = dated.unionByName(dated.sparkSession.createDataFrame([(t, None, *[0] * len(_METRICS)) for t in tables], DATED_LAYOUT))
    return dated.groupBy("entity_type").agg(
        *[F.sum(m).alias(m) for m in _METRICS], F.count_if(F.col("source_count") != F.col("destination_count")).alias("dates_differing")
    )


def metrics(sides: list[DataFrame], tables: tuple[str, ...] = ()) -> DataFrame:
    return summed(dated_metrics(sides), tables)


def table_metrics(table: str, gold: DataFrame, staging: DataFrame) -> DataFrame:
    return metrics([gold_side(table, gold), staging_side(table, staging)], (table,))


def evaluate(measured: DataFrame) -> DataFrame:
    """Event result and failure reason per table.

    No rows is a FAILURE for every table.  For tenders anything else that is wrong, also too few distinct names, is a WARNING;
    for the other tables it is a FAILURE.
    """
    is_tender = F.col("entity_type") == NAME_TABLE
    ratio = F.try_divide(F.col("distinct_names").cast("double"), F.col("destination_count").cast("double"))
    empty = F.col("destination_count") == 0
    reasons = F.concat_ws(
        "; ",
        F.when(empty, F.lit("zero rows")),
        F.when(F.col("destination_count") != F.col("source_count"), F.format_string(
            "row count %d differs from staging row count %d", "destination_count", "source_count")),
        F.when((F.col("destination_count") == F.col("source_count")) & (F.col("dates_differing") > 0), F.format_string(
            "row counts of %d dates differ from staging", "dates_differing")),
        F.when(F.col("missing_check_id") > 0, F.format_string("%d rows without check_id", "missing_check_id")),
        F.when(F.col("missing_timestamp") > 0,
               F.format_string("%d rows without transactiontimestamp", "missing_timestamp")),
        F.when(is_tender & ~empty & (ratio <= MIN_NAME_RATIO), F.lit("too few customer names")),
    )
    return (
        measured.withColumn("name_ratio", F.when(is_tender, ratio))
        .withColumn("reason", reasons)
        .withColumn(
            "event_result",
            F.when(empty, FAILURE).when(F.col("reason") == "", SUCCESS).when(is_tender, WARNING).otherwise(FAILURE),
        )
    )


def failing_dates(dated: DataFrame) -> DataFrame:
    """(entity_type, dt, reason) of every table and date that fails on its own, from the metrics by date.

    A date without rows on either side fails nothing here; a table without any is for ``evaluate``.
    """
    each = dated.where("source_count + destination_count > 0").withColumn("dates_differing", F.lit(0).cast("long"))
    return evaluate(each).where(F.col("event_result") == FAILURE).select("entity_type", "dt", "reason")


def counts_by_date(gold: DataFrame, staging: DataFrame) -> DataFrame:
    """Both sides' rows per date; a date that one side lacks counts 0 there."""
    both = counts_per_date(gold).select("dt", F.col("rows").alias("gold_rows"), F.lit(0).alias("staging_rows")).unionByName(
        counts_per_date(staging).select("dt", F.lit(0).alias("gold_rows"), F.col("rows").alias("staging_rows"))
    )
    return both.groupBy("dt").agg(
        F.sum("gold_rows").alias("gold_rows"), F.sum("staging_rows").alias("staging_rows")
    ).withColumn("difference", F.col("gold_rows") - F.col("staging_rows"))


# gold tables that carry every row of their feed with its own columns
CARRIED_TABLES = ("transactions", "product_category", "organization", "transaction_item")
_PRINT = (1 << 31) - 1


def _row_print(df: DataFrame, columns: list[str]) -> Column:
    """A number per row, of the given columns' values; never NULL, and known to be, so that no filter computes it again."""
    return F.coalesce(F.pmod(F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in columns]), F.lit(_PRINT)), F.lit(0))


def carried_columns(gold: DataFrame, staging: DataFrame) -> list[str]:
    """Columns that both sides have, in one order."""
    other = {c.lower() for c in staging.columns}
    return sorted(c.lower() for c in gold.columns if c.lower() in other)


def contents_by_date(gold: DataFrame, staging: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows of both sides per date, and whether they are the same rows as far as ``columns`` go, in any order and each as often.

    A date's fingerprint is the sum of its rows' numbers, so a lost row and a doubled one do not cancel out as their counts do.
    """
    columns = carried_columns(gold, staging) if columns is None else columns

    def side(df: DataFrame, name: str) -> DataFrame:
        counted = df.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum(_row_print(df, columns)).alias("print"))
        zero = F.lit(0).cast("long")
        mine, other = ("gold", "staging") if name == "gold" else ("staging", "gold")
        return counted.select("dt", *[c.alias(a) for c, a in sorted((
            (F.col("n"), f"{mine}_rows"), (F.col("print"), f"{mine}_print"), (zero, f"{other}_rows"), (zero, f"{other}_print")), key=lambda x: x[1])])

    both = side(gold, "gold").unionByName(side(staging, "staging")).groupBy("dt").agg(
        *[F.sum(c).alias(c) for c in ("gold_rows", "staging_rows", "gold_print", "staging_print")]
    )
    same = (F.col("gold_rows") == F.col("staging_rows")) & (F.col("gold_print") == F.col("staging_print"))
    return both.select("dt", "gold_rows", "staging_rows", same.alias("same"))


# a date's rows are narrowed down to so many groups by their numbers
_GROUPS = 256


def _differing_groups(gold: DataFrame, staging: DataFrame, columns: list[str]) -> DataFrame:
    """(dt, groups): of every date whose contents differ the groups of rows that do; a row per calendar day at most."""
    def side(df: DataFrame, sign: int) -> DataFrame:
        rows = df.select("dt", _row_print(df, columns).alias("_print")).groupBy("dt", _group_of("_print").alias("_group"))
        return rows.agg((F.count(F.lit(1)) * sign).alias("n"), (F.sum("_print") * sign).alias("print"))

    both = side(gold, 1).unionByName(side(staging, -1)).groupBy("dt", "_group").agg(F.sum("n").alias("n"), F.sum("print").alias("print"))
    return both.where("n <> 0 or print <> 0").groupBy(F.col("dt").alias("_dt")).agg(F.collect_list("_group").alias("_groups"))


def _group_of(number: str) -> Column:
    return (F.col(number) % _GROUPS).cast("smallint")


def differing_rows(gold: DataFrame, staging: DataFrame, keys: list[str], columns: list[str] | None = None) -> DataFrame:
    """(dt, keys, gold_rows, staging_rows): rows that one side has more often than the other, named by ``keys``.

    Only dates whose contents differ are compared row by row, and of them only the groups of rows that do, so that few rows are
    shuffled.  What is broadcast is a row per calendar day.
    """
    columns = carried_columns(gold, staging) if columns is None else columns
    wrong = F.broadcast(_differing_groups(gold, staging, columns))

    def side(df: DataFrame, mine: int) -> DataFrame:
        rows = df.select("dt", *keys, _row_print(df, columns).alias("_print"), F.lit(mine).alias("_gold"))
        # not a semi-join, which would go below the numbers and compute them twice; a date has one row in ``wrong``
        same = F.col("dt").eqNullSafe(F.col("_dt")) & F.array_contains("_groups", _group_of("_print"))
        return rows.join(wrong, same).drop("_dt", "_groups")

    both = side(gold, 1).unionByName(side(staging, 0)).groupBy("dt", *keys, "_print").agg(
        F.count_if(F.col("_gold") == 1).alias("gold_rows"), F.count_if(F.col("_gold") == 0).alias("staging_rows")
    )
    return both.where("gold_rows <> staging_rows").drop("_print")


def audit_rows(
    evaluated: DataFrame, *, brand: str, ingestion_date: str, source: str, destination: str,
    start: Column, end: Column, notes: dict[str, str] | None = None, event_type: str = EVENT_TYPE,
) -> DataFrame:
    """The 13-column audit row of every evaluated table."""
    note_fields = [F.lit(v).alias(k) for k, v in sorted((notes or {}).items())]
    event_notes = F.to_json(F.struct(
        F.lit("table").alias("SOURCE_TYPE"), F.lit("file").alias("DESTINATION_TYPE"), *note_fields,
        F.nullif(F.col("reason"), F.lit("")).alias("FAILURE_REASON"),
    ))
    return evaluated.select(
        F.lit(brand).alias("BRAND_SID"), F.lit(event_type).alias("EVENT_TYPE"), F.lit(DATA_CATEGORY).alias("DATA_CATEGORY"),
        F.lit(ingestion_date).alias("INGESTION_DATE"), F.col("entity_type").alias("ENTITY_TYPE"),
        F.col("source_count").alias("SOURCE_COUNT"), F.col("destination_count").alias("DESTINATION_COUNT"),
        F.lit(source).alias("SOURCE"), F.lit(destination).alias("DESTINATION"),
        start.cast("timestamp").alias("EVENT_START_TIME"), end.cast("timestamp").alias("EVENT_END_TIME"),
        F.col("event_result").alias("EVENT_RESULT"), event_notes.alias("EVENT_NOTES"),
    ).to(AUDIT_LAYOUT)
