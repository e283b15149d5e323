"""Arrival notifications: what came, for which brand, schedule, feed and date, and which dates are complete."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailgold.functions import date_from_name, feed_from_name, file_name
from retailgold.operators.selection import real_day
from retailgold.schemas import DIMENSIONS, POS_FEEDS

_RECORD = "eventTime: string, s3: struct<bucket: struct<name: string>, object: struct<key: string, size: bigint, eTag: string>>"
_NOTICE = f"Records array<struct<{_RECORD}>>"
_ENVELOPE = f"Records array<struct<Sns: struct<Message: string>, {_RECORD}>>"

DAILY, WEEKLY = "daily", "weekly"
REMOTE, STAGED, SETTLEMENT = "remote", "staged", "settlement"


@dataclass(frozen=True)
class Routes:
    """Folders that matter.  The weekly run takes its dimensions from a staging folder the daily run fills."""

    remote: tuple[str, ...] = ("brand_a/daily/", "brand_b/daily/", "brand_a/weekly/", "brand_b/weekly/")
    staged: tuple[str, ...] = ("brand_a/weekly_staging/", "brand_b/weekly_staging/")
    settlement: tuple[str, ...] = ("settlement/",)
    second_brand: str = "brand_b"
    first_brand: str = "brand_a"


def required_feeds(schedule: str) -> dict[str, str]:
    """Feed -> where it has to be, per schedule."""
    if schedule == DAILY:
        return {f: REMOTE for f in POS_FEEDS}
    return {f: STAGED if f in DIMENSIONS else REMOTE for f in POS_FEEDS}


def parse(notifications: DataFrame, value: str = "value") -> DataFrame:
    """JSON text -> one row per record (event_time, bucket, key, size); bad text gives no row.

    A record holds the object itself or, inside a message envelope, the text of a further notification.
    """
    outer = notifications.select(F.explode(F.from_json(F.col(value), _ENVELOPE).getField("Records")).alias("r"))
    inner = F.from_json(F.col("r.Sns.Message"), _NOTICE).getField("Records")
    plain = F.array(F.struct(F.col("r.eventTime").alias("eventTime"), F.col("r.s3").alias("s3")))
    return (
        outer.select(F.explode(F.coalesce(inner, plain)).alias("n"))
        .select(
            F.col("n.eventTime").alias("event_time"), F.col("n.s3.bucket.name").alias("bucket"),
            F.col("n.s3.object.key").alias("key"), F.col("n.s3.object.size").alias("size"),
        )
        .filter(F.col("key").isNotNull())
    )


def malformed(notifications: DataFrame, value: str = "value") -> DataFrame:
    """(value, reason, lost) of every notification that ``parse`` takes less from than it holds; ``lost`` counts records without a key.

    A notification without text, or whose text is no JSON with records, has lost an unknown number (NULL).
    """
    records = F.from_json(F.col(value), _ENVELOPE).getField("Records")
    inner = lambda r: F.transform(F.from_json(r["Sns"]["Message"], _NOTICE).getField("Records"), lambda n: n["s3"]["object"]["key"])
    keys = F.flatten(F.transform(records, lambda r: F.coalesce(inner(r), F.array(r["s3"]["object"]["key"]))))
    lost = F.size(F.filter(keys, lambda k: k.isNull()))
    reason = F.when(F.col(value).isNull(), F.lit("no text")).when(records.isNull(), F.lit("no records")).when(lost > 0, F.lit("records without a key"))
    rows = notifications.select(F.col(value).alias("value"), reason.alias("reason"), F.when(records.isNotNull(), lost).alias("lost"))
    return rows.filter(F.col("reason").isNotNull())


def _starts_with_any(key: Column, prefixes: tuple[str, ...]) -> Column:
    found = F.lit(False)
    for prefix in prefixes:
        found = found | key.startswith(prefix)
    return found


def relevant(arrivals: DataFrame, routes: Routes = Routes()) -> DataFrame:
    """Rows below the known folders; below a staging folder only the dimensions.  Other rows go, row by row."""
    key = F.col("key")
    dimension = F.lit(False)
    for feed in DIMENSIONS:
        dimension = dimension | key.contains(feed)
    return arrivals.filter(
        _starts_with_any(key, routes.remote + routes.settlement) | (_starts_with_any(key, routes.staged) & dimension)
    )


def classify(arrivals: DataFrame, routes: Routes = Routes()) -> DataFrame:
    """Adds brand, schedule (``weekly`` wins over ``daily``; NULL for neither), place, feed and date.

    A settlement file belongs to all brands and schedules, so it has none.  The date is NULL where the name holds no real day.
    """
    key = F.col("key")
    settlement = _starts_with_any(key, routes.settlement)
    return arrivals.select(
        "*",
        F.when(~settlement, F.when(key.contains(routes.second_brand), routes.second_brand).otherwise(routes.first_brand)).alias("brand"),
        F.when(settlement, F.lit(None)).when(F.lower(key).contains(WEEKLY), WEEKLY).when(F.lower(key).contains(DAILY), DAILY).alias("schedule"),
        F.when(settlement, SETTLEMENT).when(_starts_with_any(key, routes.staged), STAGED).otherwise(REMOTE).alias("place"),
        file_name(key).alias("file_name"),
        F.when(settlement, SETTLEMENT).otherwise(feed_from_name(key)).alias("feed"),
        real_day(date_from_name(key)).alias("dt"),
    )


def settled(classified: DataFrame) -> DataFrame:
    """Days whose settlement file has come."""
    return classified.filter((F.col("place") == SETTLEMENT) & F.col("dt").isNotNull()).select("dt").distinct()


def route(notifications: DataFrame, routes: Routes = Routes()) -> DataFrame:
    """Parse, filter and classify; stateless, so the same for a batch and a stream."""
    return classify(relevant(parse(notifications), routes), routes)


def _seen(feed: str) -> Column:
    """Whether a feed's file has come, wherever the group's schedule wants it."""
    hit = F.lit(False)
    for schedule in (DAILY, WEEKLY):
        hit = hit | ((F.col("schedule") == schedule) & (F.col("place") == required_feeds(schedule)[feed]))
    return F.coalesce(F.bool_or((F.col("feed") == feed) & hit), F.lit(False))


def completeness(classified: DataFrame, settlement_dates: DataFrame | None = None) -> DataFrame:
    """Per brand, schedule and date: what is missing and whether the date is ready.

    Without ``settlement_dates`` the settlement files among the arrivals count.
    One flag per required feed instead of a set: the partial aggregate has a fixed size however often a file is announced.
    """
    feeds = classified.filter(F.col("dt").isNotNull() & F.col("schedule").isNotNull()).groupBy("brand", "schedule", "dt").agg(
        *[_seen(f).alias(f"has_{f}") for f in POS_FEEDS]
    )
    days = settled(classified) if settlement_dates is None else settlement_dates.select("dt").distinct()
    return (
        feeds.join(days.withColumn("has_settlement", F.lit(True)), "dt", "left")
        .select(
            "brand", "schedule", "dt",
            F.concat_ws(",", *[F.when(~F.col(f"has_{f}"), f) for f in POS_FEEDS]).alias("missing"),
            F.coalesce("has_settlement", F.lit(False)).alias("has_settlement"),
        )
        .withColumn("ready", (F.col("missing") == "") & F.col("has_settlement"))
    )


def ready(classified: DataFrame, settlement_dates: DataFrame | None = None) -> DataFrame:
    return completeness(classified, settlement_dates).filter("ready").select("brand", "schedule", "dt")


def missing(classified: DataFrame, settlement_dates: DataFrame | None = None) -> DataFrame:
    return completeness(classified, settlement_dates).filter("not ready").select(
        "brand", "schedule", "dt", "missing", "has_settlement"
    )


def pending(arrived: DataFrame, staged: DataFrame) -> DataFrame:
    """Arrived files whose feed and date are not staged yet."""
    return arrived.join(staged.select("feed", "dt").distinct(), ["feed", "dt"], "left_anti")
