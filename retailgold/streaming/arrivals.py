"""Notification streams: routing (stateless) and completeness per date (a ledger of what has come)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retailgold.operators import arrivals
from retailgold.operators.arrivals import Routes

_LEDGER = "brand string, schedule string, place string, feed string, dt int, batch_id bigint"
_READY = "brand string, schedule string, dt int, batch_id bigint"


def read_notifications(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Notification files as a stream of JSON lines."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _start(stream: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None]) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def stream_arrivals(notifications: DataFrame, out: str, checkpoint: str, routes: Routes = Routes()) -> StreamingQuery:
    """Route the stream into a table of arrivals."""
    return (
        arrivals.route(notifications, routes).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def _append(rows: DataFrame, path: str, batch_id: int, by: list[str]) -> None:
    """Write a batch's rows into the partitions of its own number, so that a replayed batch replaces itself; one file per date."""
    (
        rows.repartition("dt").withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    )


def update_ledger(batch: DataFrame, batch_id: int, ledger: str, routes: Routes) -> DataFrame:
    """Add a batch's arrivals to the ledger; the ready dates among those the batch touched.

    Settlement files are in the ledger like all others, so a date also becomes ready when its settlement comes last.  The
    ledger holds at most one row per brand, schedule, place, feed, date and batch, and is partitioned by date: only touched
    dates are read again.  The touched dates are real calendar days, which bounds what the driver sees of a batch.
    """
    spark = batch.sparkSession
    seen = (
        arrivals.route(batch, routes).filter(F.col("dt").isNotNull() & (F.col("schedule").isNotNull() | (F.col("place") == arrivals.SETTLEMENT)))
        .select("brand", "schedule", "place", "feed", "dt").distinct().persist()
    )
    touched = [r["dt"] for r in seen.select("dt").distinct().collect()]
    if touched:
        _append(seen, ledger, batch_id, ["dt", "batch_id"])
    seen.unpersist()
    if not touched:
        return arrivals.ready(seen)
    known = spark.read.schema(_LEDGER).option("basePath", ledger).parquet(*[f"{ledger}/dt={d}" for d in touched])
    # a replayed batch must not see what came after it
    return arrivals.ready(known.filter(F.col("batch_id") <= batch_id))


def stream_completeness(
    notifications: DataFrame, ledger: str, out: str, checkpoint: str, routes: Routes = Routes(),
) -> StreamingQuery:
    """Write the dates that are ready after each batch, one partition per batch.

    A date that was ready before and got another file is listed again, because it has to be rebuilt.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        _append(update_ledger(batch, batch_id, ledger, routes), out, batch_id, ["batch_id"])

    return _start(notifications, checkpoint, each)


def read_ready(spark: SparkSession, out: str) -> DataFrame:
    """What ``stream_completeness`` wrote, also while no date is ready yet."""
    return spark.read.schema(_READY).parquet(out)
