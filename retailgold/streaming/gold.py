"""Incremental gold: rebuild the dates that have become complete, and only those."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from retailgold.operators.arrivals import Routes
from retailgold.plans.gold_run import GateFailure, RejectedDate, run
from retailgold.schemas import GOLD_TABLES
from retailgold.streaming.arrivals import _start, update_ledger

_REJECTED = "brand string, schedule string, dt int, entity_type string, reason string, batch_id bigint"


def stream_gold(
    notifications: DataFrame, feeds: Callable[[str, str], dict[str, DataFrame]], *, ledger: str, out: str, rejected: str,
    audit_path: str, checkpoint: str, tables: tuple[str, ...] = GOLD_TABLES, routes: Routes = Routes(),
) -> StreamingQuery:
    """Build, check and publish every newly ready date of every brand and schedule.

    ``feeds(brand, schedule)`` gives the raw feeds.  A replayed batch finds the same ready dates and overwrites the same
    date partitions.  A brand's ready dates are one run; dates on which a table fails are left out of it and written to
    ``rejected`` with the reason, and the stream goes on.  A rejected date is run again when another of its files comes.  Where
    rows of some date cannot be computed at all, the dates are halved until those are found.  Other errors stop the stream before
    its batch is committed.
    """
    def each(batch: DataFrame, batch_id: int) -> None:
        spark, bad = batch.sparkSession, []
        ready = update_ledger(batch, batch_id, ledger, routes).collect()
        for brand, schedule in sorted({(r["brand"], r["schedule"]) for r in ready}):
            dates = sorted(r["dt"] for r in ready if (r["brand"], r["schedule"]) == (brand, schedule))

            def publish(part: list[int], brand: str = brand, schedule: str = schedule) -> Iterable[RejectedDate]:
                return run(
                    spark, feeds(brand, schedule), f"{out}/{brand}/{schedule}", audit_path=audit_path, brand=brand, schedule=schedule,
                    as_of=str(part[-1]), dates=",".join(map(str, part)), tables=tables, gate_dates=True,
                ).rejected

            bad += [(brand, schedule, r.dt, r.table, r.reason, batch_id) for r in _rejected(publish, dates)]
        rows = spark.createDataFrame(bad, _REJECTED).coalesce(1)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(rejected)

    return _start(notifications, checkpoint, each)


def _rejected(publish: Callable[[list[int]], Iterable[RejectedDate]], dates: list[int]) -> list[RejectedDate]:
    """The dates that were not published; those of a run that failed as a whole are tried in halves."""
    try:
        return list(publish(dates))
    except GateFailure as failure:
        if failure.rejected:
            return list(failure.rejected)
        if len(dates) == 1:
            return [RejectedDate(dates[0], failure.table, failure.reason)]
        half = len(dates) // 2
        return _rejected(publish, dates[:half]) + _rejected(publish, dates[half:])


def read_rejected(spark: SparkSession, rejected: str) -> DataFrame:
    """Dates that failed, each with the table and the reason of the last batch that ran it."""
    rows = spark.read.schema(_REJECTED).parquet(rejected)
    last = F.max_by(F.struct("entity_type", "reason", "batch_id"), "batch_id").alias("last")
    return rows.groupBy("brand", "schedule", "dt").agg(last).select("brand", "schedule", "dt", "last.*")
