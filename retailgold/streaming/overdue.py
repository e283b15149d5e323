"""Completeness as keyed state: dates are reported when they are ready, and when they stay incomplete for too long."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from retailgold.operators import arrivals
from retailgold.operators.arrivals import Routes, required_feeds
from retailgold.schemas import POS_FEEDS
from retailgold.session import share_package, use_keyed_state

READY, OVERDUE = "ready", "overdue"
_STATES = "dt int, brand string, schedule string, state string, missing string, has_settlement boolean, due timestamp"


class _Watch(StatefulProcessor):
    """The state of one date: whether its settlement has come and, per brand and schedule, the feeds seen and the time it is due.

    Its size is fixed however often a file is announced.
    """

    def __init__(self, patience_ms: int) -> None:
        self.patience_ms = patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.settled = handle.getValueState("settled", "settled boolean")
        self.groups = handle.getMapState("groups", "brand string, schedule string", "feeds string, due_ms bigint, reported boolean")

    def _report(self, dt: int, group: tuple, state: str, missing: list[str], due_ms: int) -> Row:
        return Row(dt=dt, brand=group[0], schedule=group[1], state=state, missing=",".join(missing), has_settlement=self.settled.exists(), due_ms=due_ms)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        (dt,) = key
        groups = {tuple(k): tuple(v) for k, v in self.groups.iterator()}
        touched = set()
        for r in rows:
            if r["place"] == arrivals.SETTLEMENT:
                self.settled.update((True,))
                touched |= set(groups)  # a settlement belongs to all brands and schedules
            if r["schedule"] is None:
                continue
            group = (r["brand"], r["schedule"])
            due = r["event_ms"] + self.patience_ms
            feeds, known, reported = groups.get(group, ("", due, False))
            # a date is due from its first file on, whatever order the files are read in
            if not reported and (group not in groups or due < known):
                if group in groups and not any(g != group and v[1] == known for g, v in groups.items()):
                    self.handle.deleteTimer(known)
                known = due
                self.handle.registerTimer(known)
            seen = set(filter(None, feeds.split(",")))
            if required_feeds(r["schedule"]).get(r["feed"]) == r["place"]:
                seen.add(r["feed"])
            groups[group] = (",".join(sorted(seen)), known, reported)
            touched.add(group)
        for group in sorted(touched, key=str):
            self.groups.updateValue(group, groups[group])
            feeds, due, _ = groups[group]
            if self.settled.exists() and len(feeds.split(",")) == len(POS_FEEDS):
                yield self._report(dt, group, READY, [], due)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        (dt,) = key
        now = expiredTimerInfo.getExpiryTimeInMs()
        for group, (feeds, due, reported) in sorted(((tuple(k), tuple(v)) for k, v in self.groups.iterator()), key=str):
            missing = [f for f in POS_FEEDS if f not in feeds.split(",")]
            if due <= now and not reported and (missing or not self.settled.exists()):
                self.groups.updateValue(group, (feeds, due, True))
                yield self._report(dt, group, OVERDUE, missing, due)

    def close(self) -> None:
        pass


def date_states(notifications: DataFrame, patience: timedelta, delay: str, routes: Routes = Routes()) -> DataFrame:
    """(dt, brand, schedule, state, missing, has_settlement, due): a stream of what becomes of the dates.

    ``ready`` comes with every batch in which a complete date has got a file, as in ``stream_completeness``, but nothing that came
    before is read again.  ``overdue`` comes once, when event time is ``patience`` past the date's first file and something is still
    missing; a date may become ready after that.  Event time runs ``delay`` behind the latest notification, and notifications
    older than that, or without a readable time, are left to ``stream_completeness``.  Only real calendar days count.
    """
    spark = notifications.sparkSession
    use_keyed_state(spark)
    share_package(spark)
    routed = arrivals.route(notifications, routes).withColumn("event_time", F.expr("try_cast(event_time as timestamp)"))
    relevant = F.col("schedule").isNotNull() | (F.col("place") == arrivals.SETTLEMENT)
    rows = routed.filter(F.col("dt").isNotNull() & F.col("event_time").isNotNull() & relevant).withWatermark("event_time", delay)
    rows = rows.select("dt", "brand", "schedule", "place", "feed", "event_time", F.unix_millis("event_time").alias("event_ms"))
    watched = rows.groupBy("dt").transformWithState(
        _Watch(int(patience.total_seconds() * 1000)), _STATES.replace("due timestamp", "due_ms bigint"), outputMode="Append", timeMode="EventTime",
    )
    return watched.select("dt", "brand", "schedule", "state", "missing", "has_settlement", F.timestamp_millis("due_ms").alias("due"))


def stream_date_states(
    notifications: DataFrame, out: str, checkpoint: str, patience: timedelta = timedelta(days=1), delay: str = "1 hour", routes: Routes = Routes(),
) -> StreamingQuery:
    """Write ``date_states`` as a table."""
    return (
        date_states(notifications, patience, delay, routes).writeStream.format("parquet").outputMode("append")
        .option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def read_date_states(spark, out: str) -> DataFrame:
    """What ``stream_date_states`` wrote, also while there is nothing to report."""
    return spark.read.schema(_STATES).parquet(out)
