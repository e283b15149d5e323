"""One gold run: build, validate, and only then publish.

Jobs per run: one count of all staging feeds by date, one list of the tenders' days, per table one write of the built rows
(Parquet, in the shared scratch folder), one aggregate over all that was written, and, once every table has passed, per table
one write of its files; then one entry of the log that readers follow, and the audit log.  Tables that need no other one are built side by side.  The joins run
once; validation and publication read their result.  Checks read the written rows rather than metrics observed during the
write, because a task that is run again after a lost executor would be observed twice.

Readers take the files that the log names (``snapshots``), so all tables change in one step, or none does.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from retailgold import snapshots
from retailgold.folders import value_of
from retailgold.functions import settlement_date
from retailgold.operators import gold, quality
from retailgold.operators.selection import NEVER, SETTLEMENT_AFTER, after_start, in_date_spec, spec_holds
from retailgold.operators.typed import type_feeds
from retailgold.schemas import DIMENSIONS, GOLD_TABLES, POS_FEEDS, STAGING_OF, conform, feed_layout
from retailgold.session import configure, drop_scratch, free_shuffles, scratch_dir
from retailgold.sinks import (
    archive_feed, archive_summary, archived_settlement_files, carry_over_dimensions, commit_gold, read_archive, read_rejects, stage_gold, store, write_audit,
)
from retailgold.sinks.gold_files import ROWS_PER_FILE
from retailgold.sources import read_feed, read_settlement, run_sql, settlement_files


class GateFailure(RuntimeError):
    """A table failed its checks and nothing of the run was published, or its files could not be written.

    ``by_date`` lists the dates whose gold and staging counts differ, ``rejected`` the dates of a run with ``gate_dates`` if all failed.
    """

    def __init__(self, table: str, reason: str, by_date: list[Row], rejected: tuple[RejectedDate, ...] = ()):
        super().__init__(f"{table}: {reason}")
        self.table, self.reason, self.by_date, self.rejected = table, reason, by_date, rejected


@dataclass(frozen=True)
class RejectedDate:
    """A date that was not published, and the first table that failed on it."""

    dt: int | None
    table: str
    reason: str


@dataclass(frozen=True)
class RunResult:
    """Event result and published folder per table, where the list of published files is, and the dates that were left out."""

    results: dict[str, str]
    published: dict[str, str]
    manifest: str | None = None
    rejected: tuple[RejectedDate, ...] = ()


def stage_feeds(
    raw: dict[str, DataFrame], path: str, *, settlement_after: str | None = None, dates: str | None = None,
) -> dict[str, DataFrame]:
    """Archive all raw feeds as Parquet and give them back from there, so that gzip text is parsed once.

    An archive holds earlier dates too: ``run(dates=...)`` picks those to build.  With ``settlement_after`` only settlement
    files dated after that day are taken.  Dates that ``dates`` asks for and a feed does not have are removed from its archive.
    """
    if settlement_after is not None:
        if not raw["settlement"].filter(F.col("file_dt").isNull()).isEmpty():
            raise ValueError("settlement rows of a file without a date in its name")
        raw = {**raw, "settlement": after_start(raw["settlement"], settlement_after, "file_dt")}
    spark = next(iter(raw.values())).sparkSession
    landed = _side_by_side(spark, list(raw), lambda feed: archive_feed(raw[feed], path, feed, lambda dt: spec_holds(dates, dt)))
    for done in landed.values():
        if isinstance(done, Exception):
            raise done
    return landed


def _prune_settlement(feeds: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Keep the settlement of the tenders' days; no other day can match.

    The days are calendar days, so they are few and broadcast; their months pick the archive's partitions while the query
    runs, before any file is opened, the first and last of them its row groups, and nothing of them comes to the driver.
    """
    days = feeds["tenders"].select(F.col("transactiondate").alias("_day")).distinct()
    # the comparison says to the optimizer that the months are worth pruning partitions by
    days = days.select("_day", (F.year("_day") * 100 + F.month("_day")).alias("_month")).filter("_month >= 101")
    # two subqueries that are not merged into one of two fields: only a whole value is pushed into the scan
    first, last = (days.select("_day").orderBy(order("_day")).limit(1).scalar() for order in (F.asc, F.desc))
    out = dict(feeds)
    for name in ("settlement", "settlement_summary"):
        if name not in feeds:
            continue
        rows = feeds[name]
        day = F.col("settlement_day") if "settlement_day" in rows.columns else settlement_date(F.col("store_transaction_date_time"))
        same = F.col("_day") == day
        if "settlement_month" in rows.columns:
            same = same & (F.col("settlement_month") == F.col("_month"))
        out[name] = rows.filter((day >= first) & (day <= last)).join(F.broadcast(days), same, "left_semi")
    return out


def _now() -> datetime:
    return datetime.now(timezone.utc)


def _build(
    spark: SparkSession, feeds: dict[str, DataFrame], table: str, built: dict[str, DataFrame], scratch: str, strict: bool, sql: dict[str, str],
) -> DataFrame:
    """Build one table into the scratch folder and give it back from there."""
    if table in sql:
        df = run_sql(spark, feeds, sql[table])
    elif table == "discounts" and "transaction_item" in built:
        df = gold.discounts(feeds, line_items=built["transaction_item"])
    else:
        df = gold.BUILDERS[table](feeds)
    return store(conform(df, table, unknown=not strict), f"{scratch}/{table}")


def _side_by_side(spark: SparkSession, tables: list[str], step: Callable[[str], object], at_once: int | None = None) -> dict[str, object]:
    """The step's result per table, or what went wrong; all tables at the same time, or ``at_once``.  What they shuffled is freed."""
    def one(table: str) -> object:
        try:
            return step(table)
        except Exception as error:
            return error

    with ThreadPoolExecutor(max_workers=at_once or max(1, len(tables))) as pool:
        out = dict(zip(tables, pool.map(inheritable_thread_target(spark)(one), tables)))
    free_shuffles(spark)
    return out


@dataclass
class _Checked:
    """What the audit log says of a table."""

    table: str
    source_count: int | None
    destination_count: int | None = None
    missing_check_id: int | None = None
    missing_timestamp: int | None = None
    distinct_names: int | None = None
    dates_differing: int | None = None
    name_ratio: float | None = None
    reason: str = ""
    event_result: str = quality.FAILURE
    started: datetime | None = None
    ended: datetime | None = None

    def row(self) -> tuple:
        return (
            self.table, self.source_count, self.destination_count, self.missing_check_id, self.missing_timestamp, self.distinct_names,
            self.dates_differing, self.name_ratio, self.reason, self.event_result, self.started, self.ended,
        )


def run(
    spark: SparkSession, raw: dict[str, DataFrame], out: str, *, audit_path: str, brand: str, schedule: str, as_of: str,
    dates: str | None = None, tables: tuple[str, ...] = GOLD_TABLES, rows_per_file: int = ROWS_PER_FILE,
    strict_contract: bool = False, sql: dict[str, str] | None = None, scratch: str | None = None, gate_dates: bool = False,
    notes: dict[str, str] | None = None, contents: bool = False,
) -> RunResult:
    """Build the gold tables of one brand and schedule from its raw feeds and publish them below ``out``.

    ``dates`` (``d``, ``d1,d2`` or ``d1:d2``) limits every dated feed; ``as_of`` is the run day.  The first table that fails ends the
    run: the audit log gets the rows up to it, ``GateFailure`` is raised and no table is published.  A date that the run covers
    and that has no rows any more goes from the gold.  ``strict_contract`` keeps exactly the contract's columns; otherwise unknown
    columns of a feed follow them.  ``sql`` gives a user's own text, over the typed feeds, for some tables; its rows pass the same
    checks.  Built tables lie below ``scratch`` until their files are written.  With ``gate_dates`` a date on which some table fails is left out
    of all tables and keeps the gold it has; the others are published.  With ``contents`` the tables that carry their feed's rows are
    compared with it row by row, by one sum per date and side.  ``notes`` are added to the audit log's.
    """
    configure(spark)
    sql = sql or {}
    feeds = type_feeds(raw)
    if dates is not None:
        # settlement files are not dated like the feeds: a day's settlement may come in a later file
        feeds = {n: df if n.startswith("settlement") else df.filter(in_date_spec(dates)) for n, df in feeds.items()}
    scratch = scratch_dir(spark, f"gold-{brand}-{schedule}", scratch)
    began, failed, crash, by_date, published = _now(), None, None, [], {}
    staged_rows: dict[str, int | None] = dict.fromkeys(tables)
    checked: list[_Checked] = []
    rejected: dict[int | None, RejectedDate] = {}
    try:
        built: dict[str, object] = {}
        try:
            counts = quality.dated_metrics([quality.staging_side(t, feeds[STAGING_OF[t]]) for t in tables]).collect()
            staged_rows = {t: sum(r["source_count"] for r in counts if r["entity_type"] == t) for t in tables}
            if "tenders" in tables:
                feeds = _prune_settlement(feeds)
        except Exception as error:
            built = dict.fromkeys(tables, error)
        build = lambda t: _build(spark, feeds, t, built, scratch, strict_contract, sql)
        if not built:
            built = _side_by_side(spark, [t for t in tables if t != "discounts"], build)
            if "discounts" in tables and not isinstance(built.get("transaction_item"), Exception):
                built |= _side_by_side(spark, ["discounts"], build)
        # tables up to the first that could not be built are checked, in one job
        whole = []
        for table in tables:
            if isinstance(built[table], Exception):
                crash = built[table]
                break
            whole.append(table)
        evaluated, sizes, rejected = _evaluate(spark, built, whole, counts, gate_dates) if whole else ({}, {}, {})
        if contents and whole:
            _compare(built, feeds, whole, evaluated, set(rejected))
        for table in whole:
            checked.append(_Checked(*evaluated[table], started=began, ended=_now()))
            if checked[-1].event_result == quality.FAILURE:
                failed, crash = checked[-1], None
                both = quality.counts_by_date(built[table], feeds[STAGING_OF[table]])
                by_date = both.filter("difference <> 0").orderBy("dt").collect()
                break
        if failed is None and len(whole) < len(tables):
            failed = _Checked(tables[len(whole)], staged_rows[tables[len(whole)]], reason=str(crash), started=began, ended=_now())
            checked.append(failed)
        if failed is None:
            covered = {r["dt"] for r in counts} - set(rejected)
            name = snapshots.new_run()

            def write(table: str) -> None:
                stage_gold(built[table], out, table, rows_per_file, sizes[table], name)
                drop_scratch(spark, f"{scratch}/{table}")
                free_shuffles(spark)

            # one after the other: each shuffles all of its rows, and what a table's files are made of goes before the next is dealt
            staged = _side_by_side(spark, list(tables), write, at_once=1)
            broken = next((t for t in tables if isinstance(staged[t], Exception)), None)
            if broken is None:
                gone = lambda dt: dt in covered or (dt not in rejected and spec_holds(dates, dt))
                commit_gold(spark, out, list(tables), name, schedule=schedule, as_of=as_of, emptied=gone)
                published = {t: f"{out}/{t}" for t in tables}
            else:
                crash = staged[broken]
                for c in checked:  # what passed is not published either
                    c.event_result, c.ended = quality.FAILURE, _now()
                    c.reason = str(crash) if c.table == broken else f"not published, because {broken} could not be written"
                failed = next(c for c in checked if c.table == broken)
                snapshots.discard(spark, out, tables, name)
        manifest = f"{out}/{snapshots.LOG}" if published else None
        log = spark.createDataFrame([c.row() for c in checked], f"{quality.CHECKED_LAYOUT}, started timestamp, ended timestamp")
        write_audit(quality.audit_rows(
            log, brand=brand, ingestion_date=f"{as_of[:4]}-{as_of[4:6]}-{as_of[6:]}", source="staging", destination=out,
            start=F.col("started"), end=F.col("ended"), notes={"SCHEDULE": schedule, "DATES": dates or "all", **(notes or {})},
        ), audit_path)
        if failed is not None:
            raise GateFailure(failed.table, failed.reason, by_date, tuple(rejected.values())) from crash
        return RunResult({c.table: c.event_result for c in checked}, published, manifest, tuple(rejected.values()))
    finally:
        drop_scratch(spark, scratch)


def _evaluate(
    spark: SparkSession, built: dict[str, DataFrame], tables: list[str], counts: list[Row], gate_dates: bool = False,
) -> tuple[dict[str, tuple], dict[str, dict[int | None, int]], dict[int | None, RejectedDate]]:
    """The verdict per table, the rows per date of each, and the dates left out; a row per table and calendar day comes to the driver.

    A verdict speaks of the dates that are not left out.  The sizes are what a publishing write joins its rows with, so a date
    that is not among them is not written.
    """
    measured = quality.dated_metrics([quality.gold_side(t, built[t]) for t in tables]).collect()
    staged = [r for r in counts if r["entity_type"] in tables]
    both = [tuple(r) for r in measured + staged]
    rejected: dict[int | None, RejectedDate] = {}
    if gate_dates:
        failing = quality.failing_dates(quality.dated_metrics([spark.createDataFrame(both, quality.DATED_LAYOUT)])).collect()
        for r in sorted(failing, key=lambda r: tables.index(r["entity_type"])):
            rejected.setdefault(r["dt"], RejectedDate(r["dt"], r["entity_type"], r["reason"]))
        dated = {r["dt"] for r in measured + staged if r["source_count"] + r["destination_count"]}
        if rejected and dated - set(rejected):
            left = [x for x in both if x[1] not in rejected]
            empty = [t for t in tables if not sum(r["destination_count"] for r in measured if r["entity_type"] == t and r["dt"] not in rejected)]
            # a table whose rows were all on dates left out has none to publish the others with
            for dt in dated - set(rejected) if empty else ():
                rejected[dt] = RejectedDate(dt, empty[0], "zero rows")
            both = left
    verdicts = quality.evaluate(quality.summed(quality.dated_metrics([spark.createDataFrame(both, quality.DATED_LAYOUT)]), tuple(tables))).collect()
    sizes: dict[str, dict[int | None, int]] = defaultdict(dict)
    for r in measured:
        if r["destination_count"] and r["dt"] not in rejected:
            sizes[r["entity_type"]][r["dt"]] = r["destination_count"]
    return {r["entity_type"]: tuple(r) for r in verdicts}, sizes, rejected


def _compare(
    built: dict[str, DataFrame], feeds: dict[str, DataFrame], tables: list[str], evaluated: dict[str, tuple], rejected: set[int | None],
) -> None:
    """Fail the tables that do not carry just their feed's rows; one job for all of them, a row per date that differs."""
    sides = [
        quality.contents_by_date(built[t], feeds[STAGING_OF[t]]).where("not same").select(F.lit(t).alias("entity_type"), "dt")
        for t in tables if t in quality.CARRIED_TABLES
    ]
    wrong: dict[str, int] = defaultdict(int)
    for r in reduce(DataFrame.unionByName, sides).collect() if sides else ():
        if r["dt"] not in rejected:
            wrong[r["entity_type"]] += 1
    for table, n in wrong.items():
        *measures, reason, _ = evaluated[table]
        reason = "; ".join(filter(None, [reason, f"rows of {n} dates are not those of staging"]))
        evaluated[table] = (*measures, reason, quality.FAILURE)


def run_paths(
    spark: SparkSession, staging: str, settlement: str | list[str], archive: str, out: str, *, dates: str, schedule: str,
    settlement_after: str | None = None, dimensions: str | None = None, summarise: bool = False, **options,
) -> RunResult:
    """``run`` over feed files: ``staging/<feed>/dt=<date>/`` and settlement files by glob, landed in ``archive`` first.

    Only the folders of ``dates`` are read.  Settlement files that are archived already are not read again, nor are those up to
    ``settlement_after`` (by default the start day of a daily run; a weekly run takes none and uses what is archived).
    With ``summarise`` each settlement file is summarised once, when it is landed, and the tenders take the summaries.
    Lines with more or fewer fields than their header are landed apart (``read_rejects``), and their number is in the audit notes.
    ``dimensions`` is where a daily run leaves its dimensions for the weekly one, which takes them from there.  ``options`` are
    those of ``run``.
    """
    weekly = schedule == "weekly"
    if weekly and dimensions is None:
        raise ValueError("a weekly run takes its dimensions from the folder that the daily runs leave them in")
    feeds = [f for f in POS_FEEDS if not (weekly and f in DIMENSIONS)]
    raw = {feed: read_feed(spark, staging, feed, dates=dates, rejects=True) for feed in feeds}
    if weekly:
        raw |= {f: read_archive(spark, dimensions, f, feed_layout(f)).filter(in_date_spec(dates)) for f in DIMENSIONS}
    asked = lambda dt: spec_holds(dates, dt)
    staged = stage_feeds(raw, archive, dates=dates)
    after = SETTLEMENT_AFTER[schedule] if settlement_after is None else settlement_after
    staged["settlement"] = stage_settlement(spark, settlement, archive, after)
    if summarise:
        staged["settlement_summary"] = stage_summary(spark, staged["settlement"], archive)
    if not weekly and dimensions is not None:
        carry_over_dimensions({f: staged[f].filter(in_date_spec(dates)) for f in DIMENSIONS}, dimensions, asked)
    days = lambda feed, partition: feed == "settlement" or spec_holds(dates, int(value_of(partition, "dt") or 0))
    aside = {r["feed"]: r["n"] for r in read_rejects(spark, archive, feeds, days).groupBy("feed").agg(F.count("*").alias("n")).collect()}
    notes = {**options.pop("notes", {}), "REJECTED_ROWS": ",".join(f"{f}={aside[f]}" for f in feeds if f in aside) or "none"}
    return run(spark, staged, out, dates=dates, schedule=schedule, notes=notes, **options)


def stage_settlement(spark: SparkSession, paths: str | list[str], archive: str, after: str) -> DataFrame:
    """Land the settlement files dated after a day that are not archived yet, and give back the whole archive."""
    known = archived_settlement_files(spark, archive)
    new = [] if after == NEVER else [path for path, day in settlement_files(spark, paths).items() if day > after and day not in known]
    rows = read_settlement(spark, new, rejects=True) if new else spark.createDataFrame([], feed_layout("settlement")).withColumn("file_dt", F.lit(None).cast("int"))
    return archive_feed(rows, archive, "settlement")


def stage_summary(spark: SparkSession, settlement: DataFrame, archive: str) -> DataFrame:
    """Summarise the archived settlement files that have no summary yet, and give back the summaries of all."""
    known = sorted(int(d) for d in archived_settlement_files(spark, archive, "settlement_summary") if d and d.isdigit())
    new = settlement.where(~F.col("file_dt").isin(known)) if known else settlement
    return archive_summary(new, archive)
