"""Gold files: gzip pipe-delimited files of a fixed number of rows per date, numbered within the date."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailgold import snapshots
from retailgold.folders import value_of
from retailgold.functions import partition_value, shift_day

# --- fixed values ----------------------------------------------------------------------------------------------------
PUBLISHED_NAMES = {"transaction_item": "line_item"}
FILE_OPTIONS = {"sep": "|", "header": "true", "compression": "gzip", "quote": '"', "escape": '"', "emptyValue": ""}
# --- end of fixed values ---------------------------------------------------------------------------------------------

ROWS_PER_FILE = 5_000_000
BROADCAST_PLACES = 100_000
# a task writes small files one after the other, up to so many rows and files
TASK_ROWS = 100_000
TASK_FILES = 1_000
PARTITION = "partition_col"


def store(df: DataFrame, path: str) -> DataFrame:
    """Write a built table as Parquet and give it back as a scan; what ``write_gold`` and ``publish`` take.

    Each file is sorted by date, so a date's rows follow each other in it.
    """
    df.sortWithinPartitions(PARTITION).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def date_sizes(stored: DataFrame) -> dict[int | None, int]:
    """Rows per date."""
    return {r[PARTITION]: r["n"] for r in stored.groupBy(PARTITION).agg(F.count(F.lit(1)).alias("n")).collect()}


def in_parts(stored: DataFrame, rows_per_file: int, sizes: dict[int | None, int], parts_per_task: int = 1) -> DataFrame:
    """One task per date and part, each part but a date's last with exactly ``rows_per_file`` rows.

    With ``parts_per_task`` a task holds so many parts of a date, in their order; a writer that ends a file after ``rows_per_file`` rows
    writes just those parts.
    ``stored`` comes from ``store``.  A row's rank within its date is its place in its file, less that of the date's first row there,
    after the rows of the date's earlier files: no window ranks it, it is the same whenever a task runs again, and identical
    rows are spread like others.  The places come from one scan of the date column, a row per file and date.
    """
    starts, total = [], 0
    for day in sorted(sizes, key=lambda d: (d is not None, d or 0)):
        starts.append((day, total))
        total += -(-sizes[day] // (rows_per_file * parts_per_task))
    spark = stored.sparkSession
    first = spark.createDataFrame(starts, "_date int, _first int")  # a row per calendar day
    placed = stored.withColumns({"_file": F.col("_metadata.file_name"), "_row": F.col("_metadata.row_index")})
    before = Window.partitionBy(PARTITION).orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = placed.groupBy(PARTITION, "_file").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_top"))
    files = files.select(
        F.col(PARTITION).alias("_d"), F.col("_file").alias("_f"), (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_top")).alias("_shift")
    ).join(first, F.col("_d").eqNullSafe(F.col("_date")))
    if len(stored.inputFiles()) * len(sizes) <= BROADCAST_PLACES:  # rows of ``files`` at most
        files = F.broadcast(files)
    ranked = placed.join(files, F.col(PARTITION).eqNullSafe(F.col("_d")) & (F.col("_file") == F.col("_f")))
    rank = F.col("_row") + F.col("_shift")
    task = F.col("_first") + F.floor(rank / (rows_per_file * parts_per_task)).cast("int")
    dealt = ranked.withColumns({"_task": task, "_part": F.floor(rank / rows_per_file)}).repartitionById(max(1, total), "_task")
    if parts_per_task > 1:
        dealt = dealt.sortWithinPartitions(PARTITION, "_part")
    return dealt.select(*stored.columns)


def stage_gold(
    stored: DataFrame, path: str, table: str, rows_per_file: int, sizes: dict[int | None, int] | None = None, run: str | None = None,
) -> str:
    """Write a table's files, which no reader sees before ``commit_gold``; gives the run they are named after."""
    run = run or snapshots.new_run()
    together = min(TASK_FILES, max(1, TASK_ROWS // rows_per_file))
    parts = in_parts(stored, rows_per_file, date_sizes(stored) if sizes is None else sizes, together)
    snapshots.add_files(parts, path, table, [PARTITION], run, "csv", maxRecordsPerFile=rows_per_file, **FILE_OPTIONS)
    return run


def commit_gold(
    spark: SparkSession, path: str, tables: list[str], run: str, *, schedule: str = "daily", as_of: str | None = None, prefix: str = "",
    emptied: Callable[[int], bool] = lambda dt: False,
) -> int:
    """Publish what a run wrote of all tables, in one step; gives the number of the log's entry.

    Written dates replace themselves, dates that ``emptied`` names go, others stay with the names they were published under.
    """
    def gone(_: str, partition: str) -> bool:
        value = value_of(partition, PARTITION)
        return value.isdigit() and emptied(int(value))

    files = _named(snapshots.files_of(spark, path, tables, run), schedule, as_of, prefix)
    done = snapshots.commit(spark, path, files, gone, tables)
    snapshots.remove(spark, path, done.replaced)
    return done.version


def write_gold(stored: DataFrame, path: str, table: str, *, rows_per_file: int = ROWS_PER_FILE) -> str:
    """Write a whole table's files, replacing what is there."""
    return publish(stored, path, table, rows_per_file=rows_per_file, emptied=lambda dt: True)


def publish(
    stored: DataFrame, path: str, table: str, *, rows_per_file: int = ROWS_PER_FILE,
    emptied: Callable[[int], bool] = lambda dt: False,
) -> str:
    """Replace the dates in ``stored``, remove those that ``emptied`` names, and leave every other date as it is."""
    commit_gold(stored.sparkSession, path, [table], stage_gold(stored, path, table, rows_per_file), emptied=emptied)
    return f"{path}/{table}"


def _stem(table: Column, dt: Column, schedule: str, as_of: str | None, prefix: str) -> Column:
    first = shift_day(F.lit(as_of), 1) if schedule == "weekly" else shift_day(dt, -1)
    name = table
    for one, other in PUBLISHED_NAMES.items():
        name = F.when(table == one, F.lit(other)).otherwise(name)
    return F.concat_ws("_", F.concat(F.lit(prefix), name), first, dt.cast("string"), F.lit(schedule))


def _named(files: DataFrame, schedule: str, as_of: str | None, prefix: str) -> DataFrame:
    """Files with their number in their date and their published name; all dates' files are numbered from 1."""
    dt = partition_value(F.col("path")).cast("int")
    part = F.row_number().over(Window.partitionBy("table", "partition").orderBy("path"))
    stem = _stem(F.col("table"), dt, schedule, as_of, prefix)
    return files.withColumn("part", part).withColumn("file_name", F.concat(stem, F.format_string("_p%04d", "part"), F.lit(".psv.gz")))


def gold_manifest(df: DataFrame, table: str, *, schedule: str, as_of: str, prefix: str = "") -> DataFrame:
    """Date -> name of the date's data; daily ones carry the day before, weekly ones the day after ``as_of``."""
    dates = df.select(F.col(PARTITION).alias("dt")).distinct()
    name = F.concat(_stem(F.lit(table), F.col("dt"), schedule, as_of, prefix), F.lit(".psv.gz"))
    return dates.select(F.lit(table).alias("entity_type"), "dt", name.alias("file_name"))


def published_files(
    spark: SparkSession, path: str, table: str, *, schedule: str, as_of: str, prefix: str = "",
) -> DataFrame:
    """Every file of a table with the name that a run of this schedule and day would publish it under."""
    files = _named(snapshots.state(spark, f"{path}/{snapshots.LOG}").where(F.col("table") == table), schedule, as_of, prefix)
    return _listed(files, path)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """All files of all tables, each with the name that the run which wrote it published it under."""
    return _listed(snapshots.state(spark, f"{path}/{snapshots.LOG}"), path)


def _listed(files: DataFrame, path: str) -> DataFrame:
    dt = partition_value(F.col("path")).cast("int")
    return files.select(F.col("table").alias("entity_type"), dt.alias("dt"), "part", F.concat(F.lit(f"{path}/"), "path").alias("path"), "size", "file_name")
