"""Delimited-file scans."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailgold import snapshots
from retailgold.folders import partitions, value_of
from retailgold.functions import date_from_name
from retailgold.operators.selection import in_date_spec, real_day, spec_holds
from retailgold.schemas import DT, NEEDED_COLUMNS, feed_layout, gold_layout
from retailgold.session import configure

NULL_TEXT = "\\N"
SMALL_FILE = 1 << 20
REJECTED = "_rejected"


def _file_day() -> Column:
    return date_from_name(F.col("_metadata.file_name")).try_cast("int")


def _reader(spark: SparkSession, sep: str, quote_escape: str = '"') -> DataFrameReader:
    return (
        spark.read.option("sep", sep).option("header", True).option("nullValue", NULL_TEXT).option("escape", quote_escape)
    )


def _scan(spark: SparkSession, path, sep: str, schema: T.StructType | None, quote_escape: str = '"') -> DataFrame:
    """Without a schema the first file's header names the columns.  With one, a file with another header is an error."""
    reader = _reader(spark, sep, quote_escape)
    if schema is not None:
        reader = reader.schema(schema).option("enforceSchema", False)
    return reader.csv(path)


def first_lines(spark: SparkSession, paths: list[str]) -> dict[str, str]:
    """File -> its first line that is not blank, of every file below the paths; a file without one is left out.

    A large file has a task of its own, which ends with the file's first line.  Small files share tasks and are read to their end,
    which costs less than the new Python worker that Spark starts after a task that stopped early.  (An RDD, because a DataFrame has
    no limit per partition.)
    """
    if not paths:
        return {}

    def first(rows: Iterator[Row]) -> Iterator[tuple[str, str]]:
        found = None  # a file's rows follow each other
        for value, path, size in rows:
            if path != found and value.strip():
                found = path
                yield unquote(path), value
                if size > SMALL_FILE:
                    return

    apart = configure(spark.newSession())  # other sizes of tasks only here
    size = F.col("_metadata.file_size")
    lines = apart.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), size.alias("size"))
    out: dict[str, str] = {}
    for which, most, each in ((size <= SMALL_FILE, 1 << 32, 1 << 22), (size > SMALL_FILE, 1 << 40, 1 << 40)):
        apart.conf.set("spark.sql.files.maxPartitionBytes", str(most))
        apart.conf.set("spark.sql.files.openCostInBytes", str(each))
        out |= dict(lines.where(which).rdd.mapPartitions(first).collect())  # a row per file
    return out


def column_names(line: str, sep: str, quote_escape: str = '"') -> tuple[str, ...]:
    """The names in a header line; one that is empty or comes again is told apart by its place."""
    doubled = quote_escape == '"'
    (names,) = csv.reader([line.removeprefix("\ufeff")], delimiter=sep, doublequote=doubled, escapechar=None if doubled else quote_escape)
    plain = [n.lower() for n in names]
    return tuple(f"_c{i}" if not n else f"{n}{i}" if plain.count(n.lower()) > 1 else n for i, n in enumerate(names))


def _headers(spark: SparkSession, paths: list[str], sep: str, quote_escape: str) -> dict[tuple[str, ...], list[str]]:
    """Files by the names in their header."""
    by: dict[tuple[str, ...], list[str]] = {}
    for path, line in sorted(first_lines(spark, paths).items()):
        by.setdefault(column_names(line, sep, quote_escape), []).append(path)
    return by


def _by_header(
    spark: SparkSession, paths: list[str], sep: str, feed: str, quote_escape: str = '"', base: str | None = None, rejects: bool = False,
) -> DataFrame:
    """One scan per distinct header, put together by column name; a column that a file lacks is NULL there.

    A header without a column of the feed is an error that names its files.
    """
    scans = []
    wanted = {n.lower() for n in NEEDED_COLUMNS[feed].split()}
    for names, group in _headers(spark, paths, sep, quote_escape).items():
        if lacking := sorted(wanted - {n.lower() for n in names}):
            raise ValueError(f"{feed}: no {lacking} in {group[:5]}")
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names if base is None or n.lower() != "dt"])
        if rejects:
            schema = schema.add(REJECTED, T.StringType())
        if base is not None:
            schema = schema.add(DT)
        reader = _reader(spark, sep, quote_escape).schema(schema).option("enforceSchema", False).option("columnNameOfCorruptRecord", REJECTED)
        if base is not None:
            reader = reader.option("basePath", base)
        rows = reader.csv(group)
        if base is None:
            rows = rows.withColumn("file_dt", _file_day())
        scans.append(rows)
    if scans:
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    empty = spark.createDataFrame([], feed_layout(feed))
    if rejects:
        empty = empty.withColumn(REJECTED, F.lit(None).cast("string"))
    return empty if base is not None else empty.withColumn("file_dt", F.lit(None).cast("int"))


def read_feed(
    spark: SparkSession, path: str, feed: str, *, declared: bool = False, escape: str = '"', dates: str | None = None,
    rejects: bool = False,
) -> DataFrame:
    """One pipe-delimited feed below ``path/feed``, all columns text, plus ``dt`` from the ``dt=`` directories.

    Each file's header names its columns, so new ones pass through and their order may change from file to file; only the
    first lines are read for that.  ``dates`` leaves other dates' folders unread.  With ``declared`` the documented
    layout is used instead and every file's header is compared with it.  ``escape='\\'`` reads quotes the way older runs did.
    With ``rejects`` a column ``_rejected`` holds the line of every row that has more or fewer fields than its file's header; an
    archive that is landed with it sets such rows aside (``sinks.archive``).
    """
    base = f"{path}/{feed}"
    if declared:
        rows = _scan(spark, base, "|", feed_layout(feed), escape)
        return rows if dates is None else rows.filter(in_date_spec(dates))
    days = [p for p in partitions(spark, base) if dates is None or spec_holds(dates, int(value_of(p, "dt")))]
    return _by_header(spark, [f"{base}/{p}" for p in days], "|", feed, escape, base, rejects)


def settlement_files(spark: SparkSession, paths: str | list[str]) -> dict[str, str]:
    """Path -> date in the name of every settlement file; a name without a real day is an error."""
    day = real_day(date_from_name(F.col("name")))
    listed = list_files(spark, paths).select("path", "name", day.alias("day")).collect()  # one row per file
    if bad := sorted(r["name"] for r in listed if r["day"] is None):
        raise ValueError(f"settlement files without a date in their name: {bad[:5]}")
    return {r["path"]: str(r["day"]) for r in listed}


def read_settlement(spark: SparkSession, paths: str | list[str], *, declared: bool = False, rejects: bool = False) -> DataFrame:
    """All comma-delimited settlement files that a glob (or several) names, with the date in the file name as ``file_dt``.

    Each file's own header names its columns, as for the feeds.
    """
    if declared:
        return _scan(spark, paths, ",", feed_layout("settlement")).withColumn("file_dt", _file_day())
    return _by_header(spark, [paths] if isinstance(paths, str) else paths, ",", "settlement", rejects=rejects)


def read_gold(spark: SparkSession, path: str, table: str, files: list[str] | None = None) -> DataFrame:
    """Published gold files with ``partition_col`` from their directories; the contract's columns are typed.

    The files are those that the log next to the tables names, or all below the folder where there is no log.  Each file's own
    header names its columns: a column that a date does not have is NULL there.  ``files`` are those of the table to read, out of
    ``snapshots.current_parts``: Spark's driver holds every file that it reads, so a table of very many is read part by part.
    """
    types = {f.name.lower(): f.dataType for f in gold_layout(table)}
    base = f"{path}/{table}"
    if files is None:
        files = snapshots.current_files(spark, path, table) if snapshots.exists(spark, f"{path}/{snapshots.LOG}") else [base]
    scans = []
    for names, group in _headers(spark, files, "|", '"').items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names]).add("partition_col", T.IntegerType())
        scans.append(_reader(spark, "|").schema(schema).option("enforceSchema", False).option("basePath", base).csv(group))
    if not scans:
        return spark.createDataFrame([], gold_layout(table).add("partition_col", T.IntegerType()))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
    return rows.select(*[
        F.col(f"`{c}`").try_cast(types[c.lower()]).alias(c) if c.lower() in types else F.col(f"`{c}`")
        for c in rows.columns
    ])


def list_files(spark: SparkSession, path: str | list[str], name_prefix: str | None = None) -> DataFrame:
    """Files below a path as rows (path, name, size, modified); file contents are not read."""
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
        .select(
            "path", F.element_at(F.split("path", "/"), -1).alias("name"),
            F.col("length").alias("size"), F.col("modificationTime").alias("modified"),
        )
    )
    return files if name_prefix is None else files.filter(F.col("name").startswith(name_prefix))
