"""Which files make up the tables below a folder: a log that only grows.

A run adds its files to the tables' partition folders, under names of its own, and then adds one entry to the log that lists them
and the partitions that have become empty.  Readers take the files that the log names, so they see all of a run or nothing
of it, and a crash at any place leaves what was there before.  Nothing is moved.  An entry is put at its number only if none is
there (the file system's rename without overwriting); who comes second takes the next number.  Files that an entry replaces
are removed afterwards; what a crashed run left is removed by ``vacuum``.

A folder's tables may be written side by side.  Two runs at once into one table are not supported, as Spark's file writers
do not support them either.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import islice

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from retailgold.session import configure, drop_scratch, file_system, scratch_dir

LOG = "_manifest"
LISTED = "table string, partition string, path string, size bigint, part int, file_name string"
ENTRY = f"version bigint, {LISTED}"
# files that the driver holds at once; a run of more files lists them beside its entry, which then names that list
MOST_FILES = 10_000
# every so many entries the whole state is written, so that readers fold few of them
WHOLE_EVERY = 32


def new_run() -> str:
    return uuid.uuid4().hex[:12]


def add_files(df: DataFrame, root: str, table: str, by: list[str], run: str, source: str = "parquet", **options) -> None:
    """Write rows into the table's partition folders, in files named after the run; no entry names them yet."""
    fs, folder = file_system(df.sparkSession, f"{root}/{table}")
    fs.mkdirs(folder)
    df.write.mode("append").options(**options).option("mapreduce.output.basename", f"part-{run}").partitionBy(*by).format(source).save(f"{root}/{table}")


def files_of(spark: SparkSession, root: str, tables: Iterable[str], run: str, depth: int = 1) -> DataFrame:
    """(table, partition, path, size) of a run's files, ``depth`` folders below their table; paths from the root on.

    One listing, spread over the cluster; of many files one per group of folders, each written down before the next, because Spark's
    driver holds every file of a listing.
    """
    folders = [f"{root}/{t}" for t in tables]
    if sum(_held(spark, f) for f in folders) <= MOST_FILES:
        return _listing(spark, folders, f"part-{run}-*", depth)
    apart, path = configure(spark.newSession()), scratch_dir(spark, "listing")
    apart.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 32))  # no file is read, so few tasks do
    for group, names in _groups(spark, folders, run, depth):
        _listing(apart, group, names, depth).write.mode("append").parquet(path)
    return spark.read.schema("table string, partition string, path string, size bigint").parquet(path)


def _held(spark: SparkSession, folder: str) -> int:
    """Files below a folder."""
    fs, path = file_system(spark, folder)
    return fs.getContentSummary(path).getFileCount()


def _groups(spark: SparkSession, folders: list[str], run: str, depth: int) -> Iterator[tuple[list[str], str]]:
    """Partition folders of at most ``MOST_FILES`` files together, and the names to list in them.

    A folder of more files comes once per last digit of its files' task numbers, or its last two.
    """
    named = "-".join("?" * k for k in (8, 4, 4, 4, 12))  # the writer's name of its job follows the task's number
    group, held = [], 0
    for folder in folders:
        fs, path = file_system(spark, folder + "/*=*" * depth)
        for found in fs.globStatus(path) or []:
            name, n = found.getPath().toString(), _held(spark, found.getPath().toString())
            if n > MOST_FILES:
                digits = 1 if n <= 5 * MOST_FILES else 2
                yield from (([name], f"part-{run}-*{i:0{digits}d}-{named}*") for i in range(10**digits))
                continue
            if group and held + n > MOST_FILES:
                yield group, f"part-{run}-*"
                group, held = [], 0
            group.append(name)
            held += n
    if group:
        yield group, f"part-{run}-*"


def _listing(spark: SparkSession, folders: list[str], names: str, depth: int) -> DataFrame:
    found = spark.read.format("binaryFile").option("pathGlobFilter", names).option("recursiveFileLookup", True).load(folders)
    steps = F.split("path", "/")
    return found.select(
        F.element_at(steps, -2 - depth).alias("table"), F.array_join(F.slice(steps, -1 - depth, depth), "/").alias("partition"),
        F.array_join(F.slice(steps, -2 - depth, depth + 2), "/").alias("path"), F.col("length").alias("size"),
    )


def _versions(spark: SparkSession, log: str) -> tuple[list[int], int, bool]:
    """Numbers of the entries, the last one of which there is a whole state (-1: none), and whether entries may name lists."""
    fs, folder = file_system(spark, log)
    if not fs.exists(folder):
        return [], -1, False
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    whole = [int(n.removeprefix("whole-")) for n in names if n.startswith("whole-") and fs.exists(_path(spark, f"{log}/{n}/_SUCCESS"))]
    entries = sorted(int(n.removesuffix(".json")) for n in names if n[0].isdigit() and n.endswith(".json"))
    return entries, max(whole, default=-1), any(n.startswith("files-") for n in names)


def _path(spark: SparkSession, text: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(text)


def _entry(log: str, version: int) -> str:
    return f"{log}/{version:012d}.json"


def state(spark: SparkSession, log: str) -> DataFrame:
    """The files that the tables consist of: of each partition those of its last entry."""
    versions, whole, lists = _versions(spark, log)
    paths = [_entry(log, v) for v in versions if v > whole]
    rows = spark.read.schema(ENTRY).json(paths) if paths else spark.createDataFrame([], ENTRY)
    if lists:  # a line without a table names a list of the entry's files
        named = rows.where("table is null").select("version", "path").collect()
        rows = rows.where("table is not null")
        for r in named:
            rows = rows.unionByName(spark.read.schema(LISTED).parquet(f"{log}/{r['path']}").withColumn("version", F.lit(r["version"])))
    if whole >= 0:
        rows = rows.unionByName(spark.read.schema(ENTRY).parquet(f"{log}/whole-{whole:012d}"))
    last = F.max("version").over(Window.partitionBy("table", "partition"))
    return rows.withColumn("_last", last).where("version = _last and path is not null").drop("_last")


def exists(spark: SparkSession, log: str) -> bool:
    return bool(_versions(spark, log)[0])


@dataclass(frozen=True)
class Committed:
    """The entry's number, and the files that it took out of the tables."""

    version: int
    replaced: Iterable[str]


def commit(
    spark: SparkSession, root: str, files: DataFrame, gone: Callable[[str, str], bool] = lambda table, partition: False,
    tables: Iterable[str] = (), log: str | None = None,
) -> Committed:
    """Make a run's files (``table, partition, path, size`` and, if they are published, ``part, file_name``) the tables'.

    A partition that comes again consists of the new files only; one of ``tables`` that ``gone`` names has none any more; all others
    stay.  The driver sees a row per partition of the tables concerned, and a row per file up to ``MOST_FILES``; more files are listed
    by the executors.
    """
    log = log or f"{root}/{LOG}"
    added, apart = [r.asDict() for r in files.limit(MOST_FILES + 1).collect()], None
    if len(added) > MOST_FILES:
        apart, added = f"files-{uuid.uuid4().hex}", []
        files = files if "part" in files.columns else files.withColumns({"part": F.lit(None).cast("int"), "file_name": F.lit(None).cast("string")})
        files.select("table", "partition", "path", "size", "part", "file_name").write.parquet(f"{log}/{apart}")
        mine = {tuple(r) for r in spark.read.schema(LISTED).parquet(f"{log}/{apart}").select("table", "partition").distinct().collect()}
    else:
        mine = {(r["table"], r["partition"]) for r in added}
    concerned = {t for t, _ in mine} | set(tables)
    while True:
        versions, _, _ = _versions(spark, log)
        version = max(versions, default=-1) + 1
        before = state(spark, log).where(F.col("table").isin(sorted(concerned))).select("table", "partition", "path") if versions else None
        there = [] if before is None else before.limit(MOST_FILES + 1).collect()
        if len(there) > MOST_FILES:
            known = {tuple(r) for r in before.select("table", "partition").distinct().collect()}
        else:
            known = {(r["table"], r["partition"]) for r in there}
        emptied = {(t, p) for t, p in known if (t, p) not in mine and gone(t, p)}
        lines = [{"version": version, **r} for r in added] + [{"version": version, "table": t, "partition": p} for t, p in sorted(emptied)]
        lines += [{"version": version, "path": apart}] if apart else []
        if _put(spark, log, version, "".join(json.dumps(line) + "\n" for line in lines)):
            break
    if version % WHOLE_EVERY == WHOLE_EVERY - 1:
        state(spark, log).coalesce(1).write.mode("overwrite").parquet(f"{log}/whole-{version:012d}")
    if len(there) > MOST_FILES:
        left = spark.createDataFrame(sorted(mine | emptied), "table string, partition string")
        return Committed(version, (r["path"] for r in _one_by_one(before.join(F.broadcast(left), ["table", "partition"]).select("path"))))
    return Committed(version, [r["path"] for r in there if (r["table"], r["partition"]) in mine | emptied])


def _one_by_one(rows: DataFrame) -> Iterator:
    """The rows of a table that is too large for the driver, in some order; they are written down first."""
    path = scratch_dir(rows.sparkSession, "rows")
    rows.write.parquet(path)
    yield from rows.sparkSession.read.schema(rows.schema).parquet(path).toLocalIterator()
    drop_scratch(rows.sparkSession, path)


def _put(spark: SparkSession, log: str, version: int, text: str) -> bool:
    """Write an entry; False if its number is taken."""
    fs, folder = file_system(spark, log)
    fs.mkdirs(folder)
    draft, target = _path(spark, f"{log}/.{uuid.uuid4().hex}"), _path(spark, _entry(log, version))
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark.sparkContext._jvm
    names = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(folder).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    plain = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)  # without overwriting
    try:
        names.rename(fs.makeQualified(draft), fs.makeQualified(target), plain)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def remove(spark: SparkSession, root: str, paths: Iterable[str]) -> None:
    """Delete files, and the partition folders that they leave empty."""
    fs, _ = file_system(spark, root)

    def delete(path: str) -> str:
        fs.delete(_path(spark, f"{root}/{path}"), False)
        return path.rsplit("/", 1)[0]

    paths, folders = iter(paths), set()
    with ThreadPoolExecutor(max_workers=16) as pool:
        while some := list(islice(paths, MOST_FILES)):
            folders |= set(pool.map(delete, some))
    for folder in folders:
        while "=" in folder.rsplit("/", 1)[-1] and not fs.listStatus(_path(spark, f"{root}/{folder}")):
            fs.delete(_path(spark, f"{root}/{folder}"), False)
            folder = folder.rsplit("/", 1)[0]


def discard(spark: SparkSession, root: str, tables: Iterable[str], run: str) -> None:
    """Remove the files of a run that has added no entry."""
    fs, _ = file_system(spark, root)
    there = [t for t in tables if fs.exists(_path(spark, f"{root}/{t}"))]
    if there:
        remove(spark, root, (r["path"] for r in _one_by_one(files_of(spark, root, there, run).select("path"))))


def vacuum(spark: SparkSession, root: str, table: str, log: str | None = None, depth: int = 1) -> list[str]:
    """Remove the files of a table that its log does not name; for use while no run writes.  Gives their paths."""
    current = state(spark, log or f"{root}/{LOG}").where(F.col("table") == table).select("path")
    left = [r["path"] for r in files_of(spark, root, [table], "*", depth).join(current, "path", "left_anti").select("path").collect()]
    remove(spark, root, left)
    return left


def current_parts(spark: SparkSession, root: str, table: str) -> Iterator[list[str]]:
    """Full paths of a table's files, at most ``MOST_FILES`` at once; one empty list where it has none."""
    rows = state(spark, f"{root}/{LOG}").where(F.col("table") == table).select("path")
    first = rows.limit(MOST_FILES + 1).collect()
    if len(first) <= MOST_FILES:
        yield sorted(f"{root}/{r['path']}" for r in first)
        return
    files = _one_by_one(rows.orderBy("path"))
    while some := [f"{root}/{r['path']}" for r in islice(files, MOST_FILES)]:
        yield some


def current_files(spark: SparkSession, root: str, table: str, log: str | None = None, keep: Callable[[str], bool] = lambda partition: True) -> list[str]:
    """Full paths of a table's files, of the partitions that ``keep`` names."""
    rows = state(spark, log or f"{root}/{LOG}").where(F.col("table") == table).select("partition", "path").collect()
    return sorted(f"{root}/{r['path']}" for r in rows if keep(r["partition"]))
