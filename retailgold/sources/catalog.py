"""External tables over staged, archived and gold folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailgold import snapshots
from retailgold.schemas import GOLD_COLUMNS, feed_layout, gold_layout, history_columns

NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def create_external_table(
    spark: SparkSession, name: str, location: str, table: str, *, kind: str = "gold",
) -> DataFrame:
    """Register a folder as an external table and find its date partitions.

    ``kind`` is ``gold`` (contract columns, ``partition_col``), ``staging`` or ``archive`` (feed columns, ``dt``), or ``history``
    (gold files of the older layout in one folder; ``schemas.from_history`` gives them the contract's columns).  Archives are
    Parquet, the others delimited text (commas for settlement).  Partitions come from the log of the folder where there is one.
    """
    if kind == "history":
        fields, partition = T.StructType([T.StructField(old, T.StringType()) for old in history_columns(table).values()]), None
    elif kind == "gold":
        if table not in GOLD_COLUMNS:
            raise ValueError(f"no gold table {table}")
        fields, partition = gold_layout(table), "partition_col"
    elif table != "settlement":
        fields, partition = feed_layout(table), "dt"
    elif kind == "archive":
        fields = feed_layout(table).add("settlement_day", T.DateType()).add("settlement_month", T.IntegerType()).add("file_dt", T.IntegerType())
        partition = "settlement_month, file_dt"
    else:
        fields, partition = feed_layout(table), None
    file_format = "parquet" if kind == "archive" else "csv"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    sep = "," if table == "settlement" else "|"
    options = f"OPTIONS (sep '{sep}', header 'true', nullValue '\\\\N', escape '\"')" if file_format == "csv" else ""
    by_date = f"PARTITIONED BY ({partition})" if partition else ""
    spark.sql(f"CREATE TABLE {name} ({columns}) USING {file_format} {options} {by_date} LOCATION '{location}'")
    log = f"{location}/{snapshots.LOG}" if kind == "archive" else f"{location.rstrip('/').rsplit('/', 1)[0]}/{snapshots.LOG}"
    if partition and kind != "staging" and snapshots.exists(spark, log):
        sync_partitions(spark, name, log, location.rstrip("/").rsplit("/", 1)[-1])
    elif partition:
        spark.sql(f"MSCK REPAIR TABLE {name}")
    return spark.table(name)


def sync_partitions(spark: SparkSession, name: str, log: str, table: str) -> tuple[int, int]:
    """Give an external table the partitions that the log of its folder names; no listing of the folder.

    Gives how many were added and dropped, so after a run it is as many as the run's new and emptied dates.
    """
    wanted = {r["partition"] for r in snapshots.state(spark, log).where(F.col("table") == table).select("partition").distinct().collect()}
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new, gone = sorted(wanted - known), sorted(known - wanted)

    def spec(partition: str) -> str:
        values = (part.split("=", 1) for part in partition.split("/"))
        return "PARTITION (" + ", ".join(f"{k} = {'null' if v == NO_VALUE else int(v)}" for k, v in values) + ")"

    for i in range(0, len(new), 200):
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(map(spec, new[i : i + 200])))
    for i in range(0, len(gone), 200):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS " + ", ".join(map(spec, gone[i : i + 200])))
    return len(new), len(gone)
