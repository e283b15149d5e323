"""Partition folders: what lies below a table."""

from __future__ import annotations

from pyspark.sql import SparkSession

from retailgold.session import file_system


def partitions(spark: SparkSession, path: str, depth: int = 1) -> list[str]:
    """Partition folders below a table as relative paths, such as ``dt=20200101``; at most one per date (and file)."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/*=*" * depth)) or []
    return sorted("/".join(f.getPath().toString().rsplit("/", depth)[1:]) for f in found if f.isDirectory())


def value_of(partition: str, column: str) -> str | None:
    return dict(part.split("=", 1) for part in partition.split("/")).get(column)
